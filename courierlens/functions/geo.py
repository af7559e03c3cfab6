"""Great-circle distance with the coordinate rules of the order log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlens.functions.rounding import half_even
from courierlens.settings import DEFAULT


def gps_valid(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Restaurant point non-zero and delivery point above one degree.

    Not-a-number counts as missing.

    The signs differ on purpose: an inverted restaurant point is repaired by
    ``haversine_km``, an inverted delivery point is not a position.
    """
    lat2, lon2 = known(lat2), known(lon2)
    restaurant = F.coalesce((lat1 != 0) & (lon1 != 0), F.lit(True))
    return restaurant & F.coalesce((lat2 > 1) & (lon2 > 1), F.lit(False))


def known(c: Column) -> Column:
    """Null for not-a-number."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def _half_sine_squared(angle: Column) -> Column:
    return F.pow(F.sin(angle / 2.0), 2)


def haversine_km(
    lat1: Column,
    lon1: Column,
    lat2: Column,
    lon2: Column,
    radius_km: float = DEFAULT.earth_radius_km,
) -> Column:
    """Kilometres at two decimals, null where the coordinates are not valid.

    A coordinate that is infinite or not a number has no distance.
    """
    phi1, phi2 = F.radians(F.abs(lat1)), F.radians(F.abs(lat2))
    lambda1, lambda2 = F.radians(F.abs(lon1)), F.radians(F.abs(lon2))
    chord = _half_sine_squared(phi2 - phi1) + F.cos(phi1) * F.cos(
        phi2
    ) * _half_sine_squared(lambda2 - lambda1)
    arc = 2 * F.asin(F.sqrt(F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0))))
    # greatest and least skip nulls, so a missing point must be ruled out here.
    # They take not-a-number for the largest number, too.
    there = lat1.isNotNull() & lon1.isNotNull() & ~F.isnan(chord)
    valid = gps_valid(lat1, lon1, lat2, lon2) & there
    return F.when(valid, half_even(radius_km * arc, 2))
