"""Rounding and averages that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column, places: int) -> Column:
    scale = float(10**places)
    return F.rint(c * scale) / scale


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent as a double, unrounded."""
    return part / whole * 100.0


def scaled_sum(c: Column, places: int) -> Column:
    """Sum of a measured double as whole units of its last decimal place.

    A sum of doubles depends on the order in which partitions are merged; a sum
    of integers does not, so averages and their ties come out the same each run.
    """
    return F.sum(F.round(c * 10**places).cast("bigint"))


def exact_avg(c: Column, places: int = 6) -> Column:
    """Mean of a measured double through its ``scaled_sum``; null when empty."""
    n = F.count(c)
    return F.when(n > 0, scaled_sum(c, places) / (n * float(10**places)))
