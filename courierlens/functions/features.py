"""Service-level and peak-hour features of an order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlens.settings import (
    DEFAULT,
    DINNER_LABEL,
    LUNCH_LABEL,
    OFF_PEAK_LABEL,
    SQL_NON_PEAK_LABEL,
    SQL_UNKNOWN_HOUR_LABEL,
    UNKNOWN,
    WINDOW_NON_PEAK_LABEL,
    WINDOW_PEAK_LABEL,
    SlaConfig,
)


def sla_flag(minutes: Column, threshold: float = DEFAULT.threshold) -> Column:
    """1 when the delivery took longer than the threshold, else 0."""
    return (minutes > F.lit(threshold)).cast("int")


def peak_period(hour: Column, config: SlaConfig = DEFAULT) -> Column:
    return (
        F.when(hour.isNull(), UNKNOWN)
        .when(hour.isin(*config.dinner_hours), DINNER_LABEL)
        .when(hour.isin(*config.lunch_hours), LUNCH_LABEL)
        .otherwise(OFF_PEAK_LABEL)
    )


def peak_flag(hour: Column, config: SlaConfig = DEFAULT) -> Column:
    """1 in the dinner hours, 0 in any other known hour, null when unknown."""
    return hour.isin(*config.dinner_hours).cast("int")


def operational_period(flag: Column) -> Column:
    """Label of a peak flag in the query pack."""
    return (
        F.when(flag == 1, DINNER_LABEL)
        .when(flag == 0, SQL_NON_PEAK_LABEL)
        .otherwise(SQL_UNKNOWN_HOUR_LABEL)
    )


def window_label(flag: Column) -> Column:
    """Label of a peak flag in the peak comparison; null stays null."""
    return F.when(flag == 1, WINDOW_PEAK_LABEL).when(flag == 0, WINDOW_NON_PEAK_LABEL)
