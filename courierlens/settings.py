"""Fixed values and the tunable parameters built from them."""

from __future__ import annotations

from dataclasses import dataclass

# Labels, domains and limits that results must carry exactly.
UNKNOWN = "Unknown"
DINNER_LABEL = "Dinner Peak (18-21)"
LUNCH_LABEL = "Lunch Peak (12-13)"
OFF_PEAK_LABEL = "Off-Peak"
SQL_NON_PEAK_LABEL = "Non-Peak"
SQL_UNKNOWN_HOUR_LABEL = "Unknown Hour"
WINDOW_PEAK_LABEL = "Dinner Peak (18:00 - 21:00)"
WINDOW_NON_PEAK_LABEL = "Non-Peak Hours"
TRAFFIC_DOMAIN = ("Low", "Medium", "High", "Jam", "Unknown")
PERIOD_CHOICES = (DINNER_LABEL, LUNCH_LABEL, OFF_PEAK_LABEL)
FESTIVAL_CHOICES = ("Yes", "No")
SWEEP_THRESHOLDS = (25, 30, 32, 35, 40)
TIME_PERCENTILES = (0.05, 0.10, 0.25, 0.50, 0.75, 0.80, 0.90, 0.95)
THRESHOLD_RANGE = (20, 45)
HISTOGRAM_MAX_BINS = 45
PEAK_BAND = (17.5, 21.5)
MINUTES_PER_DAY = 1440
SECONDS_PER_DAY = 86400

# Text that a CSV reader with default settings takes as missing.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Every character that counts as white space when stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


@dataclass(frozen=True)
class SlaConfig:
    """Analytical parameters; the defaults are the published baseline."""

    threshold: int = 30
    dinner_hours: tuple[int, ...] = (18, 19, 20, 21)
    lunch_hours: tuple[int, ...] = (12, 13)
    multiple_deliveries_fill: int = 1
    rating_cap: float = 5.0
    earth_radius_km: float = 6371.0
    rider_min_orders: int = 50
    rider_top: int = 15


DEFAULT = SlaConfig()
