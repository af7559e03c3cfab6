"""Report headings, number formats, bar labels and chart-ready tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.operators import metrics
from courierlens.operators.scope import in_domain_order
from courierlens.settings import DEFAULT, PEAK_BAND

# Which metric columns each report table shows, under which
# heading and in which number format.
COUNT, TEXT = "count", "text"
TABLES = {
    "traffic": {
        "traffic_density": ("Traffic Level", TEXT),
        "order_count": ("Orders", COUNT),
        "avg_delivery_time": ("Avg Time (min)", "%.2f"),
        "median_delivery_time": ("Median Time (min)", "%.1f"),
        "sla_violations": ("SLA Breaches", COUNT),
        "sla_violation_rate": ("SLA Breach Rate (%)", "%.2f%%"),
        "order_share_pct": ("Share (%)", "%.1f%%"),
    },
    "peak": {
        "period_label": ("Operating Window", TEXT),
        "order_count": ("Orders", COUNT),
        "order_share_pct": ("Volume Share (%)", "%.1f%%"),
        "avg_delivery_time": ("Avg Time (min)", "%.2f"),
        "sla_violation_rate": ("SLA Breach Rate (%)", "%.2f%%"),
    },
    "city": {
        "city": ("City Tier", TEXT),
        "order_count": ("Total Orders", COUNT),
        "order_share_pct": ("Share (%)", "%.1f%%"),
        "avg_delivery_time": ("Avg Time (min)", "%.2f"),
        "sla_violation_rate": ("SLA Breach Rate (%)", "%.2f%%"),
    },
    "vehicle": {
        "vehicle_condition": ("Vehicle Condition (0=Poor, 3=Optimal)", TEXT),
        "order_count": ("Deliveries", COUNT),
        "avg_delivery_time": ("Avg Time (min)", "%.2f"),
        "sla_violation_rate": ("SLA Breach Rate (%)", "%.2f%%"),
    },
    "riders": {
        "delivery_person_id": ("Rider ID", TEXT),
        "total_orders": ("Total Orders", COUNT),
        "avg_rating": ("Avg Rating", "%.2f"),
        "avg_time": ("Avg Delivery Time (min)", "%.2f"),
        "sla_violations": ("SLA Breaches", COUNT),
        "sla_violation_rate": ("SLA Breach Rate (%)", "%.2f%%"),
    },
}
# Title, value and subtitle of the headline cards; a format takes the column after it.
CARDS = (
    ("Total Deliveries", (COUNT, "total_orders"), "Active in Scope"),
    ("SLA Violations", (COUNT, "sla_violations"), "Orders > {threshold} min"),
    ("SLA Violation Rate", ("%.1f%%", "sla_violation_rate"), "Breach Frequency"),
    ("Avg Delivery Time", ("%.1f min", "avg_time"), ("Median: %.0f min", "median_time")),
    ("Dinner Peak Orders", (COUNT, "peak_orders"), ("%.1f%% of Volume", "peak_share_pct")),
)
TIME_LABEL = "%.1f min"
SHORT_TIME_LABEL = "%.1f m"
RATE_LABEL = "(%.1f%% viol.)"
DROPS_LABEL = "%d Drops"


def formatted(c: Column, fmt: str) -> Column:
    """Text of a number in one of the report formats; null stays null."""
    if fmt == TEXT:
        return c
    text = F.format_number(c, 0) if fmt == COUNT else F.format_string(fmt, c)
    return F.when(c.isNotNull(), text)


def display_names(df: DataFrame, table: str) -> DataFrame:
    """The columns a report table shows, under its headings."""
    return df.select(*[
        F.col(name).alias(heading) for name, (heading, _) in TABLES[table].items()
    ])


def display_format(df: DataFrame, table: str) -> DataFrame:
    """``display_names`` with every number as formatted text."""
    return df.select(*[
        formatted(F.col(name), fmt).alias(heading)
        for name, (heading, fmt) in TABLES[table].items()
    ])


def headline_cards(kpis: DataFrame, threshold: float = DEFAULT.threshold) -> DataFrame:
    """The headline figures as cards: position, title, value and subtitle."""
    def text(part) -> Column:
        if isinstance(part, str):
            return F.lit(part.format(threshold=threshold))
        return formatted(F.col(part[1]), part[0])

    cards = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(title).alias("title"),
            text(value).alias("value"),
            text(below).alias("subtitle"),
        )
        for i, (title, value, below) in enumerate(CARDS, 1)
    ]
    return kpis.select(F.inline(F.array(*cards)))


def time_label(c: Column) -> Column:
    return F.format_string(TIME_LABEL, c)


def time_and_rate_label(minutes: Column, rate: Column) -> Column:
    return F.format_string(f"{TIME_LABEL} {RATE_LABEL}", minutes, rate)


# --- the table behind each chart --------------------------------------------


def chart_hourly(hourly: DataFrame) -> DataFrame:
    """Volume and rate per hour, flagged inside the highlighted peak band."""
    hour = F.col("order_hour")
    return hourly.select(
        "order_hour",
        "order_count",
        "sla_violation_rate",
        hour.between(*PEAK_BAND).alias("in_peak_band"),
    )


def chart_traffic(traffic: DataFrame) -> DataFrame:
    """Mean time and rate per traffic level, from light to heavy."""
    minutes, rate = F.col("avg_delivery_time"), F.col("sla_violation_rate")
    return in_domain_order(traffic, "traffic_density").select(
        "traffic_density",
        "avg_delivery_time",
        "sla_violation_rate",
        time_and_rate_label(minutes, rate).alias("label"),
    )


def chart_batching(multi: DataFrame) -> DataFrame:
    minutes = F.col("avg_delivery_time")
    return multi.select(
        F.format_string(DROPS_LABEL, F.col("multiple_deliveries")).alias("drops"),
        "avg_delivery_time",
        time_label(minutes).alias("label"),
    )


def chart_city(city: DataFrame) -> DataFrame:
    minutes = F.col("avg_delivery_time")
    return city.select("city", "avg_delivery_time", time_label(minutes).alias("label"))


def chart_weather(weather: DataFrame) -> DataFrame:
    label = F.format_string(SHORT_TIME_LABEL, F.col("avg_delivery_time"))
    return weather.select("weather", "avg_delivery_time", label.alias("label"))


def chart_distribution(
    df: DataFrame, threshold: float = DEFAULT.threshold
) -> DataFrame:
    return metrics.histogram(df, threshold)
