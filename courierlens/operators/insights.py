"""Insight rows: two sides of one dimension compared, with the evidence.

Evidence numbers stand in their own columns beside the text, so results can be
checked and used without reading a sentence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.functions.rounding import percent
from courierlens.operators.time_counts import (
    mean_time,
    order_count,
    set_id,
    time_count_sets,
    time_counts,
    violations,
)
from courierlens.settings import DEFAULT, SlaConfig


@dataclass(frozen=True)
class Comparison:
    """One insight: a dimension, the two values compared, and its texts.

    ``evidence`` is a format over the mean and rate of both sides and the
    difference of the means; ``numbers`` names those it shows, in order.
    """

    name: str
    dim: str
    first: object
    second: object
    numbers: tuple[str, ...]
    title: str
    pattern: str
    evidence: str
    operational_meaning: str
    limitation: str


MEANS_AND_RATES = ("first_mean", "first_rate", "second_mean", "second_rate")

# The texts of the five insights, in their fixed order.
COMPARISONS = (
    Comparison(
        name="batching",
        dim="multiple_deliveries",
        first=0,
        second=2,
        numbers=("first_mean", "second_mean", "difference"),
        title="Multi-Order Stacking & Delay Escalation",
        pattern="Deliveries with multiple stacked orders exhibit dramatically "
        "higher delivery times.",
        evidence="Single drop orders (0 multiple deliveries) averaged %s minutes, "
        "whereas orders stacked with 2 drops averaged %s minutes "
        "(an observed increase of +%s minutes).",
        operational_meaning="Automated dispatch batching algorithms should be "
        "capped or optimized with strict distance radius constraints to prevent "
        "compounded customer wait times.",
        limitation="The dataset records the total multiple delivery count but does "
        "not record the rider's drop sequence or intermediate restaurant wait "
        "times.",
    ),
    Comparison(
        name="traffic",
        dim="traffic_density",
        first="Jam",
        second="Low",
        numbers=MEANS_AND_RATES,
        title="Severe Traffic Congestion Bottlenecks",
        pattern="High traffic density conditions are associated with substantially "
        "elevated SLA breach rates.",
        evidence="Deliveries conducted during 'Jam' conditions experienced an "
        "average delivery duration of %s minutes with a %s%% SLA breach rate, "
        "compared to %s minutes and %s%% under 'Low' traffic.",
        operational_meaning="Operations teams should dynamically expand delivery "
        "time estimates and increase rider incentives or localized geo-fencing "
        "when municipal traffic sensors report congestion.",
        limitation="Traffic density is logged as a categorical descriptor without "
        "precise vehicular speed or GPS telematics.",
    ),
    Comparison(
        name="dinner",
        dim="order_hour",
        first=None,
        second=None,
        numbers=MEANS_AND_RATES,
        title="Dinner Rush Operational Stress (18:00 – 21:00)",
        pattern="The dinner peak represents both the highest demand window and the "
        "peak window for SLA breaches.",
        evidence="Orders placed between 18:00 and 21:00 averaged %s minutes "
        "delivery time and %s%% SLA violation rate, compared to %s minutes and "
        "%s%% during non-peak operating hours.",
        operational_meaning="Rider supply scheduling must be heavily weighted toward "
        "17:30–21:30 to absorb peak dinner surge, and restaurant kitchen prep "
        "throttling should be considered.",
        limitation="Order volume peaks reflect aggregated historical logs; kitchen "
        "prep delays are inferred through pickup buffer.",
    ),
    Comparison(
        name="vehicle",
        dim="vehicle_condition",
        first=0,
        second=2,
        numbers=MEANS_AND_RATES,
        title="Vehicle Condition & Turnaround Efficiency",
        pattern="Vehicles graded condition 0 (poor) exhibit significantly higher "
        "delay frequencies.",
        evidence="Deliveries with vehicle condition 0 averaged %s minutes with a "
        "%s%% SLA breach rate, whereas condition 2 vehicles averaged %s minutes "
        "with a %s%% breach rate.",
        operational_meaning="Implementing periodic vehicle maintenance audits or "
        "fleet onboarding fitness checks can help protect delivery turnaround "
        "reliability.",
        limitation="The vehicle condition index (0–3) represents an internal "
        "operational score whose exact mechanical criteria are not detailed in the "
        "source documentation.",
    ),
    Comparison(
        name="festival",
        dim="festival",
        first="Yes",
        second="No",
        numbers=MEANS_AND_RATES,
        title="Festival Disruption and Order Backlogs",
        pattern="Deliveries during festival periods encounter extreme delivery "
        "delays.",
        evidence="Festival orders experienced an average turnaround of %s minutes "
        "and %s%% SLA violation rate, compared to %s minutes and %s%% during "
        "standard operational days.",
        operational_meaning="Special festive operational protocols (curated menus, "
        "expanded ETAs, emergency surge riders) are essential to prevent customer "
        "disappointment during major festivals.",
        limitation="Festival orders account for a small percentage (~2%) of total "
        "records, so sample size is smaller.",
    ),
)

INSIGHT_DIMS = [c.dim for c in COMPARISONS]


def insights(
    df: DataFrame,
    config: SlaConfig = DEFAULT,
    only: tuple[str, ...] | None = None,
) -> DataFrame:
    """The insights whose compared sides both occur in the data."""
    chosen = [c for c in COMPARISONS if only is None or c.name in only]
    dims = [c.dim for c in chosen]
    # counted jointly first, so that only counts are multiplied by the grouping sets
    sets = time_count_sets(time_counts(df, *dims), dims, F.sum("n"))
    return insights_from(sets, dims, config, only)


def insights_from(
    sets: DataFrame,
    dims: list[str],
    config: SlaConfig = DEFAULT,
    only: tuple[str, ...] | None = None,
) -> DataFrame:
    """Insights from the counted rows of each dimension (``time_count_sets``)."""
    chosen = [
        (ordinal, c)
        for ordinal, c in enumerate(COMPARISONS, 1)
        if only is None or c.name in only
    ]
    figures = _side_figures(sets, dims, [c for _, c in chosen], config)
    rows = F.array(*[_insight_row(ordinal, c) for ordinal, c in chosen])
    present = _enough(
        F.col("name"),
        F.col("first_mean").isNotNull(),
        F.col("second_mean").isNotNull(),
    )
    return figures.select(F.inline(rows)).where(present).orderBy("ordinal")


def comparison_sizes(df: DataFrame, config: SlaConfig = DEFAULT) -> DataFrame:
    """Rows on each side of the comparisons that have what they need."""
    sides = df.agg(*[
        F.count_if(mask).alias(f"{c.name}_{side}")
        for c in COMPARISONS
        for side, mask in _masks(c, config).items()
    ])
    rows = F.array(*[
        F.struct(
            F.lit(c.name).alias("comparison"),
            F.col(f"{c.name}_first").alias("first_orders"),
            F.col(f"{c.name}_second").alias("second_orders"),
        )
        for c in COMPARISONS
    ])
    present = _enough(
        F.col("comparison"), F.col("first_orders") > 0, F.col("second_orders") > 0
    )
    return sides.select(F.inline(rows)).where(present)


def _enough(name: Column, first: Column, second: Column) -> Column:
    """Both sides occur; the dinner insight needs only its own hours."""
    return first & (second | (name == "dinner"))


def _masks(c: Comparison, config: SlaConfig) -> dict[str, Column]:
    value = F.col(c.dim)
    if c.name == "dinner":
        inside = value.isin(*config.dinner_hours)
        return {"first": inside, "second": ~inside}
    return {"first": value == c.first, "second": value == c.second}


def _side_figures(
    sets: DataFrame, dims: list[str], chosen: list[Comparison], config: SlaConfig
) -> DataFrame:
    """One row with the mean and the rate on both sides of each comparison.

    The mean over hours weighs each hour the same; in the other comparisons a
    side is a single value, so averaging over its one row changes nothing.
    """
    per_value = sets.groupBy("set_id", *dims).agg(
        mean_time().alias("mean"),
        percent(violations(config.threshold), order_count()).alias("rate"),
    )
    aggs = []
    for c in chosen:
        own_rows = F.col("set_id") == set_id(dims, c.dim)
        for side, mask in _masks(c, config).items():
            for figure in ("mean", "rate"):
                value = F.when(own_rows & mask, F.col(figure))
                aggs.append(F.avg(value).alias(f"{c.name}_{side}_{figure}"))
    return per_value.agg(*aggs)


def _insight_row(ordinal: int, c: Comparison) -> Column:
    figures = {
        f"{side}_{figure}": F.col(f"{c.name}_{side}_{figure}")
        for side in ("first", "second")
        for figure in ("mean", "rate")
    }
    figures["difference"] = figures["second_mean"] - figures["first_mean"]
    # format_string prints a null as the text 'null'.
    printed = [
        F.when(figures[n].isNull(), "nan").otherwise(F.format_string("%.1f", figures[n]))
        for n in c.numbers
    ]
    return F.struct(
        F.lit(ordinal).alias("ordinal"),
        F.lit(c.name).alias("name"),
        F.lit(c.title).alias("title"),
        F.lit(c.pattern).alias("pattern"),
        F.format_string(c.evidence, *printed).alias("evidence"),
        F.lit(c.operational_meaning).alias("operational_meaning"),
        F.lit(c.limitation).alias("limitation"),
        *[F.round(value, 6).alias(name) for name, value in figures.items()],
    )
