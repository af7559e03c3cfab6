"""Values that results must carry, stated here on their own.

Fixed values: nothing in this folder is taken from the library under test.
"""

from __future__ import annotations

# Text that a CSV reader with default settings takes as missing.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Code points of the characters that count as white space.
WHITESPACE = (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195,
    8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288,
)

# Report tables: column, heading, decimals (None: as it is, 0: with thousands
# separators) and what follows the number.
TABLES = {
    "traffic": (
        ("traffic_density", "Traffic Level", None, ""),
        ("order_count", "Orders", 0, ""),
        ("avg_delivery_time", "Avg Time (min)", 2, ""),
        ("median_delivery_time", "Median Time (min)", 1, ""),
        ("sla_violations", "SLA Breaches", 0, ""),
        ("sla_violation_rate", "SLA Breach Rate (%)", 2, "%"),
        ("order_share_pct", "Share (%)", 1, "%"),
    ),
    "peak": (
        ("period_label", "Operating Window", None, ""),
        ("order_count", "Orders", 0, ""),
        ("order_share_pct", "Volume Share (%)", 1, "%"),
        ("avg_delivery_time", "Avg Time (min)", 2, ""),
        ("sla_violation_rate", "SLA Breach Rate (%)", 2, "%"),
    ),
    "city": (
        ("city", "City Tier", None, ""),
        ("order_count", "Total Orders", 0, ""),
        ("order_share_pct", "Share (%)", 1, "%"),
        ("avg_delivery_time", "Avg Time (min)", 2, ""),
        ("sla_violation_rate", "SLA Breach Rate (%)", 2, "%"),
    ),
    "vehicle": (
        ("vehicle_condition", "Vehicle Condition (0=Poor, 3=Optimal)", None, ""),
        ("order_count", "Deliveries", 0, ""),
        ("avg_delivery_time", "Avg Time (min)", 2, ""),
        ("sla_violation_rate", "SLA Breach Rate (%)", 2, "%"),
    ),
    "riders": (
        ("delivery_person_id", "Rider ID", None, ""),
        ("total_orders", "Total Orders", 0, ""),
        ("avg_rating", "Avg Rating", 2, ""),
        ("avg_time", "Avg Delivery Time (min)", 2, ""),
        ("sla_violations", "SLA Breaches", 0, ""),
        ("sla_violation_rate", "SLA Breach Rate (%)", 2, "%"),
    ),
}

# The insights in their order. A %s of the evidence stands for the next number;
# first and second are the compared values of the dimension.
INSIGHTS = (
    {
        "name": "batching",
        "dim": "multiple_deliveries",
        "first": 0,
        "second": 2,
        "numbers": ("first_mean", "second_mean", "difference"),
        "title":
            "Multi-Order Stacking & Delay Escalation",
        "pattern":
            "Deliveries with multiple stacked orders exhibit dramatically higher "
            "delivery times.",
        "evidence":
            "Single drop orders (0 multiple deliveries) averaged %s minutes, "
            "whereas orders stacked with 2 drops averaged %s minutes (an observed "
            "increase of +%s minutes).",
        "operational_meaning":
            "Automated dispatch batching algorithms should be capped or optimized "
            "with strict distance radius constraints to prevent compounded customer"
            " wait times.",
        "limitation":
            "The dataset records the total multiple delivery count but does not "
            "record the rider's drop sequence or intermediate restaurant wait "
            "times.",
    },
    {
        "name": "traffic",
        "dim": "traffic_density",
        "first": "Jam",
        "second": "Low",
        "numbers": ("first_mean", "first_rate", "second_mean", "second_rate"),
        "title":
            "Severe Traffic Congestion Bottlenecks",
        "pattern":
            "High traffic density conditions are associated with substantially "
            "elevated SLA breach rates.",
        "evidence":
            "Deliveries conducted during 'Jam' conditions experienced an average "
            "delivery duration of %s minutes with a %s%% SLA breach rate, compared "
            "to %s minutes and %s%% under 'Low' traffic.",
        "operational_meaning":
            "Operations teams should dynamically expand delivery time estimates and"
            " increase rider incentives or localized geo-fencing when municipal "
            "traffic sensors report congestion.",
        "limitation":
            "Traffic density is logged as a categorical descriptor without precise "
            "vehicular speed or GPS telematics.",
    },
    {
        "name": "dinner",
        "dim": "order_hour",
        "first": None,
        "second": None,
        "numbers": ("first_mean", "first_rate", "second_mean", "second_rate"),
        "title":
            "Dinner Rush Operational Stress (18:00 – 21:00)",
        "pattern":
            "The dinner peak represents both the highest demand window and the peak"
            " window for SLA breaches.",
        "evidence":
            "Orders placed between 18:00 and 21:00 averaged %s minutes delivery "
            "time and %s%% SLA violation rate, compared to %s minutes and %s%% "
            "during non-peak operating hours.",
        "operational_meaning":
            "Rider supply scheduling must be heavily weighted toward 17:30–21:30 to"
            " absorb peak dinner surge, and restaurant kitchen prep throttling "
            "should be considered.",
        "limitation":
            "Order volume peaks reflect aggregated historical logs; kitchen prep "
            "delays are inferred through pickup buffer.",
    },
    {
        "name": "vehicle",
        "dim": "vehicle_condition",
        "first": 0,
        "second": 2,
        "numbers": ("first_mean", "first_rate", "second_mean", "second_rate"),
        "title":
            "Vehicle Condition & Turnaround Efficiency",
        "pattern":
            "Vehicles graded condition 0 (poor) exhibit significantly higher delay "
            "frequencies.",
        "evidence":
            "Deliveries with vehicle condition 0 averaged %s minutes with a %s%% "
            "SLA breach rate, whereas condition 2 vehicles averaged %s minutes with"
            " a %s%% breach rate.",
        "operational_meaning":
            "Implementing periodic vehicle maintenance audits or fleet onboarding "
            "fitness checks can help protect delivery turnaround reliability.",
        "limitation":
            "The vehicle condition index (0–3) represents an internal operational "
            "score whose exact mechanical criteria are not detailed in the source "
            "documentation.",
    },
    {
        "name": "festival",
        "dim": "festival",
        "first": "Yes",
        "second": "No",
        "numbers": ("first_mean", "first_rate", "second_mean", "second_rate"),
        "title":
            "Festival Disruption and Order Backlogs",
        "pattern":
            "Deliveries during festival periods encounter extreme delivery delays.",
        "evidence":
            "Festival orders experienced an average turnaround of %s minutes and "
            "%s%% SLA violation rate, compared to %s minutes and %s%% during "
            "standard operational days.",
        "operational_meaning":
            "Special festive operational protocols (curated menus, expanded ETAs, "
            "emergency surge riders) are essential to prevent customer "
            "disappointment during major festivals.",
        "limitation":
            "Festival orders account for a small percentage (~2%) of total records,"
            " so sample size is smaller.",
    },
)
