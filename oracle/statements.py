"""The independent DuckDB statement of each query."""

from __future__ import annotations

from oracle.base import (
    CLEAN,
    DECIMAL,
    MARKERS,
    RAW,
    RAW_COLUMNS,
    TEXT_COLUMNS,
    fixed,
    from_clean,
    from_parsed,
    from_raw,
    half_up,
    parsed,
)
from oracle.values import INSIGHTS as TEXTS
from oracle.values import TABLES

N = "count(*)"
TOTAL = "(SELECT count(*) FROM clean)"
MEAN = "CAST(sum(delivery_time_min) AS DOUBLE) / count(*)"
MEDIAN = "CAST(median(delivery_time_min) AS DOUBLE)"


def late(threshold: int = 30) -> str:
    return f"count(*) FILTER (WHERE delivery_time_min > {threshold})"


def rate(threshold: int = 30) -> str:
    return f"CAST({late(threshold)} AS DOUBLE) / count(*) * 100e0"


def share(total: str = TOTAL) -> str:
    return f"CAST(count(*) AS DOUBLE) / {total} * 100e0"


def scaled_mean(column: str, scale: str) -> str:
    """Mean of a measured double through a sum of whole units."""
    units = f"CAST(sum(CAST(round({column} * {scale}) AS BIGINT)) AS DOUBLE)"
    return (
        f"CASE WHEN count({column}) > 0 "
        f"THEN {units} / (count({column}) * CAST({scale} AS DOUBLE)) END"
    )


KM = scaled_mean("delivery_distance_km", "1e2")
RATING = scaled_mean("delivery_person_rating", "1e6")

# --- the query pack -----------------------------------------------------------

AVG_TIME = f"{half_up(MEAN, 2)} AS avg_delivery_time_min"
PACK_RATE = (
    half_up("CAST(sum(is_sla_violated) AS DOUBLE) / count(*) * 100", 2)
    + " AS sla_violation_rate_pct"
)
PACK_LATE = "CAST(sum(is_sla_violated) AS BIGINT)"
PACK_SHARE = half_up(f"count(*) * 100e0 / {TOTAL}", 2)


def breakdown(key: str, alias: str) -> str:
    return f"""SELECT {key} AS {alias}, {N} AS total_deliveries, {AVG_TIME},
        {PACK_LATE} AS sla_violations, {PACK_RATE} FROM clean GROUP BY {key}"""


PACK = {
    "sql01_kpis": f"""SELECT {N} AS total_deliveries, {AVG_TIME},
        {PACK_LATE} AS total_sla_violations, {PACK_RATE},
        {half_up(KM, 2)} AS avg_distance_km FROM clean""",
    "sql02_peak": f"""SELECT coalesce(
            ['Non-Peak', 'Dinner Peak (18-21)'][is_peak_hour + 1], 'Unknown Hour')
            AS operational_period, {N} AS total_deliveries,
        {PACK_SHARE} AS pct_of_total_orders, {AVG_TIME},
        {PACK_LATE} AS total_sla_violations, {PACK_RATE}
        FROM clean GROUP BY is_peak_hour""",
    "sql03_hourly": f"""SELECT order_hour AS hour_of_day, {N} AS order_volume,
        {AVG_TIME}, {PACK_LATE} AS sla_violations, {PACK_RATE}
        FROM clean WHERE order_hour IS NOT NULL GROUP BY order_hour""",
    "sql04_city": f"""SELECT city, {N} AS total_deliveries,
        {PACK_SHARE} AS order_share_pct, {AVG_TIME},
        {PACK_LATE} AS sla_violations, {PACK_RATE} FROM clean GROUP BY city""",
    "sql05_traffic": breakdown("traffic_density", "traffic_density"),
    "sql06_batching": breakdown("multiple_deliveries", "multi_orders_stacked"),
    "sql07_vehicle": f"""SELECT vehicle_type, vehicle_condition,
        {N} AS total_deliveries, {AVG_TIME}, {PACK_RATE}
        FROM clean GROUP BY vehicle_type, vehicle_condition""",
    "sql08_weather": breakdown("weather", "weather"),
    "sql09_festival": breakdown("festival", "festival"),
    "sql10_riders": f"""SELECT delivery_person_id, {N} AS total_orders_delivered,
        {half_up(RATING, 2)} AS avg_rider_rating, {AVG_TIME},
        {PACK_LATE} AS sla_violations, {PACK_RATE}
        FROM clean GROUP BY delivery_person_id HAVING count(*) >= 50
        ORDER BY total_orders_delivered DESC, sla_violation_rate_pct,
                 delivery_person_id LIMIT 15""",
}

PACK_SHAPE = {
    "sql01_kpis": (
        "Overall operational KPIs",
        "''",
        ["total_deliveries", "avg_delivery_time_min", "total_sla_violations",
         "sla_violation_rate_pct", "avg_distance_km"],
    ),
    "sql02_peak": (
        "Peak against non-peak deliveries",
        "operational_period",
        ["total_deliveries", "pct_of_total_orders", "avg_delivery_time_min",
         "total_sla_violations", "sla_violation_rate_pct"],
    ),
    "sql03_hourly": (
        "Hourly performance",
        "hour_of_day",
        ["order_volume", "avg_delivery_time_min", "sla_violations",
         "sla_violation_rate_pct"],
    ),
    "sql04_city": (
        "City performance",
        "city",
        ["total_deliveries", "order_share_pct", "avg_delivery_time_min",
         "sla_violations", "sla_violation_rate_pct"],
    ),
    "sql05_traffic": (
        "Traffic density impact",
        "traffic_density",
        ["total_deliveries", "avg_delivery_time_min", "sla_violations",
         "sla_violation_rate_pct"],
    ),
    "sql06_batching": (
        "Batched deliveries impact",
        "multi_orders_stacked",
        ["total_deliveries", "avg_delivery_time_min", "sla_violations",
         "sla_violation_rate_pct"],
    ),
    "sql07_vehicle": (
        "Vehicle type and condition",
        "vehicle_type || '/' || vehicle_condition",
        ["total_deliveries", "avg_delivery_time_min", "sla_violation_rate_pct"],
    ),
    "sql08_weather": (
        "Weather impact",
        "weather",
        ["total_deliveries", "avg_delivery_time_min", "sla_violations",
         "sla_violation_rate_pct"],
    ),
    "sql09_festival": (
        "Festival impact",
        "festival",
        ["total_deliveries", "avg_delivery_time_min", "sla_violations",
         "sla_violation_rate_pct"],
    ),
    "sql10_riders": (
        "High-volume riders",
        "delivery_person_id",
        ["total_orders_delivered", "avg_rider_rating", "avg_delivery_time_min",
         "sla_violations", "sla_violation_rate_pct"],
    ),
}


def pack_rows() -> str:
    parts = []
    for number, (name, (title, key, measures)) in enumerate(PACK_SHAPE.items(), 1):
        for measure in measures:
            parts.append(
                f"SELECT {number} AS query_no, '{name}' AS query_name, "
                f"'{title}' AS title, CAST({key} AS VARCHAR) AS row_key, "
                f"'{measure}' AS measure, CAST({measure} AS DOUBLE) AS value, "
                f"CAST(NULL AS VARCHAR) AS error FROM {name}"
            )
    ctes = [f"{name} AS ({sql})" for name, sql in PACK.items()]
    return from_clean(" UNION ALL ".join(parts), *ctes)


# --- metrics --------------------------------------------------------------------


def summary(key: str, alias: str | None = None, threshold: int = 30,
            total: str = TOTAL, source: str = "clean") -> str:
    return f"""SELECT {key} AS {alias or key}, {N} AS order_count,
        {MEAN} AS avg_delivery_time, {MEDIAN} AS median_delivery_time,
        {late(threshold)} AS sla_violations, {rate(threshold)} AS sla_violation_rate,
        {share(total)} AS order_share_pct
        FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}"""


HOURLY = f"""SELECT order_hour, {N} AS order_count, {MEAN} AS avg_delivery_time,
    {late()} AS sla_violations, {rate()} AS sla_violation_rate
    FROM clean WHERE order_hour IS NOT NULL GROUP BY order_hour"""

RIDERS = f"""SELECT delivery_person_id, {N} AS total_orders, {RATING} AS avg_rating,
    {MEAN} AS avg_time, {late()} AS sla_violations, {rate()} AS sla_violation_rate
    FROM clean WHERE delivery_person_id IS NOT NULL GROUP BY delivery_person_id
    HAVING count(*) >= 50 ORDER BY total_orders DESC, delivery_person_id LIMIT 15"""


def group_stats(key: str) -> str:
    return f"""SELECT '{key}' AS dimension, CAST({key} AS VARCHAR) AS value,
        {N} AS count, {MEAN} AS mean, {MEDIAN} AS median
        FROM clean WHERE {key} IS NOT NULL GROUP BY {key}"""


def conditional_rate(key: str, value: str) -> str:
    return f"""SELECT '{key}' AS dimension, '{value}' AS value,
        CAST({late()} AS DOUBLE) / count(*) * 100 AS sla_violation_rate
        FROM clean WHERE {key} = '{value}'"""


def describe(column: str, value: str) -> str:
    quantiles = ", ".join(
        f"{half_up(f'quantile_cont({value}, {q})', 6)} AS {label}"
        for label, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )
    return f"""SELECT '{column}' AS column_name, count({value}) AS count,
        {half_up(f'avg({value})', 6)} AS mean,
        {half_up(f'stddev_samp({value})', 6)} AS std,
        CAST(min({value}) AS DOUBLE) AS min, {quantiles},
        CAST(max({value}) AS DOUBLE) AS max FROM parsed"""


DESCRIBED = {
    "Delivery_person_Age": "delivery_person_age",
    "Delivery_person_Ratings": "rating",
    "Restaurant_latitude": '"r_Restaurant_latitude"',
    "Restaurant_longitude": '"r_Restaurant_longitude"',
    "Delivery_location_latitude": '"r_Delivery_location_latitude"',
    "Delivery_location_longitude": '"r_Delivery_location_longitude"',
    "Vehicle_condition": 'CAST("r_Vehicle_condition" AS DOUBLE)',
    "multiple_deliveries": '"r_multiple_deliveries"',
    "Time_taken (min)": 'CAST("r_Time_taken (min)" AS DOUBLE)',
}


def histogram(width: int, extra: str = "") -> str:
    return f"""SELECT CAST(delivery_time_min // {width} * {width} AS DOUBLE) AS bin_start,
        CAST({width} AS DOUBLE) AS bin_width, {N} AS order_count{extra}
        FROM clean GROUP BY delivery_time_min // {width}"""


MARKS = """, (SELECT CAST(median(delivery_time_min) AS DOUBLE) FROM clean)
    AS median_minutes, 30 AS sla_threshold"""

KNOWN = "(SELECT count(*) FROM clean WHERE order_hour IS NOT NULL)"
PEAK = "count(*) FILTER (WHERE is_peak_hour = 1)"

KPIS = f"""SELECT {N} AS total_orders, {half_up(MEAN, 2)} AS avg_time,
    {half_up(MEDIAN, 1)} AS median_time, {late()} AS sla_violations,
    {half_up(rate(), 2)} AS sla_violation_rate, {PEAK} AS peak_orders,
    {half_up(f"CAST({PEAK} AS DOUBLE) / count(*) * 100e0", 2)} AS peak_share_pct,
    {half_up(KM, 2)} AS avg_distance FROM clean"""

METRICS = {
    "agg_kpis": KPIS,
    **PACK,
    "agg_hourly": HOURLY,
    "agg_peak_compare": f"""SELECT *, ['Non-Peak Hours', 'Dinner Peak (18:00 - 21:00)']
        [is_peak_hour + 1] AS period_label FROM ({summary('is_peak_hour', total=KNOWN)})""",
    "agg_category": summary("festival", threshold=35),
    "agg_category_traffic": summary("traffic_density"),
    "agg_category_city": summary("city"),
    "agg_category_weather": summary("weather"),
    "agg_category_multi": summary("multiple_deliveries"),
    "agg_category_vehicle": summary("vehicle_condition"),
    "agg_riders": RIDERS,
    "agg_group_stats": " UNION ALL ".join(
        group_stats(k) for k in ("traffic_density", "multiple_deliveries", "city")
    ),
    "agg_share": f"""SELECT city, {N} AS order_count, {share()} AS order_share_pct
        FROM clean GROUP BY city""",
    "agg_conditional_rate": " UNION ALL ".join(
        conditional_rate(k, v)
        for k, v in (("traffic_density", "Jam"), ("traffic_density", "Low"),
                     ("vehicle_condition", "0"), ("vehicle_condition", "2"),
                     ("festival", "Yes"), ("festival", "No"))
    ),
    "agg_mean_of_means": "SELECT " + ", ".join(
        f"{half_up(f'avg({source}) FILTER (WHERE {mask})', 6)} AS {side}_{name}"
        for side, mask in (("dinner", "order_hour BETWEEN 18 AND 21"),
                           ("other", "order_hour NOT BETWEEN 18 AND 21"))
        for name, source in (("mean_of_hourly_time", "avg_delivery_time"),
                             ("mean_of_hourly_rate", "sla_violation_rate"))
    ) + f" FROM ({HOURLY})",
    "agg_threshold_sweep": " UNION ALL ".join(
        f"""SELECT {t} AS threshold, {late(t)} AS sla_violations,
        {rate(t)} AS sla_violation_rate FROM clean"""
        for t in (25, 30, 32, 35, 40)
    ),
    "agg_percentiles": " UNION ALL ".join(
        f"""SELECT CAST({p} AS DOUBLE) AS percentile,
        {half_up(f'CAST(quantile_cont(delivery_time_min, {p}) AS DOUBLE)', 6)} AS minutes
        FROM clean"""
        for p in (0.05, 0.10, 0.25, 0.50, 0.75, 0.80, 0.90, 0.95)
    ),
    "agg_histogram": histogram(5),
    "chart_hourly": f"""SELECT order_hour, order_count, sla_violation_rate,
        order_hour BETWEEN 17.5 AND 21.5 AS in_peak_band FROM ({HOURLY})""",
    "chart_traffic": f"""SELECT traffic_density, avg_delivery_time, sla_violation_rate,
        {fixed('avg_delivery_time', 1)} || ' min (' || {fixed('sla_violation_rate', 1)}
            || '% viol.)' AS label FROM ({summary('traffic_density')})
        WHERE traffic_density IN ('Low', 'Medium', 'High', 'Jam', 'Unknown')""",
    "chart_batching": f"""SELECT multiple_deliveries || ' Drops' AS drops,
        avg_delivery_time, {fixed('avg_delivery_time', 1)} || ' min' AS label
        FROM ({summary('multiple_deliveries')})""",
    "chart_city": f"""SELECT city, avg_delivery_time,
        {fixed('avg_delivery_time', 1)} || ' min' AS label FROM ({summary('city')})""",
    "chart_weather": f"""SELECT weather, avg_delivery_time,
        {fixed('avg_delivery_time', 1)} || ' m' AS label FROM ({summary('weather')})""",
    "chart_distribution": histogram(1, MARKS),
}

# --- filters, options and sorts -----------------------------------------------------

IN_SCOPE = """city IN ('Metropolitian', 'Urban') AND traffic_density IN ('Jam', 'High')
    AND weather IN ('Fog', 'Stormy', 'Sunny')
    AND vehicle_type IN ('scooter', 'motorcycle')
    AND festival = 'No' AND peak_period = 'Dinner Peak (18-21)'"""


def option(column: str) -> str:
    return f"""SELECT DISTINCT '{column}' AS dimension, {column} AS value FROM clean
        WHERE {column} IS NOT NULL"""


def sides(name: str, first: str, second: str) -> str:
    return f"""SELECT '{name}' AS comparison,
        count(*) FILTER (WHERE {first}) AS first_orders,
        count(*) FILTER (WHERE {second}) AS second_orders FROM clean"""


def place(order: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position"


DOMAIN = "list_position(['Low', 'Medium', 'High', 'Jam', 'Unknown'], traffic_density)"

FILTERS = {
    "filter_city": "SELECT order_id, city FROM clean WHERE city IN ('Urban', 'Semi-Urban')",
    "filter_traffic": """SELECT order_id, traffic_density FROM clean
        WHERE traffic_density IN ('Jam', 'High')""",
    "filter_weather": """SELECT order_id, weather FROM clean
        WHERE weather IN ('Fog', 'Stormy')""",
    "filter_vehicle": """SELECT order_id, vehicle_type FROM clean
        WHERE vehicle_type IN ('scooter', 'bicycle')""",
    "filter_festival": "SELECT order_id, festival FROM clean WHERE festival = 'Yes'",
    "filter_period": """SELECT order_id, peak_period FROM clean
        WHERE peak_period = 'Dinner Peak (18-21)'""",
    "filter_order_type": """SELECT order_id, order_type FROM clean
        WHERE order_type IN ('Meal', 'Snack')""",
    "filter_scope": f"""SELECT order_id, city, traffic_density, weather, vehicle_type,
        delivery_time_min FROM clean WHERE {IN_SCOPE}""",
    "scope_share": f"""SELECT count(*) FILTER (WHERE {IN_SCOPE}) AS filtered_orders,
        count(*) AS all_orders,
        CAST(count(*) FILTER (WHERE {IN_SCOPE}) AS DOUBLE) / count(*) * 100e0
            AS share_pct FROM clean""",
    "filter_not_null": """SELECT order_id, order_hour, is_peak_hour FROM clean
        WHERE order_hour IS NOT NULL AND is_peak_hour IS NOT NULL""",
    "filter_hours": """SELECT order_id, order_hour,
        CASE WHEN order_hour BETWEEN 18 AND 21 THEN 'dinner' ELSE 'other' END AS side
        FROM clean WHERE order_hour IS NOT NULL""",
    "filter_having": """SELECT delivery_person_id, count(*) AS order_count
        FROM clean GROUP BY delivery_person_id HAVING count(*) >= 50""",
    "filter_case_present": "SELECT * FROM (" + " UNION ALL ".join((
        sides("batching", "multiple_deliveries = 0", "multiple_deliveries = 2"),
        sides("traffic", "traffic_density = 'Jam'", "traffic_density = 'Low'"),
        sides("dinner", "order_hour BETWEEN 18 AND 21",
              "order_hour NOT BETWEEN 18 AND 21"),
        sides("vehicle", "vehicle_condition = 0", "vehicle_condition = 2"),
        sides("festival", "festival = 'Yes'", "festival = 'No'"),
    )) + """) WHERE first_orders > 0
        AND (second_orders > 0 OR comparison = 'dinner')""",
    "distinct_options": " UNION ALL ".join(
        option(c) for c in ("city", "weather", "vehicle_type")
    ),
    "domain_options": f"""SELECT DISTINCT traffic_density,
        CAST({DOMAIN} AS INTEGER) AS position FROM clean
        WHERE {DOMAIN} > 0""",
    "sort_key": f"""SELECT vehicle_type, vehicle_condition, {N} AS order_count,
        {place('vehicle_type NULLS FIRST, vehicle_condition NULLS FIRST')}
        FROM clean GROUP BY vehicle_type, vehicle_condition""",
    "sort_key_nulls_last": f"""SELECT is_peak_hour, {N} AS order_count,
        {place('is_peak_hour DESC NULLS LAST')} FROM clean GROUP BY is_peak_hour""",
    "sort_metric": f"""SELECT weather, order_count, avg_delivery_time,
        {place('avg_delivery_time DESC, weather')} FROM ({summary('weather')})""",
    "sort_domain": f"""SELECT traffic_density, {N} AS order_count, {place(DOMAIN)}
        FROM clean WHERE {DOMAIN} > 0 GROUP BY traffic_density""",
    "topk_riders": f"""SELECT {place('total_orders_delivered DESC, '
        'sla_violation_rate_pct, delivery_person_id')},
        delivery_person_id, total_orders_delivered FROM ({PACK['sql10_riders']})""",
}

# --- insights ---------------------------------------------------------------------


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def insight(ordinal: int) -> str:
    c = TEXTS[ordinal - 1]
    if c['name'] == "dinner":
        figures = {
            f"{side}_{figure}": f"(SELECT avg({source}) FROM ({HOURLY}) "
            f"WHERE order_hour {test} BETWEEN 18 AND 21)"
            for side, test in (("first", ""), ("second", "NOT"))
            for figure, source in (("mean", "avg_delivery_time"),
                                   ("rate", "sla_violation_rate"))
        }
    else:
        figures = {
            f"{side}_{figure}": f"(SELECT CASE WHEN count(*) > 0 THEN {formula} END "
            f"FROM clean WHERE {c['dim']} = {quoted(str(value))})"
            for side, value in (("first", c['first']), ("second", c['second']))
            for figure, formula in (("mean", MEAN), ("rate", rate()))
        }
    inner = ", ".join(f"{sql} AS {name}" for name, sql in figures.items())
    numbers = [f"coalesce({fixed(n, 1)}, 'nan')" for n in c['numbers']]
    pieces = [quoted(p.replace("%%", "%")) for p in c['evidence'].split("%s")]
    evidence = pieces[0] + "".join(
        f" || {n} || {p}" for n, p in zip(numbers, pieces[1:])
    )
    rounded = ", ".join(
        f"{half_up(n, 6)} AS {n}" for n in (*figures, "difference")
    )
    second = "" if c['name'] == "dinner" else " AND second_mean IS NOT NULL"
    return f"""SELECT {ordinal} AS ordinal, '{c['name']}' AS name,
        {quoted(c['title'])} AS title, {quoted(c['pattern'])} AS pattern,
        {evidence} AS evidence,
        {quoted(c['operational_meaning'])} AS operational_meaning,
        {quoted(c['limitation'])} AS limitation, {rounded}
        FROM (SELECT *, second_mean - first_mean AS difference FROM (SELECT {inner}))
        WHERE first_mean IS NOT NULL{second}"""


INSIGHTS = {
    f"insight_{c['name']}": insight(i) for i, c in enumerate(TEXTS, 1)
}
INSIGHTS["insights"] = " UNION ALL ".join(list(INSIGHTS.values()))

# --- cleaning rules -----------------------------------------------------------------

RULES = {
    "clean_order_date": "order_date",
    "clean_date_parts": "order_day, order_month, order_day_name",
    "clean_weekend": "is_weekend",
    "clean_date_format": "strftime(order_date, '%Y-%m-%d') AS order_date_text",
    "clean_time_parse": "time_ordered, time_order_picked",
    "clean_order_hour": "order_hour",
    "clean_pickup_delay": "pickup_delay_minutes",
    "clean_gps_valid": "gps_valid",
    "clean_haversine": "delivery_distance_km",
    "clean_fill_unknown":
        "weather, traffic_density, festival, city",
    "clean_trim_text": "delivery_person_id, order_type, vehicle_type",
    "clean_multi_fill": "multiple_deliveries",
    "clean_numeric_coerce": "delivery_person_age, rating",
    "clean_rating_cap": "delivery_person_rating",
    "clean_int_cast": "vehicle_condition, delivery_time_min",
}

FEATURES = {
    "feat_sla_flag": """CAST(delivery_time_min > 25 AS INTEGER) AS sla_25,
        CAST(delivery_time_min > 30 AS INTEGER) AS sla_30""",
    "feat_peak_period": "peak_period",
    "feat_peak_flag": "is_peak_hour",
    "proj_period_label": """coalesce(['Non-Peak', 'Dinner Peak (18-21)']
        [is_peak_hour + 1], 'Unknown Hour') AS operational_period,
        ['Non-Peak Hours', 'Dinner Peak (18:00 - 21:00)'][is_peak_hour + 1]
        AS period_label""",
}


TABLE_ROWS = {
    "traffic": summary("traffic_density"),
    "peak": METRICS["agg_peak_compare"],
    "city": summary("city"),
    "vehicle": summary("vehicle_condition"),
    "riders": RIDERS,
}


def display_columns(table: str, formatted: bool) -> str:
    shown = []
    for column, heading, places, unit in TABLES[table]:
        value = column
        if formatted and places == 0:
            value = f"format('{{:,}}', {column})"
        elif formatted and places is not None:
            value = fixed(column, places) + (f" || '{unit}'" if unit else "")
        shown.append(f'{value} AS "{heading}"')
    return f"SELECT {', '.join(shown)} FROM ({TABLE_ROWS[table]})"


def cards() -> str:
    """Title, value and subtitle of the headline cards."""
    rows = (
        ("Total Deliveries", "format('{:,}', total_orders)", "'Active in Scope'"),
        ("SLA Violations", "format('{:,}', sla_violations)", "'Orders > 30 min'"),
        ("SLA Violation Rate", f"{fixed('sla_violation_rate', 1)} || '%'",
         "'Breach Frequency'"),
        ("Avg Delivery Time", f"{fixed('avg_time', 1)} || ' min'",
         f"'Median: ' || {fixed('median_time', 0)} || ' min'"),
        ("Dinner Peak Orders", "format('{:,}', peak_orders)",
         f"{fixed('peak_share_pct', 1)} || '% of Volume'"),
    )
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{title}' AS title, {value} AS value, "
        f"{below} AS subtitle FROM ({KPIS})"
        for i, (title, value, below) in enumerate(rows, 1)
    )


def display_statements() -> dict[str, str]:
    found = {}
    for table in TABLE_ROWS:
        suffix = "" if table == "traffic" else f"_{table}"
        found[f"proj_display_names{suffix}"] = display_columns(table, formatted=False)
        found[f"proj_format{suffix}"] = display_columns(table, formatted=True)
    found["proj_format_kpis"] = cards()
    return {name: from_clean(sql) for name, sql in found.items()}


POINTS = (0.05, 0.10, 0.25, 0.50, 0.75, 0.80, 0.90, 0.95)
TIME_SUMMARY = f"""SELECT count(delivery_time_min) AS count,
    {half_up(MEAN, 6)} AS mean,
    {half_up('stddev_samp(delivery_time_min)', 6)} AS std,
    min(delivery_time_min) AS min, """ + ", ".join(
    f"{half_up(f'CAST(quantile_cont(delivery_time_min, {p}) AS DOUBLE)', 6)} "
    f"AS p{round(p * 100):02d}"
    for p in POINTS
) + ", max(delivery_time_min) AS max FROM clean"
TIME_MARKS = """SELECT CAST(median(delivery_time_min) AS DOUBLE) AS median_minutes,
    CAST(quantile_cont(delivery_time_min, 0.75) AS DOUBLE) AS q3_minutes FROM clean"""


# --- raw log --------------------------------------------------------------------------


def missing(column: str) -> str:
    test = f'"{column}" IS NULL'
    if column in TEXT_COLUMNS:
        test += f' OR "{column}" IN ({MARKERS})'
    return f"""SELECT '{column}' AS column_name,
        count(*) FILTER (WHERE {test}) AS missing_count FROM raw"""


def issue(name: str, test: str) -> str:
    return f"""SELECT '{name}' AS issue, count(*) FILTER (WHERE {test}) AS row_count
        FROM parsed"""


def read_back() -> str:
    """The raw log after a CSV round trip: exact missing markers become null."""
    columns = ", ".join(
        f'CASE WHEN "{c}" NOT IN ({MARKERS}) THEN "{c}" END AS "{c}"'
        if c in TEXT_COLUMNS else f'"{c}"'
        for c in RAW_COLUMNS
    )
    return f"SELECT {columns} FROM raw"


def fraction(column: str) -> str:
    """Second of the day of a time written as a fraction, null for other notations."""
    return f"""CASE WHEN regexp_full_match({column}, '{DECIMAL}')
        THEN round_even(CAST({column} AS DOUBLE) * 24 * 3600, 0) % 86400 END"""


ORDERED, PICKED = '"r_Time_Orderd"', '"r_Time_Order_picked"'
FRACTIONS = f"""SELECT * FROM (SELECT order_id,
    {fraction(ORDERED)} AS time_ordered_second, time_ordered,
    {fraction(PICKED)} AS time_order_picked_second, time_order_picked FROM parsed)
    WHERE time_ordered_second IS NOT NULL OR time_order_picked_second IS NOT NULL"""


def past_day(column: str) -> str:
    return f"""coalesce(contains({column}, ':')
        AND TRY_CAST(split_part({column}, ':', 1) AS INT) >= 24, false)"""


ROLLOVERS = f"""SELECT order_id, {ORDERED} AS time_ordered_written, time_ordered,
    {PICKED} AS time_order_picked_written, time_order_picked
    FROM parsed WHERE {past_day(ORDERED)} OR {past_day(PICKED)}"""

DECIMAL_TIME = "NOT contains(\"r_Time_Orderd\", ':')"

QUALITY = f"""SELECT {N} AS clean_rows, 30 AS sla_threshold,
    {late()} AS sla_violations, {half_up(rate(), 2)} AS sla_violation_rate,
    {half_up(MEAN, 2)} AS avg_time, {half_up(MEDIAN, 1)} AS median_time,
    {PEAK} AS peak_orders,
    {half_up(f"CAST({PEAK} AS DOUBLE) / count(order_hour) * 100e0", 2)}
        AS peak_share_of_known_hours_pct,
    count(delivery_distance_km) AS valid_distances, {half_up(KM, 2)} AS avg_distance,
    count(*) - count(time_ordered) AS missing_order_times,
    (SELECT count(*) FROM raw) AS raw_rows FROM clean"""


def scoped_summary(dim: str) -> str:
    inner = summary(dim, "value", total="(SELECT count(*) FROM scoped)", source="scoped")
    return f"SELECT *, '{dim}' AS dimension FROM ({inner})"


def statements() -> dict[str, str]:
    every_clean = from_clean("SELECT * FROM clean")
    return {
        "scan_raw": from_raw(read_back()),
        "scan_clean": every_clean,
        "sink_clean": every_clean,
        "register_table": from_clean("SELECT * FROM clean"),
        "query_pack": pack_rows(),
        "build_if_missing": from_clean("SELECT * FROM clean"),
        "cache_scope": from_clean(
            f"{scoped_summary('city')} UNION ALL {scoped_summary('weather')}",
            f"scoped AS (SELECT * FROM clean WHERE {IN_SCOPE})",
        ),
        "clean_colnames": from_raw("SELECT * FROM raw"),
        "clean_dedup": from_raw("SELECT DISTINCT * FROM raw"),
        **{
            name: from_parsed(f"SELECT order_id, {columns} FROM parsed")
            for name, columns in RULES.items()
        },
        "clean_excel_fraction": from_parsed(FRACTIONS),
        "clean_midnight_rollover": from_parsed(ROLLOVERS),
        **{
            name: from_clean(f"SELECT order_id, {columns} FROM clean")
            for name, columns in FEATURES.items()
        },
        "clean_select": f"WITH {RAW}, {parsed('raw')}, {CLEAN} SELECT * FROM clean",
        "clean_all": every_clean,
        **display_statements(),
        "agg_time_summary": from_clean(TIME_SUMMARY),
        "agg_time_marks": from_clean(TIME_MARKS),
        **{name: from_clean(sql) for name, sql in FILTERS.items()},
        "limit_head": from_raw('SELECT * FROM raw ORDER BY "ID" LIMIT 5'),
        **{name: from_clean(sql) for name, sql in METRICS.items()},
        "agg_describe": from_parsed(
            " UNION ALL ".join(describe(c, v) for c, v in DESCRIBED.items())
        ),
        "dq_report": from_clean(QUALITY),
        "profile_shape": from_raw(
            "SELECT count(*) AS row_count, 20 AS column_count FROM raw"
        ),
        "profile_nulls": from_raw(" UNION ALL ".join(missing(c) for c in RAW_COLUMNS)),
        "profile_duplicates": from_raw(
            """SELECT (SELECT count(*) FROM raw)
            - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicate_rows"""
        ),
        "dq_issue_audit": from_parsed(" UNION ALL ".join((
            issue("day_fraction_order_times", DECIMAL_TIME),
            issue("past_midnight_pickup_times", "\"r_Time_Order_picked\" LIKE '24:%'"),
            issue("missing_order_times", '"r_Time_Orderd" IS NULL'),
            issue("zero_restaurant_coordinates",
                  '"r_Restaurant_latitude" = 0 OR "r_Restaurant_longitude" = 0'),
            issue("ratings_above_cap", "rating > 5"),
            issue("riders_under_18", "delivery_person_age < 18"),
            issue("missing_city", '"r_City" IS NULL'),
            issue("missing_weather", '"r_Weather_conditions" IS NULL'),
            issue("missing_traffic", '"r_Road_traffic_density" IS NULL'),
            issue("missing_festival", '"r_Festival" IS NULL'),
            issue("missing_multiple_deliveries", '"r_multiple_deliveries" IS NULL'),
        ))),
        **{name: from_clean(sql) for name, sql in INSIGHTS.items()},
    }
