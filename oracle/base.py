"""DuckDB spelling of the derived order log and of its cleaning.

Written independently of the Spark code: plain SQL over the ``events`` view.
"""

from __future__ import annotations

from oracle.values import MISSING_MARKERS, WHITESPACE

MARKERS = ", ".join(f"'{m}'" for m in MISSING_MARKERS)
SPACES = "concat(" + ", ".join(f"chr({c})" for c in WHITESPACE) + ")"
DECIMAL = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"

RAW_COLUMNS = (
    "ID", "Delivery_person_ID", "Delivery_person_Age", "Delivery_person_Ratings",
    "Restaurant_latitude", "Restaurant_longitude", "Delivery_location_latitude",
    "Delivery_location_longitude", "Order_Date", "Time_Orderd", "Time_Order_picked",
    "Weather_conditions", "Road_traffic_density", "Vehicle_condition",
    "Type_of_order", "Type_of_vehicle", "multiple_deliveries", "Festival", "City",
    "Time_taken (min)",
)
TEXT_COLUMNS = (
    "ID", "Delivery_person_ID", "Delivery_person_Age", "Delivery_person_Ratings",
    "Order_Date", "Time_Orderd", "Time_Order_picked", "Weather_conditions",
    "Road_traffic_density", "Type_of_order", "Type_of_vehicle", "Festival", "City",
)


def half_up(value: str, places: int) -> str:
    """Round the shortest decimal form of a double half up, as Spark does."""
    decimal = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({decimal}, {places}) AS DOUBLE)"


def fixed(value: str, places: int) -> str:
    """Text of a double with a fixed number of decimals, rounded half up."""
    return f"printf('%.{places}f', {half_up(value, places)})"


def hhmm(minutes: str) -> str:
    return (
        f"lpad(CAST({minutes} // 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({minutes} % 60 AS VARCHAR), 2, '0')"
    )


# Spark writes doubles below 1e-3 with an exponent; of the day fractions only
# minute 1 is that small.
RAW = f"""
events_twice AS (
    SELECT event_id AS e, user_id AS u, ts, hour(ts) * 60 + minute(ts) AS om,
           unnest(CASE WHEN event_id % 500 = 0 THEN [1, 2] ELSE [1] END) AS copy
    FROM events
),
raw AS (
    SELECT
        ' O' || e || ' ' AS "ID",
        'R' || u AS "Delivery_person_ID",
        CASE WHEN e % 50 = 0 THEN NULL WHEN e % 97 = 0 THEN '15'
             ELSE CAST(20 + u % 20 AS VARCHAR) END AS "Delivery_person_Age",
        CASE WHEN e % 53 = 0 THEN 'NaN ' WHEN e % 211 = 0 THEN '6.0'
             ELSE (3 + e % 2) || '.' || (e % 10) END AS "Delivery_person_Ratings",
        CASE WHEN e % 12 = 0 THEN 0e0
             WHEN e % 101 = 0 THEN -(12 + (e % 1000) / 100e0)
             ELSE 12 + (e % 1000) / 100e0 END AS "Restaurant_latitude",
        CASE WHEN e % 12 = 0 THEN 0e0
             ELSE 72 + (e % 700) / 100e0 END AS "Restaurant_longitude",
        (12 + (e % 1000) / 100e0 + (e % 14) / 100e0)
            * CASE WHEN e % 103 = 0 THEN -1 ELSE 1 END
            AS "Delivery_location_latitude",
        72 + (e % 700) / 100e0 + (e % 14) / 100e0 AS "Delivery_location_longitude",
        ' ' || strftime(ts, '%d-%m-%Y') AS "Order_Date",
        CASE WHEN e % 26 = 0 THEN NULL
             WHEN e % 7 = 0 AND om = 1 THEN '6.944444444444445E-4'
             WHEN e % 7 = 0 THEN CAST(om / 1440e0 AS VARCHAR)
             ELSE {hhmm('om')} END AS "Time_Orderd",
        {hhmm('(om + (e % 3 + 1) * 5)')}
            || CASE WHEN e % 2 = 0 THEN ':00' ELSE '' END AS "Time_Order_picked",
        CASE WHEN e % 74 = 0 THEN NULL WHEN e % 75 = 0 THEN 'NaN'
             ELSE ['Sunny', 'Cloudy', 'Fog', 'Stormy', 'Sandstorms', 'Windy'][e % 6 + 1]
             END AS "Weather_conditions",
        CASE WHEN e % 76 = 0 THEN NULL
             ELSE ['Low', 'Medium', 'High', 'Jam'][(e // 6) % 4 + 1] || ' '
             END AS "Road_traffic_density",
        CAST(e % 4 AS INTEGER) AS "Vehicle_condition",
        ['Snack', 'Meal', 'Drinks', 'Buffet'][e % 4 + 1] AS "Type_of_order",
        ['motorcycle', 'scooter', 'electric_scooter', 'bicycle'][(e // 4) % 4 + 1]
            AS "Type_of_vehicle",
        CASE WHEN e % 46 = 0 THEN NULL
             ELSE CAST((e // 24) % 4 AS DOUBLE) END AS "multiple_deliveries",
        CASE WHEN e % 200 = 0 THEN NULL WHEN e % 49 = 0 THEN 'Yes'
             ELSE 'No ' END AS "Festival",
        CASE WHEN e % 38 = 0 THEN NULL WHEN e % 250 = 1 THEN 'Semi-Urban'
             WHEN e % 4 = 1 THEN 'Urban' ELSE 'Metropolitian' END AS "City",
        CAST(10 + (e * 7919) % 25 + ((e // 6) % 4) * 4
             + CASE WHEN om >= 1080 AND om < 1320 THEN 8 ELSE 0 END AS INTEGER)
            AS "Time_taken (min)"
    FROM events_twice
)"""


def _trimmed() -> str:
    return ",\n           ".join(
        f'trim("{c}", spaces.chars) AS "{c}"' for c in TEXT_COLUMNS
    )


def _unmarked() -> str:
    """All columns as r_…: DuckDB names ignore case, so Order_Date is order_date."""
    return ",\n           ".join(
        f'CASE WHEN "{c}" NOT IN ({MARKERS}) THEN "{c}" END AS "r_{c}"'
        if c in TEXT_COLUMNS else f'"{c}" AS "r_{c}"'
        for c in RAW_COLUMNS
    )


def _seconds(text: str) -> str:
    """Second of the day of a day fraction, half-even."""
    return (
        f"(CAST(round_even(TRY_CAST({text} AS DOUBLE) * 24 * 3600, 0) AS BIGINT) "
        f"% 86400 + 86400) % 86400"
    )


def _hour(text: str) -> str:
    return f"""CASE
        WHEN contains({text}, ':')
            THEN (TRY_CAST(split_part({text}, ':', 1) AS BIGINT) % 24 + 24) % 24
        WHEN regexp_full_match({text}, '{DECIMAL}') THEN ({_seconds(text)}) // 3600 END"""


def _minute(text: str) -> str:
    return f"""CASE
        WHEN contains({text}, ':') THEN TRY_CAST(split_part({text}, ':', 2) AS BIGINT)
        WHEN regexp_full_match({text}, '{DECIMAL}')
            THEN ({_seconds(text)}) % 3600 // 60 END"""


def _clock(hour: str, minute: str) -> str:
    return f"printf('%02d', {hour}) || ':' || printf('%02d', {minute})"


def _number(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '{DECIMAL}') "
        f"THEN TRY_CAST({text} AS DOUBLE) END"
    )


def parsed(source: str) -> str:
    """CTEs that clean every row of ``source`` into ``parsed``."""
    km = """2 * asin(sqrt(least(greatest(
            sin(dphi / 2) * sin(dphi / 2)
            + cos(phi1) * cos(phi2) * sin(dlam / 2) * sin(dlam / 2), 0), 1))) * 6371e0"""
    return f"""
spaces AS (SELECT {SPACES} AS chars),
trimmed AS (
    SELECT raw_rows.* REPLACE (
           {_trimmed()}
    ) FROM {source} raw_rows, spaces
),
unmarked AS (
    SELECT {_unmarked()}
    FROM trimmed
),
parts AS (
    SELECT *,
        CAST(strptime("r_Order_Date", '%d-%m-%Y') AS DATE) AS order_date,
        {_hour('"r_Time_Orderd"')} AS oh,
        {_minute('"r_Time_Orderd"')} AS omin,
        {_hour('"r_Time_Order_picked"')} AS ph,
        {_minute('"r_Time_Order_picked"')} AS pmin,
        "r_Restaurant_latitude" <> 0 AND "r_Restaurant_longitude" <> 0
            AND "r_Delivery_location_latitude" > 1
            AND "r_Delivery_location_longitude" > 1 AS gps_valid,
        radians(abs("r_Restaurant_latitude")) AS phi1,
        radians(abs("r_Delivery_location_latitude")) AS phi2,
        phi2 - phi1 AS dphi,
        radians(abs("r_Delivery_location_longitude"))
            - radians(abs("r_Restaurant_longitude")) AS dlam
    FROM unmarked
),
parsed AS (
    SELECT *,
        coalesce("r_ID", 'nan') AS order_id,
        "r_Delivery_person_ID" AS delivery_person_id,
        {_number('"r_Delivery_person_Age"')} AS delivery_person_age,
        {_number('"r_Delivery_person_Ratings"')} AS rating,
        CASE WHEN {_number('"r_Delivery_person_Ratings"')} <= 5
             THEN {_number('"r_Delivery_person_Ratings"')} END AS delivery_person_rating,
        CASE WHEN gps_valid
             THEN round_even(({km}) * 100, 0) / 100 END AS delivery_distance_km,
        {_clock('oh', 'omin')} AS time_ordered,
        {_clock('ph', 'pmin')} AS time_order_picked,
        CAST(CASE WHEN omin IS NOT NULL THEN oh END AS INTEGER) AS order_hour,
        CAST(day(order_date) AS INTEGER) AS order_day,
        CAST(month(order_date) AS INTEGER) AS order_month,
        dayname(order_date) AS order_day_name,
        CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
        CAST((ph * 60 + pmin) - (oh * 60 + omin)
             + CASE WHEN (ph * 60 + pmin) < (oh * 60 + omin) THEN 1440 ELSE 0 END
             AS INTEGER) AS pickup_delay_minutes,
        coalesce("r_Weather_conditions", 'Unknown') AS weather,
        coalesce("r_Road_traffic_density", 'Unknown') AS traffic_density,
        "r_Vehicle_condition" AS vehicle_condition,
        "r_Type_of_order" AS order_type,
        "r_Type_of_vehicle" AS vehicle_type,
        CAST(coalesce(trunc("r_multiple_deliveries"), 1) AS INTEGER) AS multiple_deliveries,
        coalesce("r_Festival", 'Unknown') AS festival,
        coalesce("r_City", 'Unknown') AS city,
        "r_Time_taken (min)" AS delivery_time_min
    FROM parts
)"""


CLEAN = """
clean AS (
    SELECT order_id, delivery_person_id, delivery_person_age, delivery_person_rating,
        "r_Restaurant_latitude" AS restaurant_latitude,
        "r_Restaurant_longitude" AS restaurant_longitude,
        "r_Delivery_location_latitude" AS delivery_location_latitude,
        "r_Delivery_location_longitude" AS delivery_location_longitude,
        delivery_distance_km, order_date, time_ordered, time_order_picked, order_hour,
        order_day, order_month, order_day_name, is_weekend, pickup_delay_minutes,
        weather, traffic_density, vehicle_condition, order_type, vehicle_type,
        multiple_deliveries, festival, city,
        delivery_time_min,
        CAST(delivery_time_min > 30 AS INTEGER) AS is_sla_violated,
        CASE WHEN order_hour IS NULL THEN NULL
             WHEN order_hour BETWEEN 18 AND 21 THEN 1 ELSE 0 END AS is_peak_hour,
        CASE WHEN order_hour IS NULL THEN 'Unknown'
             WHEN order_hour BETWEEN 18 AND 21 THEN 'Dinner Peak (18-21)'
             WHEN order_hour BETWEEN 12 AND 13 THEN 'Lunch Peak (12-13)'
             ELSE 'Off-Peak' END AS peak_period
    FROM parsed
)"""

DISTINCT = "distinct_raw AS (SELECT DISTINCT * FROM raw)"


def from_raw(query: str) -> str:
    """A query over ``raw``, the log as written."""
    return f"WITH {RAW}\n{query}"


def from_parsed(query: str) -> str:
    """A query over ``parsed``, every raw row cleaned, copies included."""
    return f"WITH {RAW}, {parsed('raw')}\n{query}"


def from_clean(query: str, *ctes: str) -> str:
    """A query over ``clean``, the fact table."""
    parts = [RAW, DISTINCT, parsed("distinct_raw"), CLEAN, *ctes]
    return "WITH " + ", ".join(parts) + f"\n{query}"
