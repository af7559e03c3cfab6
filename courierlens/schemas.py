"""Declared schemas of the two stages of the order log."""

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("Delivery_person_ID", T.StringType()),
    T.StructField("Delivery_person_Age", T.StringType()),
    T.StructField("Delivery_person_Ratings", T.StringType()),
    T.StructField("Restaurant_latitude", T.DoubleType()),
    T.StructField("Restaurant_longitude", T.DoubleType()),
    T.StructField("Delivery_location_latitude", T.DoubleType()),
    T.StructField("Delivery_location_longitude", T.DoubleType()),
    T.StructField("Order_Date", T.StringType()),
    T.StructField("Time_Orderd", T.StringType()),
    T.StructField("Time_Order_picked", T.StringType()),
    T.StructField("Weather_conditions", T.StringType()),
    T.StructField("Road_traffic_density", T.StringType()),
    T.StructField("Vehicle_condition", T.IntegerType()),
    T.StructField("Type_of_order", T.StringType()),
    T.StructField("Type_of_vehicle", T.StringType()),
    T.StructField("multiple_deliveries", T.DoubleType()),
    T.StructField("Festival", T.StringType()),
    T.StructField("City", T.StringType()),
    T.StructField("Time_taken (min)", T.IntegerType()),
])

CLEAN_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("delivery_person_id", T.StringType()),
    T.StructField("delivery_person_age", T.DoubleType()),
    T.StructField("delivery_person_rating", T.DoubleType()),
    T.StructField("restaurant_latitude", T.DoubleType()),
    T.StructField("restaurant_longitude", T.DoubleType()),
    T.StructField("delivery_location_latitude", T.DoubleType()),
    T.StructField("delivery_location_longitude", T.DoubleType()),
    T.StructField("delivery_distance_km", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("time_ordered", T.StringType()),
    T.StructField("time_order_picked", T.StringType()),
    T.StructField("order_hour", T.IntegerType()),
    T.StructField("order_day", T.IntegerType()),
    T.StructField("order_month", T.IntegerType()),
    T.StructField("order_day_name", T.StringType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("pickup_delay_minutes", T.IntegerType()),
    T.StructField("weather", T.StringType()),
    T.StructField("traffic_density", T.StringType()),
    T.StructField("vehicle_condition", T.IntegerType()),
    T.StructField("order_type", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("multiple_deliveries", T.IntegerType()),
    T.StructField("festival", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("delivery_time_min", T.IntegerType()),
    T.StructField("is_sla_violated", T.IntegerType()),
    T.StructField("is_peak_hour", T.IntegerType()),
    T.StructField("peak_period", T.StringType()),
])

CLEAN_COLUMNS = CLEAN_SCHEMA.fieldNames()
