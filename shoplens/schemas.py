"""Declared schemas of the three raw inputs (no schema inference at scale)."""

from pyspark.sql import types as T

SHOP_EVENTS = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])

REVIEWS = T.StructType([
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("helpful_vote", T.LongType()),
    T.StructField("verified_purchase", T.BooleanType()),
])

WEATHER = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
])

# {"properties": {"parameter": {"T2M": {"20191001": 20.5, ...}, ...}}}
WEATHER_PAYLOAD = T.StructType([
    T.StructField("properties", T.StructType([
        T.StructField(
            "parameter",
            T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())),
        ),
    ])),
])
