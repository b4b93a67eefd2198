"""The weather service payload as rows.

A payload is ``{"properties": {"parameter": {PARAM: {yyyyMMdd: value}}}}``
per city. Dates come from the temperature map; every other parameter is
looked up by the same key, and a missing key gives null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import parse_compact_date
from ..schemas import WEATHER_PAYLOAD
from ..settings import CITIES, WEATHER_PARAMETERS, WEATHER_SENTINEL

DATE_KEY_FORMAT = "yyyyMMdd"


def flatten_weather_payload(
    payloads: DataFrame,
    city_col: str = "city",
    payload_col: str = "payload",
    sentinel: float = WEATHER_SENTINEL,
) -> DataFrame:
    """S4 + S5 + S6: one row per (city, date) with the four measures.

    Narrow (no shuffle): each payload is parsed once, its parameter maps are
    merged key by key with ``map_zip_with`` (a hash merge, linear in the
    map size) into one map date → struct of measures, and only that map is
    exploded. Keys come from the first parameter; a key missing from
    another parameter, or a missing parameter, gives null."""
    params = F.from_json(F.col(payload_col), WEATHER_PAYLOAD)["properties"]["parameter"]
    (first_code, first_name), rest = WEATHER_PARAMETERS[0], WEATHER_PARAMETERS[1:]
    merged = F.transform_values(
        F.try_element_at(params, F.lit(first_code)), lambda k, v: F.struct(v.alias(first_name))
    )
    empty = F.create_map().cast("map<string,double>")

    def add_field(name: str):
        return lambda k, a, b: F.when(a.isNotNull(), a.withField(name, b))

    for code, name in rest:
        other = F.coalesce(F.try_element_at(params, F.lit(code)), empty)
        merged = F.map_zip_with(merged, other, add_field(name))
    rows = payloads.select(
        F.col(city_col).alias("city"),
        F.explode(F.map_filter(merged, lambda k, v: v.isNotNull())).alias("__day", "__m"),
    )
    return rows.select(
        "city",
        parse_compact_date("__day", DATE_KEY_FORMAT).alias("date"),
        *[F.nullif(F.col("__m")[name], F.lit(sentinel)).alias(name) for _, name in WEATHER_PARAMETERS],
    )


def read_weather_payloads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Payload files as rows (city, payload): each file holds one city's
    service response and is read whole; the city is the file name without
    its extension (``New York.json`` → ``New York``). Files are independent,
    so this is one task per file and no shuffle."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("wholetext", True).text(paths)
    return raw.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("city"),
        F.col("value").alias("payload"),
    )


def city_dimension(spark: SparkSession) -> DataFrame:
    """The fixed five-city table (name, latitude, longitude)."""
    return spark.createDataFrame(list(CITIES), "city string, latitude double, longitude double")


def attach_city_coordinates(observations: DataFrame, cities: DataFrame) -> DataFrame:
    """Latitude and longitude per observation. Spark broadcasts the city
    table where its size allows."""
    return observations.join(cities, "city", "left")
