"""Shop events, reviews, weather and order purchases as views over the
driver's parquet tables (FIXTURES.md).

Each view is a pure function of its input rows, built once with the
DataFrame API (what the queries run) and once as DuckDB SQL (what the
oracle runs). Both definitions live side by side here so they cannot drift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import REVIEWS, SHOP_EVENTS, WEATHER
from ..settings import CITIES, WEATHER_PARAMETERS
from .weather import DATE_KEY_FORMAT

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# shop events ------------------------------------------------------------------
def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events ⟕ part: clicks become carts, props.k is the product, the part's
    type and brand form a two-level category code, sessions are user-day.
    Time (with its zone) and price are text, as in the raw files.

    Each part is one row of the dimension by construction, so Spark drops the
    join from plans that use none of its columns."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", k.alias("k")
    )
    part = table(spark, sf_dir, "part").groupBy("p_partkey").agg(
        F.max("p_type").alias("p_type"), F.max("p_brand").alias("p_brand"))
    j = ev.join(part, ev.k == part.p_partkey, "left")
    return j.select(
        "event_id",
        F.concat(F.substring(F.col("ts").cast("string"), 1, 19), F.lit(" UTC")).alias("event_time"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        F.col("k").alias("product_id"),
        F.when(F.col("k") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("p_type"), F.lit("."), F.col("p_brand")))
        .alias("category_code"),
        F.col("value").cast("string").alias("price"),
        "user_id",
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("-"),
                            F.col("ts").cast("date").cast("string")))
        .alias("user_session"),
    )


SHOP_EVENTS_SQL = """
shop_events AS (
  SELECT e.event_id, CAST(date_trunc('second', e.ts) AS TIMESTAMP) AS event_time,
         CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS event_type,
         e.k AS product_id,
         CASE WHEN e.k % 10 = 0 THEN NULL ELSE p.p_type || '.' || p.p_brand END AS category_code,
         e.value AS price, e.user_id,
         CASE WHEN e.event_id % 50 = 0 THEN NULL
              ELSE CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) END AS user_session
  FROM (SELECT event_id, ts, user_id, event_type, value,
               TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN (SELECT p_partkey, max(p_type) AS p_type, max(p_brand) AS p_brand FROM part GROUP BY p_partkey) p
    ON p.p_partkey = e.k
)"""


# order purchases (daily purchases for the weather join) ---------------------------
def order_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one purchase event: order date, total price, customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("event_time"),
        F.lit("purchase").alias("event_type"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("user_id"),
    )


ORDER_PURCHASES_SQL = """
order_purchases AS (
  SELECT o_orderkey AS event_id, o_orderdate AS event_time, 'purchase' AS event_type,
         o_totalprice AS price, o_custkey AS user_id
  FROM orders
)"""


# reviews ----------------------------------------------------------------------
def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⟕ labels: quality and toxicity become a star rating; an
    unlabelled document's comes from its id, one in 29 of them without any.
    The source is the product, one day per doc."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    q, t, i = F.col("quality"), F.col("toxic"), F.col("doc_id")
    rating = (
        F.when((q == 1) & (t == 0), F.when(i % 3 == 0, 4.0).otherwise(5.0))
        .when((q == 0) & (t == 0), 3.0)
        .when(q == 1, 2.0)
        .when(q == 0, 1.0)
        .when(i % 29 != 0, 1.0 + i % 5)
    )
    return j.select(
        "doc_id",
        rating.cast("double").alias("rating"),
        F.when(i % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("title"),
        "text",
        F.col("source").alias("asin"),
        (F.lit(1577836800000) + i * 86400000).alias("timestamp"),
        (F.col("n_chars") % 10).alias("helpful_vote"),
        F.when(i % 11 == 0, F.lit(None).cast("boolean")).otherwise(i % 4 != 0).alias("verified_purchase"),
    )


REVIEWS_SQL = """
reviews AS (
  SELECT d.doc_id,
         CAST(CASE WHEN l.quality = 1 AND l.toxic = 0 THEN CASE WHEN d.doc_id % 3 = 0 THEN 4.0 ELSE 5.0 END
                   WHEN l.quality = 0 AND l.toxic = 0 THEN 3.0
                   WHEN l.quality = 1 THEN 2.0
                   WHEN l.quality = 0 THEN 1.0
                   WHEN d.doc_id % 29 <> 0 THEN 1.0 + d.doc_id % 5 END AS DOUBLE) AS rating,
         CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE d.source END AS title,
         d.text, d.source AS asin,
         1577836800000 + d.doc_id * 86400000 AS timestamp,
         d.n_chars % 10 AS helpful_vote,
         CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE d.doc_id % 4 <> 0 END AS verified_purchase
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


# weather ----------------------------------------------------------------------
def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as an observation: ship date, the supplier's region
    as the city. Temperature is seasonal (5 degrees per month of the ship
    date, from -20 in January) plus a spread of -5..5 from the quantity, so
    daily means cover every bucket; quantity 50 carries the -999 sentinel.
    All measures are integer-valued, so sums are exact on any engine."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_shipdate"
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation and region are fixed-size dimensions (25 and 5 rows)
    nat = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    reg = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    j = (
        li.join(sup, li.l_suppkey == sup.s_suppkey)
        .join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(reg, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return j.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("r_name").alias("city"),
        F.when(F.col("l_quantity") == 50, F.lit(-999.0))
        .otherwise(F.month("l_shipdate") * 5 - 25 + F.col("l_quantity") % 11 - 5)
        .alias("temperature"),
        F.greatest(F.lit(0.0), F.round(F.col("l_tax") * 100) - 6).alias("precipitation"),
        F.round(F.col("l_discount") * 100).alias("wind_speed"),
        (F.lit(40) + F.col("l_partkey") % 61).cast("double").alias("humidity"),
    )


WEATHER_SQL = """
weather AS (
  SELECT CAST(l_shipdate AS DATE) AS date, r_name AS city,
         CASE WHEN l_quantity = 50 THEN -999.0::DOUBLE
              ELSE month(l_shipdate) * 5 - 25 + l_quantity % 11 - 5 END AS temperature,
         greatest(0.0::DOUBLE, round(l_tax * 100) - 6) AS precipitation,
         round(l_discount * 100) AS wind_speed,
         CAST(40 + l_partkey % 61 AS DOUBLE) AS humidity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
)"""


def weather_payloads(weather: DataFrame, missing_humidity_day: int = 1) -> DataFrame:
    """Service-shaped payloads built from weather rows (for tests and the
    registered query): per city, one map per parameter from date key to
    the day's value (max over that city's observations). Humidity keys of
    day-of-month ``missing_humidity_day`` are left out, so lookups of a
    missing key are exercised. The map per city is bounded by the number of
    calendar days in the window."""
    daily = weather.groupBy("city", "date").agg(*[F.max(n).alias(n) for _, n in WEATHER_PARAMETERS])
    key = F.date_format("date", DATE_KEY_FORMAT)

    def entries(name: str, keep=None):
        e = F.struct(key.alias("k"), F.col(name).alias("v"))
        return F.collect_list(e if keep is None else F.when(keep, e)).alias(name)

    grouped = daily.groupBy("city").agg(*[
        entries(name, F.dayofmonth("date") != missing_humidity_day if name == "humidity" else None)
        for _, name in WEATHER_PARAMETERS
    ])
    parameter = F.create_map(*[
        x for code, name in WEATHER_PARAMETERS for x in (F.lit(code), F.map_from_entries(F.col(name)))
    ])
    payload = F.to_json(F.struct(F.struct(parameter.alias("parameter")).alias("properties")))
    return grouped.select("city", payload.alias("payload"))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dimension of the fixture: each region stands for one of the five
    cities, in key order, and has its coordinates."""
    key = F.col("r_regionkey")
    lat, lon = (F.element_at(F.array(*[F.lit(c[k]) for c in CITIES]), key + 1) for k in (1, 2))
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("city"), lat.alias("latitude"), lon.alias("longitude"))


CITIES_SQL = f"""
cities AS (
  SELECT r_name AS city, [{", ".join(f"{c[1]}::DOUBLE" for c in CITIES)}][r_regionkey + 1] AS latitude,
         [{", ".join(f"{c[2]}::DOUBLE" for c in CITIES)}][r_regionkey + 1] AS longitude
  FROM region
)"""


# text lines, as the raw inputs hold them -----------------------------------------
def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop events as CSV lines in the order of the declared schema."""
    ev = shop_events(spark, sf_dir).withColumns({
        "category_id": F.col("product_id") * 10, "brand": F.substring_index("category_code", ".", -1)})
    return ev.select(F.to_csv(F.struct(*SHOP_EVENTS.fieldNames())).alias("line"))


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as JSON lines."""
    return reviews(spark, sf_dir).select(F.to_json(F.struct(*REVIEWS.fieldNames())).alias("line"))


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather observations with their city's coordinates as CSV lines."""
    rows = weather(spark, sf_dir).join(cities(spark, sf_dir), "city", "left")
    return rows.select(F.to_csv(F.struct(*WEATHER.fieldNames())).alias("line"))


#: Faults planted in the lines, by event or document id.
EVENT_FAULTS = {"cut": 97, "price": 89, "time": 83, "type": 79}
REVIEW_FAULTS = {"cut": 61, "rating": 53, "high": 47}


def faulty_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_lines`` with the event's id as the brand and with faults: lines
    cut short, prices and times that are none, empty types."""
    i = F.col("event_id")
    ev = shop_events(spark, sf_dir).withColumns({
        "category_id": F.col("product_id") * 10, "brand": i.cast("string"),
        "price": F.when(i % EVENT_FAULTS["price"] == 0, "n/a").otherwise(F.col("price")),
        "event_time": F.when(i % EVENT_FAULTS["time"] == 0, "yesterday").otherwise(F.col("event_time")),
        "event_type": F.when(i % EVENT_FAULTS["type"] == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))})
    whole = F.to_csv(F.struct(*SHOP_EVENTS.fieldNames()))
    return ev.select(F.when(i % EVENT_FAULTS["cut"] == 0, F.concat(F.lit("cut off,"), i.cast("string"))).otherwise(whole)
                     .alias("line"))


def faulty_review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_lines`` with the document's id as the product and with faults:
    JSON that ends early, ratings that are none or too high."""
    i = F.col("doc_id")
    rating = (F.when(i % REVIEW_FAULTS["rating"] == 0, "five").when(i % REVIEW_FAULTS["high"] == 0, "9.0")
              .otherwise(F.col("rating").cast("string")))
    rows = reviews(spark, sf_dir).withColumns({"rating": rating, "asin": i.cast("string")})
    whole = F.to_json(F.struct(*REVIEWS.fieldNames()))
    return rows.select(F.when(i % REVIEW_FAULTS["cut"] == 0, F.concat(F.lit('{"asin": "'), i.cast("string"))).otherwise(whole)
                       .alias("line"))
