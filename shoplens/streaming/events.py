"""Shop events as a stream.

* ``ingest_events`` — new raw event files (CSV/JSON) are prepared (P1–P5,
  all narrow) and appended as Parquet partitioned by ``event_date``, exactly
  once per file (checkpointed). Batch jobs then read columnar, pruned,
  partition-filtered Parquet instead of re-parsing CSV.
* ``daily_purchase_stream`` — the daily-purchase aggregation (A11: count,
  exact revenue, mean order value) over event-time days with a watermark,
  emitted once a day is closed. Distinct buyers need the batch operator
  (exact distinct counts are not incremental).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import as_double, exact_mean, money, utc_wall_clock
from ..operators.prep import prepare_events
from ..schemas import SHOP_EVENTS
from ..settings import DEFAULT, EVENT_TIME_FORMAT


def read_event_stream(spark: SparkSession, source_dir: str, fmt: str = "csv",
                      schema: T.StructType = SHOP_EVENTS, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        # Columns are taken by position: a file with another header fails the stream.
        return r.option("header", True).option("enforceSchema", False).csv(source_dir)
    if fmt == "json":
        return r.json(source_dir)
    return r.parquet(source_dir)


def ingest_events(spark: SparkSession, source_dir: str, target_dir: str, checkpoint: str, *,
                  fmt: str = "csv", time_format: str = EVENT_TIME_FORMAT,
                  available_now: bool = True) -> StreamingQuery:
    """Prepare new event files and append them as date-partitioned Parquet."""
    prepared = prepare_events(read_event_stream(spark, source_dir, fmt), time_format=time_format)
    w = (
        prepared.writeStream.format("parquet")
        .option("path", target_dir)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def daily_purchase_stream(events: DataFrame, *, watermark: str = "1 day",
                          money_type: str = DEFAULT.money_type) -> DataFrame:
    """A11 on a stream of prepared events: per event-time day, purchases,
    exact revenue and mean order value; a day is emitted (append mode) once
    the watermark passes its end. Rows up to ``watermark`` late are always
    counted; older rows may be dropped (Spark guarantees only the former)."""
    p = events.filter(F.col("event_type") == "purchase")
    if isinstance(p.schema["event_time"].dataType, T.TimestampNTZType):
        # Watermarks need an instant; prepared times are UTC wall clocks.
        local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("event_time"))
        p = p.withColumn("event_time", local.cast("timestamp"))
    p = p.withWatermark("event_time", watermark)
    agg = p.groupBy(F.window("event_time", "1 day").alias("day")).agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.sum(money("price", money_type)).alias("__rev"),
        F.count(money("price", money_type)).alias("__n_priced"),
    )
    return agg.select(
        utc_wall_clock(F.col("day.start")).cast("date").alias("event_date"),
        "purchase_count",
        as_double("__rev").alias("daily_revenue"),
        exact_mean("__rev", "__n_priced").alias("avg_order_value"),
    )
