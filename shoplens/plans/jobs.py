"""The three analyses as job runners: read → prepare → stage → operators →
sinks. Runners own staging and writes; operators stay lazy.

The cleaned input of each analysis feeds several result tables, so it is
staged once as Parquet in the checkpoint folder (``session.stage_table``):
later stages read files instead of recomputing the parse, the regex
cleaning and the bot-filter shuffle, and a lost executor costs a re-read.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import behaviour as B
from ..operators import models as M
from ..operators import prep as P
from ..operators import sentiment as R
from ..operators import weather as W
from ..schemas import REVIEWS, SHOP_EVENTS
from ..session import Ledger, fingerprint, remove_run
from ..settings import CSV_NAMES, DEFAULT, Settings
from ..sinks import write_csv, write_results
from ..sources import files, rejects
from ..sources import weather as SW


log = logging.getLogger("shoplens.jobs")


def _log_counts(job: str, counts: dict) -> None:
    """Rows at each staged step (the reference only logged them)."""
    for stage, n in counts.items():
        log.info("%s: %s = %s rows", job, stage, n)


# L1: presentation order of each result, applied only at the outermost step
# (what the job returns and the CSV export); operators and the result store
# stay unordered. A leading "-" sorts descending.
ORDER: dict[str, list[str]] = {
    "event_distribution": ["-event_count"],
    "category_behaviour": ["revenue_rank", "category_top"],
    "hourly_patterns": ["event_hour"],
    "daily_patterns": ["event_weekday"],
    "daily_trend": ["event_date"],
    "rating_distribution": ["rating"],
    "monthly_trend": ["year_month"],
    "top_keywords": ["sentiment_group", "-frequency", "word"],
    "daily_joined_data": ["event_date"],
    "correlation_matrix": ["variable_1", "variable_2"],
    "rain_analysis": ["rain_day"],
}


def ordered(df: DataFrame, label: str) -> DataFrame:
    spec = ORDER.get(label)
    if not spec:
        return df
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in spec])


def _sink(results: dict[str, DataFrame], store: str | None, csv_dir: str | None, ledger: Ledger) -> dict[str, DataFrame]:
    """Write each result once and return all in their order: CSV files and
    the returned frames come from the store where there is one."""
    out = {}
    for label, df in results.items():
        if store:
            if ledger.finished(f"result-{label}") != {"store": store}:
                write_results(df, store, label)
                ledger.finish(f"result-{label}", {"store": store})
            df = files.read_results(df.sparkSession, store, label).drop("analysis")
        out[label] = ordered(df, label)
        if csv_dir and label in CSV_NAMES:
            write_csv(out[label], f"{csv_dir.rstrip('/')}/{CSV_NAMES[label]}")
    return out


def _finish(spark: SparkSession, results: dict[str, DataFrame], store: str | None, csv_dir: str | None,
            ledger: Ledger) -> dict[str, DataFrame]:
    """Sinks; with a store, nothing reads the staged tables any more and the
    run's folder goes."""
    out = _sink(results, store, csv_dir, ledger)
    if store:
        remove_run(spark, ledger.run_id)
    return out


def _ledger(spark: SparkSession, job: str, run_id: str | None, inputs: list, settings: Settings) -> Ledger:
    """A named run can be resumed; any other is new."""
    return Ledger(spark, run_id, fingerprint(spark, job, inputs, settings) if run_id else None)


def behaviour_job(spark: SparkSession, events_path: str | list[str], *, fmt: str = "csv",
                  store: str | None = None, csv_dir: str | None = None,
                  settings: Settings = DEFAULT, run_id: str | None = None) -> dict[str, DataFrame]:
    """RQ1: event distribution, funnel, categories, hourly / weekday / daily,
    and the rejected rows with reason and line. A job that died is resumed
    by its ``run_id``: steps that had finished on the same files are read."""
    ledger = _ledger(spark, f"behaviour-{fmt}", run_id, [events_path], settings)
    judged = rejects.judge_events(rejects.file_fields(spark, events_path, SHOP_EVENTS, fmt),
                                  time_format=settings.event_time_format)
    # The text is parsed once; sessions are then counted from one column of
    # that table, and only the columns that the results read are kept.
    split = rejects.split_rows(
        P.prepare_events(judged, time_format=settings.event_time_format,
                         category_separator=settings.category_separator, required=())
        .select("event_type", "user_id", "user_session", "price", "category_top", "event_hour", "event_weekday",
                "event_date", "reason", "problems", "line"),
        "prepared_events", ledger,
    )
    prepared = split.kept
    counts: dict[str, int] = {}
    bots = ledger.stage(P.bot_sessions(prepared, max_events=settings.max_session_events), "bot_sessions", counts)
    prefilter = None
    if counts["bot_sessions"] > settings.bot_broadcast_rows:
        prefilter = P.bot_prefilter(bots, counts["bot_sessions"], rate=settings.bot_prefilter_rate,
                                    max_bytes=settings.bot_prefilter_bytes)
    clean = P.drop_bot_sessions(prepared, max_events=settings.max_session_events, bots=bots, prefilter=prefilter)
    _log_counts("behaviour", counts | {f"prepared_events ({k})": n for k, n in split.counts.items()})
    rsd = settings.distinct_rsd
    results = {
        "event_distribution": B.event_distribution(clean, rsd),
        "conversion_funnel": B.conversion_funnel(clean),
        "category_behaviour": B.category_behaviour(clean, settings.money_type, rsd),
        "hourly_patterns": B.hourly_patterns(clean, settings.money_type),
        "daily_patterns": B.daily_patterns(clean, settings.money_type),
        "daily_trend": B.daily_trend(clean, settings.money_type, rsd),
        "rejected_events": split.rejected.select("reason", "problems", "line"),
    }
    return _finish(spark, results, store, csv_dir, ledger)


def sentiment_job(spark: SparkSession, reviews_path: str | list[str], *, key: str | None = None,
                  fmt: str = "json", store: str | None = None, csv_dir: str | None = None,
                  settings: Settings = DEFAULT, run_id: str | None = None) -> dict[str, DataFrame]:
    """RQ2: rating distribution, verified stats, monthly trend, keywords,
    classifier. ``key`` names a column that identifies a review (sampling
    and the split hash it); without one, a content hash of the review is
    used, which is just as independent of file layout. Rejected reviews are
    returned with reason and line; ``run_id`` resumes a job that died."""
    ledger = _ledger(spark, f"sentiment-{fmt}-{key}", run_id, [reviews_path], settings)
    schema = REVIEWS
    if key is not None and key not in schema.fieldNames():
        schema = T.StructType([T.StructField(key, T.StringType()), *schema.fields])
    judged = rejects.judge_reviews(
        rejects.file_fields(spark, reviews_path, schema, fmt), schema=schema, min_length=settings.min_review_length,
        min_rating=settings.min_rating, max_rating=settings.max_rating, category=settings.review_category)
    if key is None:
        key = "review_key"
        judged = judged.withColumn(key, F.xxhash64("asin", "timestamp", "rating", "title", "text"))
    # Stage only what the results read: the cleaned text, not the raw
    # title/text and their concatenation (the corpus would be stored 3x).
    kept = F.col("reason").isNull()
    split = rejects.split_rows(
        judged.withColumn("review_clean", F.when(kept, F.col("review_clean")))
        .select(*dict.fromkeys([key, "asin", "rating", "timestamp", "helpful_vote", "verified_purchase",
                                "review_clean", "sentiment_label", "review_date", "category"]),
                "reason", "problems", "line"),
        "clean_reviews", ledger,
    )
    clean = split.kept
    _log_counts("sentiment", {f"clean_reviews ({k})": n for k, n in split.counts.items()})
    results = {
        "rating_distribution": R.rating_distribution(clean),
        "verified_stats": R.verified_stats(clean),
        "monthly_trend": R.monthly_trend(clean),
        "top_keywords": R.top_keywords(clean, settings.keyword_top_n,
                                       min_length=settings.keyword_min_length, stop_words=settings.stop_words),
        "classifier_results": M.classifier_results(
            clean, key=key, fractions=settings.sample_fractions, train_fraction=settings.train_fraction,
            seed=settings.seed, num_features=settings.num_features, min_doc_freq=settings.min_doc_freq,
            max_iter=settings.classifier_max_iter, reg_param=settings.classifier_reg_param,
            stage=ledger.stage),
        "rejected_reviews": split.rejected.select("reason", "problems", "line"),
    }
    return _finish(spark, results, store, csv_dir, ledger)


def weather_job(spark: SparkSession, events_path: str | list[str], weather_path: str | list[str], *,
                events_fmt: str = "csv", weather_fmt: str = "csv", store: str | None = None,
                csv_dir: str | None = None, settings: Settings = DEFAULT,
                run_id: str | None = None) -> dict[str, DataFrame]:
    """RQ3: daily join, correlation, rain and temperature buckets, regression.
    ``run_id`` resumes a job that died."""
    ledger = _ledger(spark, f"weather-{events_fmt}-{weather_fmt}", run_id, [events_path, weather_path], settings)
    events = P.prepare_events(files.read_shop_events(spark, events_path, events_fmt),
                              time_format=settings.event_time_format, required=())
    weather = P.null_sentinel(files.read_weather(spark, weather_path, weather_fmt),
                              list(W.MEASURES), settings.weather_sentinel)
    counts: dict[str, int] = {}
    joined = ledger.stage(
        W.join_daily(W.daily_purchases(events, settings.money_type, settings.distinct_rsd, exact=True),
                     W.daily_weather(weather, settings.rain_threshold)),
        "daily_joined", counts,
    )
    _log_counts("weather", counts)
    exact, joined = joined, joined.withColumn("daily_revenue", F.col("daily_revenue").cast("double"))
    results = {
        "daily_joined_data": joined,
        "correlation_matrix": W.correlation_matrix(joined),
        "rain_analysis": W.rain_analysis(exact, settings.money_type),
        "temperature_buckets": W.temperature_buckets(exact, settings.money_type),
        "regression_metrics": M.regression_metrics(
            joined, key="event_date", train_fraction=settings.train_fraction, seed=settings.seed,
            max_iter=settings.regression_max_iter, reg_param=settings.regression_reg_param,
            stage=ledger.stage),
    }
    return _finish(spark, results, store, csv_dir, ledger)


def weather_ingest_job(spark: SparkSession, payload_path: str | list[str], out_path: str, *,
                       fmt: str = "csv") -> DataFrame:
    """Step 0 without the HTTP client: service payload files (one per city)
    → one row per city and day with coordinates → the weather table RQ3
    reads (CSV with header, or Parquet)."""
    rows = SW.attach_city_coordinates(
        SW.flatten_weather_payload(SW.read_weather_payloads(spark, payload_path)), SW.city_dimension(spark)
    ).select("date", "city", "latitude", "longitude", *W.MEASURES)
    w = rows.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(out_path)
    else:
        w.parquet(out_path)
    return files.read_weather(spark, out_path, fmt)
