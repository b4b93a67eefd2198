"""Command line: the analyses as Spark jobs (run with spark-submit or python -m).

  python -m shoplens weather-ingest --payloads DIR --out DIR [--format csv|parquet]
  python -m shoplens behaviour --events 'DIR/2019-*.csv' --store DIR [--csv-dir DIR]
  python -m shoplens sentiment --reviews FILE.jsonl --store DIR [--csv-dir DIR]
  python -m shoplens weather --events GLOB --weather DIR --store DIR [--csv-dir DIR]
  (--run-id NAME: start a job that died again, without the steps it had finished)
  python -m shoplens ingest-events --source DIR --target DIR --checkpoint DIR

The session comes from spark-submit (master, memory, ``spark.checkpoint.dir``
— a shared folder, where the runners stage cleaned inputs).
"""

from __future__ import annotations

import argparse
import logging

from pyspark import SparkConf
from pyspark.sql import SparkSession

from .session import cluster_conf


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shoplens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("weather-ingest")
    p.add_argument("--payloads", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    for name, inputs in (("behaviour", ["events"]), ("sentiment", ["reviews"]), ("weather", ["events", "weather"])):
        p = sub.add_parser(name)
        for i in inputs:
            p.add_argument(f"--{i}", required=True)
        p.add_argument("--store")
        p.add_argument("--csv-dir")
        p.add_argument("--run-id", help="name of the run; a job that died goes on from the steps it had finished")
        p.add_argument("--format", default=None, help="input format of events/reviews (csv, json, parquet)")
    p = sub.add_parser("ingest-events")
    p.add_argument("--source", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--checkpoint", required=True)
    a = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    builder = SparkSession.builder.appName(f"shoplens-{a.cmd}")
    # What spark-submit sets stays as it is, but for the time zone: days are UTC days.
    given = SparkConf()
    for k, v in cluster_conf().items():
        if not given.contains(k):
            builder = builder.config(k, v)
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    from .plans import jobs

    if a.cmd == "weather-ingest":
        jobs.weather_ingest_job(spark, a.payloads, a.out, fmt=a.format)
    elif a.cmd == "behaviour":
        jobs.behaviour_job(spark, a.events, fmt=a.format or "csv", store=a.store, csv_dir=a.csv_dir, run_id=a.run_id)
    elif a.cmd == "sentiment":
        jobs.sentiment_job(spark, a.reviews, fmt=a.format or "json", store=a.store, csv_dir=a.csv_dir,
                           run_id=a.run_id)
    elif a.cmd == "weather":
        jobs.weather_job(spark, a.events, a.weather, events_fmt=a.format or "csv", store=a.store,
                         csv_dir=a.csv_dir, run_id=a.run_id)
    elif a.cmd == "ingest-events":
        from .streaming import ingest_events

        ingest_events(spark, a.source, a.target, a.checkpoint).awaitTermination()
    spark.stop()


if __name__ == "__main__":
    main()
