"""Streaming re-use of the batch operators on look-alike event files."""

import os

from pyspark.sql import functions as F

from shoplens.operators import prep as P
from shoplens.operators import weather as W
from shoplens.sources import fixtures as X
from shoplens.streaming import daily_purchase_stream, ingest_events
from shoplens.streaming.events import read_event_stream

SF = "/root/testdata/sf0.001"


def _write_events_csv(spark, path):
    ev = X.order_purchases(spark, SF).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"), "event_type",
        F.lit(1).cast("long").alias("product_id"), F.lit(1).cast("long").alias("category_id"),
        F.lit("a.b").alias("category_code"), F.lit("x").alias("brand"), "price", "user_id",
        F.lit("s").alias("user_session"))
    ev.repartition(3).write.option("header", True).csv(path)


def test_ingest_then_batch_equals_direct_batch(spark, tmp):
    src, out, ck = (os.path.join(tmp, d) for d in ("src", "out", "ck"))
    _write_events_csv(spark, src)
    q = ingest_events(spark, src, out, ck)
    q.awaitTermination(120)
    staged = spark.read.parquet(out)
    from shoplens.sources.files import read_shop_events

    direct = P.prepare_events(read_shop_events(spark, src))
    assert staged.count() == direct.count()
    a = W.daily_purchases(staged).orderBy("event_date").collect()
    b = W.daily_purchases(direct).orderBy("event_date").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    # a second run with the same checkpoint ingests nothing new
    q2 = ingest_events(spark, src, out, ck)
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == direct.count()


def test_daily_purchase_stream_matches_batch_for_closed_days(spark, tmp):
    """All files in one micro-batch (nothing is late); the following
    no-data batch advances the watermark and emits every closed day, which
    must equal the batch operator. Later days stay open in state."""
    src, ck = os.path.join(tmp, "src"), os.path.join(tmp, "ck2")
    _write_events_csv(spark, src)
    stream = P.prepare_events(read_event_stream(spark, src))
    q = (daily_purchase_stream(stream).writeStream.format("memory").queryName("daily_stream")
         .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(180)
    got = {r.event_date: r for r in spark.table("daily_stream").collect()}
    from shoplens.sources.files import read_shop_events

    batch = {r.event_date: r for r in W.daily_purchases(P.prepare_events(read_shop_events(spark, src))).collect()}
    assert got, "no day was emitted"
    for d, r in got.items():
        b = batch[d]
        assert (r.purchase_count, r.daily_revenue, r.avg_order_value) == \
            (b.purchase_count, b.daily_revenue, b.avg_order_value)


def test_watermark_closes_days_and_late_days_count_at_most_once(spark, tmp):
    """Three files, one micro-batch each (oldest first). Days within the
    watermark are complete when emitted; a day arriving after the watermark
    passed it may be dropped or counted (Spark guarantees neither), but it
    is emitted at most once and never double-counted."""
    import time as _time

    src, ck = os.path.join(tmp, "late_src"), os.path.join(tmp, "late_ck")
    os.makedirs(src)
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    files = [
        ["2019-10-10 12:00:00 UTC"] * 3 + ["2019-10-12 12:00:00 UTC"],
        ["2019-10-01 12:00:00 UTC"] * 2,            # late: watermark is already past Oct 2
        ["2019-10-20 12:00:00 UTC"],                # moves the watermark past Oct 13
    ]
    now = _time.time()
    for i, stamps in enumerate(files):
        path = os.path.join(src, f"part-{i}.csv")
        with open(path, "w") as fh:
            fh.write(header + "".join(f"{t},purchase,1,1,a.b,x,10.0,{j},s{j}\n" for j, t in enumerate(stamps)))
        os.utime(path, (now - 100 + i * 10, now - 100 + i * 10))
    stream = P.prepare_events(read_event_stream(spark, src, max_files_per_trigger=1))
    q = (daily_purchase_stream(stream).writeStream.format("memory").queryName("late_stream")
         .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(180)
    rows = [(str(r.event_date), r.purchase_count) for r in spark.table("late_stream").collect()]
    got = dict(rows)
    assert len(rows) == len(got)  # each day emitted once
    assert got["2019-10-10"] == 3 and got["2019-10-12"] == 1
    assert got.get("2019-10-01") in (None, 2)
    assert "2019-10-20" not in got  # still open: the watermark has not passed it
