"""Rejected rows with reason and line, exactly accounted for."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators import prep as P
from shoplens.plans import catalog, jobs
from shoplens.schemas import REVIEWS, SHOP_EVENTS
from shoplens.sources import fixtures as X
from shoplens.sources import rejects as J
from shoplens.sources.files import read_results, read_shop_events

SF = "/root/testdata/sf0.01"
EVENTS = [
    "2019-10-01 00:00:00 UTC,view,1,10,a.b,x,1.5,7,s",          # good
    "2019-10-01 00:00:00 UTC,view,1,10,a.b,x,1.5",               # cut short
    "yesterday,view,1,10,a.b,x,1.5,7,s",                         # no time
    "2019-10-01 00:00:00 UTC,,1,10,a.b,x,1.5,7,s",               # no type
    "2019-10-01 00:00:00 UTC,view,one,10,a.b,x,1.5,7,s",         # no product
    "2019-10-01 00:00:00 UTC,view,,10,a.b,x,1.5,7,s",
    "2019-10-01 00:00:00 UTC,view,1,10,a.b,x,cheap,7,s",         # no price
    "2019-10-01 00:00:00 UTC,view,1,10,,,,,",                    # only what it needs
    "", "just words", "yesterday,,one,ten,a.b,x,cheap,me,s",
    '2019-10-01 00:00:00 UTC,view,1,10,"a,b",x,1.5,7,s',
]


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "line string")


def judged(spark, strict):
    return J.judge_events(J.csv_line_fields(lines(spark, EVENTS), SHOP_EVENTS), strict=strict)


def test_every_line_has_its_reason(spark):
    rows = {r["line"]: r for r in judged(spark, True).collect() if r["reason"]}
    want = {
        EVENTS[1]: "malformed", EVENTS[2]: "unparsable:event_time", EVENTS[3]: "missing:event_type",
        EVENTS[4]: "unparsable:product_id", EVENTS[5]: "missing:product_id", EVENTS[6]: "unparsable:price",
        EVENTS[8]: "missing:event_time", EVENTS[9]: "malformed", EVENTS[10]: "unparsable:event_time"}
    assert {k: r["reason"] for k, r in rows.items()} == want
    assert rows[EVENTS[10]]["problems"] == [
        "unparsable:event_time", "missing:event_type", "unparsable:product_id", "unparsable:category_id",
        "unparsable:price", "unparsable:user_id"]
    kept = judged(spark, True).filter("reason is null").collect()
    assert len(kept) == len(EVENTS) - len(want) and all(r["line"] is None and r["problems"] == [] for r in kept)


def test_without_strict_only_required_fields_reject(spark):
    got = {r["line"] or "kept": (r["reason"], r["price"]) for r in judged(spark, False).collect()}
    assert got[EVENTS[6]] == (None, None)  # kept with a problem, the price null
    assert got[EVENTS[1]][0] is None       # cut behind the price: nothing it needs is missing
    assert got[EVENTS[9]][0] == "malformed" and got[EVENTS[4]][0] == "unparsable:product_id"


def test_rows_in_are_rows_kept_and_rejected(spark):
    for strict in (True, False):
        split = J.split_rows(judged(spark, strict), "events")
        by = {r["outcome"]: r["row_count"] for r in J.account(judged(spark, strict)).collect()}
        assert sum(by.values()) == split.counts["rows"] == len(EVENTS)
        assert split.counts["kept"] == by["kept"] == split.kept.count()
        assert split.counts["rejected"] == len(EVENTS) - by["kept"] == split.rejected.count()
        assert split.kept.columns == SHOP_EVENTS.fieldNames()
    assert J.split_rows(judged(spark, False), "events").counts["noted"] == 2
    none = J.split_rows(judged(spark, True).limit(0), "none")
    assert none.counts == {"rows": 0, "kept": 0, "rejected": 0, "noted": 0} and none.kept.count() == 0


def test_kept_events_are_those_the_analysis_prepares(spark):
    rows = J.csv_line_fields(X.event_lines(spark, SF), SHOP_EVENTS)
    kept = J.judge_events(rows).filter("reason is null").select(*SHOP_EVENTS.fieldNames())
    got = P.prepare_events(kept, required=())
    want = P.prepare_events(X.shop_events(spark, SF).withColumn("price", F.col("price").cast("double")))
    columns = ["event_time", "event_type", "product_id", "price", "user_id", "user_session", "category_top", "event_hour"]
    assert got.select(*columns).exceptAll(want.select(*columns)).count() == 0 and got.count() == want.count()


REVIEW_LINES = [
    '{"rating": 4.0, "title": "fine", "text": "a long enough text", "asin": "p", "timestamp": 1577836800000, "verified_purchase": true}',
    '{"rating": 4.0, "title": "cut', '{"rating": "many", "text": "a long enough text"}', '{"text": "a long enough text"}',
    '{"rating": 9, "text": "a long enough text"}', '{"rating": 2, "text": "short"}', "[1, 2]", "",
    '{"rating": 1, "text": "a long enough text", "timestamp": "soon", "helpful_vote": 3}']


def test_reviews_say_why_they_go(spark):
    t = J.judge_reviews(J.json_line_fields(lines(spark, REVIEW_LINES), REVIEWS))
    got = {"good" if r["line"] is None else r["line"]: r["reason"] for r in t.filter("line is null or line > ''").collect()}
    assert got == {REVIEW_LINES[1]: "malformed", REVIEW_LINES[2]: "unparsable:rating",
                   REVIEW_LINES[3]: "missing:rating", REVIEW_LINES[4]: "out_of_range", REVIEW_LINES[5]: "too_short",
                   REVIEW_LINES[6]: "malformed", "good": None, REVIEW_LINES[8]: None}
    assert "" not in got  # an empty line's text is empty
    assert t.filter("line = ''").first()["reason"] == "missing:rating"
    kept = t.filter("reason is null")
    assert {r["sentiment_label"] for r in kept.collect()} == {0, 2}
    assert kept.filter("line is not null").first()["problems"] == ["unparsable:timestamp"]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_files_of_every_format(spark, tmp, fmt):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    path = os.path.join(tmp, "in")
    if fmt == "parquet":
        spark.createDataFrame([(1, "a"), (None, "b")], schema).write.parquet(path)
        want = {(None, None), ("missing:n", '{"t":"b"}')}
    else:
        text = {"csv": "t,n\na,1\nb,\nc,x\n\"d,e\",2\nf\n", "json": '{"n": 1, "t": "a"}\n{"t": "b"}\n{"n": "x", "t": "c"}\n{"n": \n'}[fmt]
        os.makedirs(path)
        with open(f"{path}/f.{fmt}", "w") as f:
            f.write(text)
        want = ({(None, None), ("missing:n", ",b"), ("unparsable:n", "x,c"), ("malformed", "f")} if fmt == "csv" else
                {(None, None), ("missing:n", '{"t":"b"}'), ("unparsable:n", '{"n":"x","t":"c"}'), ("malformed", '{"n": ')})
    t = J.judge(J.file_fields(spark, path, schema, fmt), schema, ["n"], strict=True)
    assert {(r["reason"], r["line"]) for r in t.collect()} == want


def test_the_job_stores_what_it_rejects(spark, tmp):
    path = os.path.join(tmp, "events")
    os.makedirs(path)
    header = ",".join(SHOP_EVENTS.fieldNames())
    for k in range(2):
        with open(f"{path}/{k}.csv", "w") as f:
            f.write("\n".join([header, *EVENTS]) + "\n")
    store = os.path.join(tmp, "store")
    jobs.behaviour_job(spark, path, store=store)
    rejected = read_results(spark, store, "rejected_events")
    got = {r["reason"]: r["count"] for r in rejected.groupBy("reason").count().collect()}
    # An empty line is no row of a CSV file.
    assert got == {"unparsable:event_time": 4, "missing:event_type": 2, "unparsable:product_id": 2, "missing:product_id": 2,
                   "malformed": 2}
    kept = P.prepare_events(read_shop_events(spark, path)).count()
    # Of five kept lines a file, two have no session, which the bot filter drops.
    assert kept == 10 and read_results(spark, store, "event_distribution", event_type="view").first()["event_count"] == 6


def test_the_registered_account_adds_up(spark):
    total = X.shop_events(spark, SF).count()
    by = {r["outcome"]: r["row_count"] for r in catalog.queries()["event_outcomes"](spark, SF).collect()}
    assert sum(by.values()) == total and catalog.queries()["rejected_events"](spark, SF).count() == total - by["kept"]
