"""Distinct counts from stored bitmaps equal counts over the events."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoplens.operators import behaviour as B
from shoplens.operators import distinct as D
from shoplens.plans import catalog
from shoplens.sinks import write_results
from shoplens.sources.files import read_results

SF = "/root/testdata/sf0.01"


def events(spark, seed, n=2000):
    rng = random.Random(seed)
    ids = [0, 1, 2, 32767, 32768, 32769, -1, -32768, -70000, 2 ** 40, 2 ** 62] + list(range(100, 160))
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(70)) if rng.random() < 0.95 else None,
             rng.choice(["view", "purchase", None]), rng.choice(ids) if rng.random() < 0.9 else None) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "event_date date, event_type string, user_id long")


def duck(rows, sql):
    frame = pd.DataFrame(rows, columns=["event_date", "event_type", "user_id"], dtype=object)  # noqa: F841
    con = duckdb.connect()
    con.execute("create table e as select cast(event_date as date) event_date, cast(event_type as varchar) event_type, "
                "cast(user_id as bigint) user_id from frame")
    return sorted(con.sql(sql).fetchall(), key=repr)


def same(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_range_equals_a_count_over_the_events(spark, tmp, seed):
    rows, e = events(spark, seed)
    # Stored in three parts that share days.
    for part in range(3):
        some = e.filter(F.pmod(F.xxhash64("user_id", "event_date", "event_type"), F.lit(3)) == part)
        write_results(D.user_bitmaps(some, ["event_date", "event_type"]), tmp, "users", append=True)
    state = read_results(spark, tmp, "users")
    for first, last in (("2020-01-05", "2020-02-10"), ("2020-01-01", "2020-01-01"), ("2019-01-01", "2019-02-01")):
        within = f"event_date between '{first}' and '{last}'"
        assert same(D.distinct_between(state, first, last)) == duck(rows, f"select count(distinct user_id) from e where {within}")
        assert same(D.distinct_between(state, first, last, ["event_type"])) == duck(
            rows, f"select event_type, count(distinct user_id) from e where {within} and user_id is not null group by 1")
    assert same(D.distinct_users(state, ["event_date"])) == duck(
        rows, "select event_date, count(distinct user_id) from e where user_id is not null group by 1")
    assert same(D.distinct_users(state)) == duck(rows, "select count(distinct user_id) from e")


def test_a_late_part_of_a_day_counts_its_users_once(spark):
    rows, e = events(spark, 3)
    once = D.user_bitmaps(e, ["event_date"])
    twice = once.unionByName(once)
    assert same(D.distinct_users(twice, ["event_date"])) == same(D.distinct_users(once, ["event_date"]))
    merged = D.merge_bitmaps(twice, ["event_date"])
    assert merged.count() == once.count()


def test_no_users(spark):
    empty = spark.createDataFrame([], "event_date date, event_type string, user_id long")
    nobody = spark.createDataFrame([(dt.date(2020, 1, 1), "view", None)], empty.schema)
    for e in (empty, nobody):
        state = D.user_bitmaps(e, ["event_date"])
        assert same(D.distinct_users(state)) == [(0,)] and D.distinct_users(state, ["event_date"]).count() == 0
        assert D.calendar_spans(state).count() == 0


def test_stored_days_give_the_daily_and_category_results(spark):
    clean = catalog.clean_events(spark, SF)
    bought = B.purchases(clean)
    daily = D.distinct_users(D.user_bitmaps(bought, ["event_date"]), ["event_date"], "active_buyers")
    assert same(daily) == same(B.daily_trend(clean).select("event_date", "active_buyers"))
    by_category = D.distinct_users(D.user_bitmaps(bought, ["event_date", "category_top"]), ["category_top"], "unique_buyers")
    assert same(by_category.filter("category_top is not null")) == same(
        B.category_behaviour(clean).select("category_top", "unique_buyers"))


def test_the_merge_is_partial_before_the_shuffle(spark):
    state = D.user_bitmaps(events(spark, 4)[1], ["event_date"])
    plan = D.distinct_users(state)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_or_agg" in plan and "partial_sum" in plan
