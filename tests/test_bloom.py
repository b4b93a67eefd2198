"""The Bloom filter clears most events and never changes the result."""

import random

import pytest
from pyspark.sql import functions as F

from shoplens.operators import bloom as L
from shoplens.operators import prep as P
from test_plans import executed_plan


def keys(spark, n, prefix="k"):
    return spark.range(n, numPartitions=4).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("user_session"))


@pytest.mark.parametrize("n,rate", [(0, 0.01), (1, 0.01), (500, 0.05), (5000, 0.01), (5000, 0.2)])
def test_no_key_is_cleared_and_few_others_are_not(spark, n, rate):
    held = keys(spark, n)
    b = P.bot_prefilter(held, n, rate=rate)
    assert held.filter(~b.may_hold(F.col("user_session"))).count() == 0
    others = keys(spark, 20_000, "other")
    passed = others.filter(b.may_hold(F.col("user_session"))).count() / 20_000
    assert passed <= 1.25 * rate + 0.002
    assert spark.sql("select cast(null as string) as k").filter(b.may_hold(F.col("k"))).count() == 0


def test_its_size_is_bounded_and_then_clears_less(spark):
    assert L.n_words(10 ** 9, 0.001, 1 << 10) == 128 and L.n_words(0, 0.01) == 1
    assert all(L.false_positives(n / L.n_words(n, r, 1 << 30)) <= r for n in (10, 1000, 10 ** 6) for r in (0.2, 0.01, 0.001))
    held = keys(spark, 2000)
    small = P.bot_prefilter(held, 2000, rate=0.001, max_bytes=64)
    assert small.words <= 8 and held.filter(~small.may_hold(F.col("user_session"))).count() == 0
    with pytest.raises(ValueError):
        L.n_words(5, 1.0)


def events(spark, seed=1):
    rng = random.Random(seed)
    rows = [(f"s{rng.randrange(300)}" if rng.random() < 0.7 else "hot" if rng.random() < 0.8 else None, k) for k in range(6000)]
    return spark.createDataFrame(rows, "user_session string, n int")


@pytest.mark.parametrize("rate,max_bytes", [(0.01, 1 << 20), (0.5, 1 << 20), (0.01, 8)])
def test_the_filtered_events_are_the_same(spark, rate, max_bytes):
    e = events(spark)
    bots = P.bot_sessions(e, max_events=15)
    n = bots.count()
    assert n > 5
    want = P.drop_bot_sessions(e, max_events=15)
    got = P.drop_bot_sessions(e, bots=bots, prefilter=P.bot_prefilter(bots, n, rate=rate, max_bytes=max_bytes))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0 and got.columns == want.columns


def test_events_that_it_clears_are_not_shuffled(spark, tmp):
    e = events(spark)
    e.write.parquet(f"{tmp}/events")
    e = spark.read.parquet(f"{tmp}/events")
    P.bot_sessions(e, max_events=100).write.parquet(f"{tmp}/bots")
    bots = spark.read.parquet(f"{tmp}/bots")  # one session, with a third of all events
    n = bots.count()
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
              if spark.conf.get(c, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = P.bot_prefilter(bots, n, rate=0.01)
        plan = executed_plan(P.drop_bot_sessions(e, bots=bots, prefilter=b))
        suspects = e.filter("user_session is not null").filter(b.may_hold(F.col("user_session"))).count()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert "SortMergeJoin" in plan and "Union" in plan
    # Two scans of the events; sessions are dealt out for the join's two
    # sides only, and what the events' side reads there is filtered first.
    final = plan.split("Initial Plan")[0]
    assert final.count("hashpartitioning(user_session") == 2 and final.count(f"{tmp}/events") == 2
    lines = final.split("\n")
    at = [i for i, line in enumerate(lines) if "hashpartitioning(user_session" in line][0]
    assert any("Filter" in line and "xxhash64" in line for line in lines[at + 1:at + 4])
    bot_events = e.join(bots, "user_session", "left_semi").count()
    assert bot_events <= suspects <= bot_events + 0.05 * 6000
