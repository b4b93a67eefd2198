"""Plan shapes that carry the scale properties (checked on the executed,
adaptive plan): pushdown and pruning at the scan, no shuffle of events by
session, a partial top-k before the shuffle, one pass for the correlation."""

import os

from shoplens.operators import behaviour as B
from shoplens.operators import prep as P
from shoplens.operators import sentiment as R
from shoplens.operators import weather as W
from shoplens.plans import catalog
from shoplens.sources import fixtures as X

SF = "/root/testdata/sf0.01"


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_keywords_limit_each_group_before_the_shuffle(spark):
    plan = executed_plan(R.top_keywords(catalog.clean_reviews(spark, SF), 50))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_bot_filter_is_a_broadcast_anti_join_without_session_shuffle(spark):
    plan = executed_plan(B.category_behaviour(catalog.clean_events(spark, SF)))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    # The one exchange by session carries partial counts; the events
    # themselves are never shuffled by session.
    lines = plan.split("\n")
    by_session = [i for i, line in enumerate(lines) if "hashpartitioning(user_session" in line]
    assert len(by_session) == 1 and "partial_count" in lines[by_session[0] + 1]


def test_filters_and_columns_reach_the_parquet_scan(spark, tmp):
    path = os.path.join(tmp, "prepared")
    P.prepare_events(X.shop_events(spark, SF)).write.parquet(path)
    plan = executed_plan(B.hourly_patterns(spark.read.parquet(path)))
    assert "EqualTo(event_type,purchase)" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "category_code" not in scan and "user_session" not in scan  # pruned columns


def test_correlation_is_one_aggregate_pass(spark):
    plan = executed_plan(W.correlation_matrix(catalog.joined_daily(spark, SF)))
    assert plan.count("functions=[stddev_pop") == 1  # final aggregate once
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_no_cross_joins_anywhere(spark):
    skip = {"classifier_results", "classifier_ablation", "regression_metrics"}
    for name, q in catalog.queries().items():
        if name in skip:
            continue
        plan = executed_plan(q(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_part_is_read_only_where_its_columns_are_used(spark):
    plan = executed_plan(catalog.queries()["event_distribution"](spark, SF))
    assert "p_partkey" not in plan and "p_type" not in plan
    assert "p_partkey" in executed_plan(catalog.queries()["category_profile"](spark, SF))


def test_no_shuffle_by_product_without_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = executed_plan(catalog.queries()["event_distribution"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(k#" not in plan and "hashpartitioning(product_id" not in plan


def test_no_query_leaves_anything_cached(spark):
    spark.catalog.clearCache()
    for name, q in catalog.queries().items():
        q(spark, SF).count()
        assert not spark.sparkContext._jsc.getPersistentRDDs(), name
