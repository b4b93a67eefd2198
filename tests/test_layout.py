"""Results do not depend on the physical layout: every query with an
oracle gives the same answer with another shuffle width and AQE off."""

from compare import compare

from shoplens.plans import oracle

SF = "/root/testdata/sf0.01"


def test_all_oracle_queries_with_other_layout(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sort-merge joins everywhere
        rep = compare(spark, SF, sorted(oracle.oracle_sql()), verbose=True)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    bad = {k: v for k, v in rep.items() if v != "OK"}
    assert not bad, bad


def test_all_oracle_queries_in_another_session_time_zone(spark):
    """Event times are text with a zone and become UTC wall clocks, review
    days are computed in UTC: no result depends on the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        rep = compare(spark, SF, sorted(oracle.oracle_sql()), verbose=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    bad = {k: v for k, v in rep.items() if v != "OK"}
    assert not bad, bad
