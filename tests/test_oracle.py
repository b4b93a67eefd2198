"""Every registered query with an oracle entry equals its DuckDB SQL at
sf0.01 (row count, column names, order-insensitive values)."""

import pytest

import __spark_entry__ as E
from compare import compare

SF = "/root/testdata/sf0.01"
NAMES = sorted(E.oracle_sql())


def test_every_query_is_registered_with_sql_or_is_a_model():
    from shoplens.plans import catalog, oracle

    assert set(catalog.queries()) - set(oracle.oracle_sql()) == set(catalog.MODEL_QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SF, [name], verbose=True)
    assert rep[name] == "OK", rep[name]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "revenue_rank" in df.columns
