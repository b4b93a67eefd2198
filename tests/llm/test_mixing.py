"""Source mixing against SQL and its own contract."""

import random

import duckdb
import pytest

from shoplens.llm import mixing as M
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.01"


def sql_rows(frame):
    con = duckdb.connect()
    con.register("frame", frame)
    con.execute("create table documents as select cast(doc_id as bigint) as doc_id, text, source from frame")
    return sorted(con.sql(M.MIX_SQL.format(docs="documents")).fetchall(), key=repr)


def spark_rows(docs):
    return cases.rows(M.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken"))


def test_edge_rows_equal_sql(spark):
    import pandas as pd

    frame = pd.DataFrame([(r[0], r[1], r[3]) for r in cases.ROWS], columns=["doc_id", "text", "source"], dtype=object)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    assert spark_rows(cases.documents(spark)) == sql_rows(frame)
    assert M.mix_sources(cases.documents(spark, [])).count() == 0
    assert [r[4] for r in spark_rows(cases.documents(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)]))] == [0, 0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_sources_equal_sql(spark, seed):
    import pandas as pd

    rng = random.Random(seed)
    data = [(i, "w " * int(rng.paretovariate(0.8)), "en", rng.choice("aaaaaabcdefgé") + str(rng.randint(0, 1)), 0)
            for i in range(400)]
    frame = pd.DataFrame([(r[0], r[1], r[3]) for r in data], columns=["doc_id", "text", "source"])
    got = spark_rows(cases.documents(spark, data))
    assert got == sql_rows(frame)


@pytest.mark.parametrize("ids", ["none", "one"])
def test_rows_without_an_id_of_their_own_meet_the_target(spark, ids):
    rows = [(i, f"w{i} " * 10, "en", "a", 1) for i in range(100)]
    rows += [(None if ids == "none" else 7, f"v{i} " * 10, "en", "b", 1) for i in range(200)]
    t = M.mix_sources(cases.documents(spark, rows)).groupBy("source", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r["target"]) <= 10 for r in t) and len(t) == 2
    docs = cases.documents(spark, rows)
    mixed = {r["source"]: r["count"] for r in M.repeat_documents(docs, docs.columns[:5]).groupBy("source").count().collect()}
    assert mixed == {r["source"]: r["sum(taken)"] // 10 for r in t}


def test_targets_are_met(spark):
    t = Q.op2_mix_sources(spark, SF).toPandas()
    assert (t["taken"] <= 2 * t["size"]).all() and (t["taken"] % t["size"].clip(lower=1) == 0).all()
    by = t.groupby(["source_size", "target"]).agg(taken=("taken", "sum"), longest=("size", "max")).reset_index()
    assert ((by["taken"] - by["target"]).abs() <= by["longest"] / 2 + 1).all()
    assert abs(by["target"].sum() - 1.5 * t["size"].sum()) < 1e-3 * t["size"].sum()


def test_the_mix_repeats_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r["doc_id"]: r["repeats"] for r in M.mix_sources(docs).filter("repeats > 0").collect()}
    got = {r["doc_id"]: r["count"] for r in M.repeat_documents(docs, docs.columns).groupBy("doc_id").count().collect()}
    assert got == want
    odd = M.repeat_documents(cases.documents(spark), ["doc_id", "text", "lang", "source", "n_chars"])
    assert odd.columns == ["doc_id", "text", "lang", "source", "n_chars"] and odd.count() > 0


def test_no_python_in_the_plan(spark):
    plan = Q.op2_mix_sources(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
