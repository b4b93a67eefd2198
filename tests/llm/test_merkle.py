"""Merkle manifest against a tree built by hand, row by row."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoplens.llm import merkle as M
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.01"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)])


def tree(digests, fanout):
    """Root, and the siblings (before, after) of every leaf from below."""
    level, at, paths = list(digests), list(range(len(digests))), [[] for _ in digests]
    while len(level) > 1:
        for i, p in enumerate(at):
            first = p // fanout * fanout
            run = level[first:first + fanout]
            paths[i].append(("".join(run[:p - first]), "".join(run[p - first + 1:])))
            at[i] = p // fanout
        level = [sha(*level[k:k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], paths


def brute(rows, fanout=8):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]], fanout)
    root, above = tree([trees[g][0] for g in order], fanout)
    out = []
    for k, g in enumerate(order):
        for x, path in zip(groups[g], trees[g][1]):
            out.append((x[3]["doc_id"], x[2], trees[g][0], root, tuple(path + above[k])))
    return out


def result(df):
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"])) for r in df.collect()]


def as_rows(tuples):
    return [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], t)) for t in tuples]


@pytest.mark.parametrize("n,fanout", [(1, 8), (8, 8), (9, 8), (65, 8), (130, 2), (90, 3)])
def test_trees_of_every_shape(spark, n, fanout):
    rng = random.Random(n)
    rows = [(i * 3 - 7, f"text {rng.random()}", rng.choice(["en", "en", "en", "de", None, "é"]), rng.choice(["a", None]), i)
            for i in range(n)]
    rng.shuffle(rows)
    got = result(M.manifest(cases.documents(spark, rows).repartition(3), FIELDS, "lang", fanout=fanout))
    assert sorted(got) == sorted(brute(as_rows(rows), fanout))


def test_edge_rows(spark):
    got = result(M.manifest(cases.documents(spark), FIELDS, "lang"))
    # Equal rows are leaves of their own, in any order.
    assert sorted(got, key=repr) == sorted(brute(as_rows(cases.ROWS)), key=repr)
    assert M.manifest(cases.documents(spark, []), FIELDS, "lang").count() == 0
    # A third of the rows repeat one row, in a group of its own.
    rows = [(5, "same", "xx", "a", 4)] * 40 + [(i, f"t{i}", "en", "a", 2) for i in range(80)]
    assert sorted(result(M.manifest(cases.documents(spark, rows), FIELDS, "lang"))) == sorted(brute(as_rows(rows)))


def test_a_changed_document_is_found_and_no_other(spark):
    rows = [(i, f"Text {i}", "en" if i % 3 else "de", "a", 6) for i in range(100)]
    docs = cases.documents(spark, rows)
    for name, value in (("text", F.lower("text")), ("source", F.lit(None).cast("string")), ("n_chars", F.col("n_chars") + 1)):
        shown = {name: F.when(F.col("doc_id") % 10 == 3, value).otherwise(F.col(name))}
        t = M.verify(M.manifest(docs, FIELDS, "lang", presented=shown))
        assert {r["doc_id"] for r in t.filter("not verified").collect()} == set(range(3, 100, 10))
    same = M.verify(M.manifest(docs, FIELDS, "lang"))
    assert same.filter("verified").count() == 100 and same.filter("folded_root <> root").count() == 0


def test_null_and_empty_fields_differ():
    assert leaf(as_rows([(1, "", "en", "a", 1)])[0]) != leaf(as_rows([(1, None, "en", "a", 1)])[0])


def test_the_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = con.sql(f"select {', '.join(cols)} from ({Q.ORACLE_SQL['op11_merkle_manifest']})").fetchall()
    assert cases.rows(Q.op11_merkle_manifest(spark, SF).select(*cols)) == sorted(want, key=repr)
