"""Every pipeline stage against a brute-force version on its own input."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from shoplens.llm import mixing as M
from shoplens.llm import queries as Q
from shoplens.llm.common import Run

from . import cases
from .test_linededup import plain as plain_lines
from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def stages(spark):
    """Inputs and results of all stages, over the table and some odd rows."""
    odd = cases.documents(spark, [r for r in cases.ROWS if r[0] is None or r[0] not in (8, 13)], clashing=False)
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        odd.withColumn("doc_id", F.col("doc_id") + 100_000))
    run, out = Run(spark, "test-pipeline"), []
    docs = run.stage(docs, "documents")
    for name, stage in P.STAGES:
        after = run.stage(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return out


def pairs(df):
    return sorted(((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()), key=repr)


def test_columns(stages):
    assert [n for n, _, _ in stages] == ["language_id", "line_dedup", "near_dedup", "mix", "encode"]
    for _, before, after in stages[:-1]:
        assert before.columns == after.columns == P.COLUMNS
        assert [t for _, t in before.dtypes] == [t for _, t in after.dtypes]


def test_language_id_drops_what_has_no_letters(stages):
    _, before, after = stages[0]
    want = [r for r in pairs(before) if r[1] and any(c.isalpha() for c in r[1])]
    assert pairs(after) == want and len(want) < before.count()


def test_line_dedup(stages):
    _, before, after = stages[1]
    rows = before.withColumn("h", F.xxhash64("text")).collect()
    want = []
    for r, gone in zip(rows, plain_lines([(r["doc_id"], r["text"], r["h"]) for r in rows])):
        text = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in gone)
        if text.strip(SPACE):
            want.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    assert pairs(after) == sorted(want, key=repr)


def test_near_dedup(stages):
    _, before, after = stages[2]
    rows = sorted(pairs(before), key=lambda r: (r[0] is None, r[0] or 0))
    where = plain_components([plain_fingerprint(r[1]) for r in rows], 3)
    # Every group keeps one row, also where an id stands over texts of two groups.
    want = [r[0] for k, (r, w) in enumerate(zip(rows, where)) if w == k]
    assert sorted((r[0] for r in pairs(after)), key=repr) == sorted(want, key=repr)
    assert set(pairs(after)) <= set(rows)


def test_mix(stages):
    _, before, after = stages[3]
    con = duckdb.connect()
    con.register("documents", before.toPandas().astype({"doc_id": "Int64"}))
    want = {r[0]: r[4] // r[1] for r in con.sql(M.MIX_SQL.format(docs="documents")).fetchall() if r[4]}
    got = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == want and set(pairs(after)) <= set(pairs(before))


def test_encode(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_model())
    _, before, after = stages[4]
    assert pairs(after) == pairs(before)
    for r in after.collect():
        assert list(r["ids"]) == library.encode(r["text"], add_bos=True, add_eos=True) and r["n_tokens"] == len(r["ids"])


def test_empty_tables(spark):
    for _, stage in P.STAGES:
        assert stage(spark, cases.documents(spark, [], clashing=False), SF).count() == 0


def test_run(spark, stages):
    assert P.run(spark, SF).columns == stages[-1][2].columns
