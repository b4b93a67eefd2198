"""Secret scans: candidates and features by hand, the forest, edges."""

import random
import re

from pyspark.sql import functions as F

from shoplens.llm import queries as Q
from shoplens.llm import secrets as L

from . import cases

SF = "/root/testdata/sf0.01"
RUN = r"[A-Za-z0-9+/_\-]{20,}"


def test_every_run_is_a_candidate(spark):
    d = cases.table(SF, "documents")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((r["doc_id"], r["candidate"]) for r in L.candidates(docs).collect())
    assert got == sorted((int(i), m) for i, t in zip(d["doc_id"], d["text"]) for m in re.findall(RUN, t)) and got


def test_surroundings(spark):
    k = "A1b2" * 6
    rows = [(1, f'my token = "{k}" end', None, None, 0), (2, f"see /usr/{k}/x", None, None, 0), (3, f"api_key:{k}", None, None, 0),
            (4, f"{k} {k}\n{k}", None, None, 0), (5, f"x{'y' * 70} {k}", None, None, 0), (6, k[:19], None, None, 0)]
    found = {(r["doc_id"], r["nth"]): r for r in L.candidates(cases.documents(spark, rows)).collect()}
    assert sorted(found) == [(1, 0), (2, 0), (3, 0), (4, 0), (4, 1), (4, 2), (5, 0), (5, 1)]
    a = found[1, 0]
    assert (a["before"], a["name"], a["quote"], a["candidate"], a["after"]) == ("my", "token", '"', k, '"')
    assert found[2, 0]["candidate"] == f"/usr/{k}/x" and found[3, 0]["name"] == "api_key"


def test_features(spark):
    found = L.candidates(cases.documents(spark, [(1, f"a token = \"{'ab12' * 5}\" {'the' * 7}", None, None, 0)]))
    pieces = spark.createDataFrame([("the",), ("het",)], "piece string")
    a, b = L.with_features(found, pieces).orderBy("nth").collect()
    assert (a["length"], a["digit_share"], a["credential_name"], a["quoted"], a["coverage"]) == (20, 0.5, 1, 1, 0)
    assert a["kind_changes"] == 9 / 20 and b["digit_share"] == 0 and b["assigned"] == 0
    want = ["the" * 7][0]
    pieces_of = [want[i:i + 3] for i in range(len(want) - 2)]
    assert abs(b["coverage"] - sum(p in ("the", "het") for p in pieces_of) / len(pieces_of)) < 1e-9


def test_dictionary_counts_all_texts(spark):
    rows = [(i, "common words here" if i % 2 else "rare" + "abcdefgh"[i % 8] + " words", None, None, 0) for i in range(100)]
    got = {r["piece"] for r in L.dictionary(cases.documents(spark, rows), share=0.6).collect()}
    assert got == {"wor", "ord", "rds"}


def test_forest_learns_labelled_findings(spark):
    rng = random.Random(5)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    words = ["".join(rng.choice(["the", "ing", "and", "tion", "ea"]) for _ in range(9)) for _ in range(60)]
    docs = cases.documents(spark, [(i, f"run {w} on", None, None, 0) for i, w in enumerate(hexes + words)])
    found = L.candidates(docs)
    labelled = found.withColumn("secret", F.when(F.col("doc_id") < 60, 1).otherwise(0)).filter("doc_id % 2 = 0")
    got = L.scan_secrets(docs, labelled).filter("doc_id % 2 = 1").collect()
    assert len(got) == 60 and all(r["secret"] == (r["doc_id"] < 60) for r in got)


def test_query_is_native_and_finds_the_tokens(spark):
    out = Q.op9_secret_scan(spark, SF)
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow"))
    d = cases.table(SF, "documents")
    want = {(int(i), m) for i, t in zip(d["doc_id"], d["text"]) for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', t)}
    assert {(r["doc_id"], r["candidate"]) for r in out.filter("secret").collect()} == want and want


def test_edges(spark):
    k = "0123456789abcdef" * 2
    docs = cases.documents(spark, list(cases.ROWS) + [(60, f'key = "{k}"', None, None, 0)] * 2)
    got = L.scan_secrets(docs).collect()
    assert {r["doc_id"] for r in got} == {60, 13} and sum(r["doc_id"] == 60 for r in got) == 2
    assert all(r["secret"] for r in got if r["doc_id"] == 60)
    only = L.scan_secrets(cases.documents(spark, [(60, f'key = "{k}"', None, None, 0)])).collect()
    assert [(r["probability"], r["secret"]) for r in only] == [(None, True)]
    assert L.scan_secrets(cases.documents(spark, [])).count() == 0


def test_label_evidence_is_no_input_and_other_forms_are_found(spark):
    assert not set(L.FEATURES) & {"assigned", "credential_name", "quoted", "coverage", "covered", "lettered"}
    rng = random.Random(11)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    hexes, mixed = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    bearer, env, bare = pick(mixed, 40), pick(mixed, 32), "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)
    rows = [(i, f'the token = "{pick(hexes, 40)}" of this', None, None, 0) for i in range(20)]
    rows += [(100 + i, f"nationalorganizations and thedepartmentofthings {x} {y} in the text", None, None, 0)
             for i, (x, y) in enumerate([("national", "nations"), ("thedepartment"[:12], "mentofthings"), ("ionalorganiz", "izations")] * 7)]
    rows += [(200, f"Authorization: Bearer {bearer}", None, None, 0), (201, f"DB_SECRET={env}\nMODE=fast", None, None, 0),
             (202, 'password = "S3cr3t!Passw0rd"', None, None, 0), (203, f"we used {bare} for that.", None, None, 0),
             (204, "password: t0p.S3cr~t9! is it", None, None, 0)]
    got = {(r["doc_id"], r["candidate"]): r["secret"] for r in L.scan_secrets(cases.documents(spark, rows)).collect()}
    for key in ((200, bearer), (201, env), (202, "S3cr3t!Passw0rd"), (203, bare), (204, "t0p.S3cr~t9")):
        assert got.get(key), (key, got.get(key))
    assert all(v for (i, _), v in got.items() if i < 20)
    assert not any(v for (i, _), v in got.items() if 100 <= i < 200) and any(100 <= i < 200 for i, _ in got)


def test_random_bare_runs_are_never_labelled_as_none(spark):
    found = L.candidates(cases.documents(spark, [(1, "Bearer q8Zr2LmX0vTj5KcW9bNs and Xk29fPq0LzT7vBn4RwYc", None, None, 0)]))
    pieces = spark.createDataFrame([("the",)], "piece string")
    assert [r["secret"] for r in L.weak_labels(L.with_features(found, pieces)).collect()] == [None, None]
