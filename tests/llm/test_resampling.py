"""Importance resampling against a version of dictionaries and loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from shoplens.llm import queries as Q
from shoplens.llm import resampling as R

from . import cases

SF = "/root/testdata/sf0.01"
RX = re.compile(R.WORDS)


def words(text):
    return RX.findall((text or "").encode().lower().decode())


def features(text, grams, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, grams + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=10, least=20, grams=1, buckets=10_000, seed="2024"):
    s, t = (Counter(b for x in texts for b in features(x, grams, buckets)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for k, (i, text) in enumerate(docs):
        f = features(text, grams, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, len(words(text)), k])
    enough = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(enough[:percent * len(enough) // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def got(df):
    return cases.rows(df.select("doc_id", "n_features", "weight", "score", "rank"))


def frames(spark, docs, target):
    rows = [(i, t, "en", "a", 0) for i, t in docs]
    return cases.documents(spark, rows), spark.createDataFrame([(t, "clash") for t in target], "text string, n string")


@pytest.mark.parametrize("grams,buckets,percent", [(1, 10_000, 10), (3, 97, 50), (2, 70_000, 100)])
def test_random_documents(spark, grams, buckets, percent):
    rng = random.Random(grams)
    vocabulary = ["Word", "thing", "a", "Ä", "x9", "日本", "run-on", "it's"]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(150)]
    target = [" ".join(rng.choices(vocabulary[:3], k=30)) for _ in range(5)] + [None, ""]
    d, t = frames(spark, docs, target)
    assert got(R.resample(d, t, percent, 20, grams, buckets)) == brute(docs, target, percent, 20, grams, buckets)


def test_edge_rows(spark):
    docs = [(r[0], r[1]) for r in cases.ROWS]
    _, t = frames(spark, [], ["the quick brown fox", None])
    assert got(R.resample(cases.documents(spark), t, 100, 2)) == brute(docs, ["the quick brown fox", None], 100, 2)
    assert got(R.resample(cases.documents(spark), t.limit(0), 50, 1)) == brute(docs, [], 50, 1)
    assert R.resample(cases.documents(spark, []), t).count() == 0


def test_ties_go_to_the_smaller_id_and_all_are_ranked(spark):
    d, t = frames(spark, [(7, "a b c")] * 30 + [(8, "a b c")], ["a"])
    out = R.resample(d, t, 100, 3).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 32)) and len({r["score"] for r in out}) == 2


def test_pieces_do_not_change_the_features():
    from tokenizers import Regex, pre_tokenizers

    splitter, breaks = pre_tokenizers.Split(Regex(R.WORDS), "removed", invert=True), re.compile(R.BREAKS)
    rng = random.Random(5)
    text = "".join(rng.choice("abÄ日 ,.\n9\x00\x7f😀Z") for _ in range(3000)) + "x" * 500
    for grams in (1, 2, 4):
        whole = R.feature_buckets(text, splitter, breaks, grams, 997)
        assert whole[0] == len(words(text)) and sorted(whole[1]) == sorted(features(text, grams, 997))
        for piece in (1, 7, 100):
            n, some = R.feature_buckets(text, splitter, breaks, grams, 997, piece)
            assert n == whole[0] and sorted(some) == sorted(whole[1])


def test_the_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.sql(f"select doc_id, n_features, weight, score, rank from ({Q.ORACLE_SQL['op13_importance_resampling']})").fetchall()
    assert got(Q.op13_importance_resampling(spark, SF)) == sorted(want, key=repr)
