"""Quality rules: statistics by hand, the forest, the calibrated limit."""

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shoplens.llm import quality as L
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), sum(a == b for a, b in zip(words, words[1:])))


def test_statistics_equal_the_plain_ones():
    texts = [r[1] for r in cases.ROWS] + list(cases.table(SF, "documents")["text"][:300])
    texts += ["a b c d e " * 3, "a a a a a a a", "a b c d e f a b c d e", "\x1c\x85   x"]
    for t in texts:
        assert L.statistics(t) == plain(t), t


def test_the_forest_sets_outliers_apart():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    far = np.array([[9.0, 9, 9], [-8, 0, 8], [0, 0, 0.1]])
    forest = L.IsolationForest(128).grow(x)
    s = forest.score(far)
    assert s[0] > 0.65 and s[1] > 0.6 and s[2] < 0.5
    # path lengths by walking each tree
    for point in far:
        total = 0.0
        for feature, value, child, length in forest.trees:
            at = 0
            while feature[at] >= 0:
                at = child[at] + (point[feature[at]] >= value[at])
            total += length[at]
        assert np.isclose(forest.score(point[None])[0], 2 ** (-total / 100 / L._path(128)))
    assert L.IsolationForest().grow(np.empty((0, 3))).trees == []


def test_query(spark):
    t = Q.op6_quality_rules(spark, SF).toPandas().set_index("doc_id").sort_index()
    d = cases.table(SF, "documents").set_index("doc_id").sort_index()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(x) for x in t[names].itertuples(index=False)] == [plain(x)[:5] for x in d["text"]]
    failed = (t["n_words"] < 10) | (100 * t["n_repeat_words"] > 20 * t["n_words"])
    assert (t["base_failed"] == failed).all() and not t["kept"][failed].any()
    quality = cases.table(SF, "labels").set_index("doc_id")["quality"].reindex(t.index)
    fine = ~t["base_failed"]
    assert t["kept"][fine & (quality == 1)].mean() > 0.97
    assert t["kept"][fine & (quality == 0)].mean() < 0.3


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, None), (None, 1), (999, 0)], "doc_id long, quality int")
    docs = cases.documents(spark)
    got = L.quality_filter(docs, labels)
    assert got.count() == len(cases.ROWS)
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[3]["base_failed"] and not by[3]["kept"] and by[3]["n_words"] == 0 and by[1]["kept"] == by[2]["kept"]
    none = L.quality_filter(docs, labels.limit(0))
    assert none.filter(F.col("kept") != ~F.col("base_failed")).count() == 0
    assert L.quality_filter(cases.documents(spark, []), labels).count() == 0


def test_calibration_loses_few_good_rows():
    scores, good = np.linspace(0, 1, 1001), np.ones(1001, bool)
    assert (scores > L.calibrate(scores, good, 0.01)).mean() <= 0.01
    assert L.calibrate(scores, ~good, 0.01) == 1.0
    assert L.base_failed(pd.DataFrame({"n_words": [9, 10, 10], "n_repeat_words": [0, 2, 3]})).tolist() == [True, False, True]


def test_the_sample_bounds_the_trees_alone(spark, monkeypatch):
    means, features = [], L.features
    monkeypatch.setattr(L, "features", lambda s, mean: means.append(mean) or features(s, mean))
    d, labels = cases.table(SF, "documents"), cases.table(SF, "labels")
    t = L.quality_filter(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"),
                         sample=60, n_trees=20, size=32).toPandas()
    fine = t[~t["base_failed"]]
    assert np.isclose(means[0], fine["word_chars"].sum() / fine["n_words"].sum(), rtol=1e-12)
    good = fine.merge(labels[labels["quality"] == 1], on="doc_id")["anomaly"].to_numpy()
    limit = np.quantile(good, 0.99, method="higher")
    assert len(d) == len(t) and len(good) > 200 and (t["kept"] == ~t["base_failed"] & (t["anomaly"] <= limit)).all()


def test_limit_is_the_exact_order_statistic(spark):
    rng = np.random.default_rng(7)
    for n, lose in ((1, 0.01), (2, 0.5), (999, 0.01), (30_000, 0.01), (30_000, 0.0)):
        scores = np.round(rng.random(n), 3 if n == 999 else 12)
        got = L.limit_of(spark.createDataFrame(pd.DataFrame({"score": scores})), lose, 100)
        assert got == np.quantile(scores, 1 - lose, method="higher") == L.calibrate(scores, scores >= 0, lose)
    assert L.limit_of(spark.createDataFrame([], "score double"), 0.01) == 1.0


def test_limit_is_found_with_few_rows_on_the_driver(spark):
    rng = np.random.default_rng(8)
    ties = np.concatenate([np.full(4000, 0.25), np.full(4000, 0.75), 0.25 + rng.random(3) / 4, [0.1, 0.9]])
    for scores, loses in ((np.round(rng.random(20_000), 12), (0.3, 0.01, 0.0)), (ties, (0.4999, 0.5, 0.2, 0.0, 0.99999)),
                          (np.full(3000, 0.5), (0.01,))):
        rows = spark.createDataFrame(pd.DataFrame({"score": scores}))
        for lose in loses:
            assert L.limit_of(rows, lose, 100, most=20) == np.quantile(scores, 1 - lose, method="higher")
