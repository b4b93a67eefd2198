"""Operators against plain-Python brute force on random small inputs."""

import random
from collections import Counter

import numpy as np
import pytest

from shoplens.operators import behaviour as B
from shoplens.operators import prep as P
from shoplens.operators import sentiment as R
from shoplens.operators import weather as W
from shoplens.schemas import SHOP_EVENTS
from shoplens.settings import ENGLISH_STOP_WORDS


def _events(spark, rows):
    return spark.createDataFrame(rows, SHOP_EVENTS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_peak_hours_and_bot_filter_brute_force(spark, seed):
    rnd = random.Random(seed)
    hours = rnd.sample(range(24), rnd.randint(1, 10))
    rows = []
    for i in range(rnd.randint(20, 120)):
        h = rnd.choice(hours)
        et = rnd.choice(["purchase", "purchase", "view", "cart"])
        sess = rnd.choice([None, "a", "b", "c", "d", f"u{i}"])
        rows.append((f"2019-10-0{rnd.randint(1, 9)} {h:02d}:{rnd.randint(0, 59):02d}:00 UTC", et, 1, 1, "x.y",
                     "b", 1.0, i, sess))
    max_events = rnd.randint(1, 8)
    clean = P.clean_events(_events(spark, rows), max_events=max_events)

    size = Counter(r[8] for r in rows if r[8] is not None)
    kept = [r for r in rows if r[8] is not None and size[r[8]] <= max_events]
    assert sorted(r.user_id for r in clean.select("user_id").collect()) == sorted(r[7] for r in kept)

    for width in (1, 2, 3, 4):
        per_hour = Counter(int(r[0][11:13]) for r in kept if r[1] == "purchase")
        got = B.peak_hours(clean, width).collect()
        if not per_hour:
            assert got == []
            continue
        best = max(range(0, 25 - width), key=lambda s: (sum(per_hour[h] for h in range(s, s + width)), -s))
        want = sum(per_hour[h] for h in range(best, best + width))
        assert (got[0].peak_start_hour, got[0].window_purchases) == (best, want), width


@pytest.mark.parametrize("seed", [4, 5])
def test_top_keywords_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocab = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "these", "would", "the", "abc", "tree"]
    rows, docs = [], []
    for i in range(60):
        rating = float(rnd.choice([1, 2, 3, 4, 5]))
        text = " ".join(rnd.choice(vocab) for _ in range(rnd.randint(3, 12)))
        rows.append((rating, "", text, "a", 0, 0, None))
        docs.append((rating, " " + text))
    n = 3
    got = R.top_keywords(P.clean_reviews(
        spark.createDataFrame(rows, "rating double, title string, text string, asin string, timestamp long, "
                                    "helpful_vote long, verified_purchase boolean")), n).collect()
    stop = set(ENGLISH_STOP_WORDS)
    for label, group in ((2, "positive"), (0, "negative")):
        c = Counter(w for r, t in docs if (2 if r > 3 else 0 if r <= 2 else 1) == label
                    for w in t.split(" ") if len(w) >= 4 and w not in stop)
        want = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
        have = sorted(((r.word, r.frequency) for r in got if r.sentiment_group == group),
                      key=lambda kv: (-kv[1], kv[0]))
        assert have == want, group


def test_correlation_matches_numpy(spark):
    rnd = np.random.default_rng(11)
    x = rnd.normal(size=(200, 6))
    x[:, 1] = x[:, 0] * 3 + rnd.normal(scale=0.1, size=200)
    cols = list(W.CORRELATION_COLUMNS)
    df = spark.createDataFrame([tuple(float(v) for v in row) for row in x], cols)
    got = {(r.variable_1, r.variable_2): r.pearson_corr for r in W.correlation_matrix(df).collect()}
    want = np.corrcoef(x, rowvar=False)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            assert abs(got[(a, b)] - want[i, j]) <= 1e-4 + 1e-12, (a, b)
