"""Context-tree weighting against the recursion itself, context by context."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import ctw as C
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.01"


class Brute:
    """One tree for each of the 255 places of a byte; a context is the bytes
    before, the nearest first."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.longer, self.memo = depth, defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for text in texts:
            for place, bit, context in self.steps(text):
                for d in range(depth + 1):
                    self.counts[place, context[:d]][bit] += 1
                    if d:
                        self.longer[place, context[:d - 1]].add(context[:d])

    def steps(self, text):
        whole = C.END * self.depth + text + C.END
        for p in range(self.depth, len(whole)):
            for k in range(8):
                yield (1 << k) | (whole[p] >> (8 - k)), (whole[p] >> (7 - k)) & 1, whole[p - self.depth:p][::-1]

    def seen(self, place, context):
        return self.counts.get((place, context), (0, 0))

    def weighted(self, place, context):
        """ln of the weighted probability, and the weight of the own estimate."""
        if (place, context) not in self.memo:
            a, b = self.seen(place, context)
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
            if len(context) == self.depth:
                self.memo[place, context] = own, 1.0
            else:
                longer = sum(self.weighted(place, c)[0] for c in self.longer.get((place, context), ()))
                top = max(own, longer)
                total = top + math.log(math.exp(own - top) + math.exp(longer - top))
                self.memo[place, context] = total - math.log(2), math.exp(own - total)
        return self.memo[place, context]

    def score(self, text):
        out = 0.0
        for place, bit, context in self.steps(text):
            p, rest = 0.0, 1.0
            for d in range(self.depth + 1):
                counts, weight = self.seen(place, context[:d]), self.weighted(place, context[:d])[1]
                p += rest * weight * (counts[bit] + 0.5) / (sum(counts) + 1)
                rest *= 1 - weight
            out += math.log10(p)
        return out


def lowered(text):
    return (text or "").encode().lower()


def brute(rows, depth):
    tokens = [(lowered(t).split() + [None]) for _, _, t in rows]
    counts = Counter(w for (_, held, _), ws in zip(rows, tokens) if not held for w in ws)
    n, v = sum(counts.values()), len(counts)
    model = Brute([lowered(t) for _, held, t in rows if not held], depth)
    return [(i, held, len(lowered(t)), len(ws), sum(counts[w] > 0 for w in ws), n,
             sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), model.score(lowered(t)))
            for (i, held, t), ws in zip(rows, tokens)]


def same(df, want):
    got = sorted((tuple(r)[:8] for r in df.collect()), key=repr)
    want = sorted(want, key=repr)
    assert [r[:6] for r in got] == [r[:6] for r in want]
    for g, w in zip(got, want):
        assert g[6] == pytest.approx(w[6], abs=1e-8, rel=1e-11) and g[7] == pytest.approx(w[7], abs=1e-8, rel=1e-11)


def scored(spark, rows, **how):
    df = cases.documents(spark, [(i, t, "held" if held else "in", None, 0) for i, held, t in rows])
    return C.score_texts(df, F.col("lang") == "held", **how)


TEXTS = ["the cat sat on the mat", "The cat Sat on the hat\nand ate", "", None, "a dog  sat 日本 Ä", "x" * 90 + " end", "the cat", "\x00 \t"]


@pytest.mark.parametrize("depth", [1, 2, 3, 5, 6])
def test_scores_are_those_of_the_recursion(spark, depth):
    rows = [(i, i % 3 == 1, t) for i, t in enumerate(TEXTS * 2)]
    same(scored(spark, rows, depth=depth), brute(rows, depth))


def test_blocks_and_pieces_do_not_change_scores(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, i % 4 == 1, " ".join("".join(rng.choices("abc", k=rng.randrange(1, 40))) for _ in range(rng.randrange(30)))) for i in range(40)]
    want = brute(rows, 2)
    same(scored(spark, rows, depth=2, block=500), want)
    # Pieces of a few bytes, each in a block with others.
    parts = list(C.pieces(b"ab cd  ef " + b"g" * 30 + b" h", 8))
    assert [a for a, _ in parts[1:]] == [b for _, b in parts[:-1]] and parts[-1][1] == 42
    assert list(C.pieces(b"", 8)) == [(0, 0)] and list(C.pieces(b"x" * 20, 8)) == [(0, 20)]


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    rows = [(1, True, "ab"), (2, True, None)]
    out = {r["doc_id"]: r for r in scored(spark, rows, depth=2).collect()}
    assert out[2]["score"] == pytest.approx(-math.log10(256)) and out[1]["score"] == pytest.approx(-3 * math.log10(256))
    assert out[1]["train_tokens"] == 0 and out[1]["n_known"] == 0 and out[1]["base_score"] == pytest.approx(0.0)
    assert scored(spark, []).count() == 0
    with pytest.raises(ValueError):
        scored(spark, rows, depth=7)


def test_edge_rows(spark):
    docs = cases.documents(spark).filter("doc_id is null or doc_id <> 8")
    rows = [(r[0], r[0] == 9, r[1]) for r in cases.ROWS if r[0] != 8]
    same(C.score_texts(docs, F.col("doc_id") == 9, depth=2), brute(rows, 2))


def test_probabilities_of_a_byte_add_up_to_one(spark):
    from shoplens.llm.common import Run

    text = b"abracadabra"
    runs, n = np.unique(C.runs_of([C.END * 3 + text + C.END], 3)[0], return_counts=True)
    have = dict(zip(runs.tolist(), n.tolist()))
    context = int.from_bytes(b"bra", "big")
    every = [(context << 8 | byte, have.get(context << 8 | byte, 0)) for byte in range(256)]
    rest = [(r, c) for r, c in have.items() if r >> 8 != context]
    lp = C.run_scores(spark.createDataFrame(every + rest, "run long, n long"), 3, Run(spark, "test"))
    total = sum(10 ** r["lp"] for r in lp.collect() if r["run"] >> 8 == context)
    assert total == pytest.approx(1.0, abs=1e-9)


def test_held_out_texts_are_told_from_noise(spark):
    t = Q.op12_lm_scoring(spark, SF).toPandas()
    assert len(t) == 1000 and t["n_known"].le(t["n_tokens"]).all() and t["train_tokens"].nunique() == 1
    assert t.loc[t["held_out"], "bits_per_byte"].median() < 2.5 and (t["score"] < 0).all()
    base = t.loc[~t["held_out"], "n_tokens"].sum()
    assert base == t["train_tokens"].iloc[0]


@pytest.mark.parametrize("depth", [1, 5, 6])
def test_lookups_of_runs_and_words(depth):
    rng = np.random.default_rng(depth)
    texts = [bytes(rng.integers(97, 101, n, np.uint8)) for n in (0, 3, 70_000, 200_000)]
    found, _ = C.runs_of([C.END * depth + t + C.END for t in texts], depth)
    runs = np.unique(found)
    lp = rng.random(len(runs))
    at = {int(r): x for r, x in zip(runs, lp)}
    assert C.looked_up(found, runs, lp, depth).tolist() == [at[int(r)] for r in found]
    assert not len(C.looked_up(found[:0], runs, lp, depth))
    long = b"w" * (C.LONG_WORD + 1)
    counts = C.WordCounts({b"a": 2.0, C.word_key(long): 3.0})
    assert list(map(counts.__getitem__, [b"a", long])) == [2.0, 3.0]
    with pytest.raises(KeyError):
        counts[b"b"]
