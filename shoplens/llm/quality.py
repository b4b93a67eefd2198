"""Quality rules: isolation forest on rule statistics.

Each text is reduced to the statistics of simple rules (words, characters,
symbols, repeated lines and words). Two base rules reject outright; among the
rest an isolation forest, grown over random splits of a bounded sample, finds
documents that few splits set apart from all others: their path is short. The
path length at which a document is rejected comes from all labelled rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Run, col

SYMBOLS = "#*$%&|<>"
#: Words of a repeated passage.
WINDOW = 5
STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
             "n_twin_words long"
_ASCII_SPACE = b" \t\n\x0b\x0c\r"


def statistics(text: str | None) -> tuple[int, ...]:
    """The columns of ``STATISTICS`` of one whole text (null: as empty).
    Words are runs of characters other than ASCII white space; n_repeat_words
    counts the words in windows of five words that the text holds twice or
    more, the first included; n_dup_lines the lines with a word that equal
    an earlier line; n_twin_words the words that equal the word before."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(raw.count(_ASCII_SPACE[k:k + 1]) for k in range(6))
    lines = [x for x in raw.split(b"\n") if x.strip(_ASCII_SPACE)]
    repeated = 0
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(windows)) < len(windows):
        seen: dict[tuple, int] = {}
        again = np.zeros(n + 1, np.int64)
        for i, w in enumerate(windows):
            first = seen.setdefault(w, i)
            if first != i:
                again[[i, first]] = 1
        at = np.flatnonzero(again)  # each occurrence covers its five words
        cover = np.zeros(n + WINDOW + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + WINDOW, -1)
        repeated = int((np.cumsum(cover[:n]) > 0).sum())
    return (n, chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated,
            sum(map(bytes.__eq__, words, words[1:])))


def features(s: pd.DataFrame, word_length: float) -> np.ndarray:
    """What the forest splits: the share of symbols among the characters, the
    mean word length (drawn to the corpus mean ``word_length`` as if by 100
    more words, since short texts vary), and the share of words that repeat
    the word before."""
    words, chars = np.maximum(s["n_words"].to_numpy(float), 1), np.maximum(s["word_chars"].to_numpy(float), 1)
    return np.column_stack([s["n_symbols"] / chars, (chars + 100 * word_length) / (words + 100),
                            s["n_twin_words"] / words])


def _path(n: float) -> float:
    """Mean path of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass
class IsolationForest:
    """Trees as flat arrays: feature (-1: leaf), split value, left child (the
    right one follows it), path length at a leaf."""

    size: int = 128
    word_length: float = 0.0  # mean of all rows that the base rules pass
    trees: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    limit: float = 1.0  # scores above it are rejected

    def grow(self, x: np.ndarray, n_trees: int = 100, seed: int = 42) -> IsolationForest:
        rng = np.random.default_rng(seed)
        size = min(self.size, len(x))
        depth = max(1, math.ceil(math.log2(max(2, size))))
        for _ in range(n_trees if len(x) else 0):
            feature, value, child, length = [], [], [], []

            def add(rows: np.ndarray, level: int, at: int) -> None:
                spread = rows.max(axis=0) - rows.min(axis=0)
                usable = np.flatnonzero(spread > 0)
                if level >= depth or len(rows) < 2 or not len(usable):
                    length[at] = level + _path(len(rows))
                    return
                f = int(rng.choice(usable))
                v = rng.uniform(rows[:, f].min(), rows[:, f].max())
                feature[at], value[at], child[at] = f, v, len(feature)
                for _ in range(2):
                    feature.append(-1), value.append(0.0), child.append(0), length.append(0.0)
                left = rows[:, f] < v
                add(rows[left], level + 1, child[at]) if left.any() else length.__setitem__(child[at], level + 1)
                add(rows[~left], level + 1, child[at] + 1)

            feature.append(-1), value.append(0.0), child.append(0), length.append(0.0)
            add(x[rng.choice(len(x), size, replace=False)], 0, 0)
            self.trees.append((np.array(feature), np.array(value), np.array(child), np.array(length)))
        self.size = size
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for what is set apart at
        once, about 0.5 for the ordinary."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, value, child, length in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                i, a = every[inner], at[inner]
                at[inner] = child[a] + (x[i, feature[a]] >= value[a])
            total += length[at]
        return 2.0 ** (-total / max(1, len(self.trees)) / max(_path(self.size), 1e-9))


def base_failed(s: pd.DataFrame) -> np.ndarray:
    """Fewer than 10 words, or over 20 % of the words in repeated passages."""
    return ((s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])).to_numpy()


def calibrate(scores: np.ndarray, good: np.ndarray, lose: float) -> float:
    """The least limit above which at most ``lose`` of the good rows lie;
    without good rows nothing is rejected."""
    return float(np.quantile(scores[good], 1 - lose, method="higher")) if good.any() else 1.0


def limit_of(scores: DataFrame, lose: float, accuracy: int = 10_000, most: int = 10_000) -> float:
    """``calibrate`` over all rows of ``scores`` (score double: that of a good
    row), exactly: approximate percentiles, whose rank is off by one in
    ``accuracy`` at most, bound the limit from both sides. It is one of them,
    or lies between; there the search goes on, until at most ``most`` rows are
    left, and only these come to the driver."""
    n = scores.count()
    rank = math.ceil((1 - lose) * (n - 1))  # from 0, among the rows that are left
    score = F.col("score")
    while n > most:
        at = (rank + 1) / n
        low, high = scores.agg(F.percentile_approx(score, [max(0.0, at - 2 / accuracy), min(1.0, at + 2 / accuracy)],
                                                   accuracy)).first()[0]
        under, upto, before, through = scores.agg(*[F.count_if(c) for c in (
            score < low, score <= low, score < high, score <= high)]).first()
        if under <= rank < upto:
            return float(low)
        if before <= rank < through:
            return float(high)
        if not upto <= rank < before:
            raise AssertionError("the limit is not between its bounds")
        scores, rank, n = scores.filter((score > low) & (score < high)), rank - upto, before - upto
    return sorted(r["score"] for r in scores.collect())[rank] if n else 1.0


def sample_rows(rows: DataFrame, about: int, *key: str) -> DataFrame:
    """About ``about`` rows, those whose key's hash is under a threshold;
    rows that repeat a key count once, so that copies cannot crowd in."""
    n = rows.count()
    spread = 1 << 40
    chosen = rows.filter(F.pmod(F.xxhash64(*key), F.lit(spread)) < int(min(1.0, about / max(1, n)) * spread))
    return chosen.dropDuplicates(list(key))


def quality_filter(docs: DataFrame, labels: DataFrame, lose: float = 0.01, sample: int = 20_000, n_trees: int = 100,
                   size: int = 128, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns of ``STATISTICS``,
    base_failed, anomaly (the forest's score) and kept.

    The forest grows on about ``sample`` documents that the base rules pass
    (chosen by hash, labelled or not; the bound is that parameter). The mean
    word length is of all documents that the base rules pass, and the limit is
    set on all labelled ones of these, so that it rejects at most ``lose`` of
    those labelled 1. All statistics are of whole texts of all rows.

    Null and empty texts have no words and fail. Without usable rows to learn
    from, only the base rules reject. Labels that are null or name no document
    are not used; several labels of one id all count, but equal labelled rows
    count once. Equal texts get
    equal results; a long one is read whole. Extra columns are ignored; an empty table gives no rows."""
    run = Run(docs.sparkSession, "quality")

    @F.pandas_udf(STATISTICS)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [statistics(t) for t in texts]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in STATISTICS.split(", ")])

    s = run.stage(docs.select(col(id_col).alias("doc_id"), of(col(text_col)).alias("s")).select("doc_id", "s.*"),
                  "statistics")
    passed = s.filter("n_words >= 10 and 100 * n_repeat_words <= 20 * n_words")
    columns = [c for c in s.columns if c != "doc_id"]
    grown = sample_rows(passed, sample, "doc_id", *columns).select(*columns).toPandas().sort_values(columns)
    total = passed.agg(F.sum("word_chars").alias("chars"), F.sum("n_words").alias("words")).first()
    mean = float((total["chars"] or 0) / max(1, total["words"] or 0))
    forest = IsolationForest(size, mean).grow(features(grown, mean), n_trees)
    if forest.trees:
        @F.pandas_udf("double")
        def score(*columns_of: pd.Series) -> pd.Series:
            return pd.Series(forest.score(features(pd.concat(columns_of, axis=1, keys=columns), mean)))

        known = labels.select(col(id_col).alias("doc_id"), col(label_col).alias("label")).filter("label = 1")
        known = passed.join(known, "doc_id").select("doc_id", *columns).distinct()
        forest.limit = limit_of(run.stage(known.select(score(*columns).alias("score")), "scores"), lose)

    @F.pandas_udf("base_failed boolean, anomaly double, kept boolean")
    def judge(*columns_of: pd.Series) -> pd.DataFrame:
        t = pd.concat(columns_of, axis=1, keys=columns)
        failed, score = base_failed(t), forest.score(features(t, mean))
        return pd.DataFrame({"base_failed": failed, "anomaly": score, "kept": ~failed & (score <= forest.limit)})

    return (s.select("*", judge(*columns).alias("judged"))
            .select("doc_id", *columns, "judged.base_failed", "judged.anomaly", "judged.kept"))
