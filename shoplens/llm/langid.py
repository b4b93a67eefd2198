"""Language ID: string kernel, Nyström landmarks, kernel ridge regression.

The kernel of two texts is the number of character n-grams (all orders up to
``order``: the blended spectrum, presence only) that both hold, over the
geometric mean of how many each holds. Landmark texts span the feature space
(Nyström); one-versus-rest ridge regression on ±1 targets gives each language
a weight per landmark. A batch of texts is scored by two matrix products:
n-gram presence × landmark presence, then the normalised kernels × weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, col

#: Prediction for a text that has no letters.
UNDETERMINED = "und"
#: Characters of a text that are taken apart at once, and texts per matrix product.
PIECE, ROWS = 1_000_000, 256


def letter_table() -> np.ndarray:
    """For every code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None, order: int, letters: np.ndarray) -> np.ndarray:
    """Sorted distinct n-grams, n = 1 to ``order`` (at most 3), of a text in
    lower case whose runs of other characters than letters are one space
    each; also before and after it. A null text or one without letters has none."""
    found: list[np.ndarray] = []
    tail = np.array([1], np.int64)  # a space; a letter is its code point + 2
    for at in range(0, len(text or ""), PIECE):
        x = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        x = np.where(letters[x], x.astype(np.int64) + 2, 1)
        x = np.concatenate((tail, x, tail[:0] if at + PIECE < len(text) else np.ones(1, np.int64)))
        x = x[np.concatenate(([True], (x[1:] > 1) | (x[:-1] > 1)))]
        parts, key = [x[x > 1]], x
        for n in range(2, order + 1):
            key = (key[:-1] << 21) | x[n - 1:]
            parts.append(key)
        found.append(np.unique(np.concatenate(parts)))
        tail = x[-(order - 1):] if order > 1 else x[:0]
    if len(found) > 1:
        found = [np.unique(np.concatenate(found))]
    # Without a letter there is nothing but the space.
    return found[0] if found and (found[0] < 1 << 21).any() else np.empty(0, np.int64)


@dataclass
class LanguageModel:
    """What ``train`` learns: languages by name, the landmarks' n-grams, which
    landmark holds which (0 or 1) and how many, and a weight per landmark
    and language."""

    languages: list[str]
    order: int
    vocabulary: np.ndarray
    presence: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Normalised kernel of each n-gram set with each landmark."""
        return _kernel(sets, self.vocabulary, self.presence.astype(np.float32), self.sizes)

    def predict(self, texts: list[str | None], letters: np.ndarray, presence: np.ndarray) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for at in range(0, len(texts), ROWS):
            sets = [grams(t, self.order, letters) for t in texts[at:at + ROWS]]
            if not self.languages:
                names += [UNDETERMINED] * len(sets)
                continue
            out = _kernel(sets, self.vocabulary, presence, self.sizes) @ self.weights
            best = out.argmax(axis=1)  # of equal scores, the first name
            has = np.array([len(s) > 0 for s in sets])
            names += [self.languages[b] if h else UNDETERMINED for b, h in zip(best, has)]
            top = np.clip((out[np.arange(len(sets)), best] + 1) / 2, 0, 1)
            scores[at:at + len(sets)] = np.where(has, top, 0.0)
        return names, scores


def _kernel(sets: list[np.ndarray], vocabulary: np.ndarray, presence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(sets), len(vocabulary)), np.float32)
    for r, s in enumerate(sets):
        at = np.searchsorted(vocabulary, s)
        at = at[vocabulary[np.minimum(at, len(vocabulary) - 1)] == s]
        rows[r, at] = 1
    held = np.array([max(1, len(s)) for s in sets], float)
    return (rows @ presence) / np.sqrt(held[:, None] * sizes[None, :])


def fit(sets: list[np.ndarray], labels: list[str], order: int, landmarks: int = 192, ridge: float = 1e-2) -> LanguageModel:
    """Model from n-gram sets and their languages, in this order: the first
    texts of each language become its share of the landmarks, so there are
    at most ``landmarks`` of these; more languages than that are refused."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], order, np.empty(0, np.int64), np.empty((0, 0), np.uint8), np.empty(0), np.empty((0, 0)))
    if len(languages) > landmarks:
        raise ValueError(f"{len(languages)} languages for {landmarks} landmarks")
    share = landmarks // len(languages)
    seen: dict[str, int] = {}
    chosen = []
    for k, name in enumerate(labels):
        seen[name] = seen.get(name, 0) + 1
        if seen[name] <= share:
            chosen.append(k)
    vocabulary = np.unique(np.concatenate([sets[k] for k in chosen]))
    presence = np.zeros((len(vocabulary), len(chosen)), np.uint8)
    for c, k in enumerate(chosen):
        presence[np.searchsorted(vocabulary, sets[k]), c] = 1
    sizes = presence.sum(axis=0).astype(float)
    dense = presence.astype(np.float32)
    middle = _kernel([sets[k] for k in chosen], vocabulary, dense, sizes)
    values, vectors = np.linalg.eigh((middle + middle.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T  # its inverse square root
    phi = _kernel(sets, vocabulary, dense, sizes) @ root
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Each text weighs as one over its language's count: languages count alike.
    weight = np.array([1.0 / labels.count(name) for name in languages])[[languages.index(x) for x in labels]]
    gram = (phi * weight[:, None]).T @ phi + ridge * np.eye(phi.shape[1]) * weight.mean()
    return LanguageModel(languages, order, vocabulary, presence, sizes,
                         root @ np.linalg.solve(gram, (phi * weight[:, None]).T @ targets))


def train(docs: DataFrame, per_language: int = 200, order: int = 3, landmarks: int = 192, ridge: float = 1e-2,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> LanguageModel:
    """Model of the labelled rows of ``docs`` (non-null label).

    A bounded sample is learned from: about ``per_language`` whole texts of
    each language, those first by the hash of id and text, so that reruns
    learn the same. Only counts and the sample's n-grams come to the driver.
    A label column with more than ``landmarks`` distinct values fails: it
    holds no languages. Texts without letters teach nothing; without labelled
    rows every prediction is undetermined."""
    bound_batches(docs.sparkSession)
    rows = docs.select(col(text_col).alias("text"), col(label_col).alias("label"), col(id_col).alias("id")).filter(
        "label is not null and text is not null")
    counted = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(landmarks + 1)
    counts = {r["label"]: r["n"] for r in counted.collect()}
    if len(counts) > landmarks:
        raise ValueError(f"{label_col} holds over {landmarks} languages, the number of landmarks")
    if not counts:
        return fit([], [], order)
    spread = 1 << 40
    share = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(spread, int(1.25 * (per_language + 20) / n * spread)))])
    # A sample by hash threshold: no sort.
    hashed = rows.withColumn("h", F.xxhash64("id", "text"))
    sample = hashed.filter(F.pmod("h", F.lit(spread)) < share[F.col("label")])

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "h": b["h"], "grams": [grams(t, order, letters) for t in b["text"]]})

    # Rows that repeat one id and text teach once.
    found = (sample.select("text", "label", "h").dropDuplicates(["label", "h"])
             .mapInPandas(of, "label string, h long, grams array<long>").toPandas())
    found = found[found["grams"].map(len) > 0].sort_values(["label", "h"], kind="stable")
    found = found.groupby("label").head(per_language)
    return fit([np.asarray(g, np.int64) for g in found["grams"]], found["label"].tolist(), order, landmarks, ridge)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score") -> DataFrame:
    """``docs`` with ``lang_out`` (a learned label, or ``und`` for a text that
    is null, empty or has no letters) and ``score_out`` (the language's
    regression value moved from -1..1 to 0..1 and cut there; 0 for ``und``).
    Only the text is read. Columns of these names are replaced, all others
    stay; equal texts get equal results; an empty table gives no rows. A long
    text is taken apart a million characters at a time."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("lang string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, presence = letter_table(), model.presence.astype(np.float32)
        for texts in batches:
            names, scores = model.predict(texts.tolist(), letters, presence)
            yield pd.DataFrame({"lang": names, "score": scores})

    columns = [c for c in docs.columns if c not in (lang_out, score_out)]
    out = docs.select(*[col(c) for c in columns], of(col(text_col)).alias("_language"))
    return out.select(*[col(c) for c in columns], F.col("_language.lang").alias(lang_out),
                      F.col("_language.score").alias(score_out))
