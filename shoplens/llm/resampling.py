"""Importance resampling towards a target distribution.

Words come from a pre-tokenizer: a regular expression, without any training,
splits the ASCII-lowered text and gives each word's offset pair. Windows over
those pairs are the features, hashed by CRC-32 into a fixed number of
buckets. The gain of a bucket compares its share of the target's features
with its share of the corpus's; a document's weight is the sum of its
features' gains, and Gumbel noise from a hash of its id makes the highest
scores a draw without replacement.

A text is split once: its buckets are staged as two bytes a feature, and both
the histograms and the sums read those.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Run, col, ranked

#: Letters, digits and everything outside ASCII make words.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Characters that the pre-tokenizer reads at once, to the end of their last word.
PIECE = 1 << 18


def offsets(piece: str, splitter) -> list[tuple[int, int]]:
    """Offset pairs of the words of a piece."""
    return [span for _, span in splitter.pre_tokenize_str(piece)]


def feature_buckets(text: str | None, splitter, breaks, grams: int, buckets: int, piece: int = PIECE) -> tuple[int, np.ndarray]:
    """(number of words, bucket of every feature) of a whole text. A long
    text is read in pieces that end between words; the last ``grams - 1``
    words of a piece stand before the next one."""
    if not text:
        return 0, np.empty(0, np.uint32)
    # Lower-casing bytes changes A-Z alone.
    text = text.encode().lower().decode()
    n, out, before, at = 0, [], [], 0
    while at < len(text):
        cut = breaks.search(text, min(at + piece, len(text)))
        end = cut.end() if cut else len(text)
        part = text[at:end]
        at = end
        new = [part[s:e] for s, e in offsets(part, splitter)]
        n += len(new)
        words = before + new
        for size in range(1, grams + 1):
            first = max(0, len(before) - size + 1)
            runs = words[first:] if size == 1 else (
                " ".join(words[k:k + size]) for k in range(first, len(words) - size + 1))
            out.append(np.fromiter((zlib.crc32(r.encode()) % buckets for r in runs), np.uint32))
        before = words[max(0, len(words) - grams + 1):] if grams > 1 else []
    return n, np.concatenate(out)


def features(docs: DataFrame, text_col: str, grams: int, buckets: int) -> Column:
    """Struct of n_words and buckets (little-endian, two bytes a feature, or
    four if there are over 65,536 buckets)."""
    dtype = "<u2" if buckets <= 1 << 16 else "<u4"

    @F.pandas_udf("n_words long, buckets binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import re

        from tokenizers import Regex, pre_tokenizers

        splitter, breaks = pre_tokenizers.Split(Regex(WORDS), "removed", invert=True), re.compile(BREAKS)
        for texts in batches:
            rows = [feature_buckets(t, splitter, breaks, grams, buckets) for t in texts]
            yield pd.DataFrame({"n_words": [n for n, _ in rows], "buckets": [b.astype(dtype).tobytes() for _, b in rows]})

    return of(col(text_col))


def histogram(staged: DataFrame, buckets: int) -> DataFrame:
    """Staged features → (bucket, n): each task adds up its own, so at most
    ``buckets`` rows of each reach the shuffle."""
    dtype = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for b in batch.column(0):
                total += np.bincount(np.frombuffer(b.as_buffer(), dtype), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return (staged.select("buckets").mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """Histograms of both → (bucket, gain): floor(1000 ln) of the ratio of the
    bucket's shares, each with one added to every bucket. ``buckets`` rows."""
    t = (corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
         .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
         .join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"]))
    sums = t.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).first()
    d = [F.col("t").cast("double") + 1, F.col("s").cast("double") + 1]
    ratio = (d[0] * F.lit(float(sums["all_s"] + buckets))) / (d[1] * F.lit(float(sums["all_t"] + buckets)))
    return t.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain"))


def gumbel(id_: Column, seed: str) -> Column:
    """floor(1000 x Gumbel noise) from 32 bits of the id's hash."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.ln(-F.ln((h.cast("double") + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, grams: int = 1,
             buckets: int = 10_000, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight,
    score (weight plus noise) and rank, 1 to floor(percent * N / 100) over the
    N documents of at least ``least_words`` words by score, then id; null for
    the others, which are not drawn.

    Features are all runs of 1 to ``grams`` words. The gains are ``buckets``
    numbers, which is all that the driver and each task hold of the corpus.
    Null, empty or wordless text: no features, weight 0. A null id hashes as
    an empty one and stands last among equal scores; rows that repeat an id
    share the noise, and each may be drawn. A long text is split in pieces
    and only its buckets (two bytes a feature) are held whole. An empty
    target gives gains that favour the corpus's rarer buckets; an empty table
    gives no rows. Extra columns are ignored."""
    run = Run(docs.sparkSession, "resampling")
    base = run.stage(docs.select(col(id_col).alias("doc_id"), features(docs, text_col, grams, buckets).alias("f"))
                     .select("doc_id", "f.*"), "features")
    aim = run.stage(target.select(features(target, target_text_col, grams, buckets).alias("f")).select("f.*"), "target")
    gains = run.stage(bucket_gains(histogram(base, buckets), histogram(aim, buckets), buckets), "gains")
    gain = np.zeros(buckets, np.int64)
    for r in gains.collect():  # ``buckets`` rows
        gain[r["bucket"]] = r["gain"]
    dtype = "<u2" if buckets <= 1 << 16 else "<u4"

    @F.pandas_udf("long")
    def weigh(rows: pd.Series) -> pd.Series:
        return pd.Series([int(gain[np.frombuffer(b, dtype)].sum()) for b in rows], dtype="int64")

    scored = run.stage(
        base.select("doc_id", "n_words", F.floor(F.octet_length("buckets") / np.dtype(dtype).itemsize).alias("n_features"),
                    weigh("buckets").alias("weight"))
        .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
        .withColumn("row", F.monotonically_increasing_id()), "scores")
    run.drop("features", "target")
    enough = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    drawn = F.col("rank") < F.floor(F.col("size") * percent / 100)
    in_order = (ranked(scored.filter(enough), [], order, run, "ranks")
                .withColumn("rank", F.when(drawn, F.col("rank") + 1)).drop("row", "size"))
    return in_order.unionByName(scored.filter(~enough).drop("row").withColumn("rank", F.lit(None).cast("long")))
