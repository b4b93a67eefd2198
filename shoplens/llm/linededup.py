"""Line dedup: deletion-neighbourhood join within one edit.

Two lines are within one edit (a substituted, added or missing character) if
one character left out of either or both gives the same string at the same
place. All variants of all lines would be as many as characters, so lines
first show that they can have a partner: two lines within one edit share
their first or their last m characters, m about half their length. Only lines
that share such a half with another line emit their variants, those with a
character of the other half left out, as hashes; equal variants are joined, the
edit distance of the lines is verified, and the earliest line is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Run, col

#: Lines of fewer characters have no near copies, only equal ones: one edit
#: of 20 characters leaves 95 % as it was.
MIN_CHARS = 20
#: m is a multiple of this, so that neighbouring lengths mostly have one m.
STEP = 8
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Variants that a task makes at once.
PORTION = 1_000_000

#: What names a document: rows without an id come last, told apart by their text.
KEY = ["unnamed", "number", "body"]


def _named(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [col(id_col).isNull().alias("unnamed"), F.coalesce(col(id_col).cast("long"), F.lit(0)).alias("number"),
            F.xxhash64(col(text_col)).alias("body")]


def _occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(unnamed, number, body, line, text, n, h) of each line with a word."""
    lines = docs.select(*_named(docs, id_col, text_col),
                        F.posexplode(F.split(col(text_col), "\n", -1)).alias("line", "text"))
    return (lines.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("n", F.length("text")).withColumn("h", F.xxhash64("text")))


def _half(n: Column) -> Column:
    return F.floor(n / (2 * STEP)).cast("int") * STEP


def _half_keys() -> list[Column]:
    """k0, k1: the first and last m characters for lines as long as this; k2,
    k3: the same where lines one longer have another m, else null."""
    out = []
    for j, m in enumerate((_half(F.col("n")), _half(F.col("n") + 1))):
        has = (F.col("n") >= MIN_CHARS) & (F.lit(not j) | (m != _half(F.col("n"))))
        out.append(F.when(has, F.xxhash64(F.lit(0), m, F.substring(F.col("text"), F.lit(1), m))).alias(f"k{2 * j}"))
        out.append(F.when(has, F.xxhash64(F.lit(1), m, F.substring(F.col("text"), -m, m))).alias(f"k{2 * j + 1}"))
    return out


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(0, n - 1), BASE, np.uint64))))


def variants(line: str, before: bool, after: bool, powers: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """The line's hash, places, and hashes of the line less the character at
    each place. ``after``: the first half is shared, so places after it
    count; ``before``: the last half is shared."""
    x = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    n = len(x)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * powers[:n])))
    # Lines one longer may have a larger m: take the smallest share of this line that any m allows.
    m = n // (2 * STEP) * STEP
    low, high = (m if after and not before else 0), (n - m if before and not after else n)
    p = np.arange(low, high)
    return int(sums[n]), p, sums[p] + (sums[n] - sums[p + 1]) * np.uint64(BASE_INVERSE)


def _emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (size, v, place, h, text): of each candidate line its variants
    (size: its length), itself (place -1, size: one more) and its text
    (place -2)."""
    powers = _powers(4096)
    for b in batches:
        parts: list[tuple] = []
        held = 0
        for text, candidates in zip(b["text"], b["candidates"]):
            lines = text.split("\n")
            for c in candidates:
                line = lines[c["line"]]
                if len(line) > len(powers):
                    powers = _powers(2 * len(line))
                whole, p, v = variants(line, bool(c["before"]), bool(c["after"]), powers)
                parts.append((len(line), [np.int64(0)], [-2], c["h"], line))
                parts.append((len(line) + 1, np.array([whole], np.uint64).view(np.int64), [-1], c["h"], None))
                parts += [(len(line), v[k:k + PORTION].view(np.int64), p[k:k + PORTION], c["h"], None)
                          for k in range(0, len(p), PORTION)]
                held += len(p)
                if held >= PORTION:
                    yield _frame(parts)
                    parts, held = [], 0
        if parts:
            yield _frame(parts)


def _frame(parts: list[tuple]) -> pd.DataFrame:
    many = [len(x[1]) for x in parts]
    return pd.DataFrame({
        "size": np.repeat([x[0] for x in parts], many), "v": np.concatenate([x[1] for x in parts]),
        "place": np.concatenate([x[2] for x in parts]), "h": np.repeat(np.array([x[3] for x in parts], np.int64), many),
        "text": np.repeat(np.array([x[4] for x in parts], object), many)})


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: Run | None = None) -> DataFrame:
    """(unnamed, number, body, dropped): of each document that loses lines,
    the numbers (from 0, ascending) of the lines that stand later, by doc_id
    and then line, than an equal line or one within one edit."""
    run = run or Run(docs.sparkSession, "lines")
    place = F.struct("unnamed", "number", "body", "line")
    # Equal lines are one row from here on: by hash and length, with the first place.
    lines = run.stage(_occurrences(docs, id_col, text_col).select(*KEY, "line", "n", "h", *_half_keys())
                      .groupBy("h", "n").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"),
                                             *[F.first(f"k{k}").alias(f"k{k}") for k in range(4)]), "distinct")
    # Halves that two lines share. Half 0 (the first characters) is shared: the edit is after it.
    halves = lines.select("h", "n", "first", F.explode(F.array(*[
        F.struct(F.col(f"k{k}").alias("key"), F.lit(k % 2).alias("half")) for k in range(4)])).alias("k")) \
        .select("h", "n", "first", "k.*").filter("key is not null")
    shared = halves.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("key")
    found = run.stage(halves.join(shared, "key").withColumn("size", F.explode(F.array(F.col("n"), F.col("n") + 1))), "halves")
    # Of those few, lines of one length or of two that are one apart: equal in one of these sizes.
    close = found.groupBy("key", "size").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b")
    candidates = (found.join(close.select("key", "size"), ["key", "size"]).groupBy("h", "n")
                  .agg(F.max(F.col("half") == 0).alias("after"), F.max(F.col("half") == 1).alias("before"),
                       F.first("first").alias("first")))
    by_doc = (candidates.select("first.*", F.struct(F.col("first.line"), "h", "before", "after").alias("c"))
              .groupBy(*KEY).agg(F.collect_list("c").alias("candidates")))
    texts = docs.select(*_named(docs, id_col, text_col), col(text_col).alias("text"))
    emitted = run.stage(texts.join(by_doc, KEY).select("text", "candidates")
                        .mapInPandas(_emit, "size int, v long, place int, h long, text string"), "variants")
    # At most one line for each character and place has a given variant: these groups are small.
    same = Window.partitionBy("size", "v")
    met = (emitted.filter("place > -2").select("size", "v", "place", "h")
           .withColumn("a", F.min("h").over(same)).withColumn("b", F.max("h").over(same))
           .filter("a <> b").drop("a", "b").distinct())
    whole = F.when(F.col("place") == -1, F.col("size") - 1).otherwise(F.col("size"))
    met = run.stage(met.withColumn("n", whole).join(lines.select("h", "n", "first"), ["h", "n"]), "met")
    # A substitution joins lines of one length at one place; an addition joins
    # a line (place -1) with those that have one character more.
    me = F.struct("first", "h")
    at_place = Window.partitionBy("size", "v", "place")
    pairs = (met.withColumn("twin", F.when(F.col("place") >= 0, F.min(me).over(at_place)))
             .withColumn("shorter", F.min(F.when(F.col("place") == -1, me)).over(same))
             .withColumn("longer", F.min(F.when(F.col("place") >= 0, me)).over(same))
             .withColumn("other", F.when(F.col("place") == -1, F.col("longer")).otherwise(F.col("shorter")))
             .select("h", "first", F.explode(F.array("twin", "other")).alias("e"))
             .filter(F.col("e").isNotNull() & (F.col("e.first") < F.col("first")))
             .select("h", F.col("e.h").alias("early")).distinct())
    said = emitted.filter("place = -2").select("h", "text").dropDuplicates(["h"])
    near = (pairs.join(said, "h").join(said.select(F.col("h").alias("early"), F.col("text").alias("earlier")), "early")
            .filter(F.levenshtein("text", "earlier", 1) >= 0).select("h").distinct().withColumn("near", F.lit(True)))
    # Only lines that occur again or have a near copy decide about places.
    marked = lines.select("h", "n", "first", "times").join(near, "h", "left").filter("times > 1 or near")
    marked = run.stage(marked.select("h", "n", "first", F.coalesce("near", F.lit(False)).alias("near")), "marked")
    places = _occurrences(docs, id_col, text_col).select(*KEY, "line", "h", "n")
    return (places.join(marked, ["h", "n"]).filter(F.col("near") | (place > F.col("first")))
            .groupBy(*KEY).agg(F.array_sort(F.collect_set("line")).alias("dropped")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, dropped
    (numbers, from 0, of the lines that go).

    A line (between \\n) goes if a line before it, in an earlier document by
    id or earlier in its own, is equal, or both have at least 20 characters
    and are within one edit (insert, delete or replace a character); whether
    that earlier line stays itself does not matter. Lines without a word never
    go. Null text: null n_lines and nothing dropped; empty text: one line.
    Documents without an id count as later than all others, in the order of
    their text's hash; rows that share an id, likewise. Equal rows get equal
    results: they are one document. Extra columns are ignored; an empty table
    gives no rows."""
    drops = repeated_lines(docs, id_col, text_col)
    # array<int>, null text: no lines
    rows = docs.select(col(id_col).alias("doc_id"), *_named(docs, id_col, text_col),
                       F.size(F.split(col(text_col), "\n", -1)).alias("n_lines"), col(text_col).isNull().alias("void"))
    none = F.array().cast("array<int>")
    return (rows.join(drops, KEY, "left")
            .select("doc_id", F.when(~F.col("void"), F.col("n_lines").cast("long")).alias("n_lines"),
                    F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.coalesce("dropped", none).alias("dropped")))


def without_repeated_lines(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text",
                           chars_col: str | None = "n_chars") -> DataFrame:
    """``columns`` of ``docs`` with the lines that ``dedup_lines`` drops taken
    out of the text (and ``chars_col``, if given, its new length). Documents
    that keep no word leave; one without repeated lines stays as it is."""
    drops = repeated_lines(docs, id_col, text_col)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, dropped: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, dropped):
            if text is not None and gone is not None:
                gone = set(gone.tolist())
                text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
            out.append(text)
        return pd.Series(out, dtype=object)

    named = docs.select(*[col(c) for c in columns], *[x.alias(f"_{k}") for k, x in zip(KEY, _named(docs, id_col, text_col))])
    drops = drops.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("dropped").alias("_dropped"))
    out = named.join(drops, [f"_{k}" for k in KEY], "left").withColumn("_text", cut(col(text_col), F.col("_dropped")))
    kept = out.filter(F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {text_col: F.col("_text")} | ({chars_col: F.length("_text").cast("long")} if chars_col else {})
    return kept.select(*[new.get(c, col(c)).alias(c) for c in columns])
