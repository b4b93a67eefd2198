"""Document fingerprints: threshold-scaled sketches.

A sketch keeps every distinct shingle hash below a fixed fraction of the hash
range, and the smallest hash of all, so that no text with a word has none.
Sketches of one fraction merge by union (and again the smallest), and the
share of one's hashes that another holds estimates containment, whatever the
lengths of the two texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, col

#: One in so many hashes is kept. Texts of 50 to 100 words still have some 40,
#: enough to tell half copies (measured errors: README).
SCALE = 2
#: Bytes of text in a range of documents and in a task, the most ranges, and
#: the rows by which each range's bound is estimated. They shape tasks, not results.
RANGE_BYTES, TASK_BYTES, MOST_RANGES, BOUND_ROWS = 4 << 20, 16 << 20, 1 << 16, 16


def sketch(text: str | None, shingle: int = 5, scale: int = SCALE) -> np.ndarray:
    """Sorted hashes (uint32) of a text: the upper half of XXH64, seed 42, of
    its shingles of ``shingle`` words joined by a space (fewer words: all of
    them). A text without words, or null, has none. A hash meets one of n
    others by chance in n of 2^32 / ``scale`` cases: one in 2,000 for a text
    of a million kept shingles. Long texts are hashed 65,536 shingles at a time."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, np.uint32)
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[:n].tolist(), (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    digest, kept, least = xxhash.xxh64_intdigest, [], []
    for k in range(0, n, 65536):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[k:k + 65536], last[k:k + 65536])], np.uint64)
        h = (h >> np.uint64(32)).astype(np.uint32)
        least.append(h.min())
        kept.append(np.unique(h[h < (1 << 32) // scale]))
    return np.unique(np.concatenate([*kept, np.array([min(least)], np.uint32)]))


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Sketch of what two sketched sets of shingles hold together."""
    both = np.union1d(a, b)
    return both[(both < (1 << 32) // scale) | (both == both[:1])]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b holds (a without any: 0, or 1
    if b has none either)."""
    if not len(a):
        return float(not len(b))
    return float(np.isin(a, b, assume_unique=True).mean())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Containment of the smaller sketch in the larger one."""
    return containment(a, b) if len(a) <= len(b) else containment(b, a)


def to_text(s: np.ndarray) -> str:
    """A sketch as base64 of its hashes, ascending, four bytes each (big-endian)."""
    return base64.b64encode(s.astype(">u4").tobytes()).decode("ascii")


def from_text(s: str) -> np.ndarray:
    """The sketch that ``to_text`` wrote."""
    return np.frombuffer(base64.b64decode(s), ">u4").astype(np.uint32)


def fingerprint(docs: DataFrame, shingle: int = 5, scale: int = SCALE, out: str = "fingerprint",
                text_col: str = "text") -> DataFrame:
    """``docs`` with the sketch of each whole text in base64 in ``out`` (null,
    empty or wordless text: the empty string; a long one: as many hashes as
    its shingles give)."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([to_text(sketch(t, shingle, scale)) for t in texts], dtype=object)

    return docs.withColumn(out, of(col(text_col)))


def edited_text(text: str, following: str | None) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all)
    of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + (following or "")[:half]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _compare_runs(shingle: int, scale: int):
    def row(now: tuple, following: str | None, nxt: np.ndarray | None) -> tuple:
        doc_id, text, mine = now
        edited = edited_text(text, following)
        other = sketch(edited, shingle, scale)
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(mine),
                to_text(other), likeness(mine, other),
                likeness(mine, nxt if nxt is not None else sketch(following, shingle, scale)))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows sorted by range, then document; the last row of a range is the
        # next range's first document, and only looked at.
        held: tuple | None = None  # range, (doc_id, text, sketch)
        for b in batches:
            out = []
            for where, ahead, unnamed, doc_id, text in zip(b["range"], b["ahead"], b["unnamed"], b["number"], b["text"]):
                text = text or ""
                same = held is not None and held[0] == where
                mine = None if ahead else sketch(text, shingle, scale)
                if same:
                    out.append(row(held[1], text, mine))
                elif held is not None:
                    raise AssertionError("a range ended without the next one's first document")
                held = None if ahead else (where, (None if unnamed else doc_id, text, mine))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")]).astype({"doc_id": "Int64"})
    return compare


@dataclass
class Bounds:
    """Where ranges of documents begin, in their order: ids and text hashes of
    the named ones, then text hashes of those without an id."""

    numbers: np.ndarray
    bodies: np.ndarray
    unnamed: np.ndarray

    def place(self, unnamed: np.ndarray, number: np.ndarray, body: np.ndarray) -> np.ndarray:
        """The range of each document: how many bounds are not after it."""
        low, high = (np.searchsorted(self.numbers, number, side) for side in ("left", "right"))
        out = low.copy()
        tied = (high > low) & ~unnamed  # the id is a bound's: its text's hash decides
        for k in np.unique(low[tied]):
            at = tied & (low == k)
            out[at] += np.searchsorted(self.bodies[k:high[at][0]], body[at], "right")
        out[unnamed] = len(self.numbers) + np.searchsorted(self.unnamed, body[unnamed], "right")
        return out.astype(np.int64)


def _range_bounds(d: DataFrame, ranges: int, rows: int) -> Bounds:
    """Bounds of ``ranges`` ranges of about equal bytes, from about
    ``BOUND_ROWS`` rows a range, chosen by hash."""
    spread = 1 << 40
    chosen = F.pmod(F.xxhash64(F.lit(1), "number", "body"), F.lit(spread)) < min(spread, spread * BOUND_ROWS * ranges // max(1, rows))
    found = d.filter(chosen).select("unnamed", "number", "body", "bytes").toPandas()
    found = found.sort_values(["unnamed", "number", "body"], ignore_index=True)
    total = (found["bytes"] + 1).cumsum().to_numpy()
    at = np.searchsorted(total, [total[-1] * k / ranges for k in range(1, ranges)]) if len(found) else []
    cuts = found.iloc[np.unique(at)].drop_duplicates(["unnamed", "number", "body"]) if len(at) else found[:0]
    void = cuts["unnamed"].to_numpy(bool)
    numbers, bodies = cuts["number"].to_numpy(np.int64), cuts["body"].to_numpy(np.int64)
    return Bounds(numbers[~void], bodies[~void], bodies[void])


def _with_range(d: DataFrame, ranges: int | None = None) -> tuple[DataFrame, int]:
    """``d`` with each document's range, and in how many tasks to read them."""
    rows, size = d.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    ranges = ranges or min(MOST_RANGES, max(8, -(-size // RANGE_BYTES)))
    bounds = _range_bounds(d, ranges, rows)

    @F.pandas_udf("long")
    def place(unnamed: pd.Series, number: pd.Series, body: pd.Series) -> pd.Series:
        return pd.Series(bounds.place(unnamed.to_numpy(bool), number.to_numpy(np.int64), body.to_numpy(np.int64)))

    return d.withColumn("range", place("unnamed", "number", "body")), min(ranges, max(8, -(-size // TASK_BYTES)))


def compare_with_next(docs: DataFrame, shingle: int = 5, scale: int = SCALE, ranges: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, the fingerprints of the
    text and of its edited text (``edited_text`` with the next document by
    ascending doc_id, after the last the first), edited_sha256, and how much
    the fingerprint is like the edited one and the next document's.

    Documents are dealt to ``ranges`` ranges of (id, text's hash) of about
    equal bytes (default: one for 4 MB, at most 65,536), whose bounds come
    from a small sample of the ids, as those of a range partitioning do; each
    range is read in order and ends with a copy of the first document after
    it. So one shuffle moves each text once.

    Null texts are empty. Rows without an id come last; rows that share an id
    (or have none) follow each other by their text's hash, and may be in
    several ranges; only rows equal in both share one for sure. A single
    document is its own next one. Two texts, however long, are held at a time.
    Extra columns are ignored; an empty table gives no rows."""
    bound_batches(docs.sparkSession)
    d = docs.select(col(id_col).isNull().alias("unnamed"), F.coalesce(col(id_col).cast("long"), F.lit(0)).alias("number"),
                    F.coalesce(col(text_col), F.lit("")).alias("text"))
    order = ["unnamed", "number", "body"]
    d, tasks = _with_range(d.select("unnamed", "number", F.xxhash64("text").alias("body"),
                                    F.octet_length("text").cast("long").alias("bytes"), "text"), ranges)
    # The first document of each range, one row a range, also ends the range
    # before it that has any; that of the first range ends the last one.
    firsts = d.groupBy("range").agg(F.min(F.struct(*order)).alias("first")).select("range", "first.*")
    down = Window.orderBy(F.desc("range"))
    ends = firsts.withColumn("end", F.coalesce(F.lead("range").over(down), F.first("range").over(down)))
    ahead = (d.join(F.broadcast(ends), ["range", *order]).dropDuplicates(["range"])
             .select(F.col("end").alias("range"), *order, "text"))
    dealt = d.withColumn("ahead", F.lit(False)).select("range", "ahead", *order, "text").unionByName(
        ahead.withColumn("ahead", F.lit(True)))
    return (dealt.repartition(tasks, "range").sortWithinPartitions("range", "ahead", *order)
            .select("range", "ahead", "unnamed", "number", "text").mapInPandas(_compare_runs(shingle, scale), _OUT))
