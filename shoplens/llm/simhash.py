"""SimHash near-duplicates: byte-position inverted index with count filtering.

A 64-bit fingerprint is eight bytes. Two fingerprints that differ in at most
d bits agree in at least 8 - d byte positions; that count is the filter. To
keep the lists of the index short, a posting joins several positions: if
8 - d positions agree, one half of the eight holds at least ceil((8 - d) / 2)
of them, so all subsets of that size within either half suffice (eight
three-byte postings for d = 3). Within a list the equal bytes of each pair
are tallied, pairs under 8 - d equal bytes leave, the rest are verified bit by
bit, and only a spanning forest of the links goes on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Run, col, connected_components

#: Fingerprints of one list that are compared at once; longer lists are cut
#: into blocks and every pair of blocks is a group of its own.
BLOCK = 2048


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text as a signed 64-bit integer: words of the text with
    A-Z in lower case, ``shingle`` words joined by a space (fewer words: all
    of them), XXH64 with seed 42; a bit is 1 if set in over half the hashes.
    No words (or null): 0."""
    words = text.encode().lower().split() if text else []  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashed, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    first, last = starts[:n].tolist(), (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    for k in range(0, n, 65536):
        h = np.array([hashed(joined[a:b], 42) for a, b in zip(first[k:k + 65536], last[k:k + 65536])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _linked(runs: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``runs``: each fingerprint of a linked set
    with the first of its set."""
    n = len(fps)
    change = np.flatnonzero(np.concatenate((runs[1:] != runs[:-1], [True])))
    end = np.repeat(change + 1, np.diff(np.concatenate(([-1], change))))
    label, at, step = np.arange(n), np.arange(n), 0
    while True:
        step += 1
        at = at[at + step < end[at]]
        if not len(at):
            break
        apart = fps[at] ^ fps[at + step]
        tally = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = tally >= 8 - bits
        near[near] = np.bitwise_count(apart[near]) <= bits
        p, q = at[near], at[near] + step
        while len(p):
            a, b = label[p], label[q]
            apart_yet = a != b
            p, q, a, b = p[apart_yet], q[apart_yet], a[apart_yet], b[apart_yet]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero((label != np.arange(n)) & (fps != fps[label]))
    return fps[moved], fps[label[moved]]


def _link_batches(bits: int):
    """Reads batches sorted by (key, lo, hi); the last group of a batch waits
    for the next one. A group has at most about two blocks of rows."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 4), np.int64)

        def out(rows: np.ndarray) -> pa.RecordBatch:
            new = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            a, b = _linked(np.concatenate(([0], np.cumsum(new))), np.ascontiguousarray(rows[:, 3]).view(np.uint64), bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
            held = np.concatenate((held, rows))
            done = np.flatnonzero((held[1:, :3] != held[:-1, :3]).any(axis=1))
            if len(done):
                yield out(held[:done[-1] + 1])
                held = held[done[-1] + 1:]
        if len(held):
            yield out(held)
    return link


def near_fingerprints(fps: DataFrame, bits: int, run: Run, block: int = BLOCK) -> DataFrame:
    """Distinct long ``fp`` → links (a, b) that connect every two of them
    within ``bits`` differing bits, directly or over others of the result."""
    if not 0 <= bits <= 7:
        raise ValueError("bits must be 0 to 7: beyond, no byte need agree")
    joint = (8 - bits + 1) // 2
    subsets = [s for half in (range(4), range(4, 8)) for s in combinations(half, joint)]
    byte = [F.shiftrightunsigned("fp", 8 * k).bitwiseAND(255) for k in range(8)]
    keys = []
    for t, subset in enumerate(subsets):
        key = F.lit(t).cast("long")
        for k in subset:
            key = F.shiftleft(key, 8).bitwiseOR(byte[k])
        keys.append(key)
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    lists = (postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (postings.join(lists, "key").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").cast("long").alias("lo"),
                     F.greatest("own", "other").cast("long").alias("hi"), "fp"))
    links = (dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "fp")
             .mapInArrow(_link_batches(bits), "a long, b long"))
    return run.stage(links.distinct(), "links")


def simhash_groups(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text",
                   run: Run | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), fingerprint (16 hex
    digits), component_id (the smallest doc_id that links of at most ``bits``
    differing bits reach, itself included), group (the component's smallest
    fp), and the columns ``carry``.

    Null, empty or wordless text: fingerprint zero, linked like any other.
    Equal texts share a fingerprint. A null id is never a component's id
    unless the component has no other (then it is null). Repeated rows get
    equal rows. Empty table: no rows. Extra columns are ignored."""
    run = run or Run(docs.sparkSession, "simhash")

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    base = run.stage(docs.select(col(id_col).alias("doc_id"), of(col(text_col)).alias("fp"), *[col(c) for c in carry]),
                     "fingerprints")
    firsts = run.stage(base.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    links = near_fingerprints(firsts.select("fp"), bits, run)
    nodes = connected_components(links, run)
    nodes = nodes.join(firsts, F.col("node") == F.col("fp")).select("fp", "root", "first")
    lowest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = nodes.join(lowest, "root").select("fp", "root", "component_id")
    alone = F.col("root").isNull()
    ids = run.stage(firsts.join(linked, "fp", "left")
                    .select("fp", F.when(alone, F.col("fp")).otherwise(F.col("root")).alias("group"),
                            F.when(alone, F.col("first")).otherwise(F.col("component_id")).alias("component_id")),
                    "components")
    return (base.join(ids, "fp")
            .select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "group",
                    *[col(c) for c in carry]))


def keep_first(docs: DataFrame, columns: list[str], shingle: int = 3, bits: int = 3, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``columns`` of the documents that stay when one of each group of
    ``simhash_groups`` does: the one with the smallest id, and of several
    texts under that id the one of least hash.

    Every group keeps exactly one row, so an id that stands over texts of two
    groups may stay in both. Rows without an id stand after all others. Of
    equal rows one stays, whichever. Empty table: no rows."""
    run = Run(docs.sparkSession, "simhash-keep")
    text_hash = F.xxhash64(F.coalesce(col(text_col), F.lit("")))
    groups = simhash_groups(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"),
                                        text_hash.alias("number")), shingle, bits, run=run, carry=["number"])
    first_of = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("_id"), F.col("number").alias("_hash"))
    stay = groups.groupBy("group").agg(F.min(first_of).alias("s")).select("s._id", "s._hash")
    named = docs.select(*[col(c) for c in columns], text_hash.alias("_number"))
    left = named.join(stay, col(id_col).eqNullSafe(F.col("_id")) & (F.col("_number") == F.col("_hash")))
    # Rows that share id and text: which of them stays depends on their content alone.
    order = [F.xxhash64(*[col(c) for c in columns]), col(text_col)]
    first = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(*order))
    return left.withColumn("_first", first).filter("_first = 1").select(*[col(c) for c in columns])
