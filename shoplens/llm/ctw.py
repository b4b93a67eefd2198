"""Language-model scores by context-tree weighting.

Text is read as bytes, a byte as eight binary decisions. For each of the 255
places in that decomposition a tree of contexts (the bytes before, up to
``depth``) holds counts of zeros and ones from the training documents, and a
Krichevsky-Trofimov estimate of them. The weighted probability of a context
is half its own estimate and half the product over its longer contexts, so
every depth takes part, each by what it explains; a prediction follows the
path of contexts, weighted by the same halves after training.

What a document needs of the model are its distinct runs of ``depth`` + 1
bytes. Blocks of whole documents (or pieces of very long ones) each send
their distinct runs with training counts; Spark sums these into the model,
level by level, joins each run's log probability back to the blocks that
hold it, and every block is scored against its own part of the model. The
model grows with the corpus and never meets in one place.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Run, col

#: Bytes of context.
DEPTH = 5
#: Bytes of text that share one part of the model, and of one piece of a text.
BLOCK, PIECE = 32 << 20, 4 << 20
#: Ends a text and stands before it: no byte of UTF-8.
END = b"\xff"
#: Distinct runs and words that a task holds before it sends them.
HELD_RUNS, HELD_WORDS = 1 << 21, 1 << 18
#: Bytes that are scored at once (and the piece that goes beyond them).
SCORED_BYTES = 1 << 19
#: Words beyond this length are sent as a digest.
LONG_WORD = 24


def word_key(word: bytes) -> bytes:
    return word if len(word) <= LONG_WORD else END + hashlib.blake2b(word, digest_size=16).digest()


def pieces(body: bytes, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Bounds of a text's pieces; none ends within a word."""
    at = 0
    while len(body) - at > size:
        end = max(body.rfind(s, at, at + size) for s in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) + 1
        if not end:  # one word fills the piece: it ends with that word
            ends = [p for s in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (p := body.find(s, at + size)) >= 0]
            end = min(ends, default=len(body) - 1) + 1
        yield at, end
        at = end
    if at < len(body) or not body:
        yield at, len(body)


def runs_of(sequences: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``depth`` + 1 bytes as integers, one for every byte after the
    first ``depth`` of each sequence, and how many each sequence has."""
    data = np.frombuffer(b"".join(sequences), np.uint8).astype(np.uint64)
    lengths = np.array([len(s) for s in sequences])
    run = data.copy()
    for k in range(1, depth + 1):
        run[k:] |= data[:-k] << np.uint64(8 * k)
    within = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return run[within >= depth], lengths - depth


def looked_up(found: np.ndarray, runs: np.ndarray, lp: np.ndarray, depth: int) -> np.ndarray:
    """``lp`` of each found run, ``runs`` (all unsigned) ascending. Some runs
    at a time are sorted with their places in the bits that a run leaves free,
    so that the search keeps to near memory and takes a repeated run once."""
    room = min(16, 64 - 8 * (depth + 1))
    places, mask = np.arange(1 << room, dtype=np.uint64), np.uint64((1 << room) - 1)
    out = np.empty(len(found))
    for k in range(0, len(found), 1 << room):
        part = found[k:k + (1 << room)]
        packed = np.sort((part << np.uint64(room)) | places[:len(part)])
        run = packed >> np.uint64(room)
        new = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        values = lp[np.searchsorted(runs, run[new])]
        out[k:k + len(part)][(packed & mask).astype(np.int64)] = np.repeat(values, np.diff(np.append(new, len(run))))
    return out


class WordCounts(dict):
    """Training counts of words by ``word_key``, looked up by the word."""

    def __missing__(self, word: bytes) -> float:
        if len(word) <= LONG_WORD:
            raise KeyError(word)
        return self[word_key(word)]


def _blocks(depth: int, block: int):
    """Documents → pieces with the block they belong to, lower-cased."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids, rows, held = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            take, out = [], []
            for k, text in enumerate(batch.column(3).cast(pa.binary())):
                body = (text.as_py() or b"").lower()
                for at, end in pieces(body):
                    head = (END * depth + body[max(0, at - depth):at])[-depth:]
                    last = end == len(body)
                    if filled and filled + end - at > block:
                        number, filled = number + 1, 0
                    filled += end - at
                    take.append(k)
                    out.append((number, held[k], head, body[at:end], last))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(take, pa.int64())), rows.take(pa.array(take, pa.int64())),
                 *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.bool_()))]],
                ["doc_id", "row", "block", "held_out", "head", "body", "last"])
    return deal


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of all parts with the sums of their counts."""
    runs, at = np.unique(np.concatenate([r for r, _ in parts]), return_inverse=True)
    return runs, np.bincount(at, np.concatenate([n for _, n in parts]), len(runs)).astype(np.int64)


def _terms(depth: int):
    """Pieces → each block's distinct runs and words with their counts in
    training (0: only in documents held out). What a task holds is bounded;
    a block whose terms it sends in two parts repeats some."""
    def out(block: int, runs=(), words=(), n=()) -> pa.RecordBatch:
        size = max(len(runs), len(words))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, block, np.int64)),
             pa.array(runs, pa.int64()) if len(runs) else pa.nulls(size, pa.int64()),
             pa.array(words, pa.binary()) if len(words) else pa.nulls(size, pa.binary()),
             pa.array(n, pa.int64())], ["block", "run", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, words = None, [], Counter()

        def sent_runs():
            if parts:
                runs, n = _merged(parts)
                parts.clear()
                yield out(block, runs=runs.view(np.int64), n=n)

        def sent_words():
            sums = {w: n for w, n in words.items() if len(w) <= LONG_WORD}
            for w, n in words.items():
                if len(w) > LONG_WORD:
                    sums[word_key(w)] = sums.get(word_key(w), 0) + n
            words.clear()
            if sums:
                order = sorted(sums)
                yield out(block, words=order, n=list(map(sums.__getitem__, order)))

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for b in np.unique(blocks):
                if b != block:
                    yield from sent_runs()
                    yield from sent_words()
                    block = int(b)
                rows = batch.filter(pa.array(blocks == b)).to_pylist()
                for held in (False, True):
                    some = [r for r in rows if r["held_out"] is held]
                    if some:
                        runs, _ = runs_of([r["head"] + r["body"] + (END if r["last"] else b"") for r in some], depth)
                        runs, n = np.unique(runs, return_counts=True)
                        parts.append((runs, np.zeros(len(runs)) if held else n))
                    for r in some:
                        tokens = r["body"].split()
                        if held:
                            for w in tokens:
                                if w not in words:
                                    words[w] = 0
                        else:
                            words.update(tokens)
                if sum(len(r) for r, _ in parts) > HELD_RUNS:
                    parts[:] = [_merged(parts)]
                    if len(parts[0][0]) > HELD_RUNS // 2:
                        yield from sent_runs()
                if len(words) > HELD_WORDS:
                    yield from sent_words()
        yield from sent_runs()
        yield from sent_words()
    return count


def _ln_gamma(x, ln):
    """ln of the gamma function for x of 0.5 or more: Stirling's series at
    x + 8, less the logarithm of the factors between (error under 1e-12).
    Columns and arrays alike; ``ln`` is their logarithm."""
    z = x + 8
    factors = x
    for k in range(1, 8):
        factors = factors * (x + k)
    y = 1 / (z * z)
    series = (((((y * (1 / 1188) - 1 / 1680) * y + 1 / 1260) * y - 1 / 360) * y) + 1 / 12) / z
    return (z - 0.5) * ln(z) - z + 0.5 * math.log(2 * math.pi) + series - ln(factors)


def _ln_estimate(a, b, ln=F.ln):
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _ln_gamma(a + 0.5, ln) + _ln_gamma(b + 0.5, ln) - math.log(math.pi) - _ln_gamma(a + b + 1, ln)


def decisions(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions of each run's last byte: node (the context, then
    the place among the 255: a one and the byte's bits so far) and bit."""
    byte, context = runs & 255, (runs >> 8) << 8
    nodes = np.stack([context | (1 << k) | (byte >> (8 - k)) for k in range(8)], axis=1)
    return nodes, np.stack([(byte >> (7 - k)) & 1 for k in range(8)], axis=1)


class Level(NamedTuple):
    """Contexts of one depth: node, zeros, ones, ln of the weighted
    probability, the weight of their own estimate and of longer contexts;
    ``of`` is the place of each longer node (or decision) in it."""
    node: np.ndarray
    a: np.ndarray
    b: np.ndarray
    lp: np.ndarray
    stop: np.ndarray
    go: np.ndarray
    of: np.ndarray


def deepest_levels(runs: np.ndarray, n: np.ndarray, depth: int, low: int) -> list[Level]:
    """Levels ``depth`` down to ``low`` of runs that are all there are under
    their contexts of ``low`` bytes. A context's key is the low bytes of its
    longer ones' keys."""
    nodes, bits = decisions(runs)
    node, of = np.unique(nodes.ravel(), return_inverse=True)
    counts, ones = np.repeat(n, 8).astype(np.float64), bits.ravel() == 1
    a, b = np.bincount(of, counts * ~ones, len(node)), np.bincount(of, counts * ones, len(node))
    levels = [Level(node, a, b, _ln_estimate(a, b, np.log), np.ones(len(node)), np.zeros(len(node)), of)]
    for d in range(depth - 1, low - 1, -1):
        x = levels[-1]
        node, of = np.unique(x.node & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        a, b, longer = (np.bincount(of, v, len(node)) for v in (x.a, x.b, x.lp))
        own = _ln_estimate(a, b, np.log)
        with np.errstate(over="ignore"):
            levels.append(Level(node, a, b, np.logaddexp(own, longer) - math.log(2), 1 / (1 + np.exp(longer - own)),
                                1 / (1 + np.exp(own - longer)), of))
    return levels


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[list[np.ndarray]]:
    """Batches sorted by their first column → columns of whole groups of it,
    some ``rows`` or one group at a time."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if sum(len(h[0]) for h in held) >= rows:
            columns = [np.concatenate(c) for c in zip(*held)]
            end = int(np.searchsorted(columns[0], columns[0][-1]))
            if end:
                yield [c[:end] for c in columns]
            held = [[c[end:] for c in columns]]
            rows = max(rows, 2 * len(held[0][0]))
    if held and sum(len(h[0]) for h in held):
        yield [np.concatenate(c) for c in zip(*held)]


def _upwards(depth: int, low: int):
    """Runs sorted by their context of ``low`` bytes → that level's nodes."""
    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, runs, n in _whole_groups(batches):
            x = deepest_levels(runs, n, depth, low)[-1]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in x[:6]], ["node", "a", "b", "lp", "stop", "go"])
    return up


def _downwards(depth: int, low: int):
    """Runs and mixed nodes of level ``low``, sorted by context → each run
    with log10 of its last byte's probability."""
    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, is_run, ids, n, p0, p1, rest in _whole_groups(batches):
            is_run = is_run.astype(bool)
            runs = ids[is_run]
            levels = deepest_levels(runs, n[is_run], depth, low)
            order = np.argsort(ids[~is_run])
            p0, p1, rest = (c[~is_run][order] for c in (p0, p1, rest))  # by node, as the level has them
            for longer, x in zip(levels[-2::-1], levels[:0:-1]):
                total = longer.a + longer.b + 1
                p0, p1, rest = p0[x.of], p1[x.of], rest[x.of]
                p0 = p0 + rest * longer.stop * (longer.a + 0.5) / total
                p1 = p1 + rest * longer.stop * (longer.b + 0.5) / total
                rest = rest * longer.go
            of = levels[0].of
            p = np.where(decisions(runs)[1].ravel() == 1, p1[of], p0[of])
            yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(np.log10(p).reshape(-1, 8).sum(axis=1))], ["run", "lp"])
    return down


def run_scores(runs: DataFrame, depth: int, run: Run) -> DataFrame:
    """Distinct runs (run, n: training count, 0 if unseen) → (run, lp): log10
    of the probability of the run's last byte after the bytes before it.

    Upwards, each level adds counts and weighted probabilities of its longer
    contexts; downwards, a context adds its own estimate by the weight that
    the halves have given it after training and hands the rest on. The two
    deepest levels, which hold nearly all nodes, are worked out in arrays:
    a context two bytes shorter than the deepest has at most 2^24 runs, a
    bound that no input moves. The others are aggregations and joins, whose
    keys have at most 256 longer ones; none is hot. The joins merge: a
    level's files say little of its size in memory."""
    low = max(depth - 2, 0)
    key = F.shiftright("run", 8).bitwiseAND((1 << 8 * low) - 1)
    grouped = runs.select(key.alias("key"), "run", "n")
    a, b, own, longer = (F.col(c) for c in ("a", "b", "own", "longer"))
    levels = {low: run.stage(grouped.repartition("key").sortWithinPartitions("key")
                             .mapInArrow(_upwards(depth, low), "node long, a double, b double, lp double, stop double, go double"),
                             f"level-{low}")}
    for d in range(low - 1, -1, -1):
        t = (levels[d + 1].groupBy(F.col("node").bitwiseAND((1 << 8 * (d + 1)) - 1).alias("node"))
             .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("lp").alias("longer")))
        t = t.withColumn("own", _ln_estimate(a, b))
        both = F.greatest(own, longer) + F.log1p(F.exp(-F.abs(own - longer))) - F.lit(math.log(2))
        levels[d] = run.stage(t.select("node", "a", "b", both.alias("lp"), (1 / (1 + F.exp(longer - own))).alias("stop"),
                                       (1 / (1 + F.exp(own - longer))).alias("go")), f"level-{d}")
    mixed = None
    for d in range(low + 1):
        zero, one = [(c + 0.5) / (a + b + 1) * F.col("stop") for c in (a, b)]
        t = levels[d]
        if mixed is None:
            t = t.select("node", zero.alias("p0"), one.alias("p1"), F.col("go").alias("rest"))
        else:
            up = mixed.withColumnsRenamed({"node": "up", "p0": "u0", "p1": "u1"})
            left = F.col("left")
            t = (t.join(up.withColumnRenamed("rest", "left").hint("merge"),
                        F.col("node").bitwiseAND((1 << 8 * d) - 1) == F.col("up"))
                 .select("node", (F.col("u0") + left * zero).alias("p0"), (F.col("u1") + left * one).alias("p1"),
                         (left * F.col("go")).alias("rest")))
        mixed = run.stage(t, f"mixed-{d}")
        run.drop(*([f"mixed-{d - 1}", f"level-{d}"] if d else []))
    none = F.lit(0.0)
    both = (grouped.select("key", F.lit(1).alias("is_run"), F.col("run").alias("id"), "n", none.alias("p0"), none.alias("p1"),
                           none.alias("rest"))
            .unionByName(mixed.select(F.shiftright("node", 8).alias("key"), F.lit(0).alias("is_run"), F.col("node").alias("id"),
                                      F.lit(0).cast("long").alias("n"), "p0", "p1", "rest")))
    return run.stage(both.repartition("key").sortWithinPartitions("key")
                     .mapInArrow(_downwards(depth, low), "run long, lp double"), "run-scores")


def _scored(depth: int, tokens: int, distinct: int, ends: int):
    """Rows sorted by (block, is_text): each block's terms of the model, then
    its pieces → scores of the pieces. A task holds the terms of one block and
    a batch of its pieces."""
    floor = tokens + 0.5 * (distinct + 1)
    names = ["doc_id", "row", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score"]

    def scores(heads: list, bodies: list, last: list, runs: np.ndarray, lp: np.ndarray, known: WordCounts) -> list[np.ndarray]:
        end = np.array(last)
        # Every piece has a run or is a text's end; every text ends in a token.
        found, sizes = runs_of([h + t + (END if e else b"") for h, t, e in zip(heads, bodies, last)], depth)
        score = np.add.reduceat(looked_up(found, runs, lp, depth), np.cumsum(sizes) - sizes)
        words = [t.split() for t in bodies]
        size = np.array([len(ws) for ws in words])
        c = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.float64, int(size.sum()))
        sums = [np.concatenate(([0.0], np.cumsum(x))) for x in (np.log10((c + 0.5) / floor), c > 0)]
        stop = np.cumsum(size)
        base, seen = (x[stop] - x[stop - size] for x in sums)
        base += end * math.log10((ends + 0.5) / floor)
        return [sizes - end, size + end, seen.astype(np.int64) + end * (ends > 0), base, score]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, known, runs, lp = None, [], WordCounts(), None, None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for first, after in zip(cuts, cuts[1:]):
                some = batch.slice(first, after - first)
                if not len(some):
                    continue
                if blocks[first] != block:
                    block, parts, known, runs = blocks[first], [], WordCounts(), None
                    # What Arrow held for the block before goes.
                    pa.default_memory_pool().release_unused()
                texts = some.filter(pc.equal(some.column("is_text"), 1)).column("piece").flatten()
                terms = some.slice(0, len(some) - len(texts[0]))
                if len(terms):
                    run, value = terms.column("run"), terms.column("value").to_numpy(zero_copy_only=False)
                    is_run = run.is_valid().to_numpy(zero_copy_only=False)
                    parts.append((run.drop_null().to_numpy(), value[is_run]))
                    known.update(zip(terms.column("word").filter(pa.array(~is_run)).to_pylist(), value[~is_run].tolist()))
                if not len(texts[0]):
                    continue
                if runs is None:
                    runs, lp = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(runs, kind="stable")
                    runs, lp, parts = runs[order].view(np.uint64), lp[order], []
                ids, rows, held, heads, bodies, last = texts
                filled = np.cumsum(pc.binary_length(bodies).to_numpy(zero_copy_only=False)) // SCORED_BYTES
                at = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), len(filled)]
                out = [scores(*[x.slice(p, q - p).to_pylist() for x in (heads, bodies, last)], runs, lp, known)
                       for p, q in zip(at, at[1:])]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [ids, rows, held, *[pa.array(np.concatenate(c), t) for c, t in zip(zip(*out), kinds)]], names)
    return score


def score_texts(docs: DataFrame, held_out: Column, depth: int = DEPTH, block: int = BLOCK, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_bytes, n_tokens,
    n_known, train_tokens, base_score (unigram words), score (log10 of the
    text's probability, its end included) and bits_per_byte, its code length.

    The model learns from all rows for which ``held_out`` is not true, with
    A-Z lower-cased; a row is also scored by a model that has seen it.
    ``depth`` is 1 to 6 bytes. Null or empty text: its end alone. Rows
    repeat as they are; equal texts get equal scores. No training rows: every
    byte has 1/256 by the estimates without counts, every token 0.5 of 0.5.
    A text over 4 MB is read in pieces that end between words and know the
    bytes before them; one longer word is one piece. Empty table: no rows.
    Extra columns are ignored."""
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6 bytes")
    run = Run(docs.sparkSession, "ctw")
    source = docs.select(col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                         F.coalesce(held_out, F.lit(False)).alias("held_out"), col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    parts = run.stage(source.mapInArrow(_blocks(depth, block), f"doc_id {id_type}, row long, block long, held_out boolean, "
                                        "head binary, body binary, last boolean"), "pieces", codec="zstd")
    terms = run.stage(parts.select("block", "held_out", "head", "body", "last")
                      .mapInArrow(_terms(depth), "block long, run long, word binary, n long"), "terms", codec="zstd")
    runs = run.stage(terms.filter("run is not null").groupBy("run").agg(F.sum("n").alias("n")), "runs", codec="zstd")
    lp = run_scores(runs, depth, run)
    run.drop("runs")
    # A word has a row a block, so these windows hold no more rows than that.
    of_word = Window.partitionBy("word")
    words = run.stage(terms.filter("word is not null")
                      .select("block", "word", F.sum("n").over(of_word).cast("double").alias("value"),
                              F.row_number().over(of_word.orderBy("block")).alias("place")), "words", codec="zstd")
    ends = parts.filter("last and not held_out").count()
    once = F.when(F.col("place") == 1, F.col("value"))
    sums = words.agg(F.sum(once).cast("long").alias("n"), F.count_if(once > 0).alias("v")).first()
    tokens, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    run.release()
    model = (terms.filter("run is not null").select("block", "run").join(lp.hint("merge"), "run")
             .select("block", "run", F.lit(None).cast("binary").alias("word"), F.col("lp").alias("value"))
             .unionByName(words.select("block", F.lit(None).cast("long").alias("run"), "word", "value")))
    piece = F.struct("doc_id", "row", "held_out", "head", "body", "last")
    texts = parts.select("block", F.lit(1).alias("is_text"), F.lit(None).cast("long").alias("run"),
                         F.lit(None).cast("binary").alias("word"), F.lit(None).cast("double").alias("value"), piece.alias("piece"))
    no_piece = F.lit(None).cast(texts.schema["piece"].dataType)
    both = model.select("block", F.lit(0).alias("is_text"), "run", "word", "value", no_piece.alias("piece")).unionByName(texts)
    scored = (both.repartition("block").sortWithinPartitions("block", "is_text")
              .mapInArrow(_scored(depth, tokens, distinct, ends),
                          f"doc_id {id_type}, row long, held_out boolean, n_bytes long, n_tokens long, n_known long, "
                          "base_score double, score double"))
    sums = [F.sum(c).alias(c) for c in ("n_bytes", "n_tokens", "n_known", "base_score", "score")]
    out = (scored.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *sums)
           .withColumn("train_tokens", F.lit(tokens).cast("long"))
           .withColumn("bits_per_byte", -F.col("score") * F.lit(math.log2(10)) / (F.col("n_bytes") + 1)))
    return out.select("doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score",
                      "bits_per_byte")
