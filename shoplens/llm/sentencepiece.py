"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding runs the merge rule itself: an agenda of adjacent symbol pairs
ordered by the score of the piece they form (ties: leftmost first). Pieces of
such a vocabulary hold the space mark only at their start, so no merge
crosses from a word into the next space mark, and each chunk "space marks,
then a word" is merged alone; equal chunks are merged once per task. Every
chunk that is merged anew is compared with the sentencepiece library, one
call per Arrow batch. Decoding is the library's decode(ids).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from math import inf
from operator import add
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, col

SPACE_MARK = "▁"
#: Chunks that a task remembers before it begins anew; those of the time
#: before stay until then, and what is met again is kept.
MEMORY = 300_000
#: Characters of a text, or of texts together, whose chunks are held at once.
PORTION = 500_000

#: Symbols of a chunk up to which the agenda is a plain list.
SHORT = 24

_CHUNKS = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*")
_CUT = re.compile(f"(?<=[^ {SPACE_MARK}]) ")


class Vocabulary:
    """Pieces and scores of a model file, read by the library."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        kinds = (sp.is_control, sp.is_unknown, sp.is_unused, sp.is_byte)
        pieces = {i: sp.id_to_piece(i) for i in range(sp.get_piece_size())}
        self.ids = {p: i for i, p in pieces.items() if not any(kind(i) for kind in kinds)}
        self.cost = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[1:-1], 16): i for i, p in pieces.items() if sp.is_byte(i)}
        self.unk, self.bos, self.eos = sp.unk_id(), sp.bos_id(), sp.eos_id()
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids):
            raise ValueError("a piece holds a space mark after other symbols: chunks are not independent")
        if sp.normalize("  A\té ﬁ\n ") != SPACE_MARK * 3 + "A\té" + SPACE_MARK + "ﬁ\n" + SPACE_MARK:
            raise ValueError("the model rewrites its input beyond marking spaces")
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk: the best-scored adjacent pair is merged until no
        pair forms a piece; symbols outside the vocabulary become bytes."""
        cost, n = self.cost.get, len(chunk)
        parts: list[str] = list(chunk)
        if n <= SHORT:
            # The agenda in text order, the best found by a scan: a heap costs more here.
            agenda = [cost(pair, inf) for pair in map(add, chunk, chunk[1:])]
            while agenda and (best := min(agenda)) != inf:
                i = agenda.index(best)
                parts[i] = pair = parts[i] + parts.pop(i + 1)
                del agenda[i]
                if i < len(agenda):
                    agenda[i] = cost(pair + parts[i + 1], inf)
                if i:
                    agenda[i - 1] = cost(parts[i - 1] + pair, inf)
        else:
            parts = self._merge_long(parts, cost)
        try:
            return [self.ids[p] for p in parts]
        except KeyError:
            return self._with_unknown(parts)

    @staticmethod
    def _merge_long(parts: list[str], cost: Callable) -> list[str]:
        """The same with the agenda in a heap; of a merged pair, the right
        symbol becomes empty."""
        n = len(parts)
        agenda = [(c, i, pair) for i, pair in enumerate(map(add, parts, parts[1:])) if (c := cost(pair)) is not None]
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            _, i, pair = heappop(agenda)
            left, j = parts[i], after[i]
            if not left or j >= n or left + parts[j] != pair:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (c := cost(new := pair + parts[k])) is not None:
                    heappush(agenda, (c, i, new))
            if (h := before[i]) >= 0 and (c := cost(new := parts[h] + pair)) is not None:
                heappush(agenda, (c, h, new))
        return [p for p in parts if p]

    def _with_unknown(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for p in parts:
            if p in self.ids:
                out.append(self.ids[p])
            elif self.bytes:
                out.extend(self.bytes[b] for b in p.encode())
            elif out[-1:] != [self.unk]:
                out.append(self.unk)
        return out

    def learn(self, keys: set[str]) -> None:
        """Merge chunks (named without their first space mark) that are not
        known yet, and compare each with the library, in one call."""
        if len(self.known) > MEMORY:
            self.before, self.known = self.known, {}
        new = []
        for k in keys:
            if k not in self.known:
                if k in self.before:
                    self.known[k] = self.before[k]
                else:
                    new.append(k)
        # The library itself puts a space mark before a text, unless it is empty.
        theirs = self.library.encode([k.replace(SPACE_MARK, " ") for k in new], num_threads=1)
        for key, ids in zip(new, theirs):
            mine = self.merge(SPACE_MARK + key)
            if mine != ids and key:
                raise ValueError(f"merge of {key!r}: {mine}; the library has {ids}")
            self.known[key] = pack(f"<{len(mine)}I", *mine)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text with begin and end, as little-endian unsigned
        32-bit integers; null is the empty text. Texts are looked up some
        together, and a long one in portions, so that it needs little more
        than its ids."""
        first, last = (np.array([i], "<u4").tobytes() for i in (self.bos, self.eos))
        held: list[list[str]] = []
        size = 0

        def found() -> list[bytes]:
            out = []
            for part in held:
                try:
                    out.append(b"".join(map(self.known.__getitem__, part)))
                except KeyError:
                    self.learn(set().union(*held))
                    out.append(b"".join(map(self.known.__getitem__, part)))
            held.clear()
            return out

        for text in texts:
            text = text or ""
            if len(text) > PORTION:
                yield from (first + x + last for x in found())
                ids, size = [], 0
                for part in _portions(text):
                    held.append(_keys(part))
                    ids += found()
                yield b"".join([first, *ids, last])
                continue
            held.append(_keys(text) if text else [])
            size += len(text)
            if size > PORTION:
                yield from (first + x + last for x in found())
                size = 0
        yield from (first + x + last for x in found())


def _portions(text: str) -> Iterator[str]:
    """A text cut at single spaces; the mark that begins each portion stands
    for the space before it."""
    at = 0
    while len(text) - at > PORTION and (m := _CUT.search(text, at + PORTION)):
        yield text[at:m.start()]
        at = m.end()
    yield text[at:]


def _keys(text: str) -> list[str]:
    """Chunks of a text that a space mark precedes, without their first mark."""
    if "  " in text or text[:1] == " " or SPACE_MARK in text:
        return [c[1:] for c in _CHUNKS.findall(SPACE_MARK + text.replace(" ", SPACE_MARK))]
    return text.split(" ")


def encode(docs: DataFrame, model: str, out: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with the array<int> column ``out``: the ids of the whole text
    with begin and end (null or empty text: only these two). ``model`` names
    a file that every executor can read. A column named ``out`` is replaced;
    all others stay. Empty table: no rows."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = Vocabulary(model)
        for texts in batches:
            packed = list(v.encode(t.as_py() for t in texts))
            ends = np.cumsum([0, *map(len, packed)]) // 4
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))

    return docs.withColumn(out, ids(col(text_col)))


def decode(docs: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the string column ``out``: the library's decode(ids) of
    an array<int> column (null: null)."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = Vocabulary(model)
        for ids in batches:
            yield pa.array([None if x.as_py() is None else v.library.decode(x.as_py()) for x in ids], pa.string())

    return docs.withColumn(out, text(col(ids_col)))


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (binary: the ids as
    little-endian unsigned 32-bit integers, with begin and end) and decoded
    (the library's decode of them), in one pass over the texts.

    Null and empty texts have the two ids begin and end and decode to the
    empty string. Repeated rows get equal rows; extra columns are ignored."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("ids binary, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = Vocabulary(model)
        for texts in batches:
            ids = list(v.encode(t.as_py() for t in texts))
            decoded = [v.library.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                                             ["ids", "decoded"])

    return docs.select(col(id_col).alias("doc_id"), both(col(text_col)).alias("x")).select("doc_id", "x.*")
