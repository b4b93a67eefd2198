"""A Bloom filter of keys as a Spark expression.

The filter is an array of 64-bit words. A key's hash names one word and a few
bits of it, so building is one ``bit_or`` per word and a test is one array
access: both stay in generated code. Its size is fixed before it is built
and bounded in bytes, whatever the number of keys; too many keys make it
clear less, never wrong.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that a key sets in its word; each takes six bits of the hash.
BITS = 4
MAX_BYTES = 1 << 20


def false_positives(keys_per_word: float) -> float:
    """Share of other keys that a filter of that load does not clear: words
    hold a Poisson number of keys, each of which sets ``BITS`` of 64 bits."""
    if keys_per_word > 64:  # nearly every bit is set
        return 1.0
    total, p = 0.0, math.exp(-keys_per_word)
    for j in range(int(keys_per_word * 4) + 60):
        total += p * (1 - (1 - 1 / 64) ** (BITS * j)) ** BITS
        p *= keys_per_word / (j + 1)
    return total


def n_words(keys: int, rate: float, max_bytes: int = MAX_BYTES) -> int:
    """Words (a power of two) for that many keys and that share of other
    keys not cleared, or as many as ``max_bytes`` hold."""
    if not 0 < rate < 1:
        raise ValueError(f"the rate must lie between 0 and 1, not {rate}")
    words = 1
    while 16 * words <= max_bytes and false_positives(keys / words) > rate:
        words *= 2
    return words


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """The key's word, by the leading bits of its hash, and its bits there."""
    h = F.xxhash64(key)
    bits = words.bit_length() - 1
    word = F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)
    mask = F.lit(0).cast("long")
    for k in range(BITS):
        six = F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), six))
    return word, mask


class Bloom(NamedTuple):
    words: int
    array: Column

    def may_hold(self, key: Column) -> Column:
        """False only for keys that were not put in (null for a null key)."""
        word, mask = _place(key, self.words)
        return F.when(key.isNotNull(), F.get(self.array, word).bitwiseAND(mask) == mask)


def bloom(keys: DataFrame, column: str, words: int) -> Bloom:
    """Filter of a column's values, as a scalar subquery: one row of
    ``words`` longs that Spark computes once and sends with the plan."""
    word, mask = _place(F.col(column), words)
    held = (keys.filter(F.col(column).isNotNull()).select(word.alias("word"), mask.alias("mask"))
            .groupBy("word").agg(F.bit_or("mask").alias("mask")))
    dense = keys.sparkSession.range(words).join(held, F.col("id") == F.col("word"), "left")
    in_order = F.array_sort(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0)).alias("mask"))))
    return Bloom(words, dense.agg(F.transform(in_order, lambda w: w["mask"]).alias("words")).scalar())
