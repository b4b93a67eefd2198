"""Mergeable exact distinct counts for A1, A3, A6 and A11.

The users of a day are kept as bitmaps: one 4 KB chunk for every 32,768
consecutive ids that occur. Chunks of the same ids are joined by ``or``, so
stored days give the exact number of distinct users of any span, of any
subset of the other keys and after any late part of a day, without the
events. Ids should be dense numbers: a chunk costs its 4 KB (before
compression) even for one user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = "user_chunk"
BITS = "users"


def user_bitmaps(events: DataFrame, by: Sequence[str], user: str = "user_id") -> DataFrame:
    """Users per key: (``by``, user_chunk, users). Null users are not counted;
    null keys are keys. Users repeat within a key far more than they differ,
    so the pairs are made distinct (partially, before their shuffle) and the
    bitmaps are built from what is left."""
    pairs = events.filter(F.col(user).isNotNull()).select(*by, F.col(user).cast("long").alias("_user")).distinct()
    return (pairs.groupBy(*by, F.bitmap_bucket_number("_user").alias(CHUNK))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_user")).alias(BITS)))


def merge_bitmaps(state: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """State under fewer or coarser keys, or of several parts: one chunk per
    key and ids. Partial merges run before the shuffle."""
    return state.groupBy(*by, CHUNK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_users(state: DataFrame, by: Sequence[str | Column] = (), name: str = "unique_users") -> DataFrame:
    """Exact number of distinct users per key (in all, without keys)."""
    merged = merge_bitmaps(state, by).withColumn(name, F.bitmap_count(BITS)).drop(BITS, CHUNK)
    keys = [c for c in merged.columns if c != name]
    if keys:
        return merged.groupBy(*keys).agg(F.sum(name).alias(name))
    return merged.agg(F.coalesce(F.sum(name), F.lit(0)).alias(name))


def distinct_between(state: DataFrame, first: str, last: str, by: Sequence[str] = (), day: str = "event_date",
                     name: str = "unique_users") -> DataFrame:
    """Distinct users of the days ``first`` to ``last`` (both included); only
    those days' chunks are read."""
    return distinct_users(state.filter(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))), by, name)


def calendar_spans(state: DataFrame, by: Sequence[str] = (), day: str = "event_date",
                   name: str = "unique_users") -> DataFrame:
    """Distinct users of every month, year and of all days (``span``). Days
    merge into months first, and months into the spans they lie in."""
    days = merge_bitmaps(state.filter(F.col(day).isNotNull()), [*by, F.trunc(day, "month").alias("_month")])
    spans = F.array(F.date_format("_month", "yyyy-MM"), F.date_format("_month", "yyyy"), F.lit("all"))
    return distinct_users(days.withColumn("span", F.explode(spans)), [*by, "span"], name)
