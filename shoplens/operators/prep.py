"""Preparation operators P1–P13 (narrow projections plus the bot filter).

All lazy: no action and no cached state; the caller owns staging and sinks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import calendar_fields, parse_event_time, sentiment_label, top_level
from ..functions.text import clean_text, review_text
from ..settings import DEFAULT, EVENT_TIME_FORMAT, REVIEW_CATEGORY
from .bloom import Bloom, bloom, n_words


def event_time(df: DataFrame, time_col: str = "event_time", time_format: str = EVENT_TIME_FORMAT) -> Column:
    """P2 for this frame: parsed if the column is text, else as it is."""
    is_string = isinstance(df.schema[time_col].dataType, T.StringType)
    return parse_event_time(time_col, time_format, is_string)


def prepare_events(
    df: DataFrame,
    *,
    time_col: str = "event_time",
    time_format: str = EVENT_TIME_FORMAT,
    category_col: str = "category_code",
    category_separator: str = ".",
    required: Sequence[str] = ("event_type", "product_id", "event_time"),
) -> DataFrame:
    """Price as double, event time parsed, calendar fields, top-level
    category, rows missing a required field dropped."""
    out = df.withColumns({
        "price": F.col("price").try_cast("double"),
        time_col: event_time(df, time_col, time_format),
    })
    out = out.withColumns(calendar_fields(time_col))
    if category_col in df.columns:
        out = out.withColumn("category_top", top_level(category_col, category_separator))
    return out.dropna(subset=list(required))


def session_sizes(df: DataFrame, key: str = "user_session") -> DataFrame:
    """Events per non-null session. Partial aggregation runs map-side, so a
    single giant (bot) session costs one row per map task in the shuffle."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))


def bot_sessions(df: DataFrame, key: str = "user_session", max_events: int = 500) -> DataFrame:
    """Keys of the sessions with more than ``max_events`` events (few)."""
    return session_sizes(df, key).filter(F.col("event_count") > max_events).select(key)


def drop_bot_sessions(df: DataFrame, key: str = "user_session", max_events: int = 500,
                      bots: DataFrame | None = None, prefilter: Bloom | None = None) -> DataFrame:
    """Keep events whose session has at most ``max_events`` events.

    Rows with a null session vanish, as in an inner join on the key.
    Written as a lazy anti join against the *bot* sessions, which are few:
    sessions are counted with map-side partial aggregation, and where the
    size of the key table is known to be small — AQE sees it at run time, or
    the caller passes ``bots`` that it has staged — Spark broadcasts it and
    the events are filtered where they lie. Else it is a sort-merge join
    whose skewed session partitions AQE splits.

    ``prefilter`` (``bot_prefilter``) is for key tables too large to
    broadcast: events that it clears stay where they are, and only those of
    sessions that may be bots are shuffled to the exact join. The events are
    read twice, so they should be staged."""
    if bots is None:
        bots = bot_sessions(df, key, max_events)
    df = df.filter(F.col(key).isNotNull())
    if prefilter is None:
        return df.join(bots, key, "left_anti")
    suspect = prefilter.may_hold(F.col(key))
    return df.filter(~suspect).unionByName(df.filter(suspect).join(bots, key, "left_anti"))


def bot_prefilter(bots: DataFrame, count: int, key: str = "user_session", rate: float = DEFAULT.bot_prefilter_rate,
                  max_bytes: int = DEFAULT.bot_prefilter_bytes) -> Bloom:
    """Bloom filter of the ``count`` bot sessions (staged): at most
    ``max_bytes``, and about ``rate`` of other sessions not cleared."""
    return bloom(bots, key, n_words(count, rate, max_bytes))


def clean_events(
    df: DataFrame,
    *,
    max_events: int = DEFAULT.max_session_events,
    session_col: str = "user_session",
    drop_bots: bool = True,
    bots: DataFrame | None = None,
    prefilter: Bloom | None = None,
    **prepare_kw,
) -> DataFrame:
    """``prepare_events`` then the bot-session filter."""
    out = prepare_events(df, **prepare_kw)
    return drop_bot_sessions(out, session_col, max_events, bots, prefilter) if drop_bots else out


def clean_reviews(
    df: DataFrame,
    *,
    min_length: int = DEFAULT.min_review_length,
    min_rating: float = DEFAULT.min_rating,
    max_rating: float = DEFAULT.max_rating,
    category: str = REVIEW_CATEGORY,
    timestamp_col: str = "timestamp",
    drop: bool = True,
) -> DataFrame:
    """Rating as double, title + text cleaned, short or unrated or
    out-of-range reviews dropped, sentiment label, review date, category.
    With ``drop=False`` all rows stay and ``kept`` says which would.

    ``review_date`` is the UTC calendar day of the epoch-millisecond stamp,
    independent of the session time zone."""
    out = df.withColumns({
        "rating": F.col("rating").try_cast("double"),
        "review_text": review_text("title", "text"),
    })
    # Cheap conditions first; they reach the scan (and the join, if any).
    rated = F.coalesce(F.col("rating").between(min_rating, max_rating), F.lit(False))
    out = out.filter(rated) if drop else out
    # The cleaned text is produced by a one-element generator: Catalyst does
    # not push a filter on a generator's output below it, so the length
    # check cannot copy the regex into a pushed-down filter, and the regex
    # runs once per surviving review. (review_clean is never null: the
    # concatenation of two coalesced strings is never null.)
    out = out.withColumn("review_clean", F.explode(F.array(clean_text("review_text"))))
    long_enough = F.length("review_clean") >= min_length
    out = out.filter(long_enough) if drop else out.withColumn("kept", rated & long_enough)
    day = F.floor(F.col(timestamp_col) / F.lit(86_400_000.0)).try_cast("int")  # absurd stamps → null
    return out.withColumns({
        "sentiment_label": sentiment_label("rating"),
        "review_date": F.date_from_unix_date(day),
        "category": F.lit(category),
    })


def null_sentinel(df: DataFrame, cols: Sequence[str], sentinel: float = DEFAULT.weather_sentinel) -> DataFrame:
    """Replace the missing-value sentinel by null."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in cols})
