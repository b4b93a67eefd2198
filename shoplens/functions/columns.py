"""Column expressions shared by the operators (all Spark built-ins, so they
stay inside whole-stage codegen)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import (
    RAIN_LABELS,
    TEMPERATURE_EDGES,
    TEMPERATURE_LABELS,
    WEEKDAY_NAMES,
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P2 -------------------------------------------------------------------------
def parse_event_time(c: str | Column, fmt: str, is_string: bool) -> Column:
    """String with a zone → its UTC wall clock as ``timestamp_ntz`` (null
    when unparsable), so hours and days do not depend on the session time
    zone; a column that already holds timestamps passes through."""
    c = col(c)
    return utc_wall_clock(F.try_to_timestamp(c, F.lit(fmt))) if is_string else c


def utc_wall_clock(ts: Column) -> Column:
    """Instant → ``timestamp_ntz`` of its UTC date and time."""
    seconds = (F.unix_micros(ts) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


# S5 -------------------------------------------------------------------------
def parse_compact_date(c: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """``yyyyMMdd`` text → date; null when unparsable (``to_date`` would
    fail the job under ANSI mode). Parse and cast use the same session
    time zone, so the calendar day is kept."""
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("date")


# P3 -------------------------------------------------------------------------
def calendar_fields(ts: str | Column) -> dict[str, Column]:
    ts = col(ts)
    return {
        "event_hour": F.hour(ts),
        "event_weekday": F.dayofweek(ts),
        "event_date": F.to_date(ts),
        "event_month": F.month(ts),
    }


# P4 -------------------------------------------------------------------------
def top_level(c: str | Column, sep: str = ".") -> Column:
    """Text before the first separator (the whole text if there is none);
    null stays null. Same as ``split(c, sep)[0]`` without the array."""
    return F.substring_index(col(c), sep, 1)


# P11 ------------------------------------------------------------------------
def sentiment_label(rating: str | Column) -> Column:
    r = col(rating)
    return F.when(r <= 2, 0).when(r == 3, 1).otherwise(2)


# P15 ------------------------------------------------------------------------
def weekday_name(dow: str | Column) -> Column:
    d = col(dow)
    expr = F.when(d == 1, WEEKDAY_NAMES[0])
    for i, name in enumerate(WEEKDAY_NAMES[1:-1], start=2):
        expr = expr.when(d == i, name)
    return expr.otherwise(WEEKDAY_NAMES[-1])


# P14 ------------------------------------------------------------------------
def rain_flag(precipitation: str | Column, threshold: float = 1.0) -> Column:
    """1 when strictly above the threshold; null precipitation reads dry."""
    return F.when(col(precipitation) > F.lit(threshold), 1).otherwise(0)


# P16 ------------------------------------------------------------------------
def rain_label(rain_day: str | Column) -> Column:
    return F.when(col(rain_day) == 1, RAIN_LABELS[1]).otherwise(RAIN_LABELS[0])


# P17 ------------------------------------------------------------------------
def temperature_bucket(
    t: str | Column,
    edges: Sequence[float] = TEMPERATURE_EDGES,
    labels: Sequence[str] = TEMPERATURE_LABELS,
    null_bucket: str | None = None,
) -> Column:
    """``edges`` are exclusive upper bounds. Nulls land in the last bucket
    (published behaviour) unless ``null_bucket`` names another label."""
    if not edges or len(labels) != len(edges) + 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) + 1} labels, not {len(labels)}")
    t = col(t)
    expr = F.when(t < F.lit(edges[0]), labels[0])
    for edge, label in zip(edges[1:], labels[1:-1], strict=True):
        expr = expr.when(t < F.lit(edge), label)
    if null_bucket is not None:
        expr = expr.when(t.isNull(), null_bucket)
    return expr.otherwise(labels[-1])


# money ----------------------------------------------------------------------
def money(c: str | Column, money_type: str) -> Column:
    """Exact money value; sums of it do not depend on row order. Null stays
    null; a value that the type cannot hold (out of range, NaN) fails the
    job instead of vanishing from a sum."""
    c = col(c)
    unfit = F.raise_error(F.concat(F.lit(f"not a {money_type}: "), c.cast("string"))).cast(money_type)
    return F.coalesce(c.try_cast(money_type), F.when(c.isNotNull(), unfit))


def distinct_count(c: str | Column, approx_rsd: float | None = None) -> Column:
    """Exact ``count(DISTINCT c)`` by default; with ``approx_rsd`` a
    HyperLogLog++ estimate with that relative standard deviation (fixed
    memory per group, no second aggregation level)."""
    if approx_rsd is None:
        return F.countDistinct(col(c))
    return F.approx_count_distinct(col(c), approx_rsd)


def as_double(c: str | Column) -> Column:
    return col(c).cast("double")


def exact_mean(total: str | Column, n: str | Column) -> Column:
    """Exact sum ÷ count as one IEEE division (null when n = 0)."""
    return F.try_divide(as_double(total), col(n).cast("double"))


# percentages ----------------------------------------------------------------
# 22 digits before the point and the 8 after it that money has: times 20000
# is 36 digits, and no step below loses one.
_EXACT, _WIDE = "decimal(30,8)", "decimal(36,8)"


def int_div(a: str | Column, b: str | Column) -> Column:
    """Truncating division of non-negative numbers, exact for counts and
    money: ``(a - pmod(a, b)) / b`` is an exact integer in decimal
    arithmetic, so no rounding of the quotient can cross an integer."""
    a, b = col(a).cast(_WIDE), col(b).cast(_WIDE)
    return ((a - F.pmod(a, b)) / b).cast("long")


def pct_half_up(part: str | Column, whole: str | Column) -> Column:
    """round(part / whole * 100, 2), HALF_UP away from zero, computed in
    integers so it is exact, for either sign of both. Null when whole is 0
    or null."""
    p = col(part).cast(_EXACT)
    w = F.nullif(col(whole).cast(_EXACT), F.lit(0).cast(_EXACT))
    size = int_div(F.abs(p) * 20000 + F.abs(w), F.abs(w) * 2) / F.lit(100.0)
    return F.when((p < 0) != (w < 0), -size).otherwise(size) + F.lit(0.0)  # no negative zero


# sampling -------------------------------------------------------------------
HASH_SPACE = 1 << 32


def key_hash(key: str | Column, salt: str) -> Column:
    """Uniform value in [0, 2^32) from the md5 of ``key:salt``. Depends only
    on the key, never on partitioning or row order."""
    text = F.concat(col(key).cast("string"), F.lit(":" + salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_threshold(fraction: float) -> int:
    """Keys with ``key_hash < hash_threshold(f)`` form a fraction f."""
    return int(round(min(max(fraction, 0.0), 1.0) * HASH_SPACE))
