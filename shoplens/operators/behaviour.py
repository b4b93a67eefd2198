"""RQ1 — shopping behaviour: A1–A6, W1–W2, L4, D1, D2, D4.

Inputs are prepared events (``prep.clean_events``). Money is summed in an
exact decimal and reported as double, so results do not depend on row order
or partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    as_double,
    distinct_count,
    exact_mean,
    money,
    pct_half_up,
    weekday_name,
)
from ..settings import DEFAULT, WEEKEND_DAYS
from .common import with_grand_total
from .prep import session_sizes

MONEY = DEFAULT.money_type


def purchases(df: DataFrame, event_col: str = "event_type", purchase: str = "purchase") -> DataFrame:
    """purchase events only (pushed to the scan as a parquet filter)."""
    return df.filter(F.col(event_col) == purchase)


def _revenue_aggs(price: str, money_type: str) -> list:
    """Exact revenue and the number of priced rows (for the mean)."""
    return [F.sum(money(price, money_type)).alias("__rev"), F.count(money(price, money_type)).alias("__n_priced")]


def _finish_revenue(df: DataFrame, revenue: str, mean: str | None) -> DataFrame:
    cols = {revenue: as_double("__rev")}
    if mean:
        cols[mean] = exact_mean("__rev", "__n_priced")
    return df.withColumns(cols).drop("__rev", "__n_priced")


def bot_filtered_sessions(df: DataFrame, key: str = "user_session", max_events: int = 500) -> DataFrame:
    """P6 report: every non-null session, its size and whether the bot
    filter removes it."""
    return session_sizes(df, key).withColumn("is_bot", F.col("event_count") > max_events)


def event_distribution(df: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """A1: events and distinct users per event type (exact unless
    ``approx_rsd`` is given)."""
    return (
        df.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("event_count"), distinct_count("user_id", approx_rsd).alias("unique_users"))
    )


def conversion_funnel(df: DataFrame) -> DataFrame:
    """A2: one row in a single conditional-aggregate pass. ``total_events``
    counts views, carts and purchases only; rates are % of views, 2 dp,
    0.0 when there are no views."""
    et = F.col("event_type")
    agg = df.agg(
        F.count_if(et == "view").alias("views"),
        F.count_if(et == "cart").alias("carts"),
        F.count_if(et == "purchase").alias("purchases"),
    )

    def rate(c: str):
        return F.coalesce(pct_half_up(c, "views"), F.lit(0.0))

    return agg.select(
        (F.col("views") + F.col("carts") + F.col("purchases")).alias("total_events"),
        "views", "carts", "purchases",
        rate("carts").alias("cart_conversion_rate"),
        rate("purchases").alias("purchase_conversion_rate"),
    )


def category_behaviour(df: DataFrame, money_type: str = MONEY, approx_rsd: float | None = None) -> DataFrame:
    """A3 + W1 + W2: purchases per top-level category (null category removed
    before rank and total), revenue rank (ties share a rank) and share of
    all revenue in %, 2 dp.

    The rank window runs after the aggregate, over one row per top-level
    category, so its single partition holds only the category list (bounded
    by the catalogue, not by the events). With a negative total, shares are
    negative for categories that earn."""
    stats = (
        purchases(df)
        .filter(F.col("category_top").isNotNull())
        .groupBy("category_top")
        .agg(
            F.count(F.lit(1)).alias("total_purchases"),
            F.sum(money("price", money_type)).alias("__rev"),
            F.count(money("price", money_type)).alias("__n_priced"),
            distinct_count("user_id", approx_rsd).alias("unique_buyers"),
        )
    )
    stats = with_grand_total(stats, "__rev", "__total")
    w = Window.orderBy(F.col("__rev").desc())
    return stats.select(
        "category_top",
        "total_purchases",
        as_double("__rev").alias("total_revenue"),
        exact_mean("__rev", "__n_priced").alias("avg_price"),
        "unique_buyers",
        F.rank().over(w).alias("revenue_rank"),
        pct_half_up("__rev", "__total").alias("revenue_share_pct"),
    )


def top_ranked(category_stats: DataFrame, n: int = 10) -> DataFrame:
    """Categories ranked within the top ``n`` (ties included)."""
    return category_stats.filter(F.col("revenue_rank") <= n)


def top_categories(category_stats: DataFrame, n: int = 10) -> DataFrame:
    """L4 / V1: the n categories with most revenue (ties by name)."""
    return (
        category_stats.filter(F.col("category_top").isNotNull())
        .groupBy("category_top")
        .agg(F.sum("total_revenue").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), F.col("category_top"))
        .limit(n)
    )


def hourly_patterns(df: DataFrame, money_type: str = MONEY) -> DataFrame:
    """A4: purchases, revenue and mean order value per hour of day."""
    agg = purchases(df).groupBy("event_hour").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        *_revenue_aggs("price", money_type),
    )
    return _finish_revenue(agg, "total_revenue", "avg_order_value")


def daily_patterns(df: DataFrame, money_type: str = MONEY) -> DataFrame:
    """A5: purchases and revenue per weekday (1 = Sunday) with its name."""
    agg = purchases(df).groupBy("event_weekday").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        *_revenue_aggs("price", money_type),
    )
    return _finish_revenue(agg, "total_revenue", None).withColumn("weekday_name", weekday_name("event_weekday"))


def daily_trend(df: DataFrame, money_type: str = MONEY, approx_rsd: float | None = None) -> DataFrame:
    """Purchases, revenue and distinct buyers per calendar day."""
    agg = purchases(df).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("daily_purchases"),
        *_revenue_aggs("price", money_type),
        distinct_count("user_id", approx_rsd).alias("active_buyers"),
    )
    return _finish_revenue(agg, "daily_revenue", None)


def weekend_uplift(df: DataFrame) -> DataFrame:
    """Mean daily purchases on Saturday/Sunday vs Monday–Friday, and the
    uplift (weekend ÷ weekday − 1) in %, 2 dp, computed exactly."""
    daily = (
        purchases(df)
        .filter(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("is_weekend", weekday_name(F.dayofweek("event_date")).isin(list(WEEKEND_DAYS)))
    )
    we, wd = F.col("is_weekend"), ~F.col("is_weekend")
    sums = daily.agg(
        F.sum(F.when(we, F.col("n"))).alias("s_we"),
        F.count_if(we).alias("d_we"),
        F.sum(F.when(wd, F.col("n"))).alias("s_wd"),
        F.count_if(wd).alias("d_wd"),
    )
    num = F.col("s_we") * F.col("d_wd") - F.col("s_wd") * F.col("d_we")
    den = F.col("s_wd") * F.col("d_we")
    return sums.select(
        exact_mean("s_we", "d_we").alias("weekend_avg_daily_purchases"),
        exact_mean("s_wd", "d_wd").alias("weekday_avg_daily_purchases"),
        "d_we", "d_wd",
        pct_half_up(num, den).alias("weekend_uplift_pct"),
    ).withColumnsRenamed({"d_we": "weekend_days", "d_wd": "weekday_days"})


def peak_hours(df: DataFrame, width: int = 2) -> DataFrame:
    """The ``width``-hour window (no wrap past midnight) with the most
    purchases; ties go to the earliest start.

    Each of the ≤ 24 hourly counts is added to every window start that
    covers it, so windows with no purchases never need a spine of hours.
    After the hourly aggregate everything runs on at most 24 rows."""
    hourly = purchases(df).filter(F.col("event_hour").isNotNull()).groupBy("event_hour").agg(
        F.count(F.lit(1)).alias("n")
    )
    hourly = with_grand_total(hourly, "n", "__all")
    h = F.col("event_hour")
    starts = F.sequence(F.greatest(h - (width - 1), F.lit(0)), F.least(h, F.lit(24 - width)))
    windows = (
        hourly.select(F.explode(starts).alias("peak_start_hour"), "n", "__all")
        .groupBy("peak_start_hour")
        .agg(F.sum("n").alias("window_purchases"), F.max("__all").alias("__all"))
    )
    best = Window.orderBy(F.col("window_purchases").desc(), F.col("peak_start_hour"))
    return (
        windows.withColumn("__rn", F.row_number().over(best))
        .filter(F.col("__rn") == 1)
        .select(
            "peak_start_hour",
            (F.col("peak_start_hour") + width).alias("peak_end_hour"),
            "window_purchases",
            pct_half_up("window_purchases", "__all").alias("window_share_pct"),
        )
    )


def category_profile(df: DataFrame) -> DataFrame:
    """Events per top-level category (null is its own group) with its
    share of all events in %, 2 dp."""
    counts = df.groupBy("category_top").agg(F.count(F.lit(1)).alias("event_count"))
    counts = with_grand_total(counts, "event_count", "__total")
    return counts.select(
        "category_top", "event_count", pct_half_up("event_count", "__total").alias("share_pct")
    )
