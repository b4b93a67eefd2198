"""RQ3 — weather vs. purchases: A11–A14, J2, M11, D3, D6.

Daily tables have one row per calendar day, so everything after the first
aggregation is bounded by the number of days, not by the event volume.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    as_double,
    distinct_count,
    exact_mean,
    money,
    pct_half_up,
    rain_flag,
    rain_label,
    temperature_bucket,
)
from ..settings import DEFAULT, WEATHER_PARAMETERS

MONEY = DEFAULT.money_type
MEASURES: tuple[str, ...] = tuple(name for _, name in WEATHER_PARAMETERS)
CORRELATION_COLUMNS: tuple[str, ...] = (
    "purchase_count", "daily_revenue",
    "avg_temperature", "avg_precipitation", "avg_wind_speed", "avg_humidity",
)


def daily_purchases(events: DataFrame, money_type: str = MONEY, approx_rsd: float | None = None,
                    exact: bool = False) -> DataFrame:
    """Purchases per day — count, revenue, distinct buyers, mean order
    value. No bot filter (published behaviour); null dates dropped. Revenue
    is a double, or the exact decimal sum with ``exact`` (what A13 and A14
    average without rounding in between)."""
    p = events.filter((F.col("event_type") == "purchase") & F.col("event_date").isNotNull())
    agg = p.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.sum(money("price", money_type)).alias("__rev"),
        distinct_count("user_id", approx_rsd).alias("active_buyers"),
        F.count(money("price", money_type)).alias("__n_priced"),
    )
    return agg.select(
        "event_date", "purchase_count",
        (F.col("__rev") if exact else as_double("__rev")).alias("daily_revenue"),
        "active_buyers",
        exact_mean("__rev", "__n_priced").alias("avg_order_value"),
    )


def daily_weather(weather: DataFrame, threshold: float = DEFAULT.rain_threshold) -> DataFrame:
    """Mean of each measure over all cities per day; a day is rainy if
    any city is strictly above the threshold (null reads dry)."""
    return (
        weather.withColumn("__rain", rain_flag("precipitation", threshold))
        .groupBy("date")
        .agg(
            *[F.avg(m).alias(f"avg_{m}") for m in MEASURES],
            F.max("__rain").alias("rain_day"),
        )
    )


def purchase_days(events: DataFrame) -> DataFrame:
    """The days that ``daily_purchases`` has a row for."""
    return events.filter((F.col("event_type") == "purchase") & F.col("event_date").isNotNull()).select("event_date").distinct()


def weather_days(weather: DataFrame) -> DataFrame:
    """The days that ``daily_weather`` has a row for."""
    return weather.select("date").distinct()


def join_daily(purchases_daily: DataFrame, weather_daily: DataFrame) -> DataFrame:
    """Inner join on the day; the weather key is dropped. Both sides are
    one row per day, so AQE turns this into a broadcast join at run time."""
    return purchases_daily.join(
        weather_daily, purchases_daily["event_date"] == weather_daily["date"], "inner"
    ).drop("date")


def exact_revenue(joined: DataFrame, money_type: str) -> Column:
    """Daily revenue to sum: the decimal as it is, a double as money."""
    exact = isinstance(joined.schema["daily_revenue"].dataType, T.DecimalType)
    return F.col("daily_revenue") if exact else money("daily_revenue", money_type)


def rain_analysis(joined: DataFrame, money_type: str = MONEY) -> DataFrame:
    """Mean purchases, revenue and buyers on dry vs. rainy days."""
    revenue = exact_revenue(joined, money_type)
    agg = joined.groupBy("rain_day").agg(
        F.avg("purchase_count").alias("avg_daily_purchases"),
        F.sum(revenue).alias("__rev"),
        F.count(revenue).alias("__n_rev"),
        F.avg("active_buyers").alias("avg_active_buyers"),
        F.count(F.lit(1)).alias("num_days"),
    )
    return agg.select(
        "rain_day", "avg_daily_purchases",
        exact_mean("__rev", "__n_rev").alias("avg_daily_revenue"),
        "avg_active_buyers", "num_days",
        rain_label("rain_day").alias("rain_label"),
    )


def temperature_buckets(joined: DataFrame, money_type: str = MONEY, null_bucket: str | None = None) -> DataFrame:
    """Mean purchases and revenue per temperature bucket. A day with
    no temperature counts as the last bucket unless ``null_bucket`` is set."""
    revenue = exact_revenue(joined, money_type)
    agg = (
        joined.withColumn("temp_bucket", temperature_bucket("avg_temperature", null_bucket=null_bucket))
        .groupBy("temp_bucket")
        .agg(
            F.avg("purchase_count").alias("avg_daily_purchases"),
            F.sum(revenue).alias("__rev"),
            F.count(revenue).alias("__n_rev"),
            F.count(F.lit(1)).alias("days_in_group"),
        )
    )
    return agg.select(
        "temp_bucket", "avg_daily_purchases",
        exact_mean("__rev", "__n_rev").alias("avg_daily_revenue"),
        "days_in_group",
    )


def correlation_matrix(joined: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS, digits: int = 4) -> DataFrame:
    """Pearson correlation of every pair, long form (n² rows).

    Rows with a null or NaN in any column are skipped first (listwise, as a
    vector assembler with ``skip`` does). One aggregate pass computes all
    pairwise population covariances and standard deviations; the one-row
    result is unfolded into cells by ``explode`` — nothing is collected. The diagonal is 1.0;
    pairs with a constant column are NaN."""
    cols = list(columns)
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    data = joined.filter(ok).select(*[F.col(c).cast("double").alias(c) for c in cols])

    def sd(c):
        return f"sd__{c}"

    def cv(a, b):
        return f"cv__{a}__{b}"

    aggs = [F.stddev_pop(c).alias(sd(c)) for c in cols]
    aggs += [F.covar_pop(a, b).alias(cv(a, b)) for a, b in combinations(cols, 2)]
    moments = data.agg(*aggs)

    def r(a, b):
        if a == b:
            return F.lit(1.0)
        x, y = (a, b) if cols.index(a) < cols.index(b) else (b, a)
        den = F.col(sd(x)) * F.col(sd(y))
        val = F.when(den == 0, F.lit(float("nan"))).otherwise(F.col(cv(x, y)) / den)
        return F.round(val, digits)

    cells = [F.struct(F.lit(a).alias("variable_1"), F.lit(b).alias("variable_2"), r(a, b).alias("pearson_corr"))
             for a in cols for b in cols]
    return (
        moments.filter(F.col(sd(cols[0])).isNotNull())
        .select(F.explode(F.array(*cells)).alias("c"))
        .select("c.*")
    )


def rain_gap(joined: DataFrame) -> DataFrame:
    """D3: dry vs. rainy mean daily purchases and both ratios, exactly:
    (dry − rainy) ÷ dry ("fewer") and dry ÷ rainy − 1 ("more"), %, 2 dp.
    Integer sums and day counts only, so no rounding before the end."""
    dry, wet = F.col("rain_day") == 0, F.col("rain_day") == 1
    s = joined.agg(
        F.sum(F.when(dry, F.col("purchase_count"))).alias("s_d"),
        F.count_if(dry).alias("n_d"),
        F.sum(F.when(wet, F.col("purchase_count"))).alias("s_r"),
        F.count_if(wet).alias("n_r"),
    )
    diff = F.col("s_d") * F.col("n_r") - F.col("s_r") * F.col("n_d")
    return s.select(
        exact_mean("s_d", "n_d").alias("dry_avg_daily_purchases"),
        exact_mean("s_r", "n_r").alias("rainy_avg_daily_purchases"),
        pct_half_up(diff, F.col("s_d") * F.col("n_r")).alias("rainy_fewer_pct"),
        pct_half_up(diff, F.col("s_r") * F.col("n_d")).alias("dry_more_pct"),
    )


def weather_coverage(weather: DataFrame) -> DataFrame:
    """Per city — days present, first and last day, missing values per
    measure (after the sentinel is nulled)."""
    return weather.groupBy("city").agg(
        F.countDistinct("date").alias("days_present"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count(F.lit(1)).alias("observations"),
        *[F.count_if(F.col(m).isNull()).alias(f"null_{m}") for m in MEASURES],
    )
