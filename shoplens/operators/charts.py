"""V2–V7: chart-ready tables (the data half of the chart script)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import CHART_WEEKDAY_ORDER, WEEKEND_DAYS


def chart_hourly(hourly: DataFrame) -> DataFrame:
    """V2: hour and purchase count, by hour."""
    return hourly.select("event_hour", "purchase_count").orderBy("event_hour")


def chart_weekday(daily_patterns: DataFrame) -> DataFrame:
    """V3: weekdays present, Monday first, with a weekend flag."""
    order = F.array_position(F.array(*[F.lit(d) for d in CHART_WEEKDAY_ORDER]), F.col("weekday_name"))
    return (
        daily_patterns.filter(F.col("weekday_name").isin(list(CHART_WEEKDAY_ORDER)))
        .select(
            "weekday_name",
            "purchase_count",
            order.cast("int").alias("day_order"),
            F.col("weekday_name").isin(list(WEEKEND_DAYS)).alias("is_weekend"),
        )
        .orderBy("day_order")
    )


def chart_ratings(rating_dist: DataFrame) -> DataFrame:
    """V4: rating as text with its review count, by rating."""
    return rating_dist.select(
        F.col("rating").cast("string").alias("rating_label"), "rating", "review_count"
    ).orderBy("rating")


def chart_rain(rain: DataFrame) -> DataFrame:
    """V6: label and the two means, dry first."""
    return rain.select("rain_day", "rain_label", "avg_daily_purchases", "avg_daily_revenue").orderBy("rain_day")


def chart_purchases_temperature(joined: DataFrame) -> DataFrame:
    """V7: daily purchases next to the mean temperature, by date."""
    return joined.select("event_date", "purchase_count", "avg_temperature").orderBy("event_date")
