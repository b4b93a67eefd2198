"""Parameters of the three analyses and the fixed values they rely on.

Every operator takes its thresholds as keyword arguments; ``Settings``
bundles the defaults so a job runner can pass one object around.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match the
# published behaviour: Spark ML's default English stop-word list (181 words,
# in its own order), weekday names for Spark's dayofweek (1 = Sunday), the
# rain and temperature labels, the weather parameter names, the city
# coordinates, the missing-value sentinel and the event-time format.
# ---------------------------------------------------------------------------
ENGLISH_STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)

# Spark dayofweek: 1 = Sunday ... 7 = Saturday; anything else reads Saturday.
WEEKDAY_NAMES: tuple[str, ...] = (
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
)
# Chart order, Monday first, and the weekend days.
CHART_WEEKDAY_ORDER: tuple[str, ...] = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)
WEEKEND_DAYS: tuple[str, ...] = ("Saturday", "Sunday")

RAIN_LABELS: tuple[str, str] = ("Dry Day", "Rainy Day")  # rain_day 0, 1
# Upper edges (exclusive) and labels; values at or above the last edge,
# and nulls, fall into the last label.
TEMPERATURE_EDGES: tuple[float, ...] = (0.0, 10.0, 20.0, 30.0)
TEMPERATURE_LABELS: tuple[str, ...] = ("freezing", "cold", "mild", "warm", "hot")

SENTIMENT_GROUPS: tuple[tuple[int, str], ...] = ((2, "positive"), (0, "negative"))

WEATHER_PARAMETERS: tuple[tuple[str, str], ...] = (
    ("T2M", "temperature"),
    ("PRECTOTCORR", "precipitation"),
    ("WS2M", "wind_speed"),
    ("RH2M", "humidity"),
)
WEATHER_SENTINEL: float = -999.0

CITIES: tuple[tuple[str, float, float], ...] = (
    ("New York", 40.7128, -74.0060),
    ("Los Angeles", 34.0522, -118.2437),
    ("Chicago", 41.8781, -87.6298),
    ("Houston", 29.7604, -95.3698),
    ("Phoenix", 33.4484, -112.0740),
)

EVENT_TIME_FORMAT: str = "yyyy-MM-dd HH:mm:ss z"
REVIEW_CATEGORY: str = "Electronics"

# CSV folder of each result that is exported; all results keep their label.
CSV_NAMES: Mapping[str, str] = MappingProxyType({
    "category_behaviour": "analysis1_category_stats",
    "daily_trend": "analysis1_daily_trend",
    "conversion_funnel": "analysis1_funnel",
    "hourly_patterns": "analysis1_hourly",
    "rating_distribution": "analysis2_rating_dist",
    "verified_stats": "analysis2_verified_stats",
    "monthly_trend": "analysis2_monthly_trend",
    "daily_joined_data": "analysis3_joined_data",
    "correlation_matrix": "analysis3_correlations",
    "rain_analysis": "analysis3_rain_analysis",
    "regression_metrics": "analysis3_regression_metrics",
})
# ---------------------------------------------------------------------------


def _frozen(d: Mapping) -> Mapping:
    return MappingProxyType(dict(d))


@dataclass(frozen=True)
class Settings:
    """Defaults of every threshold, fraction and model parameter."""

    # RQ1
    event_time_format: str = EVENT_TIME_FORMAT
    max_session_events: int = 500
    # Bloom filter of the bot sessions, where they are too many to broadcast
    bot_prefilter_rate: float = 0.01
    bot_prefilter_bytes: int = 1 << 20
    # more bot sessions than this are too many (a broadcast row: about 100 bytes)
    bot_broadcast_rows: int = 100_000
    category_separator: str = "."
    # RQ2
    min_review_length: int = 10
    min_rating: float = 1.0
    max_rating: float = 5.0
    review_category: str = REVIEW_CATEGORY
    keyword_top_n: int = 50
    keyword_min_length: int = 4
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS
    sample_fractions: Mapping[int, float] = field(
        default_factory=lambda: _frozen({0: 0.02, 1: 0.02, 2: 0.005})
    )
    seed: int = 42
    train_fraction: float = 0.8
    num_features: int = 10_000
    min_doc_freq: int = 5
    classifier_max_iter: int = 10
    classifier_reg_param: float = 0.01
    # RQ3
    rain_threshold: float = 1.0
    weather_sentinel: float = WEATHER_SENTINEL
    regression_max_iter: int = 100
    regression_reg_param: float = 0.01
    # money is summed exactly in this type (sums: decimal(38,8)), then reported
    # as double; eight decimals, so that no price is rounded to cents
    money_type: str = "decimal(28,8)"
    # None: exact distinct counts; a number: HyperLogLog++ with that rsd
    distinct_rsd: float | None = None


DEFAULT = Settings()
