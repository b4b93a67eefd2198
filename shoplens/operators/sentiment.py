"""RQ2 — review sentiment: A7–A10, L5, D5.

Inputs are clean reviews (``prep.clean_reviews``).
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import exact_mean, pct_half_up
from ..functions.text import is_keyword, tokens
from ..settings import DEFAULT, ENGLISH_STOP_WORDS, SENTIMENT_GROUPS
from .common import with_grand_total


def _share(df: DataFrame, count_col: str, alias: str = "percentage") -> DataFrame:
    """Share of ``count_col`` in its grand total, %, 2 dp (exact)."""
    df = with_grand_total(df, count_col, "__total")
    return df.withColumn(alias, pct_half_up(count_col, "__total")).drop("__total")


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per star rating and their share of all clean reviews."""
    counts = reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("review_count"))
    return _share(counts, "review_count")


def verified_stats(reviews: DataFrame) -> DataFrame:
    """Per verified flag (null is its own group): count, mean rating,
    share of all clean reviews."""
    counts = reviews.groupBy("verified_purchase").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg("rating").alias("avg_rating"),
    )
    return _share(counts, "review_count")


def monthly_trend(reviews: DataFrame) -> DataFrame:
    """Reviews and mean rating per ``yyyy-MM`` of the review date."""
    return (
        reviews.filter(F.col("review_date").isNotNull())
        .groupBy(F.date_format("review_date", "yyyy-MM").alias("year_month"))
        .agg(F.count(F.lit(1)).alias("review_count"), F.avg("rating").alias("avg_rating"))
    )


def keyword_tokens(
    reviews: DataFrame,
    *,
    groups: Sequence[tuple[int, str]] = SENTIMENT_GROUPS,
    stop_words: Iterable[str] = ENGLISH_STOP_WORDS,
    min_length: int = DEFAULT.keyword_min_length,
    text_col: str = "review_clean",
    label_col: str = "sentiment_label",
) -> DataFrame:
    """(sentiment_group, word): every keyword of the whole cleaned texts, in
    one pass for all groups (instead of one scan per group)."""
    label = F.col(label_col)
    name = F.lit(None).cast("string")
    for value, group in reversed(list(groups)):
        name = F.when(label == value, group).otherwise(name)
    return (
        reviews.filter(label.isin([v for v, _ in groups]))
        .select(name.alias("sentiment_group"), F.explode(tokens(text_col)).alias("word"))
        .filter(is_keyword("word", stop_words, min_length))
    )


def keyword_counts(reviews: DataFrame, **kw) -> DataFrame:
    """Word frequencies per sentiment group. The (group, word) count is
    combined map-side, so frequent words cost one row per map task in the
    shuffle."""
    words = keyword_tokens(reviews, **kw)
    return words.groupBy("sentiment_group", "word").agg(F.count(F.lit(1)).alias("frequency"))


def top_keywords(reviews: DataFrame, n: int = DEFAULT.keyword_top_n, **kw) -> DataFrame:
    """The n most frequent keywords per group, ties by word.

    ``row_number() <= n`` lets Spark insert a partial window-group limit
    before the shuffle, so each map task forwards at most n words per
    group, however many distinct words there are."""
    return _first_words(keyword_counts(reviews, **kw), n)


def _first_words(counts: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("sentiment_group").orderBy(F.col("frequency").desc(), F.col("word"))
    return (
        counts.withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") <= n)
        .select("word", "frequency", "sentiment_group")
    )


#: Words that the frequent-items sketch of a group tracks, and the share of
#: all words, times that number, that a word it does not name may have: its
#: estimates are off by at most 3.5 / tracked, and it names the words that are
#: more frequent than that for certain.
TRACKED, MISSED = 1 << 16, 2 * 3.5


def _in_place(df: DataFrame, name: str) -> DataFrame:
    return df


def frequent_keywords(reviews: DataFrame, n: int = DEFAULT.keyword_top_n, *, tracked: int = TRACKED,
                      stage: Callable[[DataFrame, str], DataFrame] = _in_place, **kw) -> DataFrame:
    """A10 with a shuffle that does not grow with the vocabulary; the result
    of ``top_keywords``.

    A frequent-items sketch per group (``approx_top_k``, merged map-side)
    names candidates, at most ``tracked`` words a group, and a second pass
    counts those exactly: both shuffles are bounded by the sketch. A word that
    it does not name stands at most ``MISSED * words / tracked`` times, and
    not more often than all words that are no candidates together. If the
    n-th candidate is more frequent than that, no word is lost; a group
    for which this does not hold is counted in full. ``stage`` materialises
    the two small tables; without it they are computed anew where read."""
    words = keyword_tokens(reviews, **kw)
    named = words.groupBy("sentiment_group").agg(
        F.count(F.lit(1)).alias("words"),
        F.call_function("approx_top_k", F.col("word"), F.lit(tracked), F.lit(tracked)).alias("items"))
    named = stage(named.select("sentiment_group", "words", F.explode("items.item").alias("word")), "keyword_candidates")
    # At most ``tracked`` words a group: a bound that no input moves.
    counts = stage(words.join(F.broadcast(named.select("sentiment_group", "word")), ["sentiment_group", "word"])
                   .groupBy("sentiment_group", "word").agg(F.count(F.lit(1)).alias("frequency")), "keyword_candidate_counts")
    first = _first_words(counts, n)
    total = named.groupBy("sentiment_group").agg(F.max("words").alias("words"))
    seen = counts.groupBy("sentiment_group").agg(F.sum("frequency").alias("seen"))
    last = first.groupBy("sentiment_group").agg(F.count(F.lit(1)).alias("found"), F.min("frequency").alias("least"))
    missed = F.least(F.col("words") - F.col("seen"), F.floor(F.col("words") * F.lit(MISSED / tracked)))
    whole = (F.col("words") == F.col("seen")) | ((F.col("found") >= n) & (F.col("least") > missed))
    sure = total.join(seen, "sentiment_group").join(last, "sentiment_group").select("sentiment_group", whole.alias("sure"))
    sure = stage(sure, "keyword_groups")
    proven = sure.filter("sure").select("sentiment_group")
    rest = words.join(F.broadcast(proven), "sentiment_group", "left_anti")
    rest = _first_words(rest.groupBy("sentiment_group", "word").agg(F.count(F.lit(1)).alias("frequency")), n)
    return first.join(F.broadcast(proven), "sentiment_group", "left_semi").select(*rest.columns).unionByName(rest)


def review_length_stats(reviews: DataFrame) -> DataFrame:
    """Min / mean / max cleaned length per sentiment label."""
    n = F.length("review_clean")
    return reviews.groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.min(n).alias("min_length"),
        exact_mean(F.sum(n), F.count(F.lit(1))).alias("mean_length"),
        F.max(n).alias("max_length"),
    )
