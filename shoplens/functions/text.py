"""Text expressions for review cleaning and keyword counting."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

# Letters kept by the cleaner: ASCII letters and Java's \s whitespace
# (space, tab, newline, vertical tab, form feed, carriage return). Runs of
# other characters are removed as one match (same result, far fewer
# matches than one per character).
NON_LETTER = r"[^a-zA-Z\s]+"
WHITESPACE = r"\s"


def review_text(title: str | Column, text: str | Column) -> Column:
    """Title and text, null read as empty, joined by one space."""
    return F.concat_ws(" ", F.coalesce(col(title), F.lit("")), F.coalesce(col(text), F.lit("")))


def clean_text(c: str | Column) -> Column:
    """P10: lower case, then drop every character that is not an ASCII
    letter or whitespace (accented letters vanish rather than fold)."""
    return F.regexp_replace(F.lower(col(c)), NON_LETTER, "")


def tokens(c: str | Column) -> Column:
    """M3: lower case and split on every single whitespace character, as
    ``ml.feature.Tokenizer`` does (runs of spaces give empty tokens)."""
    return F.split(F.lower(col(c)), WHITESPACE)


def is_keyword(word: str | Column, stop_words: Iterable[str], min_length: int) -> Column:
    """M4 + F4: at least ``min_length`` characters and not a stop word.
    Tokens come from ``tokens`` and are already lower case, so the check
    is case-insensitive without lower-casing every token again."""
    w = col(word)
    return (F.length(w) >= min_length) & ~w.isin([s.lower() for s in stop_words])
