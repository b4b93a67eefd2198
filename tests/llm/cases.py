"""Rows that test the edges: nulls in every column, empty and odd texts,
repeated rows and ids, ties, a very long text, extra columns whose names
clash with those the operators use inside."""

import pandas as pd
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use for columns of their own.
CLASHING = ["size", "h", "fp", "key", "label", "first", "range", "body", "number", "unnamed", "line", "same", "root",
            "_n", "_text", "_number", "target", "ids", "path", "record_type", "lang_pred", "score", "s", "n", "word"]

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
    (2, "the quick brown fox jumps over the lazy dog again and again", "en", None, 1),
    (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n ", "de", "b", 4), (6, "12 %% 34!", None, "b", 9),
    (7, "\n\nêtre où ça Straße 日本語 😀\r\x0b\x0cx", "fr", "é", 5), (8, LONG, "en", "a", len(LONG)),
    (9, "one", "en", "c", 3), (9, "one", "en", "c", 3), (9, "two different words here", "en", "c", 3),
    (None, "nameless text stands here", "en", "a", 5), (None, "nameless text stands here", "en", "a", 5),
    (None, None, None, None, None), (10, "a line of twenty letters\nshort\nshort\n\n\na line of twenty lettres", "en", "a", 1),
    (11, "a line of twenty letterz\nshort", "en", "a", 1), (12, "a line of twenty letters", "en", "a", 1),
    (-5, "negative numbers come first", "en", "a", 1), (13, "x" * 5000, "en", "d", 5000), (14, "a  b ▁ c ", "en", "d", 9)]


def documents(spark, rows=None, clashing=True):
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        for name in CLASHING:
            df = df.withColumn(name, F.lit("clash"))
    return df


def table(sf_dir, name) -> pd.DataFrame:
    return pd.read_parquet(f"{sf_dir}/{name}.parquet")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
