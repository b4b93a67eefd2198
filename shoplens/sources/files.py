"""Readers with declared schemas (no inference pass over the
data) for CSV, JSON Lines or Parquet inputs, and the result-store reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import REVIEWS, SHOP_EVENTS, WEATHER
from ..sinks.store import read_paths


def _by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [n for n in schema.fieldNames() if n not in df.columns]
    if missing:
        raise ValueError(f"the header lacks {missing}; it has {df.columns}")
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with headers: columns are taken by header name, in any order, and
    cast to the declared types (unparsable: null). Only the first line is
    read to learn the header; a file whose header differs from the first
    one's fails the job."""
    header = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in header])
    return _by_name(spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path), schema)


def _read(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "json":
        return spark.read.schema(schema).option("multiLine", False).json(path)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))
    raise ValueError(f"unsupported format {fmt!r}")


def read_shop_events(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                     schema: T.StructType = SHOP_EVENTS) -> DataFrame:
    """Shop events (a glob such as ``.../2019-*.csv`` is fine)."""
    return _read(spark, path, schema, fmt)


def read_reviews(spark: SparkSession, path: str | list[str], fmt: str = "json",
                 schema: T.StructType = REVIEWS) -> DataFrame:
    """Reviews, one JSON object per line."""
    return _read(spark, path, schema, fmt)


def read_weather(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                 schema: T.StructType = WEATHER) -> DataFrame:
    """S3: daily weather observations per city."""
    return _read(spark, path, schema, fmt)


def parse_csv_lines(lines: DataFrame, schema: T.StructType, line_col: str = "line") -> DataFrame:
    """S1, S3 for lines that a source delivers one by one (a queue, a text
    column): CSV fields in the order of the declared schema."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return lines.select(F.from_csv(F.col(line_col), fields).alias("r")).select("r.*")


def parse_json_lines(lines: DataFrame, schema: T.StructType, line_col: str = "line") -> DataFrame:
    """S2 for lines that a source delivers one by one."""
    return lines.select(F.from_json(F.col(line_col), schema).alias("r")).select("r.*")


def read_results(spark: SparkSession, store: str, analysis: str | None = None, version: int | None = None,
                 **equals) -> DataFrame:
    """Rows stored under one analysis label, with its ``analysis`` column;
    only the files of its last committed version (or of ``version``) are
    listed and read. ``equals`` keeps rows whose columns have the given
    values. A label that was never stored gives an empty frame. Without a
    label: all rows of the store, by column name."""
    paths = read_paths(spark, store, analysis, version)
    if paths:
        # Parts added later may have other columns.
        df = spark.read.option("basePath", store).option("mergeSchema", len(paths) > 1).parquet(*paths)
    else:
        df = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in ["analysis", *equals]]))
    for column, value in equals.items():
        df = df.filter(F.col(column) == value)
    return df
