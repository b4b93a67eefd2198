"""Reject channel of S1–S3, P5 and P10: what a source holds that cannot be
used, with reason and line, and an exact account of it.

A source is read once, as text; every field is cast to its declared type and
what went wrong with a row is kept beside it. ``split_rows`` writes both
kinds in one pass, so that rows in = rows kept + rows rejected by reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.prep import clean_reviews, event_time
from ..schemas import REVIEWS, SHOP_EVENTS
from ..session import Ledger
from ..settings import DEFAULT, EVENT_TIME_FORMAT, REVIEW_CATEGORY

CORRUPT = "_corrupt"
MALFORMED = "malformed"
#: Fields an event cannot do without.
EVENT_FIELDS = ("event_type", "product_id", "event_time")


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def _as_text(parsed: Column, line: Column, schema: T.StructType) -> list[Column]:
    return [*[parsed[f].alias(f) for f in [*schema.fieldNames(), CORRUPT]], line.alias("line")]


def csv_line_fields(lines: DataFrame, schema: T.StructType, line_col: str = "line") -> DataFrame:
    """CSV lines (fields in the order of the schema) → every field as text,
    ``_corrupt`` (not null: the line has another number of fields), ``line``."""
    fields = _text_schema(schema.fieldNames())
    parsed = F.from_csv(F.col(line_col), fields.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"columnNameOfCorruptRecord": CORRUPT})
    return lines.select(parsed.alias("r"), F.col(line_col).alias("l")).select(*_as_text(F.col("r"), F.col("l"), schema))


def json_line_fields(lines: DataFrame, schema: T.StructType, line_col: str = "line") -> DataFrame:
    """JSON lines → every field as text, ``_corrupt`` (not JSON), ``line``."""
    parsed = F.from_json(F.col(line_col), _text_schema(schema.fieldNames()), {"columnNameOfCorruptRecord": CORRUPT})
    return lines.select(parsed.alias("r"), F.col(line_col).alias("l")).select(*_as_text(F.col("r"), F.col("l"), schema))


def file_fields(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Files → every field as text, ``_corrupt``, ``line``. CSV columns are
    taken by header name; the line of a well-formed CSV row is its fields
    written again, in the order of the schema. Parquet has types of its own
    and no lines: a row is its JSON."""
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        missing = [n for n in schema.fieldNames() if n not in header]
        if missing:
            raise ValueError(f"the header lacks {missing}; it has {header}")
        rows = (spark.read.schema(_text_schema(header)).option("header", True).option("enforceSchema", False)
                .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
        written = F.to_csv(F.struct(*schema.fieldNames()))
    elif fmt == "json":
        rows = (spark.read.schema(_text_schema(schema.fieldNames())).option("columnNameOfCorruptRecord", CORRUPT).json(path))
        written = F.to_json(F.struct(*schema.fieldNames()))
    elif fmt == "parquet":
        rows = spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))
        rows = rows.select(*[F.col(f).cast("string").alias(f) for f in schema.fieldNames()],
                           F.lit(None).cast("string").alias(CORRUPT))
        written = F.to_json(F.struct(*schema.fieldNames()))
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return rows.select(*schema.fieldNames(), CORRUPT, F.coalesce(F.col(CORRUPT), written).alias("line"))


def judge(rows: DataFrame, schema: T.StructType, required: Sequence[str] = (), *, strict: bool = False,
          faults: Mapping[str, Column] | None = None, refused: Mapping[str, Column] | None = None,
          every_line: bool = False) -> DataFrame:
    """Text rows → the declared types, with ``problems`` (all of them, in the
    order of the schema), ``reason`` (the one that rejects the row, else
    null) and ``line`` (of rows with a problem, or of ``every_line``).

    A field that does not parse is ``unparsable:<field>`` and null; a
    required one that is absent (or blank, if not a text) is ``missing:<field>``. ``faults``
    adds problems by a condition over the text of a present field,
    ``refused`` reasons by a condition over the typed row. A row is rejected
    if a required field is null after that, or for any problem if ``strict``;
    other problems stay with the kept row. A rejected row that is malformed
    as a whole has that as its reason."""
    faults, refused = dict(faults or {}), dict(refused or {})
    typed, notes = {}, [F.when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED))]
    fatal = list(notes) if strict else []
    for f in schema.fields:
        text = F.col(f.name)
        value = text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)
        present = text.isNotNull()
        if not isinstance(f.dataType, T.StringType):
            present = present & (F.trim(text) != "")
        bad = present & value.isNull()
        if f.name in faults:
            bad = bad | (present & F.coalesce(faults[f.name], F.lit(False)))
        problem = F.when(bad, F.lit(f"unparsable:{f.name}"))
        if f.name in required:
            problem = problem.when(~present, F.lit(f"missing:{f.name}"))
        notes.append(problem)
        if strict or f.name in required:
            fatal.append(problem)
        typed[f.name] = value
    told = [F.when(c, F.lit(reason)) for reason, c in refused.items()]
    out = rows.select(*[typed[f.name].alias(f.name) for f in schema.fields],
                      F.array_compact(F.array(*notes)).alias("_notes"),
                      F.coalesce(*fatal, F.lit(None).cast("string")).alias("_fatal"), CORRUPT, "line")
    problems = F.array_compact(F.concat(F.col("_notes"), F.array(*told))) if told else F.col("_notes")
    reason = F.coalesce(F.col("_fatal"), *told) if told else F.col("_fatal")
    reason = F.when(reason.isNotNull() & F.col(CORRUPT).isNotNull(), F.lit(MALFORMED)).otherwise(reason)
    return out.select(*schema.fieldNames(), problems.alias("problems"), reason.alias("reason"),
                      F.when(F.lit(every_line) | (F.size(problems) > 0), F.col("line")).alias("line"))


def judge_events(rows: DataFrame, *, strict: bool = False, time_format: str = EVENT_TIME_FORMAT,
                 required: Sequence[str] = EVENT_FIELDS) -> DataFrame:
    """P5 with reasons: shop events whose required fields are absent or do
    not parse (the time by ``time_format``) are rejected."""
    unread = event_time(rows, "event_time", time_format).isNull()
    return judge(rows, SHOP_EVENTS, required, strict=strict, faults={"event_time": unread})


def judge_reviews(rows: DataFrame, *, schema: T.StructType = REVIEWS, min_length: int = DEFAULT.min_review_length,
                  min_rating: float = DEFAULT.min_rating, max_rating: float = DEFAULT.max_rating,
                  category: str = REVIEW_CATEGORY) -> DataFrame:
    """P8–P13 with reasons: all reviews with the columns of ``clean_reviews``,
    ``problems``, ``reason`` and ``line``. Rejected are those without a rating
    (``missing``, ``unparsable``), with one out of range (``out_of_range``)
    or with too little text (``too_short``), as ``clean_reviews`` drops them."""
    judged = judge(rows, schema, ["rating"], every_line=True)
    out = clean_reviews(judged, min_length=min_length, min_rating=min_rating, max_rating=max_rating, category=category,
                        drop=False)
    more = F.when(~F.col("rating").between(min_rating, max_rating), F.lit("out_of_range")).when(
        F.length("review_clean") < min_length, F.lit("too_short"))
    malformed = F.array_contains("problems", MALFORMED)
    reason = F.coalesce("reason", F.when(more.isNotNull() & malformed, F.lit(MALFORMED)).otherwise(more))
    out = out.withColumns({"reason": reason, "problems": F.array_compact(F.concat("problems", F.array(more)))})
    return out.withColumn("line", F.when(F.size("problems") > 0, F.col("line"))).drop("kept")


def account(judged: DataFrame) -> DataFrame:
    """Rows by outcome: ``kept`` or the reason of their rejection."""
    return (judged.groupBy(F.coalesce("reason", F.lit("kept")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("row_count")))


class Split(NamedTuple):
    """Kept and rejected rows of a source, and how many rows it had."""
    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def split_rows(judged: DataFrame, name: str, ledger: Ledger | None = None) -> Split:
    """Write judged rows once, kept and rejected apart, in the checkpoint
    folder: the kept rows without what only rejection needs, the rejected
    ones with reason, problems and line, and what became of the source's rows
    (``rows``, ``kept``, ``rejected``, ``noted``: kept with a problem),
    counted by the write itself. A step that the ``ledger`` has as finished
    is not done again."""
    if "rejected" in judged.columns:
        raise ValueError("the column rejected is split_rows' own")
    ledger = ledger or Ledger(judged.sparkSession)
    counts = ledger.finished(name)
    if counts is None:
        seen = Observation(name)
        gone = F.col("reason").isNotNull()
        counted = judged.withColumn("rejected", gone).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(gone).alias("rejected"),
            F.count_if(~gone & (F.size("problems") > 0)).alias("noted"))
        counted.write.mode("overwrite").partitionBy("rejected").parquet(ledger.path(name))
        got = seen.get
        counts = {"rows": got["rows"], "kept": got["rows"] - got["rejected"], "rejected": got["rejected"], "noted": got["noted"]}
        ledger.finish(name, counts)
    read = judged.sparkSession.read.schema(judged.schema.add("rejected", T.BooleanType())).parquet(ledger.path(name))
    return Split(read.filter("not rejected").drop("rejected", "reason", "problems", "line"),
                 read.filter("rejected").drop("rejected"), counts)
