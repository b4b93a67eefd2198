"""Mixing sources to target weights: hash-threshold histograms.

Each source gets a word budget from its weight; the budget is met by whole
repetitions of the source plus the documents whose hash lies under a
threshold. The threshold is found by histograms: words are summed by source
and hash bucket, the bucket in which the budget ends is split into finer
buckets, and so on; only rows of that one bucket are read again. No sort of
documents, no Python: DataFrame functions alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Run, col, n_words

#: Bits of a document's hash, and bits that each histogram resolves.
HASH_BITS, STEP_BITS = 60, 10
#: A text with a word has a character other than ASCII white space.
ONE_WORD = r"[^\x20\x09-\x0D]"


def _source_order() -> list[Column]:
    return [F.col("source").isNull(), F.col("source")]


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size) → with target: ``share`` of all words split by
    weight, at most ``most`` times a source's size, the excess reshared by
    weight among the others until none is above.

    The sources that stop at their limit are those with the least
    ``limit / weight``; one pass over the sources in that order finds how far
    they reach. One row per source is all this window reads."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    rank = F.row_number().over(Window.orderBy(*_source_order())) - 1
    by = Window.orderBy("fill", *_source_order())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    t = (sizes.withColumn("weight", F.get(w, (rank % len(weights)).cast("int")))
         .withColumn("limit", F.col("source_size") * F.lit(float(most)))
         .withColumn("fill", F.col("limit") / F.col("weight"))
         .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                     / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))))
    # The first source (in that order) whose limit is not reached fixes the level for all after it.
    place = F.row_number().over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    t = t.withColumn("place", place)
    level = F.min(F.when(F.col("fill") > F.col("level"), F.struct("place", "level"))).over(every)["level"]
    target = F.when(level.isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), level * F.col("weight")))
    return t.withColumn("target", target).select("source", "source_size", "target")


def row_hash(id_: Column, text: Column) -> Column:
    """60 bits of the md5 of a document's id and its text's md5: the same in
    any engine, and equal for rows that share both only."""
    whole = F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often the mix takes each document: one row per row of ``docs`` with
    doc_id, source, hash, size (words), source_size, target (of its source),
    repeats (0, 1, 2, …) and taken = repeats × size.

    ``weights`` go to the sources by code point, null last, and repeat.
    A source's documents are all taken floor(target / size) times, and once
    more those first by hash until the rest of its target is met; the last
    one (or last ones, if their hashes are equal) is taken if that brings the
    source nearer its target.

    Null or empty text: size 0, taken 0. Null sources form one source. The
    hash is of the document's id and text, so reruns agree; rows of a source
    that share both are taken together, so a source that is mostly one
    repeated row may miss its target by half of that row's words. Sources are
    few (their targets are found by a window over one row each). Long texts
    are counted whole, in the JVM. Empty table: no rows. Extra columns are
    ignored."""
    run = Run(docs.sparkSession, "mixing")
    top = HASH_BITS - STEP_BITS
    h = row_hash(col(id_col), col(text_col))
    base = run.stage(docs.select(col(id_col).alias("doc_id"), col(source_col).alias("source"),
                                 n_words(col(text_col)).alias("size"), h.alias("h")), "sizes")
    hist = run.stage(base.groupBy("source", F.shiftright("h", top).alias("b"))
                     .agg(F.sum("size").alias("words")), "words-0")
    targets = source_targets(hist.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    level = run.stage(targets.withColumn("whole", whole.cast("long")).withColumn("rest", rest), "targets")

    def same(x: DataFrame, y: DataFrame, extra: Column | None = None) -> Column:
        on = x["source"].eqNullSafe(y["source"])
        return on if extra is None else on & extra

    # After each step: the bucket (its leading hash bits) in which a source's
    # rest ends, and what is left of the rest at its start.
    for step in range(HASH_BITS // STEP_BITS):
        if step:
            shift = HASH_BITS - step * STEP_BITS
            part = base.join(level, same(base, level, F.shiftright(base["h"], shift) == level["bucket"]))
            hist = (part.groupBy(base["source"], F.shiftright("h", shift - STEP_BITS).alias("b"))
                    .agg(F.sum("size").alias("words")))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("b"))
        left = level.drop("bucket", "words").withColumnRenamed("source", "s")
        ends = (hist.withColumn("upto", upto).join(left, F.col("source").eqNullSafe(F.col("s")))
                .filter(F.col("upto") > F.col("rest"))
                .groupBy("source").agg(F.min_by(F.struct("b", "words", "upto"), "b").alias("e")))
        ends = ends.select(F.col("source").alias("s"), "e.*")
        level = (level.drop("bucket", "words").join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
                 .withColumn("rest", F.when(F.col("b").isNotNull(), F.col("rest") - (F.col("upto") - F.col("words")))
                             .otherwise(F.col("rest")))
                 .select("source", "source_size", "target", "whole", "rest",
                         F.col("b").alias("bucket"), "words"))
        level = run.stage(level, f"level-{step + 1}")
    # A hash below the last bucket is under the threshold; the bucket itself
    # counts if at least half of it fits. No bucket: all of the source fits.
    cut = (F.when(F.col("bucket").isNull(), F.lit(1 << HASH_BITS))
           .otherwise(F.col("bucket") + F.when(2 * F.col("rest") >= F.col("words"), 1).otherwise(0)))
    last = run.stage(level.withColumn("cut", cut).select(F.col("source").alias("s"), "source_size", "target",
                                                         "whole", "cut"), "cuts")
    out = base.join(last, F.col("source").eqNullSafe(F.col("s")))
    repeats = F.when(F.col("size") > 0, F.col("whole") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0)).otherwise(0)
    return out.select("doc_id", "source", F.col("h").alias("hash"), "size", "source_size", "target", repeats.cast("long").alias("repeats"),
                      (repeats * F.col("size")).cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, columns: Sequence[str], **how) -> DataFrame:
    """The mix itself: rows of ``docs`` (``columns`` of it), each as often as
    ``mix_sources`` takes it; documents without words are not in it."""
    id_col, source_col = how.get("id_col", "doc_id"), how.get("source_col", "source")
    text_col = how.get("text_col", "text")
    # By hash and source: rows that share both share their decision.
    m = (mix_sources(docs, **how).filter("repeats > 0")
         .groupBy(F.col("hash").alias("_hash"), F.col("source").alias("_source"))
         .agg(F.max("repeats").alias("_n")))
    d = (docs.select(*[col(c) for c in columns], row_hash(col(id_col), col(text_col)).alias("_h"))
         .filter(col(text_col).rlike(ONE_WORD)))
    return (d.join(m, (F.col("_h") == F.col("_hash")) & col(source_col).eqNullSafe(F.col("_source")))
            .withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
            .select(*[col(c) for c in columns]))


#: The same rule over one sorted list per source.
MIX_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15) as bigint) as h
  from {docs}),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
r as (select *, [5.0, 2.0, 1.0][cast((row_number() over (order by source is null, source) - 1) % 3 + 1 as int)]::double as weight,
             source_size * 2.0::double as most from s),
f as (select *, most / weight as fill, sum(source_size) over () * 1.5::double as budget from r),
l as (select *, (budget - coalesce(sum(most) over (order by fill, source is null, source rows between unbounded preceding and 1 preceding), 0.0))
             / (sum(weight) over () - coalesce(sum(weight) over (order by fill, source is null, source rows between unbounded preceding and 1 preceding), 0.0)) as lev,
             row_number() over (order by fill, source is null, source) as place from f),
m as (select min({{'place': place, 'lev': lev}}) as x from l where fill > lev),
t as (select source, source_size, case when m.x is null then most else least(most, m.x.lev * weight) end as target from l, m),
w as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from t),
c as (select d.doc_id, d.size, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size as rest,
             sum(d.size) over (partition by d.source order by h) as upto,
             sum(d.size) over (partition by d.source, h) as grp
      from d join w on d.source is not distinct from w.source)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(size * (whole + case when 2 * (rest - (upto - grp)) >= grp then 1 else 0 end) as bigint) as taken
from c"""
