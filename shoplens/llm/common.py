"""Helpers shared by the operators: quoted columns, the word expression,
staged tables in the cluster's shared folder, ranks without a window over all
rows, and connected components."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def n_words(text: Column) -> Column:
    """Number of words (null text: 0), without extracting them: the pieces
    between white space, less the empty ones at either end."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACE)
    return (F.size(pieces) - F.when(pieces[0] == "", 1).otherwise(0)
            - F.when((F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session
    that names none (a test) gets a folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shoplens-llm-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


#: Rows and bytes of texts that a Python worker takes at once.
BATCH_ROWS, BATCH_BYTES = 1000, "8m"


def bound_batches(spark: SparkSession) -> None:
    """Bound what travels to Python at once, in rows and in bytes: Spark's
    10,000 rows of long texts would fill a worker. A session that sets its
    own number of rows keeps both its settings."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


class Run:
    """Staged tables of one operator call, in one folder of the shared
    directory. A table is written once and reread, so that a lost executor
    costs its unfinished tasks only, and Spark knows its real size. ``drop``
    removes a table whose readers have all been written; the rest goes when
    the driver's JVM ends."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        bound_batches(spark)
        self.dir = f"{shared_dir(spark)}/shoplens/{name}-{uuid.uuid4().hex}"
        self._path(self.dir)[1].deleteOnExit(self._path(self.dir)[0])

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def stage(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        path = f"{self.dir}/{name}"
        df.write.mode("overwrite").parquet(path, compression=codec)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            p, fs = self._path(f"{self.dir}/{name}")
            fs.delete(p, True)

    def release(self) -> None:
        """Let Spark remove the shuffle files of frames that are written and
        that nothing refers to any more: it does so when the driver's JVM
        collects them, which may else be long after the disks are full."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def connected_components(edges: DataFrame, run: Run, rounds: int = 60) -> DataFrame:
    """``edges`` (a long, b long, a <> b) → (node, root): the smallest node
    reachable from each node that has an edge, roots included.

    Alternating large-star and small-star rounds over staged tables: each
    round is two aggregations and joins whose hot nodes are pre-aggregated
    (min) or split by AQE (the other side has one row per node). It stops
    when the edges form stars; nothing but that verdict reaches the driver."""
    a, b = F.col("a"), F.col("b")
    now = run.stage(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "cc-0")
    for k in range(1, rounds + 1):
        ends = now.select("a").unionAll(now.select(b.alias("a")).distinct())
        if ends.groupBy("a").count().filter("count > 1").limit(1).isEmpty():
            return now.select(a.alias("node"), b.alias("root")).unionAll(
                now.select(b.alias("node"), b.alias("root")).distinct())
        both = now.unionAll(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.filter("b > a").join(least, "a")
                 .select(b.alias("a"), F.col("m").alias("b")).distinct())
        large = run.stage(large, f"cc-large-{k}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct(a.alias("a"), F.col("m").alias("b")),
                                           F.struct(b.alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").filter("a <> b").distinct())
        nxt = run.stage(small, f"cc-{k}")
        run.drop(f"cc-{k - 1}", f"cc-large-{k}")
        now = nxt
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], run: Run, name: str) -> DataFrame:
    """``df`` (a staged table) with ``rank``, the row's number from 0 within
    its ``group`` (null is a group of its own) in ``order``, and ``size``,
    the rows of the group.

    No group meets in one task: rows are dealt by ranges of (group, order),
    numbered within their partition, and a table of one row per partition and
    group says where each partition's rows begin. Rows that tie in ``order``
    share a partition, so the order should end in what tells rows apart."""
    if "_at" in df.columns or "_part" in df.columns:
        raise ValueError("columns _at and _part are ranked()'s own")
    keys = [col(g).asc_nulls_first() for g in group] + list(order)
    at = run.stage(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("_at", F.monotonically_increasing_id())
                   .withColumn("_part", F.shiftright("_at", 33).cast("int")), f"{name}-dealt")
    starts = at.groupBy(*[col(g) for g in group], "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("lo"))
    within = Window.partitionBy(*[col(g) for g in group])
    before = within.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = run.stage(starts.select(
        *[col(g).alias(f"_{k}") for k, g in enumerate(group)], F.col("_part").alias("_p"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lo")).alias("_move"),
        F.sum("n").over(within).alias("size")), f"{name}-starts")
    on = F.col("_part") == F.col("_p")
    for k, g in enumerate(group):
        on = on & col(g).eqNullSafe(F.col(f"_{k}"))
    return at.join(starts, on).select(*[col(c) for c in df.columns], (F.col("_at") + F.col("_move")).alias("rank"), "size")
