"""Session helpers: a local session for tests and benchmarks, and staging
of intermediate tables in the cluster's checkpoint folder."""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import __version__, storage


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  checkpoint_dir: str | None = None, app: str = "shoplens",
                  event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests/bench: UI off, AQE on, UTC. With
    ``event_log_dir`` the event log (stage and task times) goes there."""
    b = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(shuffle_partitions: int = 2000, advisory_partition_mb: int = 128,
                 max_partition_mb: int = 256) -> dict[str, str]:
    """Settings these jobs assume on a large cluster (apply on the session
    builder or ``spark-submit --conf``). AQE re-plans joins at run time,
    coalesces small shuffle partitions and splits skewed ones; the
    shuffle width is an upper bound sized for the largest shuffle (bytes
    shuffled ÷ advisory size), AQE shrinks it for the small ones."""
    mb = 1024 * 1024
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_partition_mb * mb),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": str(max_partition_mb * mb),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. Only
    a local session that names none gets a folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d and re.match(r"local(\[|$)", spark.sparkContext.master):
        d = tempfile.mkdtemp(prefix="shoplens-")
        spark.sparkContext.setCheckpointDir(d)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (e.g. on the "
                           "cluster's object store) so staged tables survive executor loss")
    return d.rstrip("/")


def run_dir(spark: SparkSession, run_id: str) -> str:
    return f"{checkpoint_dir(spark)}/shoplens/{run_id}"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder beside the runs' that goes when the driver's JVM ends."""
    path = run_dir(spark, uuid.uuid4().hex)
    storage.delete_at_exit(spark, path)
    return path


def remove_run(spark: SparkSession, run_id: str) -> None:
    """Remove all staged tables of a run, once its results are written."""
    storage.delete(spark, run_dir(spark, run_id))


def fingerprint(spark: SparkSession, job: str, inputs: list[str | list[str]], settings: object = None) -> str:
    """Digest of what a job's staged tables depend on: the files under its
    inputs (path, size, time), its settings and the library's version."""
    files = [[e.path, e.size, e.modified_ms] for paths in inputs for e in storage.input_files(spark, paths)]
    return hashlib.sha256(json.dumps([__version__, job, repr(settings), files]).encode()).hexdigest()


class Ledger:
    """Which steps of a run have finished, and on what inputs.

    A step is recorded once its table is written whole. A job that is started
    again under the same run id skips the steps recorded with the same
    fingerprint; with other inputs or settings it does them again, beside the
    old tables. Without a fingerprint nothing is recorded or skipped."""

    def __init__(self, spark: SparkSession, run_id: str | None = None, fingerprint: str | None = None) -> None:
        self.spark, self.run_id, self.fingerprint = spark, run_id or uuid.uuid4().hex, fingerprint

    def path(self, name: str) -> str:
        tag = f"-{self.fingerprint[:16]}" if self.fingerprint else ""
        return f"{run_dir(self.spark, self.run_id)}/{name}{tag}"

    def _record(self, name: str) -> str:
        return f"{run_dir(self.spark, self.run_id)}/_steps/{name}.json"

    def finished(self, name: str) -> dict | None:
        """What was recorded of the step, if it need not be done again."""
        text = storage.read_text(self.spark, self._record(name)) if self.fingerprint else None
        record = json.loads(text) if text else {}
        return record["about"] if record.get("fingerprint") == self.fingerprint and record else None

    def finish(self, name: str, about: dict) -> None:
        if self.fingerprint:
            storage.write_text(self.spark, self._record(name),
                               json.dumps({"fingerprint": self.fingerprint, "about": about}))

    def stage(self, df: DataFrame, name: str, counts: dict[str, int] | None = None) -> DataFrame:
        """``stage_table``, unless the step has finished before."""
        done = self.finished(name)
        if done is None:
            done = {"rows": _write_counted(df, name, self.path(name))}
            self.finish(name, done)
        if counts is not None:
            counts[name] = done["rows"]
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def _write_counted(df: DataFrame, name: str, path: str) -> int:
    """Write a table; its rows, counted by the write itself (no extra job)."""
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def stage_table(df: DataFrame, name: str, run_id: str | None = None,
                counts: dict[str, int] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the whole upstream plan) and gives AQE exact sizes of the staged table.
    With ``counts``, the number of rows written is recorded under ``name``."""
    return Ledger(df.sparkSession, run_id).stage(df, name, counts)
