"""K2: the labelled result store, with versions that are committed whole.

    <store>/analysis=<label>/v-<id>/part-*.parquet     rows of one write
    <store>/analysis=<label>/_commits/<number>.json    which of those are valid

A write puts its rows in a folder of its own and then commits: the next
numbered record names the folders that make up the label. A record appears
by a rename that fails if its number is taken, so of two writers one is
asked to try again, and readers see the label before the commit or after it,
never between. A failed write leaves the label as it was. Folders that no
record names any more go after a while, so that readers of the version
before can finish.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from .. import storage

#: Seconds for which rows that a later version replaced stay readable.
KEEP_SECONDS = 24 * 3600
#: Attempts of a commit against other writers of the label.
ATTEMPTS = 20


class CommitConflict(RuntimeError):
    """The label changed since the version that a write was based on."""


def result_path(store: str, label: str) -> str:
    """Folder of one label; a label is a plain name, never a path."""
    if not re.fullmatch(r"[\w.-]+", label):
        raise ValueError(f"not a result label: {label!r}")
    return f"{store.rstrip('/')}/analysis={label}"


def versions(spark: SparkSession, store: str, label: str) -> list[int]:
    """Numbers of the committed versions that are still recorded, oldest first."""
    found = storage.entries(spark, f"{result_path(store, label)}/_commits")
    return sorted(int(e.name[:-5]) for e in found if re.fullmatch(r"\d{12}\.json", e.name))


def _record(store: str, label: str, number: int) -> str:
    return f"{result_path(store, label)}/_commits/{number:012d}.json"


def parts_of(spark: SparkSession, store: str, label: str, version: int | None = None) -> list[str]:
    """Folders that make up a version of the label (the last one by default);
    none if it was never stored, or is no longer."""
    numbers = versions(spark, store, label)
    for number in [version] if version is not None else reversed(numbers):
        text = storage.read_text(spark, _record(store, label, number)) if number in numbers else None
        if text is not None:
            return [f"{result_path(store, label)}/{name}" for name in json.loads(text)["parts"]]
    return []


def labels(spark: SparkSession, store: str) -> list[str]:
    """Labels of the store."""
    prefix = "analysis="
    return [e.name[len(prefix):] for e in storage.entries(spark, store) if e.is_dir and e.name.startswith(prefix)]


def commit(spark: SparkSession, store: str, label: str, part: str, append: bool, based_on: int | None = None) -> int:
    """Make ``part`` the label's rows, or add it to them; the new version's
    number. With ``based_on``, fail if that is no longer the last version."""
    for _ in range(ATTEMPTS):
        last = max(versions(spark, store, label), default=0)
        if based_on is not None and last != based_on:
            raise CommitConflict(f"{label} is at version {last}, not {based_on}")
        before = [p.rsplit("/", 1)[1] for p in parts_of(spark, store, label, last)] if append and last else []
        record = {"version": last + 1, "parts": [*before, part], "time": time.time()}
        if storage.write_text(spark, _record(store, label, last + 1), json.dumps(record), replace=False):
            return last + 1
    raise CommitConflict(f"{label}: other writers came first {ATTEMPTS} times")


def write_results(df: DataFrame, store: str, label: str, append: bool = False, based_on: int | None = None,
                  keep_seconds: float = KEEP_SECONDS) -> int:
    """K2: store all rows under ``analysis=label``; the version's number.

    A re-run replaces exactly that label's rows, also when the new result is
    empty and also when it was read from the label itself; with ``append`` it
    adds to them. If the write fails, the label keeps its rows. ``based_on``
    (a version read before) makes the write fail with ``CommitConflict`` if
    another one came between. Rows replaced, or written and never committed,
    over ``keep_seconds`` ago go: more than the longest write or read takes."""
    spark = df.sparkSession
    part = f"v-{uuid.uuid4().hex}"
    df.drop("analysis").write.parquet(f"{result_path(store, label)}/{part}")
    number = commit(spark, store, label, part, append, based_on)
    remove_old_versions(spark, store, label, keep_seconds)
    return number


def remove_old_versions(spark: SparkSession, store: str, label: str, keep_seconds: float = KEEP_SECONDS) -> None:
    """Remove what was replaced, or never committed, over ``keep_seconds``
    ago: records but the last, folders that no remaining record names, and
    files that lie in the label's folder itself."""
    folder = result_path(store, label)
    numbers = versions(spark, store, label)
    if not numbers:
        return
    limit = (time.time() - keep_seconds) * 1000
    by_name = {e.name: e for e in storage.entries(spark, f"{folder}/_commits")}
    # A record is replaced when the next one appears.
    old = [n for n, after in zip(numbers, numbers[1:]) if by_name[f"{after:012d}.json"].modified_ms <= limit]
    named = {p.rsplit("/", 1)[1] for n in numbers if n not in old for p in parts_of(spark, store, label, n)}
    for number in old:
        storage.delete(spark, _record(store, label, number))
    for e in storage.entries(spark, folder):
        if e.name != "_commits" and e.name not in named and e.modified_ms <= limit:
            storage.delete(spark, e.path)


def read_paths(spark: SparkSession, store: str, label: str | None, version: int | None = None) -> list[str]:
    """Folders to read for a label, or for the whole store. A label folder
    without records (written before there were any) is read as it is."""
    if label is not None:
        found = parts_of(spark, store, label, version)
        folder = result_path(store, label)
        plain = any(e.name.endswith(".parquet") for e in storage.entries(spark, folder))
        return found or ([folder] if version is None and plain and not versions(spark, store, label) else [])
    return [p for name in labels(spark, store) for p in read_paths(spark, store, name)]
