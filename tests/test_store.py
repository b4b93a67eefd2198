"""K2: versions of the result store are committed whole, or not at all."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from shoplens import storage
from shoplens.sinks import CommitConflict, remove_old_versions, versions, write_results
from shoplens.sinks import store as S
from shoplens.sources.files import read_results


def rows(df):
    return sorted(r["id"] for r in df.collect())


def failing(spark):
    """Fails after some tasks have written their rows."""
    return spark.range(0, 1000, 1, 8).withColumn(
        "v", F.when(F.col("id") == 999, F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.lit("x")))


def test_a_failed_write_keeps_the_rows(spark, tmp):
    write_results(spark.range(5), tmp, "a")
    with pytest.raises(Exception, match="broken row"):
        write_results(failing(spark), tmp, "a")
    assert rows(read_results(spark, tmp, "a")) == [0, 1, 2, 3, 4] and versions(spark, tmp, "a") == [1]
    with pytest.raises(Exception, match="broken row"):
        write_results(failing(spark), tmp, "new")
    assert read_results(spark, tmp, "new").count() == 0


def test_a_label_is_rewritten_from_itself(spark, tmp):
    write_results(spark.range(5), tmp, "a")
    write_results(read_results(spark, tmp, "a").filter("id > 1"), tmp, "a")
    write_results(read_results(spark, tmp, "a").filter("id > 2"), tmp, "a")
    assert rows(read_results(spark, tmp, "a")) == [3, 4] and rows(read_results(spark, tmp, "a", version=2)) == [2, 3, 4]


def test_a_reader_keeps_the_version_it_began_with(spark, tmp):
    write_results(spark.range(5), tmp, "a")
    before = read_results(spark, tmp, "a")
    write_results(spark.range(10, 12), tmp, "a")
    assert rows(before) == [0, 1, 2, 3, 4] and rows(read_results(spark, tmp, "a")) == [10, 11]
    # Rows that are written and not yet committed are not seen.
    spark.range(100).write.parquet(f"{S.result_path(tmp, 'a')}/v-unfinished")
    assert rows(read_results(spark, tmp, "a")) == [10, 11] and rows(read_results(spark, tmp)) == [10, 11]


def test_appending_adds_and_an_empty_result_replaces(spark, tmp):
    write_results(spark.range(2), tmp, "a")
    write_results(spark.range(2, 4).withColumn("more", F.lit("m")), tmp, "a", append=True)
    got = read_results(spark, tmp, "a")
    assert rows(got) == [0, 1, 2, 3] and {r["more"] for r in got.collect()} == {None, "m"}
    write_results(spark.range(0), tmp, "a", append=True)
    assert rows(read_results(spark, tmp, "a")) == [0, 1, 2, 3]
    write_results(spark.range(0), tmp, "a")
    assert read_results(spark, tmp, "a").count() == 0


def test_writers_at_the_same_time_lose_nothing(spark, tmp):
    def add(k):
        write_results(spark.range(10 * k, 10 * k + 3), tmp, "a", append=True)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert rows(read_results(spark, tmp, "a")) == [10 * k + j for k in range(6) for j in range(3)]
    assert versions(spark, tmp, "a") == [1, 2, 3, 4, 5, 6]


def test_a_write_may_insist_on_the_version_it_read(spark, tmp):
    first = write_results(spark.range(2), tmp, "a")
    write_results(spark.range(3), tmp, "a", based_on=first)
    with pytest.raises(CommitConflict):
        write_results(spark.range(4), tmp, "a", based_on=first)
    assert rows(read_results(spark, tmp, "a")) == [0, 1, 2]


def test_old_versions_go_after_a_while(spark, tmp):
    for n in (1, 2, 3):
        write_results(spark.range(n), tmp, "a")
    spark.range(100).write.parquet(f"{S.result_path(tmp, 'a')}/v-abandoned")
    remove_old_versions(spark, tmp, "a", keep_seconds=3600)
    assert versions(spark, tmp, "a") == [1, 2, 3] and rows(read_results(spark, tmp, "a", version=1)) == [0]
    remove_old_versions(spark, tmp, "a", keep_seconds=-5)
    assert versions(spark, tmp, "a") == [3] and rows(read_results(spark, tmp, "a")) == [0, 1, 2]
    assert read_results(spark, tmp, "a", version=1).count() == 0
    assert len([e for e in os.listdir(f"{tmp}/analysis=a") if e.startswith("v-")]) == 1
    # Appended parts that the last version still names stay.
    write_results(spark.range(7, 8), tmp, "a", append=True, keep_seconds=-5)
    assert rows(read_results(spark, tmp, "a")) == [0, 1, 2, 7]


def test_a_label_written_without_records_is_read_and_then_replaced(spark, tmp):
    spark.range(3).write.parquet(f"{tmp}/analysis=old")
    assert rows(read_results(spark, tmp, "old")) == [0, 1, 2] and rows(read_results(spark, tmp)) == [0, 1, 2]
    write_results(spark.range(5, 6), tmp, "old", keep_seconds=-5)
    assert rows(read_results(spark, tmp, "old")) == [5]
    assert not [f for f in os.listdir(f"{tmp}/analysis=old") if f.endswith(".parquet")]


def test_small_files_are_replaced_whole_or_not_at_all(spark, tmp):
    at = f"{tmp}/deep/record.json"
    assert storage.read_text(spark, at) is None and storage.entries(spark, f"{tmp}/deep") == []
    assert storage.write_text(spark, at, "one", replace=False) and not storage.write_text(spark, at, "two", replace=False)
    assert storage.read_text(spark, at) == "one"
    assert storage.write_text(spark, at, json.dumps({"é": 1})) and json.loads(storage.read_text(spark, at)) == {"é": 1}
    assert [e.name for e in storage.entries(spark, f"{tmp}/deep")] == ["record.json"]
