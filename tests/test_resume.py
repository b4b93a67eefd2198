"""A job that died goes on from the steps it had finished."""

import os
import time

import pytest

from shoplens import session, storage
from shoplens.plans import jobs
from shoplens.session import Ledger, fingerprint
from shoplens.sinks import versions
from shoplens.sources.files import read_results
from test_rejects import EVENTS, SHOP_EVENTS


def events(tmp, name="events", rows=EVENTS):
    path = os.path.join(tmp, name)
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/0.csv", "w") as f:
        f.write("\n".join([",".join(SHOP_EVENTS.fieldNames()), *rows]) + "\n")
    return path


def spark_jobs(spark, work):
    """Spark jobs that ``work`` runs."""
    group = f"count-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setJobGroup("none", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_finished_step_is_read_again(spark, tmp):
    ledger = Ledger(spark, f"resume-{os.path.basename(tmp)}", "inputs-1")
    counts = {}
    first = spark_jobs(spark, lambda: ledger.stage(spark.range(5), "five", counts))
    assert counts == {"five": 5} and first >= 1
    again = {}
    assert spark_jobs(spark, lambda: ledger.stage(spark.range(7), "five", again)) == 0
    assert again == {"five": 5} and ledger.stage(spark.range(7), "five").count() == 5
    # Other inputs: staged anew, beside the old table.
    other = Ledger(spark, ledger.run_id, "inputs-2")
    assert other.stage(spark.range(7), "five").count() == 7 and other.path("five") != ledger.path("five")
    # Without a fingerprint nothing is skipped.
    plain = Ledger(spark, ledger.run_id)
    assert [plain.stage(spark.range(n), "five").count() for n in (2, 3)] == [2, 3]


def test_a_step_that_failed_is_not_finished(spark, tmp):
    ledger = Ledger(spark, f"fail-{os.path.basename(tmp)}", "f")
    with pytest.raises(Exception, match="broken"):
        ledger.stage(spark.range(9).selectExpr("if(id = 8, raise_error('broken'), id) as id"), "t")
    assert ledger.finished("t") is None
    assert ledger.stage(spark.range(3), "t").count() == 3 and ledger.finished("t") == {"rows": 3}


def test_the_fingerprint_follows_files_and_settings(spark, tmp):
    path = events(tmp)
    one = fingerprint(spark, "job", [path], "s")
    assert one == fingerprint(spark, "job", [f"{path}/*.csv"], "s") == fingerprint(spark, "job", [[path]], "s")
    assert one != fingerprint(spark, "job", [path], "t") and one != fingerprint(spark, "other", [path], "s")
    os.utime(f"{path}/0.csv", (1, 1))
    two = fingerprint(spark, "job", [path], "s")
    events(tmp, rows=EVENTS[:3])
    assert len({one, two, fingerprint(spark, "job", [path], "s")}) == 3


def test_a_killed_job_goes_on_where_it_was(spark, tmp, monkeypatch):
    path, store, run = events(tmp), os.path.join(tmp, "store"), f"job-{os.path.basename(tmp)}"
    whole = spark_jobs(spark, lambda: jobs.behaviour_job(spark, path, store=os.path.join(tmp, "other"), run_id=run + "-b"))

    write = jobs.write_results

    def dies(df, store, label):
        if label == "hourly_patterns":
            raise KeyboardInterrupt
        return write(df, store, label)

    monkeypatch.setattr(jobs, "write_results", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.behaviour_job(spark, path, store=store, run_id=run)
    monkeypatch.setattr(jobs, "write_results", write)
    staged = storage.entries(spark, session.run_dir(spark, run))
    assert {e.name.rsplit("-", 1)[0] for e in staged if e.is_dir and not e.name.startswith("_")} == {"prepared_events", "bot_sessions"}
    rest = spark_jobs(spark, lambda: jobs.behaviour_job(spark, path, store=store, run_id=run))
    assert rest < whole
    # What was stored before the kill was not stored twice, and the run's folder is gone.
    assert versions(spark, store, "event_distribution") == [1] and versions(spark, store, "hourly_patterns") == [1]
    assert storage.entries(spark, session.run_dir(spark, run)) == []
    for label in ("event_distribution", "daily_trend", "rejected_events"):
        a, b = (read_results(spark, s, label) for s in (store, os.path.join(tmp, "other")))
        assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_a_resumed_job_sees_changed_input(spark, tmp, monkeypatch):
    path, run = events(tmp), f"changed-{os.path.basename(tmp)}"
    before = jobs.behaviour_job(spark, path, run_id=run)["event_distribution"].collect()
    events(tmp, rows=EVENTS + [EVENTS[0].replace("view", "purchase")])
    os.utime(f"{path}/0.csv", (2, 2))
    after = jobs.behaviour_job(spark, path, run_id=run)["event_distribution"].collect()
    assert len(before) == 1 and len(after) == 2
