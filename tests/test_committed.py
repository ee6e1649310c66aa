"""Transfers become visible as a whole: a run that dies leaves its catalog and its ledger, or neither."""

import os

import pytest
from test_files import write
from test_jobs import _lab

from seqlake.sinks import committed as sink
from seqlake.sources.files import read_catalog


class Killed(BaseException):
    """What ends a job from outside: no handler of the library takes it."""


def lines(spark, out):
    return sorted(r["current"] for r in read_catalog(spark, f"{out}/meta").collect())


def test_run_killed_between_copy_and_catalog(spark, tmp, monkeypatch):
    from seqlake.plans.ingest_runs import ingest_runs, time_window
    now = _lab(tmp)
    out, w = f"{tmp}/lake", time_window(now=now + 60, delta=3600)
    go = lambda run_id: ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w, run_id=run_id)
    real = sink.commit

    def killed(*a):
        raise Killed
    monkeypatch.setattr(sink, "commit", killed)
    with pytest.raises(Killed):
        go("r1")
    monkeypatch.setattr(sink, "commit", real)
    # the files are there, and nothing says so
    assert os.path.exists(f"{out}/data") and not os.path.exists(f"{out}/meta")
    assert sink.runs(spark, out).count() == 0 and sink.committed(spark, out, "catalog", sink.CATALOG_SCHEMA).count() == 0
    before = {p: os.stat(os.path.join(d, p)).st_ino for d, _, fs in os.walk(f"{out}/data") for p in fs}
    again = go("r2")
    assert again["files"] == 10 and again["failed"] == 0 and again["run_level"] == 2 and again["bytes"] > 0
    assert {p: os.stat(os.path.join(d, p)).st_ino for d, _, fs in os.walk(f"{out}/data") for p in fs} == before      # no file was copied again
    assert len(lines(spark, out)) == 10 == len(set(lines(spark, out)))
    assert go("r3")["files"] == 0
    table = {r["run_id"]: (r["files"], r["failed"], r["run_level"]) for r in sink.runs(spark, out).collect()}
    assert table == {"r2": (10, 0, 2), "r3": (0, 0, 0)}


def test_run_killed_between_commit_and_publication(spark, tmp, monkeypatch):
    from seqlake.plans import ingest_runs as job
    now = _lab(tmp)
    out, w = f"{tmp}/lake", job.time_window(now=now + 60, delta=3600)
    go = lambda run_id: job.ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w, run_id=run_id)
    from seqlake.sinks import writers

    def killed(*a, **k):
        raise Killed
    monkeypatch.setattr(writers, "write_csv", killed)
    with pytest.raises(Killed):
        go("r1")
    monkeypatch.undo()
    assert sink.committed(spark, out, "catalog", sink.CATALOG_SCHEMA).count() == 10
    assert go("r2")["files"] == 0 and len(lines(spark, out)) == 10        # the next run publishes what the first committed


def test_task_that_fails_leaves_nothing_visible(spark, tmp):
    from seqlake.plans.ingest_workspace import ingest_workspace_tables
    from seqlake.sinks.copy import local_copy
    from seqlake.sinks.ledger import read_ledger
    from seqlake.sources.files import list_files
    ids = ["project", "workspace", "submissionId"]
    for s in ("S1", "S2"):
        write(f"{tmp}/gs/{s}.fa", s)
    write(f"{tmp}/sheet.csv", "project,workspace,workflow,run\np,w,wf_a,\n")
    write(f"{tmp}/land/summary/p/w.tsv", "status\tsubmissionId\tworkflowStatuses\tsubmissionEntity\nDone\ts1\t{'Succeeded': 2}\tsample:n1\n")
    write(f"{tmp}/land/tables/p/w/sample.tsv", f"sample_id\tassembly\nS1\t{tmp}/gs/S1.fa\nS2\t{tmp}/gs/S2.fa\n")
    objects = list_files(spark, f"{tmp}/gs").select("path", "modified_ms")
    go = lambda copier: ingest_workspace_tables(spark, f"{tmp}/sheet.csv", f"{tmp}/land", f"{tmp}/lake", objects, copier=copier,
                                                marker=f"{tmp}/gs", ledger_path=f"{tmp}/ledger")

    def dies(origin, dest):
        n = local_copy(origin, dest)
        if origin.endswith("S2.fa"):
            import os as o
            o._exit(3)                  # the Python worker of the task is gone
        return n

    with pytest.raises(Exception):
        go(dies)
    assert sink.runs(spark, f"{tmp}/lake").count() == 0 and not os.path.exists(f"{tmp}/lake/meta")
    assert read_ledger(spark, f"{tmp}/ledger", ids).count() == 0
    done = go(local_copy)
    assert done["files"] == 3 and len(lines(spark, f"{tmp}/lake")) == 3
    assert [r["submissionId"] for r in read_ledger(spark, f"{tmp}/ledger", ids).collect()] == ["s1"]


def test_failed_copies_are_counted_and_not_catalogued(spark, tmp):
    write(f"{tmp}/a", "abc")
    rows = [("r", "w", None, f"{tmp}/a", "a", "1", f"{tmp}/out/data/id=null/a"), ("r", "w", "S", f"{tmp}/gone", "gone", "1", f"{tmp}/out/data/id=S/gone")]
    plan = spark.createDataFrame(rows, sink.PLAN_SCHEMA)
    from seqlake.plans.ingest_runs import catalog_rows
    from seqlake.sinks.copy import local_copy
    _, facts = sink.carry_out(spark, f"{tmp}/out", "x", plan, local_copy, catalog_rows)
    assert facts == {"files": 1, "failed": 1, "run_level": 1, "bytes": 3}
    assert [r["file"] for r in sink.committed(spark, f"{tmp}/out", "catalog", sink.CATALOG_SCHEMA).collect()] == ["a"]
