"""Jobs end to end on temporary folders; reruns move nothing."""

import os
import time

from test_files import write


def _lab(tmp):
    now = time.time()
    runs = f"{tmp}/src/runs"
    for run, samples in {"run_a": ["S1", "S2"], "run_b": ["S3"]}.items():
        rows = "".join(f"{s},{tmp}/src/reads/{s}_R1.fastq.gz,{tmp}/src/reads/{s}_R2.fastq.gz\n" for s in samples)
        write(f"{runs}/{run}/manifest.csv", "sample,fastq_1,fastq_2\n" + rows)
        write(f"{runs}/{run}/Phoenix_Summary.tsv", "ID\tSpecies\n")
        for s in samples:
            write(f"{runs}/{run}/{s}/{s}.tax", s)
            write(f"{tmp}/src/reads/{s}_R1.fastq.gz", "r1")
            if s != "S2":
                write(f"{tmp}/src/reads/{s}_R2.fastq.gz", "r2")
    write(f"{runs}/no_manifest/x.txt", "x")
    write(f"{tmp}/sheet.csv", f"workflow,path\nphoenix,{runs}\n")
    write(f"{tmp}/rules.config", "phoenix {\n    run_files = [ '/Phoenix_Summary.tsv', '/missing.txt' ]\n"
                                 "    sample_files = [ '/<sample>/<sample>.tax' ]\n}\n")
    return now


def test_ingest_runs_copies_once(spark, tmp):
    from seqlake.plans.ingest_runs import ingest_runs, time_window
    from seqlake.sources.files import read_catalog
    now = _lab(tmp)
    out = f"{tmp}/lake"
    w = time_window(now=now + 60, delta=3600)
    first = ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w, run_id="r1")
    # run_a: summary + 2 tax + S1 R1/R2 + S2 R1 ; run_b: summary + tax + R1/R2
    assert first["files"] == 10 and first["failed"] == 0
    cat = read_catalog(spark, first["catalog"])
    ids = sorted(r["id"] for r in cat.collect())
    assert ids.count("null") == 2
    assert all(os.path.exists(r["current"]) for r in cat.collect())
    again = ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w, run_id="r2")
    assert again["files"] == 0 and again["catalog"] is None


def test_export_new_reads_rerun(spark, tmp):
    from seqlake.plans.export_reads import export_new_reads
    now = int(time.time())
    src = f"{tmp}/fq"
    write(f"{src}/a_R1.fastq.gz", "1")
    write(f"{src}/a_R2.fastq.gz", "2")
    write(f"{tmp}/meta.fastq.csv",
          "id,workflow,run,file,timestamp,origin,current,id_alt\n"
          f"A,w,r,a_R1_001.fastq.gz,{now - 10},o,{src}/a_R1.fastq.gz,A\n"
          f"A,w,r,a_R2_001.fastq.gz,{now - 10},o,{src}/a_R2.fastq.gz,A\n"
          f"B,w,r,b_R1_001.fastq.gz,{now - 90 * 86400},o,{src}/b.fastq.gz,B\n"
          f"C,w,r,c_R1_001.fastq.gz,not-a-time,o,{src}/c.fastq.gz,C\n")
    first = export_new_reads(spark, f"{tmp}/meta.fastq.csv", f"{tmp}/ncbi", now)
    assert first == {"copied": 2, "skipped_rows": 1}
    assert sorted(os.listdir(f"{tmp}/ncbi")) == ["A_R1.fastq.gz", "A_R2.fastq.gz"]
    assert export_new_reads(spark, f"{tmp}/meta.fastq.csv", f"{tmp}/ncbi", now)["copied"] == 0
    # a nested object of the same name is a different key: it does not block the upload
    write(f"{tmp}/ncbi2/old/A_R1.fastq.gz", "x")
    write(f"{tmp}/ncbi2/A_R2.fastq.gz", "2")
    assert export_new_reads(spark, f"{tmp}/meta.fastq.csv", f"{tmp}/ncbi2", now)["copied"] == 1


def test_check_submissions_and_ledger(spark, tmp):
    import json

    from seqlake.plans.submissions import check_submissions
    from seqlake.sinks.ledger import read_ledger, record
    subs = [
        {"submissionId": "s1", "methodConfigurationName": "m", "submissionEntity": {"entityType": "sample_set"},
         "submissionDate": "2024-01-02T00:00:00.000000Z", "status": "Done", "workflowStatuses": {"Succeeded": 2}},
        {"submissionId": "s2", "methodConfigurationName": "m", "submissionEntity": {"entityType": "sample"},
         "submissionDate": "2024-01-01T00:00:00.000000Z", "status": "Done", "workflowStatuses": {"Succeeded": 1}},
        {"submissionId": "s3", "methodConfigurationName": "m", "submissionEntity": {"entityType": "run"},
         "submissionDate": "2024-01-03T00:00:00.5Z", "status": "Done", "workflowStatuses": {"Failed": 1}},
    ]
    write(f"{tmp}/subs.json", json.dumps(subs))
    write(f"{tmp}/types.json", json.dumps({"sample": {"count": 3, "idName": "sample_id"}, "run": {"count": 1, "idName": "run_id"}}))
    jobs = check_submissions(spark, f"{tmp}/subs.json", f"{tmp}/types.json", f"{tmp}/ledger", "p", "w", "s3://out")
    got = [(r["submission_id"], r["entity"]) for r in jobs.collect()]
    assert got == [("s1", "sample")]
    record(jobs.select("submission_id"), f"{tmp}/ledger", ["submission_id"])
    assert read_ledger(spark, f"{tmp}/ledger", ["submission_id"]).count() == 1
    assert check_submissions(spark, f"{tmp}/subs.json", f"{tmp}/types.json", f"{tmp}/ledger", "p", "w", "o").count() == 0


def test_check_of_several_workspaces(spark, tmp):
    import json

    from seqlake.plans.submissions import check_workspaces
    for ws in ("a", "b"):
        write(f"{tmp}/{ws}/submissions.json", json.dumps([
            {"submissionId": f"s_{ws}", "methodConfigurationName": "m", "submissionEntity": {"entityType": "sample"},
             "submissionDate": "2024-01-02T00:00:00.000000Z", "status": "Done", "workflowStatuses": {"Succeeded": 2}}]))
        write(f"{tmp}/{ws}/entities.json", json.dumps({"sample": {"count": 3, "idName": "sample_id"}}))
    got = check_workspaces(spark, "a, b,a", tmp, f"{tmp}/ledger", "p", "s3://out").collect()
    assert sorted((r["workspace"], r["submission_id"], r["start"]) for r in got) == [("a", "s_a", True), ("b", "s_b", True)]


def test_catalog_and_analysis_table_from_files(spark, tmp):
    from seqlake.plans.analysis import build_analysis_table_from_files
    from seqlake.plans.catalog import build_catalog
    from seqlake.sources.files import read_csv
    lake = f"{tmp}/lake"
    s1 = f"{lake}/data/id=null/workflow=PHoeNIx/run=r1/file=Phoenix_Summary.tsv/timestamp=100/Phoenix_Summary.tsv"
    s2 = f"{lake}/data/id=null/workflow=PHoeNIx/run=r2/file=Phoenix_Summary.tsv/timestamp=200/Phoenix_Summary.tsv"
    write(s1, "ID\tAuto_QC_Outcome\tSpecies\tEstimated_Coverage\nWA0000001\tPASS\tE coli\t50\nWA0000002\tPASS\tK p\t20\n")
    write(s2, "ID\tAuto_QC_Outcome\tSpecies\tEstimated_Coverage\nWA0000001-WA2\tFAIL\tE coli\t5\n")
    meta = ("id,workflow,run,file,timestamp,origin,current\n"
            f"null,PHoeNIx,r1,Phoenix_Summary.tsv,100,o,{s1}\n"
            f"null,PHoeNIx,r2,Phoenix_Summary.tsv,200,o,{s2}\n"
            "WA0000002,PHoeNIx,r1,WA0000002_R1_001.fastq.gz,100,o,s3://l/2_R1\n"
            "WA0000002,PHoeNIx,r1,WA0000002_R2_001.fastq.gz,100,o,s3://l/2_R2\n"
            "WA0000002,PHoeNIx,r1,WA0000002.scaffolds.fa.gz,100,o,s3://l/2.fa\n"
            "WA0000002,PHoeNIx,r1,WA0000002.scaffolds.fa.gz,99,o,s3://l/2old.fa\n")
    write(f"{tmp}/meta/run1.csv", meta)
    from seqlake.sources.files import read_catalog
    paths = build_catalog(spark, read_catalog(spark, f"{tmp}/meta"), lake)
    assert read_csv(spark, paths["meta.gba"]).count() == 2
    out = build_analysis_table_from_files(spark, lake)
    ok = read_csv(spark, out["gba"]).collect()
    miss = read_csv(spark, out["gba.miss"]).collect()
    # WA0000001's newest result is a FAIL: it is dropped (QC after latest)
    assert [r["id"] for r in ok] == ["WA0000002"] and ok[0]["assembly"] == "s3://l/2.fa"
    assert ok[0]["species"] == "K_p" and ok[0]["fastq_2"] == "s3://l/2_R2"
    assert miss == []


def test_run_list_to_jobs(spark, tmp):
    from seqlake.plans.ingest_runs import run_jobs
    write(f"{tmp}/runs.txt", "phoenix,s3://bkt/runs/2024.01.02/\nphoenix,s3://bkt/runs/r2/\n")
    got = sorted(r["job_name"] for r in run_jobs(spark, f"{tmp}/runs.txt", "s3://out").collect())
    assert got == ["phoenix_2024-01-02", "phoenix_r2"]


def test_upload_events_stream_into_ingest(spark, tmp):
    import json

    from seqlake.plans.ingest_runs import ingest_runs, time_window
    from seqlake.sources.files import local_table
    from seqlake.streaming.ingest import UPLOAD_EVENT_SCHEMA, file_stream, ingest_on_upload, run, upload_triggers
    now = _lab(tmp)
    out = f"{tmp}/lake"
    w = time_window(now=now + 60, delta=3600)
    seen = []

    def ingest(runs):
        seen.extend(runs)
        ingest_runs(spark, local_table(spark, runs, ["workflow", "run"]), f"{tmp}/rules.config", out, w)

    key = f"{tmp.lstrip('/')}/src/runs/run_a"
    events = [{"bucket": "", "key": f"{key}/Phoenix_Summary.tsv", "eventTime": "2024-01-01T00:00:00Z"},
              {"bucket": "", "key": f"{key}/other.txt", "eventTime": "2024-01-01T00:00:01Z"}]
    write(f"{tmp}/events/e1.json", "\n".join(json.dumps(e) for e in events))
    stream = upload_triggers(file_stream(spark, f"{tmp}/events", UPLOAD_EVENT_SCHEMA, fmt="json"), scheme="file")
    run(stream, f"{tmp}/ckpt", sink=ingest_on_upload(spark, ingest))
    assert seen == [("phoenix", f"file:///{key}/")]
    moved = [p for p in os.popen(f"find {out}/data -type f").read().split() if "run=run_a" in p]
    assert len(moved) == 6   # summary + 2 tax + S1 R1/R2 + S2 R1
    run(stream, f"{tmp}/ckpt", sink=ingest_on_upload(spark, ingest))   # nothing new landed
    assert len(seen) == 1


def test_ingest_versions_by_file(spark, tmp):
    from seqlake.plans.ingest_runs import ingest_runs, time_window
    from seqlake.sources.files import read_catalog
    now = _lab(tmp)
    w = time_window(now=now + 60, delta=3600)
    res = ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", f"{tmp}/lake", w, version_by="file")
    cat = read_catalog(spark, res["catalog"]).collect()
    assert res["files"] == 10
    assert all("." not in r["timestamp"] for r in cat)      # whole seconds per file


def test_reconcile_catalog_after_lost_catalog_write(spark, tmp):
    import shutil

    from seqlake.plans.ingest_runs import ingest_runs, reconcile_catalog, time_window
    from seqlake.sources.files import read_catalog
    now = _lab(tmp)
    out = f"{tmp}/lake"
    w = time_window(now=now + 60, delta=3600)
    first = ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w, run_id="r1")
    shutil.rmtree(first["catalog"])            # the catalog write was lost: the next run publishes it from the commit
    assert ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w)["files"] == 0
    assert read_catalog(spark, first["catalog"]).count() == 10
    for lost in ("meta", "commits", "transfers"):      # every record of the run is lost
        shutil.rmtree(f"{out}/{lost}")
    assert ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w)["files"] == 0
    fixed = reconcile_catalog(spark, out)
    assert fixed["files"] == 10
    cat = read_catalog(spark, f"{out}/meta").collect()
    assert len(cat) == 10 and sorted({r["id"] for r in cat})[-1] == "null"
    assert reconcile_catalog(spark, out)["files"] == 0


def test_ingest_with_catalog_index(spark, tmp):
    from seqlake.plans.ingest_runs import ingest_runs, time_window
    now = _lab(tmp)
    out = f"{tmp}/lake"
    w = time_window(now=now + 60, delta=3600)
    assert ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w, lake_index="catalog")["files"] == 10
    assert ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", out, w, lake_index="catalog")["files"] == 0


def test_arrow_copier_matches_local_copier(spark, tmp):
    from seqlake.sinks.copy import arrow_copy, copy_files
    from seqlake.sources.files import local_table
    write(f"{tmp}/a/x.txt", "hello")
    write(f"{tmp}/a/y.txt", "world!")
    plan = local_table(spark, [(f"{tmp}/a/x.txt", f"{tmp}/b/1/x.txt"), (f"{tmp}/a/y.txt", f"{tmp}/b/2/y.txt"),
                               (f"{tmp}/a/missing", f"{tmp}/b/3/z")], ["origin", "dest"])
    got = {r["dest"]: (r["ok"], r["bytes"]) for r in copy_files(plan, arrow_copy).collect()}
    assert got[f"{tmp}/b/1/x.txt"] == (True, 5) and got[f"{tmp}/b/2/y.txt"] == (True, 6)
    assert got[f"{tmp}/b/3/z"][0] is False
    assert open(f"{tmp}/b/2/y.txt").read() == "world!"
    again = {r["dest"]: r["ok"] for r in copy_files(plan, arrow_copy, parallelism=3).collect()}
    assert again[f"{tmp}/b/1/x.txt"] is True


def test_runs_of_one_name_and_absent_folders(spark, tmp):
    """Two roots hold a run of the same name; a rule names a folder that no run has."""
    from seqlake.plans.ingest_runs import ingest_runs, time_window
    from seqlake.sources.files import read_catalog
    for wf, s in (("phoenix", "S1"), ("mycosnp", "S2")):
        write(f"{tmp}/{wf}/run1/manifest.csv", f"sample,fastq_1,fastq_2\n{s},{tmp}/reads/{s}_R1.fastq.gz,{tmp}/gone/{s}_R2.fastq.gz\n")
        write(f"{tmp}/{wf}/run1/{wf}.txt", wf)
        write(f"{tmp}/reads/{s}_R1.fastq.gz", s)
    write(f"{tmp}/sheet.csv", f"workflow,path\nphoenix,{tmp}/phoenix\nmycosnp,{tmp}/mycosnp\n")
    write(f"{tmp}/rules.config", "".join(f"{wf} {{\n run_files = [ '/{wf}.txt' ]\n sample_files = [ '/<sample>/assembly/x.fa' ]\n}}\n" for wf in ("phoenix", "mycosnp")))
    res = ingest_runs(spark, f"{tmp}/sheet.csv", f"{tmp}/rules.config", f"{tmp}/lake", time_window(now=time.time() + 60, delta=3600))
    cat = {(r["id"], r["workflow"], r["file"]) for r in read_catalog(spark, res["catalog"]).collect()}
    assert res["files"] == 4
    assert cat == {("S1", "phoenix", "S1_R1.fastq.gz"), ("S2", "mycosnp", "S2_R1.fastq.gz"), ("null", "phoenix", "phoenix.txt"), ("null", "mycosnp", "mycosnp.txt")}
    assert all(r["timestamp"].isdigit() for r in read_catalog(spark, res["catalog"]).collect())


def test_analysis_skips_a_vanished_table(spark, tmp):
    from seqlake.plans.analysis import build_analysis_table_from_files
    write(f"{tmp}/lake/a/Phoenix_Summary.tsv", "ID\tAuto_QC_Outcome\tSpecies\nWA0000001\tPASS\tE c\n")
    head = "id,workflow,run,file,timestamp,origin,current,id_alt\n"
    write(f"{tmp}/meta.gba.csv", head + f"null,phoenix,r,f,100,o,{tmp}/lake/a/Phoenix_Summary.tsv,null\n"
                                       f"null,phoenix,r2,f,200,o,{tmp}/lake/gone/Phoenix_Summary.tsv,null\n")
    write(f"{tmp}/meta.fastq.csv", head)
    write(f"{tmp}/meta.fasta.csv", head)
    out = build_analysis_table_from_files(spark, tmp)
    rows = [r["id"] for p in out.values() for r in spark.read.option("header", True).csv(p).collect()]
    assert rows == ["WA0000001"]
