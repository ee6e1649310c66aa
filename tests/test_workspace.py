"""Workspace ingest, lake discovery, SQL steps, previews, run counters."""

from test_files import write


def test_ingest_workspace_tables(spark, tmp):
    from seqlake.plans.ingest_workspace import ingest_workspace_tables
    from seqlake.sources.files import list_files, read_catalog
    gs = f"{tmp}/gs"
    write(f"{gs}/S1.fa", "a")
    write(f"{gs}/S1_R1.fq", "r")
    write(f"{tmp}/sheet.csv", "project,workspace,workflow,run\np,w,wf_a,\np,w,wf_b,sample\n")
    write(f"{tmp}/land/summary/p/w.tsv",
          "submissionId\tmethodConfigurationName\tsubmissionEntity\tsubmissionDate\tstatus\tworkflowStatuses\n"
          "s1\tm\tsample:n1\t2024-01-01\tDone\t{'Succeeded': 2}\n"
          "s2\tm\trun:n2\t2024-01-01\tDone\t{'Failed': 1}\n"
          "s3\tm\tsample_set:x\t2024-01-01\tDone\t{'Succeeded': 1}\n"
          "s4\tm\tplate:n4\t2024-01-01\tAborted\t{'Succeeded': 1}\n")
    write(f"{tmp}/land/tables/p/w/sample.tsv",
          f"sample_id\tassembly\treads\tnote\nS1\t{gs}/S1.fa\t{gs}/S1_R1.fq\tx\nS2\t{gs}/S2.fa\t\ty\n")
    objects = list_files(spark, gs).select("path", "modified_ms")
    res = ingest_workspace_tables(spark, f"{tmp}/sheet.csv", f"{tmp}/land", f"{tmp}/lake", objects, marker=gs)
    # (2 objects + the table) for workflows wf_a and wf_b
    assert res["files"] == 6
    cat = read_catalog(spark, res["catalog"]).collect()
    assert sorted({r["id"] for r in cat}) == ["S1", "null"]
    assert {r["run"] for r in cat} == {"sample"}
    again = ingest_workspace_tables(spark, f"{tmp}/sheet.csv", f"{tmp}/land", f"{tmp}/lake", objects, marker=gs)
    assert again["files"] == 0


def test_workspace_ledger_is_written_after_success(spark, tmp):
    from seqlake.plans.ingest_workspace import ingest_workspace_tables
    from seqlake.sinks.copy import local_copy
    from seqlake.sinks.ledger import read_ledger
    from seqlake.sources.files import list_files
    ids = ["project", "workspace", "submissionId"]
    write(f"{tmp}/gs/S1.fa", "a")
    write(f"{tmp}/sheet.csv", "project,workspace,workflow,run\np,w,wf_a,\n")
    # columns in another order than usual
    write(f"{tmp}/land/summary/p/w.tsv", "status\tsubmissionId\tworkflowStatuses\tsubmissionEntity\nDone\ts1\t{'Succeeded': 2}\tsample:n1\nDone\ts2\t{'Failed': 1}\tsample:n2\n")
    write(f"{tmp}/land/tables/p/w/sample.tsv", f"sample_id\tassembly\nS1\t{tmp}/gs/S1.fa\n")
    objects = list_files(spark, f"{tmp}/gs").select("path", "modified_ms")
    go = lambda out, copier: ingest_workspace_tables(
        spark, f"{tmp}/sheet.csv", f"{tmp}/land", f"{tmp}/{out}", objects, copier=copier, marker=f"{tmp}/gs", ledger_path=f"{tmp}/ledger")

    def broken(origin, dest):
        raise OSError("no space")

    assert go("one", broken)["files"] == 0
    assert read_ledger(spark, f"{tmp}/ledger", ids).count() == 0          # nothing succeeded: the run is repeated
    assert go("one", local_copy)["files"] == 2
    assert [tuple(r) for r in read_ledger(spark, f"{tmp}/ledger", ids).collect()] == [("p", "w", "s1")]
    assert go("two", local_copy)["files"] == 0                            # another lake, but the submission is done


def test_lake_catalog_keeps_text(spark, tmp):
    from seqlake.sources.files import lake_catalog
    write(f"{tmp}/lake/data/id=0001/workflow=w/run=r/file=a.tsv/timestamp=1700000000.5/a.tsv", "x")
    write(f"{tmp}/lake/data/id=null/workflow=w/run=r/file=b.tsv/timestamp=17/b.tsv", "x")
    got = sorted((r["id"], r["timestamp"], r["file"]) for r in lake_catalog(spark, f"{tmp}/lake").collect())
    assert got == [("0001", "1700000000.5", "a.tsv"), ("null", "17", "b.tsv")]


def test_sql_steps_and_preview(spark):
    from seqlake.operators.reshape import entity_page
    from seqlake.plans.catalog import run_sql_steps
    df = spark.createDataFrame([(f"e{i:02d}",) for i in range(25)], "name string")
    out = run_sql_steps(spark, ["CREATE OR REPLACE TEMPORARY VIEW t2 AS\n  SELECT name FROM t WHERE name > 'e05'",
                                "SELECT count(*) AS n FROM t2"], {"t": df})
    assert out[1].first()["n"] == 19
    assert [r[0] for r in entity_page(df, "name", 3, 10).collect()] == [f"e{i:02d}" for i in range(20, 25)]


def test_observed_counters(spark):
    from seqlake.plans.ingest_runs import observed
    df = spark.createDataFrame([("r1", None, "a"), ("r1", "S1", "b"), ("r2", "S2", "c")],
                               "run string, sample string, dest string")
    moved, obs = observed(df)
    moved.write.format("noop").mode("overwrite").save()
    assert obs.get == {"files": 3, "run_level": 1}


def test_list_cells_explode_on_request(spark):
    from seqlake.plans.ingest_workspace import table_uris
    df = spark.createDataFrame([("wf", "sample", ["sample_id", "reads"], ["S1", "['gs://b/1.fq', 'gs://b/2.fq']"])],
                               "workflow string, run string, header array<string>, cells array<string>")
    assert [r["file"] for r in table_uris(df).collect()] == ["['gs://b/1.fq', 'gs://b/2.fq']"]
    got = sorted((r["sample"], r["file"]) for r in table_uris(df, explode_lists=True).collect())
    assert got == [("S1", "gs://b/1.fq"), ("S1", "gs://b/2.fq")]


def test_analysis_normalize_files_option(spark):
    from seqlake.plans.analysis import analysis_table
    res = spark.createDataFrame([(1, "WA0000001", 10, "PASS", "E")],
                                "row_id long, id string, timestamp long, qc string, species string")
    files = spark.createDataFrame([
        ("LABWA0000001-WA2", "LABWA0000001", "LABWA0000001-WA2_R1_1.fastq.gz", "10", "s3://r1"),
        ("LABWA0000001-WA2", "LABWA0000001", "LABWA0000001-WA2_R2_1.fastq.gz", "10", "s3://r2"),
        ("LABWA0000001-WA2", "LABWA0000001", "LABWA0000001-WA2.scaffolds.fa.gz", "10", "s3://a"),
    ], "id string, id_alt string, file string, timestamp string, current string")
    plain = analysis_table(res, files, files).first()
    assert plain["fastq_1"] is None and plain["assembly"] is None
    norm = analysis_table(res, files, files, normalize_files=True).first()
    assert (norm["fastq_1"], norm["fastq_2"], norm["assembly"]) == ("s3://r1", "s3://r2", "s3://a")


def test_table_that_lands_late_and_a_failing_workspace(spark, tmp):
    from seqlake.plans.ingest_workspace import ingest_workspace_tables
    from seqlake.sinks.copy import local_copy
    from seqlake.sinks.ledger import read_ledger
    from seqlake.sources.files import list_files
    ids = ["project", "workspace", "submissionId"]
    for s in ("S1", "P1", "B1"):
        write(f"{tmp}/gs/{s}.fa", s)
    write(f"{tmp}/sheet.csv", "project,workspace,workflow,run\np,w,wf_a,\np,v,wf_a,\n")
    head = "status\tsubmissionId\tworkflowStatuses\tsubmissionEntity\n"
    write(f"{tmp}/land/summary/p/w.tsv", head + "Done\ts1\t{'Succeeded': 2}\tsample:n1\nDone\ts2\t{'Succeeded': 1}\tplate:n2\n")
    write(f"{tmp}/land/summary/p/v.tsv", head + "Done\ts3\t{'Succeeded': 2}\tbad:n1\n")
    write(f"{tmp}/land/tables/p/w/sample.tsv", f"sample_id\tassembly\nS1\t{tmp}/gs/S1.fa\n")
    write(f"{tmp}/land/tables/p/v/bad.tsv", f"bad_id\tassembly\nB1\t{tmp}/gs/B1.fa\n")
    objects = list_files(spark, f"{tmp}/gs").select("path", "modified_ms")
    go = lambda copier: ingest_workspace_tables(spark, f"{tmp}/sheet.csv", f"{tmp}/land", f"{tmp}/lake", objects, copier=copier,
                                                marker=f"{tmp}/gs", ledger_path=f"{tmp}/ledger")["files"]
    known = lambda: sorted(r["submissionId"] for r in read_ledger(spark, f"{tmp}/ledger", ids).collect())

    def no_b1(origin, dest):
        if origin.endswith("B1.fa"):
            raise OSError("no space")
        return local_copy(origin, dest)

    assert go(no_b1) == 3 and known() == ["s1"]            # plate.tsv is not there, a file of workspace v failed
    write(f"{tmp}/land/tables/p/w/plate.tsv", f"plate_id\tassembly\nP1\t{tmp}/gs/P1.fa\n")
    assert go(local_copy) == 3 and known() == ["s1", "s2", "s3"]
    assert go(local_copy) == 0 and known() == ["s1", "s2", "s3"]
