"""One named file from many tasks; entity pages as the table file of the workspace ingest; paced copies; rules of a hot workflow."""

import csv
import json
import os

from pyspark.sql import functions as F

from test_files import write


def test_one_file_in_order_with_header_once(spark, tmp):
    from seqlake.sinks.onefile import write_ordered_file
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k"), F.concat(F.lit('a,"b" '), "id").alias("t"),
                                      F.when(F.col("id") % 3 > 0, F.col("id")).alias("n")).repartition(7)
    path = f"{tmp}/out/all.csv"
    size = write_ordered_file(rows, path, ["k"], ["t", "k", "n"])
    assert os.path.getsize(path) == size and os.listdir(f"{tmp}/out") == ["all.csv"]
    with open(path, newline="") as f:
        got = list(csv.reader(f))
    want = sorted((r["k"], r["t"], "" if r["n"] is None else str(r["n"])) for r in rows.collect())
    assert got[0] == ["t", "k", "n"] and [(int(k), t, n) for t, k, n in got[1:]] == want


def test_one_file_edges(spark, tmp):
    from seqlake.sinks.onefile import _stream, write_ordered_file
    empty = spark.createDataFrame([], "a string, b int")
    path = f"{tmp}/x.csv"
    write_ordered_file(empty, path, ["a"])
    assert open(path).read() == "a,b\n"
    rows = spark.createDataFrame([("y", 1), (None, 2), ("y", 1), ("x\ty", None), ("", 3)], "a string, b int")
    write_ordered_file(rows, path, ["b"], sep="\t", quoted=False)                       # replaces the file; ties and nulls
    assert open(path).read() == "a\tb\nx y\t\ny\t1\ny\t1\n\t2\n\t3\n"
    rows.write.csv(f"{tmp}/folder.csv")
    write_ordered_file(rows.where("b = 1"), f"{tmp}/folder.csv", ["b"])                 # replaces an export folder
    assert open(f"{tmp}/folder.csv").read() == "a,b\ny,1\ny,1\n"
    # stores that cannot be written at an offset: parts streamed in order
    write(f"{tmp}/p/part-0", "1\n2\n")
    write(f"{tmp}/p/part-1", "3\n")
    _stream(spark, f"{tmp}/streamed", b"h\n", [(f"{tmp}/p/part-0", 4), (f"{tmp}/p/part-1", 2)])
    assert open(f"{tmp}/streamed").read() == "h\n1\n2\n3\n"


def test_failed_part_leaves_the_old_file(spark, tmp):
    import pytest

    from seqlake.sinks.onefile import _place
    write(f"{tmp}/all.csv", "old")
    write(f"{tmp}/p/part-0", "1\n")
    with pytest.raises(Exception, match="part-0 has 2 bytes, not 5"):
        _place(spark, f"{tmp}/all.csv", b"h\n", [(f"{tmp}/p/part-0", 5)], 7)
    assert open(f"{tmp}/all.csv").read() == "old"


def test_entity_pages_become_the_table_of_the_ingest(spark, tmp):
    from seqlake.plans.export_entities import export_entity_table
    from seqlake.plans.ingest_workspace import ingest_workspace_tables
    from seqlake.sources.files import list_files, read_catalog
    gs = f"{tmp}/gs"
    write(f"{gs}/S1.fa", "a")
    write(f"{gs}/S2.fa", "b")
    page = lambda *e: json.dumps({"results": [{"name": n, "attributes": a} for n, a in e]})
    write(f"{tmp}/pages/2.json", page(("S2", {"assembly": f"{gs}/S2.fa", "ok": True}), ("S3", {"note": None})))
    write(f"{tmp}/pages/1.json", page(("S1", {"assembly": f"{gs}/S1.fa", "reads": [1, "x"]})))
    write(f"{tmp}/types.json", json.dumps({"sample": {"count": 3, "idName": "sample_id", "attributeNames": ["reads", "assembly", "ok", "note"]}}))
    path = export_entity_table(spark, f"{tmp}/pages", f"{tmp}/types.json", "sample", f"{tmp}/land", "p", "w", ["assembly", "ok", "reads"])
    assert open(path).read() == ("sample_id\treads\tassembly\tok\n" f"S1\t[1, 'x']\t{gs}/S1.fa\t\n" f"S2\t\t{gs}/S2.fa\tTrue\n" "S3\t\t\t\n")
    write(f"{tmp}/sheet.csv", "project,workspace,workflow,run\np,w,wf_a,sample\n")
    write(f"{tmp}/land/summary/p/w.tsv", "submissionId\tsubmissionEntity\tstatus\tworkflowStatuses\n")
    objects = list_files(spark, gs).select("path", "modified_ms")
    res = ingest_workspace_tables(spark, f"{tmp}/sheet.csv", f"{tmp}/land", f"{tmp}/lake", objects, marker=gs)
    assert sorted(r["id"] for r in read_catalog(spark, res["catalog"]).collect()) == ["S1", "S2", "null"]


def test_copies_are_released_batch_by_batch(spark, tmp):
    from seqlake.sinks.copy import copy_files
    plan = spark.createDataFrame([(f"o{i:02d}", f"d{i:02d}", i // 3) for i in range(15)], "origin string, dest string, batch long")
    log = f"{tmp}/log"
    os.makedirs(log)

    def copier(origin, dest):
        import time
        with open(f"{log}/{dest}", "w") as f:
            f.write(str(time.time()))
        return 1

    status = copy_files(plan, copier, parallelism=2, slot="batch", interval=0.5).collect()
    assert len(status) == 15 and all(r["ok"] for r in status)
    slots = {}
    for f in sorted(os.listdir(log)):
        slots.setdefault(int(float(open(f"{log}/{f}").read()) // 0.5), set()).add(int(f[1:]) // 3)
    assert len(slots) == 5 and all(len(batches) == 1 for batches in slots.values())      # three files in a slot, never more


def test_paced_run_is_committed(spark, tmp):
    from seqlake.sinks.committed import PLAN_SCHEMA, carry_out, runs
    for i in range(5):
        write(f"{tmp}/src/f{i}", "x")
    plan = spark.createDataFrame([("r", "w", None, f"{tmp}/src/f{i}", f"f{i}", "1", f"{tmp}/lake/data/f{i}") for i in range(5)], PLAN_SCHEMA)
    from seqlake.plans.ingest_runs import catalog_rows
    from seqlake.sinks.copy import local_copy
    moved, facts = carry_out(spark, f"{tmp}/lake", "r1", plan, local_copy, catalog_rows, batch_size=2, interval=0.1)
    assert facts["files"] == 5 and sorted(r["batch"] for r in moved.collect()) == [0, 0, 1, 1, 2]
    assert runs(spark, f"{tmp}/lake").count() == 1


def test_rules_of_a_hot_workflow_expand_where_the_samples_are(spark):
    """All samples have one workflow, broadcasts are off: no task gets much more than another."""
    from seqlake.operators.retention import expand_rules
    n = 200_000
    runs = spark.range(1000).select(F.concat(F.lit("r"), "id").alias("run"), F.lit("hot").alias("workflow"), F.concat(F.lit("/r"), "id").alias("run_path"))
    manifest = spark.range(n).select(F.concat(F.lit("/r"), F.col("id") % 1000).alias("run_path"), F.concat(F.lit("S"), "id").alias("sample"),
                                     F.lit("a").alias("fastq_1"), F.lit(None).cast("string").alias("fastq_2"))
    rules = spark.createDataFrame([("hot", "sample_files", "/<sample>/x"), ("hot", "sample_files", "/<sample>/x"), ("hot", "run_files", "/y"),
                                   ("cold", "run_files", "/z")], "workflow string, kind string, pattern string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = expand_rules(runs, manifest, rules)
        per_task = sorted(r["count"] for r in out.where("sample is not null").groupBy(F.spark_partition_id().alias("t")).count().collect())
        assert sum(per_task) == 3 * n and out.count() == 3 * n + 1000
        assert len(per_task) == 4 and per_task[-1] <= 3 * per_task[len(per_task) // 2]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_unknown_workflow_keeps_its_reads_only(spark):
    from seqlake.operators.retention import expand_rules
    runs = spark.createDataFrame([("r", "other", "/r"), ("q", None, "/q")], "run string, workflow string, run_path string")
    manifest = spark.createDataFrame([("/r", "S", "a", None), ("/q", None, None, "b")], "run_path string, sample string, fastq_1 string, fastq_2 string")
    rules = spark.createDataFrame([("w", "sample_files", "/x"), ("w", "run_files", "/y")], "workflow string, kind string, pattern string")
    assert sorted(r["file"] for r in expand_rules(runs, manifest, rules).collect()) == ["a", "b"]
