"""Operators against brute force on small literal inputs."""

import random



def test_latest_by_ties_and_nulls(spark):
    from seqlake.operators.latest import latest_by
    df = spark.createDataFrame([
        ("a", 5, 2, "x"), ("a", 5, 1, "y"), ("a", None, 0, "z"), ("b", None, 1, "n"), ("b", 3, 9, "m"),
    ], "k string, t long, tb long, v string")
    got = {r["k"]: r["v"] for r in latest_by(df, ["k"], ["t"], ["tb"]).collect()}
    assert got == {"a": "y", "b": "m"}


def test_rows_matching_latest_keeps_equal_rows(spark):
    from seqlake.operators.latest import rows_matching_latest
    df = spark.createDataFrame([
        ("1", "m", "e", 10), ("2", "m", "e", 10), ("3", "q", "e", 10), ("4", "m", "e", 5),
    ], "id string, method string, ent string, t long")
    got = sorted(r["id"] for r in rows_matching_latest(df, ["ent"], ["method", "t"], ["t"], ["id"]).collect())
    assert got == ["1", "2"]


def test_first_rows_are_marked_and_none_dropped(spark):
    from seqlake.operators.latest import first_rows_marked
    for n in (0, 10, 11, 19, 40):
        got = first_rows_marked(spark.range(n).withColumnRenamed("id", "x"), "x", 19, ["x"]).collect()
        assert sorted((r["x"], r["start"]) for r in got) == [(i, i < 19) for i in range(n)]


def test_latest_with_null_method(spark):
    from seqlake.operators.latest import rows_matching_latest
    df = spark.createDataFrame([("1", None, "a", 5), ("2", "m", "a", 4), ("3", None, "a", 5)], "id string, method string, ent string, t long")
    assert sorted(r["id"] for r in rows_matching_latest(df, ["ent"], ["method", "t"], ["t"], ["id"]).collect()) == ["1", "3"]


def test_group_row_number_matches_brute_force_under_skew(spark):
    from seqlake.operators.ranking import group_row_number
    random.seed(3)
    rows = [("hot" if random.random() < 0.5 else f"k{random.randint(0, 20)}", i) for i in random.sample(range(5000), 3000)]
    df = spark.createDataFrame(rows, "k string, line long")
    got = {(r["k"], r["line"]): r["n"] for r in group_row_number(df, ["k"], "line", span=64).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        for n, line in enumerate(sorted(line for kk, line in rows if kk == k), 1):
            want[(k, line)] = n
    assert got == want


def test_batch_number_dense(spark):
    from seqlake.operators.ranking import batch_number
    df = spark.createDataFrame([(f"p{i:04d}",) for i in random.sample(range(1000), 555)], "dest string")
    got = sorted((r["dest"], r["batch"]) for r in batch_number(df.repartition(7), ["dest"], 20).collect())
    assert [b for _, b in got] == [i // 20 for i in range(555)]


def test_read_pairs_first_mate_and_missing_mate(spark):
    from seqlake.operators.pairs import read_pairs
    df = spark.createDataFrame([
        ("A", "A_R1_001.fastq.gz", "s3://x/2"), ("A", "A_R1_001.fastq.gz", "s3://x/1"),
        ("A", "A_R2_001.fastq.gz", "s3://y/9"), ("A", "A_R2_001.fastq.gz", "s3://y/3"),
        ("B", "B_R1.fastq.gz", "s3://b/1"), ("null", "n_R1.fastq.gz", "s3://n/1"), ("null", "n_R2.fastq.gz", "s3://n/2"),
    ], "id_alt string, file string, current string")
    got = {r["id_alt"]: (r["fastq_1"], r["fastq_2"]) for r in read_pairs(df).collect()}
    assert got == {"A": ("s3://x/1", "s3://y/3")}


def test_resolve_results_first_present_header(spark):
    from seqlake.operators.headers import resolve_results
    df = spark.createDataFrame([
        (["ID", "Auto_QC_Outcome", "qc_outcome", "Species"], ["WA1234567-WA1", "", "PASS", "E coli, x"]),
        (["sample", "qc_outcome", "species", "species"], ["S1", "FAIL", "first", "last"]),
        (["sample", "qc_outcome"], ["S2"]),
    ], "header array<string>, cells array<string>")
    got = [(r["id"], r["qc"], r["species"]) for r in
           resolve_results(df, alternatives={"qc": ["Auto_QC_Outcome", "qc_outcome"], "species": ["Species", "species"]}).collect()]
    assert got == [("WA1234567", None, "E_coli;_x"), ("S1", "FAIL", "last"), ("S2", None, None)]


def test_infer_rules_reference_and_disjoint(spark):
    from seqlake.operators.retention import infer_rules
    files = spark.createDataFrame([("r", p) for p in [
        "/summary.tsv", "/S1/S1.tax", "/S10/S10.tax", "/S10/S10_R1.fq"]], "run string, rel string")
    samples = spark.createDataFrame([("r", "S1", 1), ("r", "S10", 2)], "run string, sample string, ord long")
    ref = {(r["kind"], r["pattern"]) for r in infer_rules(files, samples).collect()}
    dis = {(r["kind"], r["pattern"]) for r in infer_rules(files, samples, "disjoint").collect()}
    assert ("run_files", "/summary.tsv") in ref and ("run_files", "/S1/S1.tax") in ref
    assert dis & {("run_files", "/S1/S1.tax")} == set()
    assert ("sample_files", "/<sample>/<sample>.tax") in ref
    # S1 is inside S10 and is replaced first (manifest order), as the lab's fold does
    assert ("sample_files", "/<sample>0/<sample>0.tax") in ref


def test_expand_rules_unknown_workflow_keeps_reads(spark):
    from seqlake.operators.retention import expand_rules
    runs = spark.createDataFrame([("r1", "phoenix", "/runs/r1"), ("r2", "other", "/runs/r2")],
                                 "run string, workflow string, run_path string")
    man = spark.createDataFrame([("/runs/r1", "S1", "/reads/S1_1.fq.gz", None), ("/runs/r2", "S2", "/reads/S2_1.fq.gz", "/reads/S2_2.fq.gz")],
                                "run_path string, sample string, fastq_1 string, fastq_2 string")
    rules = spark.createDataFrame([("phoenix", "run_files", "/sum.tsv"), ("phoenix", "sample_files", "/<sample>/<sample>.tax")],
                                  "workflow string, kind string, pattern string")
    got = sorted((r["run"], r["sample"] or "", r["file"]) for r in expand_rules(runs, man, rules).collect())
    assert got == [("r1", "", "/runs/r1/sum.tsv"), ("r1", "S1", "/reads/S1_1.fq.gz"), ("r1", "S1", "/runs/r1/S1/S1.tax"),
                   ("r2", "S2", "/reads/S2_1.fq.gz"), ("r2", "S2", "/reads/S2_2.fq.gz")]


def test_samplesheet_rules(spark):
    from seqlake.operators.samplesheet import MSG_EXT, MSG_FIRST, MSG_FORMATS, MSG_PAIR, MSG_SAMPLE, sheet_errors, sheet_valid
    df = spark.createDataFrame([
        (2, "a b", "x_1.fastq.gz", "x_2.fastq.gz"), (3, "", "y.fq.gz", None), (4, "c", "", None),
        (5, "d", "z.bam", None), (6, "e", "z_1.fq.gz", "z_2.fastq.gz"), (7, "a b", "w_1.fq.gz", ""),
    ], "line long, sample string, fastq_1 string, fastq_2 string")
    errs = {r["line"]: r["error"] for r in sheet_errors(df).collect()}
    assert errs == {3: MSG_SAMPLE, 4: MSG_FIRST, 5: MSG_EXT + "z.bam" + MSG_FORMATS, 6: MSG_PAIR}
    ok = {r["line"]: (r["sample"], r["single_end"]) for r in sheet_valid(df).collect()}
    assert ok[2] == ("a_b_T1", False) and ok[7] == ("a_b_T2", True)
    assert sheet_valid(df).columns[:2] == ["sample", "single_end"]


def test_uri_cells_keep_id_cell_and_drop_nulls(spark):
    from seqlake.operators.reshape import uri_cells, uri_cells_from_lines
    df = spark.createDataFrame([("gs://b/id", "gs://b/1", None, "x y")], "id string, a string, b string, c string")
    got = sorted((r["attribute"], r["uri"]) for r in uri_cells(df, "id").collect())
    assert got == [("a", "gs://b/1"), ("id", "gs://b/id")]
    lines = spark.createDataFrame([("S1\tgs://b/a b,gs://c\tplain",)], "value string")
    assert sorted(r["uri"] for r in uri_cells_from_lines(lines).collect()) == ["gs://b/a_b", "gs://c"]


def test_time_window_rules():
    import pytest

    from seqlake.plans.ingest_runs import time_window
    assert time_window(now=100, delta=10) .start == 90
    w = time_window(now=100, delta=10, start=0, end=5)
    assert (w.start, w.end) == (0, 5)
    with pytest.raises(ValueError):
        time_window(now=100, delta=None)
    with pytest.raises(ValueError):
        time_window(now=100, start=1)
    with pytest.raises(ValueError):
        time_window(now=100, start=5, end=1)


def test_line_numbers_follow_file_order(spark, tmp_path):
    from seqlake.operators.ranking import line_numbers
    p = tmp_path / "f.txt"
    p.write_text("".join(f"row{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = line_numbers(spark.read.text(str(p))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["line"], r["value"]) for r in got) == [(i + 1, f"row{i}") for i in range(5000)]


def test_explode_list_and_newest_file(spark):
    from seqlake.operators.reshape import explode_list
    from seqlake.sources.files import newest_file_per_key
    df = spark.createDataFrame([("p", "ws1, ws2,ws3")], "project string, workspaces string")
    assert [r["workspaces"] for r in explode_list(df, "workspaces").collect()] == ["ws1", "ws2", "ws3"]
    listing = spark.createDataFrame([("p", "w", "/c/1", 5), ("p", "w", "/c/2", 9), ("p", "w", "/c/0", 9), ("q", "w", "/c/3", 1)],
                                    "project string, workspace string, path string, modified_ms long")
    got = {(r["project"], r["path"]) for r in newest_file_per_key(listing, ["project", "workspace"]).collect()}
    assert got == {("p", "/c/0"), ("q", "/c/3")}


def test_first_rows_keep_repeated_and_absent_ids(spark):
    from seqlake.operators.latest import first_rows_marked
    rows = [("a", 1), ("a", 1), ("b", 2), (None, 1), (None, 3), ("c", None)]
    df = spark.createDataFrame(rows, "x string, t int")
    got = sorted(((r["x"], r["t"], r["start"]) for r in first_rows_marked(df, "x", 3, ["t"]).collect()), key=str)
    # null times and ids come first: (c, null), (null, 1), (a, 1) and the row that equals it
    assert got == sorted([("a", 1, True), ("a", 1, True), ("b", 2, False), (None, 1, True), (None, 3, False), ("c", None, True)], key=str)
    many = spark.createDataFrame([(g, i) for g in ("p", "q") for i in range(30)] + [(None, 5)], "g string, x int")
    marked = first_rows_marked(many, "x", 19, ["x"], by=["g"]).where("start").groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in marked} == {"p": 19, "q": 19, None: 1}


def test_sample_hits_are_the_real_ones_in_split_groups(spark):
    import random

    from seqlake.operators.retention import sample_hits
    r = random.Random(5)
    names = [(f"r{k}", "".join(r.choices("ab1", k=r.randrange(1, 4))), i) for k in range(3) for i in range(15)]
    files = list({(f"r{k}", "".join(r.choices("ab1/.", k=r.randrange(1, 12)))) for k in range(4) for _ in range(25)}) + [(None, "a")]
    want = sorted((run, rel, n, o) for run, rel in files for m, n, o in names if m == run and n in rel)
    f = spark.createDataFrame(files, "run string, rel string")
    s = spark.createDataFrame([*names, (None, "a", 0)], "run string, sample string, ord long")
    assert want
    for per_group in ((4, 3), (50_000, 200_000)):
        assert sorted(tuple(x) for x in sample_hits(f, s, *per_group).collect()) == want      # a row for a hit, and no other


def test_value_text_equals_str(spark):
    import json

    from pyspark.sql import functions as F

    from seqlake.operators.reshape import value_text
    values = ["a b", "it's", "", 5, -7, True, False, [], {}, ["a", None, True, 3], {"k": [1, {"x": "y"}], "m": "say \"a\""}, ["it's", "x:y, z", "[b]"], "true", "None"]
    df = spark.createDataFrame([(i, json.dumps({"v": v})) for i, v in enumerate(values)] + [(100, '{"v": null}'), (101, "{}")], "i int, j string")
    got = {r["i"]: r["t"] for r in df.select("i", value_text(F.from_json("j", "map<string, variant>")["v"]).alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [str(v) for v in values]
    assert got[100] == got[101] == ""
