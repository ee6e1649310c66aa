"""File formats on temporary folders."""

import json
import os

import pytest


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_header_per_file_and_first_present_header(spark, tmp):
    from seqlake.operators.headers import resolve_results
    from seqlake.sources.files import read_tables_with_header
    write(f"{tmp}/a/Phoenix_Summary.tsv", "ID\tAuto_QC_Outcome\tqc_outcome\tSpecies\nWA1234567-WA9\t\tPASS\tE coli\n")
    write(f"{tmp}/b/terra_table.tsv", "entity_id\tqc_outcome\tspecies\nX2024JQ-00001\tFAIL\tK pneu\n\n")
    rows = read_tables_with_header(spark, [f"{tmp}/a/Phoenix_Summary.tsv", f"{tmp}/b/terra_table.tsv"])
    got = sorted((r["id"], r["qc"], r["species"]) for r in resolve_results(rows).collect())
    assert got == [("2024JQ-00001", "FAIL", "K_pneu"), ("WA1234567", None, "E_coli")]


def test_listing_keeps_partition_text(spark, tmp):
    from seqlake.sources.files import list_files
    for p in ["data/id=0001/workflow=w/run=r/file=f/timestamp=1700000000.5/f",
              "data/id=null/workflow=w/run=r/file=g/timestamp=1700000001/g"]:
        write(f"{tmp}/{p}", "x")
    df = list_files(spark, f"{tmp}/data")
    assert set(df.columns) == {"path", "modified_ms", "length"}
    paths = sorted(r["path"] for r in df.collect())
    assert paths[0].startswith("/") and "id=0001" in paths[0] and "timestamp=1700000000.5" in paths[0]
    assert "id=null" in paths[1]


def test_paged_entities(spark, tmp):
    from seqlake.operators.reshape import entity_attributes, entity_table, page_count
    from seqlake.sources.files import read_json_docs
    ents = [{"name": f"s{i}", "attributes": {"a": f"gs://b/{i}", "n": i}} for i in range(5)]
    del ents[3]["attributes"]["a"]
    for k, chunk in enumerate([ents[0:2], ents[2:4], ents[4:]]):
        write(f"{tmp}/pages/p{k}.json", json.dumps({"results": chunk}))
    write(f"{tmp}/meta.json", json.dumps({"sample": {"count": 5, "idName": "sample_id", "attributeNames": ["n", "a"]}}))
    id_name, attrs, n = entity_attributes(read_json_docs(spark, f"{tmp}/meta.json"), "sample")
    assert (id_name, attrs, n, page_count(n, 2)) == ("sample_id", ["n", "a"], 5, 3)
    df = entity_table(read_json_docs(spark, f"{tmp}/pages"), id_name, attrs)
    assert df.columns == ["sample_id", "n", "a"]
    got = {r["sample_id"]: (r["n"], r["a"]) for r in df.collect()}
    assert got["s3"] == ("3", "") and got["s4"] == ("4", "gs://b/4") and len(got) == 5


@pytest.mark.parametrize("sep", [",", "\t", ";"])
def test_samplesheet_dialects(spark, tmp, sep):
    from seqlake.operators.samplesheet import SamplesheetError, validate_samplesheet
    good = sep.join(["sample", "fastq_1", "fastq_2"]) + "\n" + sep.join(["S 1", "a_1.fastq.gz", "a_2.fastq.gz"]) + "\n" \
        + sep.join(["S 1", "b_1.fastq.gz", ""]) + "\n"
    write(f"{tmp}/good.csv", good)
    out = validate_samplesheet(spark, f"{tmp}/good.csv", f"{tmp}/out")
    assert [tuple(r) for r in out.collect()] == [("S_1_T1", False, "a_1.fastq.gz", "a_2.fastq.gz"),
                                                ("S_1_T2", True, "b_1.fastq.gz", None)]
    bad = sep.join(["sample", "fastq_1", "fastq_2"]) + "\n" + sep.join(["S1", "a_1.fastq.gz", "a_2.fq.gz"]) + "\n"
    write(f"{tmp}/bad.csv", bad)
    with pytest.raises(SamplesheetError, match="On line 2"):
        validate_samplesheet(spark, f"{tmp}/bad.csv")
    write(f"{tmp}/cols.csv", sep.join(["sample", "fastq_1"]) + "\n" + sep.join(["S1", "a.fq.gz"]) + "\n")
    with pytest.raises(SamplesheetError, match="must contain"):
        validate_samplesheet(spark, f"{tmp}/cols.csv")


def test_rules_config_round_trip(spark, tmp):
    from seqlake.sources.files import read_rules_config, write_rules_config
    text = ("phoenix {\n    run_files    = [\n        '/a.tsv',\n        '/b.yml']\n"
            "    sample_files = [\n        '/<sample>/<sample>.tax'\n                  ]\n}\n"
            "other {\n    run_files = [ '/x' ]\n    sample_files = [ ]\n}\n")
    write(f"{tmp}/r.config", text)
    df = read_rules_config(spark, f"{tmp}/r.config")
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("other", "run_files", "/x"), ("phoenix", "run_files", "/a.tsv"), ("phoenix", "run_files", "/b.yml"),
                   ("phoenix", "sample_files", "/<sample>/<sample>.tax")]
    write(f"{tmp}/r2.config", write_rules_config(df))
    assert sorted(tuple(r) for r in read_rules_config(spark, f"{tmp}/r2.config").collect()) == got


def test_infer_rules_from_run_folder(spark, tmp):
    from seqlake.operators.retention import infer_retention_rules
    run = f"{tmp}/run1"
    write(f"{run}/manifest.csv", "sample,fastq_1,fastq_2\nS1,/r/S1_1.fq.gz,\nS10,/r/S10_1.fq.gz,\n")
    for p in ["summary.tsv", "S1/S1.tax", "S10/S10.tax"]:
        write(f"{run}/{p}", "x")
    got = {(r["kind"], r["pattern"]) for r in infer_retention_rules(spark, run, "wf", mode="disjoint").collect()}
    # disjoint mode replaces the longest name first: S10 is not read as S1 + "0"
    assert got == {("run_files", "/manifest.csv"), ("run_files", "/summary.tsv"),
                   ("sample_files", "/<sample>/<sample>.tax")}


def test_sniff_delimiter(spark, tmp):
    from seqlake.sources.files import sniff_delimiters
    write(f"{tmp}/a.csv", "a;b;c\n1;2;3\n")
    write(f"{tmp}/b.tsv", "a\tb\n1\t2\n")
    got = {os.path.basename(r["file_path"]): r["sep"] for r in sniff_delimiters(spark, [f"{tmp}/a.csv", f"{tmp}/b.tsv"]).collect()}
    assert got == {"a.csv": ";", "b.tsv": "\t"}


def test_header_per_file_over_many_splits(spark, tmp):
    from seqlake.sources.files import read_tables_with_header
    body = "".join(f"S{i}\t{i}\n" for i in range(3000))
    write(f"{tmp}/a.tsv", "ID\tn\n" + body)
    write(f"{tmp}/b.tsv", "sample\tm\nX\t1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        big = read_tables_with_header(spark, [f"{tmp}/a.tsv", f"{tmp}/b.tsv"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = read_tables_with_header(spark, [f"{tmp}/a.tsv", f"{tmp}/b.tsv"]).collect()
    key = lambda r: (r["file_path"], tuple(r["header"]), tuple(r["cells"]))
    assert sorted(map(key, big)) == sorted(map(key, whole))
    assert len(big) == 3001
    lines = [r["cells"][0] for r in sorted(big, key=lambda r: (r["block"], r["line_no"])) if r["file_path"].endswith("a.tsv")]
    assert lines == [f"S{i}" for i in range(3000)]


def test_every_file_has_its_own_header(spark, tmp):
    from seqlake.sources.files import read_manifests, read_named
    write(f"{tmp}/a/manifest.csv", "sample,fastq_1,fastq_2\nS1,r1,r2\n")
    write(f"{tmp}/b/manifest.csv", '"sample",single_end,fastq_1,fastq_2\n"S2",true,q1,\n')
    write(f"{tmp}/c/manifest.csv", "fastq_2,fastq_1,sample\nz2,z1,S3\n")
    got = {tuple(r)[1:] for r in read_manifests(spark, [f"{tmp}/{d}" for d in "abc"]).collect()}
    assert got == {("S1", "r1", "r2"), ("S2", "q1", None), ("S3", "z1", "z2")}
    write(f"{tmp}/s/1.tsv", "submissionId\tstatus\n7\tDone\n")
    write(f"{tmp}/s/2.tsv", "status\tsubmissionId\nDone\t8\n")
    assert sorted(r["submissionId"] for r in read_named(spark, f"{tmp}/s", ["submissionId", "status"], "\t").collect()) == ["7", "8"]


def test_every_bad_line_is_reported(spark, tmp):
    from seqlake.operators.samplesheet import SamplesheetError, validate_samplesheet
    write(f"{tmp}/bad.csv", "sample,fastq_1,fastq_2\n" + "".join(f"S{i},r{i}.bam,\n" for i in range(200)))
    with pytest.raises(SamplesheetError) as e:
        validate_samplesheet(spark, f"{tmp}/bad.csv")
    assert all(f"On line {i + 2}." in str(e.value) for i in range(200))


def test_delimiter_is_judged_by_every_line(spark, tmp):
    from seqlake.sources.files import sniff_delimiters
    write(f"{tmp}/a.csv", "a;b\n" + "1;2\n" * 30 + "x,y;z\n" + '"q;r";s\n')
    write(f"{tmp}/b.csv", "a,b\n" + "1,2\n" * 30 + "1;2\n")
    got = {r["file_path"][-5:]: r["sep"] for r in sniff_delimiters(spark, f"{tmp}").collect()}
    assert got == {"a.csv": ";", "b.csv": None}


def test_folders_named_by_rows(spark, tmp):
    from seqlake.sources.listing import list_folders, paths_status, read_lines
    for k in range(40):
        write(f"{tmp}/runs/run_{k:02d}/manifest.csv", f"sample,fastq_1,fastq_2\nS{k},/r/{k}_R1.fq,\n")
        write(f"{tmp}/runs/run_{k:02d}/S{k}/S{k}.tax", "xyz")
    folders = spark.createDataFrame([(f"{tmp}/runs/run_{k:02d}",) for k in range(40)] + [(f"{tmp}/absent",), (None,), (f"{tmp}/runs/run_00",)], "path string")
    got = list_folders(folders).where("not is_dir").collect()
    assert sorted(r["path"] for r in got) == sorted(f"{tmp}/runs/run_{k:02d}/{x}" for k in range(40) for x in ("manifest.csv", f"S{k}/S{k}.tax"))
    assert {r["length"] for r in got if r["name"].endswith(".tax")} == {3} and all(r["modified_ms"] > 10**12 for r in got)
    flat = list_folders(folders, recursive=False).collect()
    assert sum(r["is_dir"] for r in flat) == 40 and len(flat) == 80
    assert list_folders(folders, recursive=False, glob="manifest.csv").count() == 40
    named = spark.createDataFrame([(f"file:{tmp}/runs/",), (f"{tmp}/absent",), (f"{tmp}/runs/run_00/manifest.csv",)], "path string")
    assert sorted((r["path"], r["is_dir"]) for r in paths_status(named).collect()) == [(f"{tmp}/runs", True), (f"{tmp}/runs/run_00/manifest.csv", False)]
    lines = read_lines(list_folders(folders, glob="*.csv")).collect()
    assert len(lines) == 80 and {r["line"] for r in lines if r["line_no"] == 0} == {"sample,fastq_1,fastq_2"}


def test_manifests_of_folders_named_by_rows(spark, tmp):
    from seqlake.sources.files import read_manifests
    write(f"{tmp}/a/manifest.csv", "sample,fastq_1,fastq_2\nS1,/x_R1,/x_R2\nS2,/y_R1,\n")
    write(f"{tmp}/b/manifest.csv", 'fastq_1,extra,"sample"\r\n"/z_R1",q,S3\r\n')
    write(f"{tmp}/c/manifest.csv", "")
    df = spark.createDataFrame([(f"{tmp}/{x}",) for x in ("a", "b/", "c", "d")], "run_path string")
    got = sorted(tuple(r) for r in read_manifests(spark, df).collect())
    assert got == [(f"{tmp}/a", "S1", "/x_R1", "/x_R2"), (f"{tmp}/a", "S2", "/y_R1", None), (f"{tmp}/b", "S3", "/z_R1", None)]
