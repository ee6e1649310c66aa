"""Column functions on literal rows, one test per quirk."""

from pathlib import Path

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_extract_or_keep_and_normalize(spark):
    from seqlake.functions.ids import extract_or_keep, normalize_sample_id
    assert one(spark, extract_or_keep("v", r"WA\d{7}"), "xxWA1234567yy") == "WA1234567"
    assert one(spark, extract_or_keep("v", r"WA\d{7}"), "nothing") == "nothing"
    assert one(spark, normalize_sample_id("v"), "WA1234567-WA2") == "WA1234567"
    assert one(spark, normalize_sample_id("v"), "X2024JQ-00012-WA1") == "2024JQ-00012"
    assert one(spark, normalize_sample_id("v"), "null") == "null"


def test_last_matching_pattern_wins_and_none_text(spark):
    from seqlake.functions.ids import extract_last_match
    e = extract_last_match("v", [r"S\d+", r"WA\d{7}"])
    assert one(spark, e, "S12_WA1234567") == "WA1234567"
    assert one(spark, e, "S12_only") == "S12"
    assert one(spark, e, "zzz") == "None"


def test_sanitize(spark):
    from seqlake.functions.ids import sanitize
    assert one(spark, sanitize("v"), "E. coli, K-12") == "E._coli;_K-12"


def test_workflow_family_first_match_wins(spark):
    from seqlake.functions.text import normalize_workflow
    assert one(spark, normalize_workflow("v"), "PHoeNIx_theiaprok") == "phoenix"
    assert one(spark, normalize_workflow("v"), "TheiaProk_Illumina_PE") == "theiaprok"
    assert one(spark, normalize_workflow("v"), "ReCaPP") == "recapp"
    assert one(spark, normalize_workflow("v"), "BaseSpace_Fetch") == "basespace_fetch"
    assert one(spark, normalize_workflow("v"), "mycosnp") == "mycosnp"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab._/", min_size=0, max_size=12))
def test_last_two_suffixes_equal_pathlib(spark, name):
    from seqlake.functions.text import last_two_suffixes
    if name == "":
        return
    want = "".join(Path(name).suffixes[-2:])
    got = one(spark, last_two_suffixes("v"), name)
    assert got == want, name


def test_seconds_text_and_whole_seconds(spark):
    from seqlake.functions.timefmt import ms_to_seconds, seconds_text, whole_seconds
    assert one(spark, seconds_text(ms_to_seconds("v")), 1700000000500, "v long") == "1700000000.5"
    assert one(spark, seconds_text(ms_to_seconds("v")), 1700000000000, "v long") == "1700000000"
    assert one(spark, seconds_text(ms_to_seconds("v")), 1000, "v long") == "1"
    assert one(spark, whole_seconds("v"), " 42 ") == 42
    assert one(spark, whole_seconds("v"), "1700000000.5") is None
    assert one(spark, whole_seconds("v"), "timestamp") is None


def test_paths(spark):
    from seqlake.functions.paths import base_name, job_name, lake_path, uri_bucket, uri_key, uri_scheme, uri_text
    assert one(spark, base_name("v"), "s3://b/run/x.tsv") == "x.tsv"
    assert one(spark, base_name("v"), "s3://b/run/") == "run"
    assert one(spark, uri_scheme("v"), "gs://bkt/a/b.fa") == "gs"
    assert one(spark, uri_bucket("v"), "gs://bkt/a/b.fa") == "bkt"
    assert one(spark, uri_key("v"), "gs://bkt/a/b.fa") == "a/b.fa"
    assert one(spark, uri_text("v"), "file:///tmp/x") == "/tmp/x"
    assert one(spark, uri_text("v"), "file:/tmp/x") == "/tmp/x"
    assert one(spark, job_name(F.lit("phoenix"), "v"), "s3://b/run.1/") == "phoenix_run-1"
    df = spark.createDataFrame([(None, "wf", "r", "f.txt", "17")], "s string, w string, r string, f string, t string")
    assert df.select(lake_path("s3://out/", "s", "w", "r", "f", "t")).first()[0] == \
        "s3://out/data/id=null/workflow=wf/run=r/file=f.txt/timestamp=17/f.txt"


def test_predicates(spark):
    from seqlake.functions.predicates import full_match, looks_like_read, qc_not_failed
    df = spark.createDataFrame([("FAIL",), ("PASS",), (None,), ("fail",)], "v string")
    assert [r[0] for r in df.where(qc_not_failed("v")).collect()] == ["PASS", None, "fail"]
    assert one(spark, full_match("v", r".*_R[12].*.fastq.gz"), "S_R1_001.fastq.gz") is True
    assert one(spark, full_match("v", r".*_R[12].*.fastq.gz"), "S_R1_001.fastq.gz.md5") is False
    # asymmetric read test: '_R1' or 'R2'
    assert one(spark, looks_like_read("v"), "xR1.fq") is False
    assert one(spark, looks_like_read("v"), "xR2.fq") is True


def test_epoch_micros_ignores_session_zone(spark):
    import datetime as dt

    from seqlake.functions.timefmt import epoch_micros
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 0, 123456),)], "t timestamp_ntz")
    want = int((dt.datetime(2024, 3, 10, 2, 30, 0, 123456) - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(epoch_micros("t")).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_collapse_ws_and_entity_name(spark):
    from seqlake.functions.text import collapse_ws, entity_name, strip_set
    assert one(spark, collapse_ws("v"), "  SELECT *\n\t FROM  t ") == "SELECT * FROM t"
    assert one(spark, entity_name("v"), "sample_set:abc:d") == "sample_set"
    assert one(spark, strip_set("v"), "sample_set") == "sample"
    assert one(spark, strip_set("v"), "set_sample") == "set_sample"


def test_last_segment_as_the_patterns_have_it(spark):
    """Names and parents equal those of the patterns, and no pattern is searched where the text ends in no line break."""
    from seqlake.functions.paths import base_name, parent_dir
    texts = ["", "/", "///", "a", "a/", "/a", "//a//", "a/b", "a//b", "/a/b//", "s3://b/k/x.tsv", "s3://b/k/x/", "é/ü", "a/\n", "a\n", "a/b\r\n/", "a/b/\n", "\n", "/\n", "a b/ c", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = df.select("v", base_name("v").alias("n"), parent_dir("v").alias("p"), F.regexp_extract("v", r"([^/]+)/*$", 1).alias("n0"),
                     F.regexp_replace("v", r"/*[^/]+/*$", "").alias("p0")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n, r.p) == (r.n0, r.p0), r
    # one segment of a million characters before a break within the text: the patterns try every place of it
    long = spark.range(1).select(F.concat(F.lit("a\n"), F.repeat(F.lit("b"), 1 << 20), F.lit("/c")).alias("v"))
    assert tuple(long.select(base_name("v"), F.length(parent_dir("v"))).first()) == ("c", 2 + (1 << 20))
