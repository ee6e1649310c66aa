"""Streams: reruns add nothing, replays are idempotent, redeliveries dedupe."""

import datetime as dt

import pytest
from pyspark.sql import functions as F


def _subs(spark, n=40):
    base = dt.datetime(2024, 1, 1)
    rows = [(str(i), "m", f"e{i % 4}", base + dt.timedelta(hours=i), "Done", '{"Succeeded":1}') for i in range(n)]
    return spark.createDataFrame(rows, "submission_id string, method string, entity_raw string, "
                                       "submission_date timestamp, status string, workflow_statuses string")


def test_available_now_twice_equals_one_batch(spark, tmp):
    from seqlake.plans.submissions import candidates
    from seqlake.streaming.ingest import file_stream, land, ledgered_sink, run, seed_ledger
    subs = _subs(spark)
    types = spark.createDataFrame([("e0",), ("e1",), ("e2",)], "entity_type string")
    land(subs, f"{tmp}/landed", 4)
    seed_ledger(spark.createDataFrame([("0",), ("1",)], "submission_id string"), f"{tmp}/ledger", "submission_id")
    sink = ledgered_sink(spark, "submission_id", f"{tmp}/ledger", f"{tmp}/out")
    stream = lambda: candidates(file_stream(spark, f"{tmp}/landed", subs.schema, max_files=1), types)
    run(stream(), f"{tmp}/ckpt", sink=sink)
    first = sorted(r[0] for r in spark.read.parquet(f"{tmp}/out").select("submission_id").collect())
    want = sorted(str(i) for i in range(40) if i % 4 != 3 and i not in (0, 1))
    assert first == want
    run(stream(), f"{tmp}/ckpt", sink=sink)   # nothing new landed
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp}/out").select("submission_id").collect()) == want
    land(_subs(spark, 44).where(F.col("submission_id").cast("int") >= 40), f"{tmp}/landed", 1)
    run(stream(), f"{tmp}/ckpt", sink=sink)   # a later delivery: only the new ids
    got = sorted(r[0] for r in spark.read.parquet(f"{tmp}/out").select("submission_id").collect())
    assert got == sorted(want + ["40", "41", "42"])


def test_replayed_batch_is_idempotent(spark, tmp):
    from seqlake.streaming.ingest import ledgered_sink
    sink = ledgered_sink(spark, "submission_id", f"{tmp}/ledger", f"{tmp}/out")
    batch = _subs(spark, 5)
    sink(batch, 0)
    sink(batch, 0)        # replay of the same batch after a crash
    assert spark.read.parquet(f"{tmp}/out").count() == 5
    sink(batch, 1)        # the same ids in a later batch are already done
    assert spark.read.parquet(f"{tmp}/out").count() == 5


def test_two_streams_on_one_ledger_keep_all_rows(spark, tmp):
    from seqlake.streaming.ingest import file_stream, land, ledgered_sink, run
    subs = _subs(spark, 10)
    sink = ledgered_sink(spark, "submission_id", f"{tmp}/ledger", f"{tmp}/out")
    land(subs.where("cast(submission_id as int) < 6"), f"{tmp}/one", 1)
    land(subs.where("cast(submission_id as int) >= 4"), f"{tmp}/two", 1)
    run(file_stream(spark, f"{tmp}/one", subs.schema), f"{tmp}/ckpt1", sink=sink)
    run(file_stream(spark, f"{tmp}/two", subs.schema), f"{tmp}/ckpt2", sink=sink)     # its batch ids start at 0 again
    got = spark.read.parquet(f"{tmp}/out")
    assert sorted(int(r[0]) for r in got.select("submission_id").collect()) == list(range(10))
    assert got.select("query").distinct().count() == 2


def test_upload_trigger_filter(spark):
    from seqlake.streaming.ingest import upload_triggers
    ev = spark.createDataFrame([("b", "runs/r1/Phoenix_Summary.tsv", None), ("b", "runs/r1/other.tsv", None),
                                ("b", "runs/r2/x/Phoenix_Summary.tsv", None)], "bucket string, key string, eventTime timestamp")
    assert sorted(r["run"] for r in upload_triggers(ev).collect()) == ["s3://b/runs/r1/", "s3://b/runs/r2/x/"]


def test_redelivered_records_dedupe_across_batches(spark, tmp):
    from seqlake.streaming.ingest import dedupe_within, file_stream, land, run
    subs = _subs(spark, 30)
    land(subs, f"{tmp}/landed", 2)
    land(subs.where(F.col("submission_id").cast("int") > 20), f"{tmp}/landed", 1)   # redelivery, later
    stream = dedupe_within(file_stream(spark, f"{tmp}/landed", subs.schema, max_files=2),
                           ["submission_id"], "submission_date", "30 days")
    run(stream, f"{tmp}/ckpt", path=f"{tmp}/out")
    got = spark.read.parquet(f"{tmp}/out")
    assert got.count() == 30 and got.select("submission_id").distinct().count() == 30


@pytest.mark.parametrize("forget", [None, 10**6])
def test_versions_of_replayed_and_late_events(spark, tmp, forget):
    from seqlake.streaming.ingest import VERSION_SCHEMA, file_stream, land, newer_versions, run

    def deliver(rows):
        land(spark.createDataFrame(rows, VERSION_SCHEMA), f"{tmp}/in", 1)
        stream = newer_versions(file_stream(spark, f"{tmp}/in", VERSION_SCHEMA), forget_after_ms=forget)
        run(stream, f"{tmp}/ckpt", path=f"{tmp}/out", state_partitions=2)
        return sorted((tuple(r) for r in spark.read.schema(VERSION_SCHEMA).parquet(f"{tmp}/out").collect()), key=str)

    a, b = ("r", "S1", "x.tsv"), ("r", None, "y.tsv")
    first = [(*a, 5), (*a, 7), (*b, 1)]
    assert deliver([(*a, 5), (*a, 5), (*a, 7), (*b, 1)]) == sorted(first, key=str)
    assert deliver([(*a, 7), (*b, 1), (*a, 6)]) == sorted(first, key=str)         # a replay and a late older event
    assert deliver([(*a, 9), (*b, None)]) == sorted([*first, (*a, 9)], key=str)


def test_versions_of_many_objects_share_states(spark, tmp):
    """Thousands of objects make no more states than groups, and their versions are those of each object alone."""
    from seqlake.streaming.ingest import OBJECT_GROUPS, VERSION_SCHEMA, file_stream, land, newer_versions, run
    ids = spark.range(3000)
    base = ids.select(F.lit("r").alias("run"), F.concat(F.lit("S"), "id").alias("sample"), F.when(F.col("id") % 3 > 0, "x.tsv").alias("file"),
                      (F.col("id") % 7).alias("modified_ms"))
    for rows in (base, base, base.withColumn("modified_ms", F.col("modified_ms") + F.when(F.col("sample").endswith("5"), 1).otherwise(-1))):
        land(rows, f"{tmp}/in", 2)
        q = run(newer_versions(file_stream(spark, f"{tmp}/in", VERSION_SCHEMA)), f"{tmp}/ckpt", path=f"{tmp}/out", state_partitions=2)
        assert 0 < q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= OBJECT_GROUPS
    got = sorted((r["sample"], r["file"] or "", r["modified_ms"]) for r in spark.read.schema(VERSION_SCHEMA).parquet(f"{tmp}/out").collect())
    want = [(f"S{i}", "x.tsv" if i % 3 else "", i % 7 + more) for i in range(3000) for more in ((0, 1) if i % 10 == 5 else (0,))]
    assert got == sorted(want)


def test_forgotten_objects_leave_the_groups(spark, tmp):
    """Objects that the watermark has passed go from their groups' states; newer ones stay and replays of them make nothing."""
    from seqlake.streaming.ingest import VERSION_SCHEMA, file_stream, land, newer_versions, run

    def deliver(rows):
        land(spark.createDataFrame(rows, VERSION_SCHEMA), f"{tmp}/in", 1)
        q = run(newer_versions(file_stream(spark, f"{tmp}/in", VERSION_SCHEMA), forget_after_ms=1000), f"{tmp}/ckpt", path=f"{tmp}/out", state_partitions=2)
        return q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    deliver([("r", f"S{i}", "x", 10) for i in range(40)])
    deliver([("r", "late", "x", 100_000)])
    assert deliver([("r", "late", "x", 100_000), ("r", "S1", "x", 20)]) == 1
    got = {(r["sample"], r["modified_ms"]) for r in spark.read.schema(VERSION_SCHEMA).parquet(f"{tmp}/out").collect()}
    assert got == {*((f"S{i}", 10) for i in range(40)), ("late", 100_000)}
