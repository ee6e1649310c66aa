"""Incremental ingest with Structured Streaming (STR1-STR6).

The lab's jobs run on a schedule or on object events and stay correct on
rerun through a ledger of processed ids and versioned destination paths.
Here the same rules run as micro-batches:

* a file source over landed records (events, submission lists) with
  ``maxFilesPerTrigger`` for throttling and ``availableNow`` for
  scheduled catch-up runs (STR5, STR6);
* ``foreachBatch`` handlers that anti-join a ledger, write their output
  and then the ledger, both keyed by the batch id, so a replayed batch
  overwrites its own earlier attempt (STR2, STR3);
* watermarks with ``dropDuplicatesWithinWatermark`` for redelivered
  events inside a lookback window (STR4);
* a filter on the uploaded object name that turns summary uploads into
  run ingests (STR1).

Checkpoints, landed test data and outputs live below the shared folder
named by ``spark.checkpoint.dir`` (:func:`seqlake.session.shared_dir`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.paths import parent_dir
from ..functions.predicates import is_trigger_upload
from ..session import shared_dir

UPLOAD_EVENT_SCHEMA = "bucket string, key string, eventTime timestamp"


def land(df: DataFrame, path: str, files: int | None = None) -> None:
    """Append records as parquet files (one landed delivery)."""
    if files:
        df = df.repartition(files)
    df.write.mode("append").parquet(path)


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """Records landed under ``path``; at most ``max_files`` new files per
    micro-batch (the lab's batches of 20 files)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def dedupe_within(df: DataFrame, key: list[str], event_time: str, lookback: str = "30 days") -> DataFrame:
    """Drop redelivered records: a key seen within ``lookback`` of event
    time is emitted once; state older than the watermark is released."""
    # Watermarks need a TIMESTAMP column; local date-times are cast.
    marked = df.withColumn("_event_time", F.col(event_time).cast("timestamp"))
    return (marked.withWatermark("_event_time", lookback).dropDuplicatesWithinWatermark(key)
            .drop("_event_time"))


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(query_df: DataFrame, checkpoint: str, sink: Callable | None = None, path: str | None = None,
        available_now: bool = True, interval: str | None = None, state_partitions: int | None = None,
        rocksdb_state: bool = False):
    """Start a stream into ``foreachBatch(sink)`` or a parquet ``path``.

    ``available_now`` processes what has landed, in as many micro-batches as
    the source options ask for, then stops (a scheduled run); otherwise a
    ``processingTime`` trigger of ``interval`` keeps it running.

    ``state_partitions`` and ``rocksdb_state`` only matter for stateful
    queries: they are applied while the query starts (Spark then keeps
    them in the checkpoint for every restart) and the session's own
    settings are restored.  RocksDB keeps large dedupe state off the heap.
    """
    confs = {}
    if state_partitions:
        confs["spark.sql.shuffle.partitions"] = str(state_partitions)
    if rocksdb_state:
        confs["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    spark = query_df.sparkSession
    saved = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        w = query_df.writeStream.option("checkpointLocation", checkpoint)
        if sink is not None:
            w = w.foreachBatch(sink)
        else:
            w = w.format("parquet").option("path", path).outputMode("append")
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "10 seconds")
        q = w.start()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    if available_now:
        q.awaitTermination()
    return q


# ----------------------------------------------------- exactly once (STR2)
def ledgered_sink(spark: SparkSession, key: str, ledger_path: str, out_path: str,
                  work: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: rows whose ``key`` is not in the ledger are
    processed (``work``, default: kept as they are), written to
    ``out_path/query=<query>/batch=<id>``, and only then their keys are
    written to the same folder below ``ledger_path``.

    Both writes replace the folder of their own query and batch id, so a
    second stream or a new checkpoint, whose batch ids start at 0 again,
    never overwrites another's rows.  Ledger entries of the same query and
    batch are ignored when deciding what is new, so a batch replayed after
    a crash between the two writes redoes the same rows instead of
    finding them "seen" and emitting nothing.
    """
    jvm = spark.sparkContext._jvm

    def exists(p: str) -> bool:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)

    def handle(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        place, b = f"query={query}/batch={batch_id}", str(batch_id)
        new = batch.dropDuplicates([key])
        if exists(ledger_path):
            seen = spark.read.parquet(ledger_path).where((F.col("query") != query) | (F.col("batch") != b)).select(key)
            new = new.join(seen, key, "left_anti")
        if work is not None:
            new = work(new)
        new.write.mode("overwrite").parquet(f"{out_path}/{place}")
        done = spark.read.parquet(f"{out_path}/{place}").select(key)   # no recomputation of the batch
        done.write.mode("overwrite").parquet(f"{ledger_path}/{place}")

    return handle


def seed_ledger(ids: DataFrame, ledger_path: str, key: str) -> None:
    """Ids processed before the stream existed."""
    ids.select(key).write.mode("overwrite").parquet(f"{ledger_path}/query=seed/batch=seed")


# --------------------------------------------------------- uploads (STR1)
def upload_triggers(events: DataFrame, target: str | None = None, scheme: str = "s3") -> DataFrame:
    """Object-created events ``(bucket, key, eventTime)`` -> run folders to
    ingest.  Only uploads of the run summary start an ingest; everything
    else is ignored."""
    ok = is_trigger_upload("key") if target is None else is_trigger_upload("key", target)
    return events.where(ok).select(
        F.concat(F.lit(f"{scheme}://"), F.col("bucket"), F.lit("/"), parent_dir("key"), F.lit("/")).alias("run"),
        F.lit("phoenix").alias("workflow"), "eventTime")


def ingest_on_upload(spark: SparkSession, ingest: Callable[[list[tuple[str, str]]], object]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler calling ``ingest`` with the distinct
    ``(workflow, run)`` pairs of a micro-batch (a handful per batch).  The
    ingest itself is idempotent by versioned path, so a replayed batch
    copies nothing twice."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        runs = [(r["workflow"], r["run"]) for r in batch.select("workflow", "run").distinct().collect()]
        if runs:
            ingest(runs)

    return handle


# ------------------------------------------------- versions (STR3)
VERSION_SCHEMA = "run string, sample string, file string, modified_ms bigint"


#: Groups of objects that share a state; each is worked on at once, whatever number of objects it has.
OBJECT_GROUPS = 256


def newer_versions(events: DataFrame, forget_after_ms: int | None = None) -> DataFrame:
    """Streamed object events ``(run, sample, file, modified_ms)`` -> one row
    for every time of an object that is newer than any seen before.

    The state of an object is its newest time, kept over
    restarts with the stream's checkpoint.  Objects are dealt by the hash of their names to
    ``OBJECT_GROUPS`` groups, and a group's objects are compared with its state all at
    once.  A replayed or late older event makes
    nothing; several new times in one micro-batch make a version each,
    oldest first.  With ``forget_after_ms`` an event-time timer drops an object
    from the state once the stream has seen times that much newer than its
    newest; events older than that are late and make nothing.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    names = ["run", "sample", "file"]

    # defined here, so that tasks get them with the function
    def packed(newest) -> bytes:
        """Newest time of each object of a group (a frame) as compressed Arrow."""
        import pyarrow as pa
        kinds = pa.schema([*((n, pa.string()) for n in names), ("modified_ms", pa.int64())])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, kinds, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(pa.Table.from_pandas(newest, schema=kinds, preserve_index=False))
        return out.getvalue().to_pybytes()

    def unpacked(raw: bytes):
        import pyarrow as pa
        return pa.ipc.open_stream(raw).read_all().to_pandas()

    def versions(key, frames, state):
        import pandas as pd
        held = unpacked(bytes(state.get[0])) if state.exists else None
        if state.hasTimedOut:
            held = held[held["modified_ms"] + 1 > state.getCurrentWatermarkMs()]
            if len(held):
                state.update((packed(held),))
                state.setTimeoutTimestamp(max(int(held["modified_ms"].min()), state.getCurrentWatermarkMs()) + 1)
            else:
                state.remove()
            return
        new = pd.concat([pdf[[*names, "modified_ms"]].drop_duplicates() for pdf in frames], ignore_index=True).drop_duplicates()
        new["modified_ms"] = new["modified_ms"].astype("int64")
        if held is not None:
            # names may be null, and equal ones match
            new = new.merge(held.rename(columns={"modified_ms": "newest"}), "left", names)
            new = new[new["newest"].isna() | (new["modified_ms"] > new["newest"])]
            new = new[[*names, "modified_ms"]]
        if len(new):
            both = new if held is None else pd.concat([held, new], ignore_index=True)
            held = both.groupby(names, dropna=False, sort=False, as_index=False)["modified_ms"].max()
            state.update((packed(held),))
        if forget_after_ms and held is not None:
            state.setTimeoutTimestamp(max(int(held["modified_ms"].min()), state.getCurrentWatermarkMs()) + 1)
        if len(new):
            yield new.sort_values([*names, "modified_ms"], ignore_index=True)

    rows = events.select("run", "sample", "file", "modified_ms").where("modified_ms is not null")
    if forget_after_ms:
        rows = rows.withColumn("_at", F.timestamp_millis("modified_ms")).withWatermark("_at", f"{forget_after_ms} milliseconds")
    timer = GroupStateTimeout.EventTimeTimeout if forget_after_ms else GroupStateTimeout.NoTimeout
    group = F.pmod(F.xxhash64(*names), F.lit(OBJECT_GROUPS)).cast("int")
    return rows.withColumn("_group", group).groupBy("_group").applyInPandasWithState(versions, VERSION_SCHEMA, "newest binary", "append", timer)


# ------------------------------------------------------ registered demos
def stream_new_submissions(spark: SparkSession, submissions: DataFrame, entity_types: DataFrame,
                           seen_ids: DataFrame, files: int = 8, max_files: int | None = 2) -> DataFrame:
    """Scheduled only-new check as a stream: landed submission records are
    filtered (done, succeeded, known entity), ids already in the ledger
    are skipped, the rest are written and then recorded.  Returns what the
    stream wrote."""
    from ..plans.submissions import candidates

    root = shared_dir(spark, "stream-new-ids")
    src, ledger, out = f"{root}/landed", f"{root}/ledger", f"{root}/out"
    land(submissions, src, files)
    seed_ledger(seen_ids, ledger, "submission_id")
    stream = file_stream(spark, src, submissions.schema, max_files=max_files)
    run(candidates(stream, entity_types), f"{root}/checkpoint",
        sink=ledgered_sink(spark, "submission_id", ledger, out))
    return spark.read.parquet(out).drop("query", "batch")


def stream_deduped_submissions(spark: SparkSession, submissions: DataFrame, lookback: str = "30 days",
                               files: int = 8) -> DataFrame:
    """Redelivered submission records (every record landed twice) are
    emitted once.  Returns the sink's rows."""
    root = shared_dir(spark, "stream-dedupe")
    src, out = f"{root}/landed", f"{root}/out"
    land(submissions, src, files)
    land(submissions, src, files)        # the redelivery
    stream = file_stream(spark, src, submissions.schema)
    run(dedupe_within(stream, ["submission_id"], "submission_date", lookback), f"{root}/checkpoint", path=out,
        state_partitions=spark.sparkContext.defaultParallelism, rocksdb_state=True)
    return spark.read.parquet(out)


def stream_file_versions(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Deliveries of object events ``(..., modified_ms, delivery)``, each one
    landed twice, in order, one micro-batch a landing.  Returns the versions
    that the stream made."""
    root = shared_dir(spark, "stream-versions")
    src, out = f"{root}/landed", f"{root}/out"
    deliveries = sorted(r[0] for r in events.select("delivery").distinct().collect())      # a handful
    for k in deliveries:
        for _ in range(2):                  # the second landing is a replay
            land(events.where(F.col("delivery") == k).select("run", "sample", "file", "modified_ms"), src)
            run(newer_versions(file_stream(spark, src, VERSION_SCHEMA)), f"{root}/checkpoint", path=out, state_partitions=spark.sparkContext.defaultParallelism)
    if not deliveries:
        return spark.createDataFrame([], VERSION_SCHEMA)
    return spark.read.schema(VERSION_SCHEMA).parquet(out)
