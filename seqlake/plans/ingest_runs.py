"""JOB1 ``ingest_runs``: copy the files worth keeping from workflow run
folders into the versioned results lake (FLT1-FLT3, EXP5, SNK1-SNK3,
SNK11-SNK12, JON5, WIN3, AGG5, AGG8, AGG14).

Steps 1-5 are one lazy plan; the copy is one distributed action over the
written plan, and the catalog rows are those whose copy succeeded.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import base_name, lake_path, null_text, uri_text
from ..functions.predicates import within
from ..functions.timefmt import ms_to_seconds, round_seconds, seconds_text
from ..operators.joins import missing_from, present_in
from ..operators.ranking import batch_number
from ..operators.retention import existing_files, expand_rules

BATCH_SIZE = 20
BATCH_SECONDS = 10.0
DEFAULT_DELTA = 1_000_000_000


@dataclass(frozen=True)
class Window:
    start: float
    end: float


def time_window(now: float | None = None, delta: float | None = DEFAULT_DELTA,
                start: float | None = None, end: float | None = None) -> Window:
    """``start ?: now - delta`` .. ``end ?: now``; start and end go together
    and take precedence over delta.  ``None`` means unset (0 is a time)."""
    now = time.time() if now is None else now
    if delta is None and start is None and end is None:
        raise ValueError("Provide a timespan using delta, or start and end")
    if (start is None) != (end is None):
        raise ValueError("Both start and end must be given when not using delta")
    if start is not None and end < start:
        raise ValueError("start must be smaller than end")
    s = start if start is not None else now - delta
    e = end if end is not None else now
    return Window(s, e)


def runs_in_window(run_listing: DataFrame, manifests: DataFrame, window: Window) -> DataFrame:
    """Run folders modified inside the window that hold a ``manifest.csv``.

    ``run_listing``: ``(path, modified_ms, is_dir)``; ``manifests``: listing
    ``(path)`` of manifest objects.  Output ``(run_path, run, seconds)``.
    """
    secs = ms_to_seconds("modified_ms")
    runs = (run_listing.where(F.col("is_dir") & within(secs, window.start, window.end))
            .select(F.regexp_replace("path", "/+$", "").alias("run_path"), secs.alias("seconds")))
    mf = manifests.select(F.regexp_replace("path", "/manifest\\.csv$", "").alias("run_path"))
    runs = present_in(runs, mf, ["run_path"])
    return runs.withColumn("run", base_name("run_path"))


def transfer_plan(files: DataFrame, out: str, file_times: DataFrame | None = None) -> DataFrame:
    """Destination of every kept file, one row per distinct transfer.

    ``files``: ``(run, workflow, sample, file, seconds)`` where ``seconds``
    is the run folder's time (version by run).  With ``file_times``
    ``(path, modified_ms)`` each file is versioned by its own rounded time
    instead (version by file).
    """
    if file_times is not None:
        ft = file_times.select(F.col("path").alias("file"), round_seconds(ms_to_seconds("modified_ms")).alias("_ft"))
        files = files.join(ft, "file", "left").withColumn("seconds", F.coalesce(F.col("_ft").cast("decimal(18,3)"), "seconds")).drop("_ft")
    p = files.select(
        "run", "workflow", "sample",
        uri_text("file").alias("origin"),
        base_name("file").alias("file"),
        seconds_text("seconds").alias("timestamp"),
    )
    p = p.withColumn("dest", lake_path(out, "sample", "workflow", "run", "file", "timestamp"))
    return p.distinct()


def pending_transfers(plan: DataFrame, lake_listing: DataFrame, path: str = "path") -> DataFrame:
    """Versioned paths already in the lake are skipped (rerun-safe)."""
    return missing_from(plan, lake_listing, ["dest"], [path])


def transfer_batches(pending: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Throttle groups of ``size`` files in destination order."""
    return batch_number(pending, ["dest"], size)


def observed(moved: DataFrame, name: str = "transfer"):
    """Attach run counters (files moved, run-level files among them) that
    are filled in by the action that consumes ``moved`` (AGG14, SNK11):
    no second pass over the data."""
    from pyspark.sql import Observation
    obs = Observation(name)
    run_level = F.sum(F.when(F.col("sample").isNull(), 1).otherwise(0)) if "sample" in moved.columns else F.lit(0)
    return moved.observe(obs, F.count(F.lit(1)).alias("files"), run_level.alias("run_level")), obs


def run_summary(pending: DataFrame) -> DataFrame:
    """Runs being transferred with their version and file count."""
    return pending.groupBy("run", "timestamp").agg(F.count(F.lit(1)).alias("files"))


def catalog_rows(moved: DataFrame) -> DataFrame:
    """Catalog lines ``id,workflow,run,file,timestamp,origin,current``; the
    time is in whole seconds, as its readers want it, while ``current``
    keeps the version folder's exact one."""
    whole = round_seconds(F.col("timestamp").cast("decimal(18,3)")).cast("string").alias("timestamp")
    return moved.select(null_text("sample").alias("id"), "workflow", "run", "file", whole, "origin",
                        F.col("dest").alias("current"))


def plan_runs(run_listing: DataFrame, manifests_listing: DataFrame, manifest_rows: DataFrame, rules: DataFrame,
              source_listing: DataFrame, workflow_of_run: DataFrame, window: Window, out: str) -> DataFrame:
    """Whole planning step of the production ingest.

    ``manifest_rows``: ``(run_path, sample, fastq_1, fastq_2)``;
    ``workflow_of_run``: ``(run_path, workflow)`` from the run samplesheet.
    """
    runs = runs_in_window(run_listing, manifests_listing, window).join(workflow_of_run, "run_path")
    expanded = expand_rules(runs.select("run", "workflow", "run_path"), manifest_rows, rules)
    kept = existing_files(expanded, source_listing)
    kept = kept.join(runs.select("run_path", "seconds"), "run_path")
    return transfer_plan(kept, out)


# ---------------------------------------------------------------- runner
def ingest_runs(spark, samplesheet, rules_path: str, outdir: str, window: Window,
                copier=None, run_id: str | None = None, rules_format: str = "config",
                version_by: str = "run", lake_index: str = "listing", batch_size: int | None = None,
                interval: float = BATCH_SECONDS) -> dict:
    """Run the whole production ingest against real folders.

    ``samplesheet``: CSV path or DataFrame with ``workflow`` and either
    ``path`` (a folder of runs) or ``run`` (one run folder).  Steps: list runs, keep those in the
    window with a manifest, expand the rules, keep files that exist, plan
    versioned destinations, drop those already in the lake, then
    copy and commit (:mod:`seqlake.sinks.committed`): catalog rows of the files
    that copied and the counters of the run become visible together.
    ``version_by='run'`` versions every file by its run folder's time (the
    production ingest); ``'file'`` by the file's own rounded time.
    ``lake_index`` says how "already in the lake" is decided: ``'listing'``
    lists the lake (exact, storage is the truth); ``'catalog'`` reads the
    ``current`` column of the catalog instead, which is far cheaper than
    listing billions of objects (run :func:`reconcile_catalog` after a lost
    catalog write).  ``batch_size`` paces the copies: so many files
    (:data:`BATCH_SIZE` is the lab's number) every ``interval`` seconds.
    """
    if lake_index not in ("listing", "catalog"):
        raise ValueError("lake_index must be 'listing' or 'catalog'")
    if version_by not in ("run", "file"):
        raise ValueError("version_by must be 'run' or 'file'")
    import uuid

    from ..sinks.committed import arrived, carry_out, publish
    from ..sinks.copy import local_copy
    from ..sinks.writers import write_table
    from ..sources import files as src
    from ..sources.listing import list_folders, paths_status
    from ..session import send_package, shared_dir

    send_package(spark)
    out = outdir.rstrip("/")
    run_id = run_id or f"{int(time.time())}-{uuid.uuid4()}"
    sheet = samplesheet if isinstance(samplesheet, DataFrame) else src.read_csv(spark, samplesheet)
    for c in ("path", "run"):
        if c not in sheet.columns:
            sheet = sheet.withColumn(c, F.lit(None).cast("string"))
    bare = lambda c: F.regexp_replace(uri_text(c), "/+$", "")
    wanted = sheet.select("workflow", F.nullif(bare("path"), F.lit("")).alias("parent"), F.nullif(bare("run"), F.lit("")).alias("run"))
    parents = wanted.where("parent is not null").select("parent", "workflow")
    singles = wanted.where("parent is null and run is not null").select(F.col("run").alias("path"), "workflow")
    # every listing is made inside tasks, from folder names held as rows
    listing = list_folders(parents, "parent", recursive=False).join(parents.distinct(), "parent")
    single = paths_status(singles).join(singles.withColumnRenamed("path", "parent").distinct(), "parent")
    cands = listing.unionByName(single).select(F.regexp_replace("path", "/+$", "").alias("path"), "modified_ms", "is_dir", "workflow")
    publish(spark, out)                                 # what a run that was cut short left unpublished
    work = shared_dir(spark, f"ingest-{run_id}")
    write_table(cands, f"{work}/candidates")            # the store is asked once for each folder
    cands = spark.read.parquet(f"{work}/candidates")
    manifests = list_folders(cands.where("is_dir"), recursive=False, glob="manifest.csv").select("path")
    runs = runs_in_window(cands.select("path", "modified_ms", "is_dir"), manifests, window)
    write_table(runs.join(cands.select(F.col("path").alias("run_path"), "workflow"), "run_path"), f"{work}/runs")
    runs = spark.read.parquet(f"{work}/runs")
    if runs.isEmpty():
        return {"run_id": run_id, "files": 0, "catalog": None}
    m = src.read_manifests(spark, runs.select("run_path"))
    rules = src.read_rules_config(spark, rules_path) if rules_format == "config" else src.read_rules(spark, rules_path)
    write_table(expand_rules(runs.select("run", "workflow", "run_path"), m, rules).withColumn("file", uri_text("file")), f"{work}/expanded")
    expanded = spark.read.parquet(f"{work}/expanded")
    # one recursive listing of the run folders; reads may lie in other folders, which are listed too if they are there
    outside = expanded.where(~F.startswith("file", F.concat("run_path", F.lit("/"))))
    elsewhere = outside.select(F.regexp_replace("file", "/[^/]+$", "").alias("path"))
    files = list_folders(runs, "run_path").unionByName(list_folders(elsewhere, recursive=False)).where("not is_dir")
    write_table(files.groupBy("path").agg(F.max("modified_ms").alias("modified_ms")), f"{work}/present")
    present = spark.read.parquet(f"{work}/present")
    kept = existing_files(expanded, present)
    plan = transfer_plan(kept.join(runs.select("run_path", "seconds"), "run_path"), out,
                         file_times=present if version_by == "file" else None)
    lake = arrived(spark, out, _lake_listing(spark, f"{out}/data")) if lake_index == "listing" else _catalog_index(spark, out)
    moved, counts = carry_out(spark, out, run_id, pending_transfers(plan, lake), copier or local_copy, catalog_rows,
                              batch_size=batch_size, interval=interval)
    publish(spark, out)
    return {"run_id": run_id, "files": counts["files"], "failed": counts["failed"], "run_level": counts["run_level"], "bytes": counts["bytes"],
            "catalog": f"{out}/meta/{run_id}.csv" if counts["files"] else None,
            "runs": [r.asDict() for r in run_summary(moved).orderBy("run").collect()] if counts["files"] else []}


def _catalog_index(spark, out: str) -> DataFrame:
    """Destinations the catalog already lists (one pruned column)."""
    from ..sources import files as src
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{out}/meta")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "path string")
    return src.read_catalog(spark, f"{out}/meta").select(uri_text("current").alias("path"))


def _lake_listing(spark, root: str) -> DataFrame:
    from ..sources import files as src
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "path string")
    return src.list_files(spark, root).select(uri_text("path").alias("path"))


def run_jobs(spark, run_list: str, outdir: str) -> DataFrame:
    """Headerless ``workflow,run_uri`` lines -> one ingest work item per
    run with its job name (SRC6, PRJ7, PRJ8); nothing is submitted."""
    from ..functions.paths import job_name
    from ..sources.files import read_csv
    runs = read_csv(spark, run_list, header=False, columns=["workflow", "run"])
    return runs.select("workflow", "run", job_name("workflow", "run").alias("job_name"),
                       F.lit(outdir).alias("outdir"))


def reconcile_catalog(spark, outdir: str, run_id: str | None = None) -> dict:
    """Catalog lake objects that no catalog file lists yet.

    A run that dies after copying but before writing its catalog rows
    leaves files in the lake that later runs skip (they exist).  The lake
    layout carries every catalog field except the origin, so such files
    are found by an anti join of the lake listing with the catalog and
    appended as one more catalog file.
    """
    import uuid

    from ..sinks.committed import publish
    from ..sinks.writers import append_if_any
    from ..sources import files as src

    out = outdir.rstrip("/")
    publish(spark, out)                 # committed rows have their origin
    lake = src.lake_catalog(spark, out)
    jvm = spark.sparkContext._jvm
    meta = jvm.org.apache.hadoop.fs.Path(f"{out}/meta")
    if meta.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(meta):
        known = src.read_catalog(spark, f"{out}/meta").select(uri_text("current").alias("current"))
        lake = lake.join(known, "current", "left_anti")
    run_id = run_id or f"{int(time.time())}-reconcile-{uuid.uuid4().hex[:8]}"
    orphans = lake.select(*["id", "workflow", "run", "file", "timestamp", "origin", "current"])
    path = f"{out}/meta/{run_id}.csv"
    wrote = append_if_any(orphans, path)
    return {"catalog": path if wrote else None, "files": orphans.count() if wrote else 0}
