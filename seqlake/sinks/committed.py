"""Transfers that become visible as a whole (SNK2, SNK3, SNK9, SNK11).

A run leaves four tables under ``<out>/transfers/<kind>/run_id=<id>``: its plan,
the status of every copy, the catalog rows of the files that arrived and
the ledger rows of the work that is done.  Nothing reads them until the run has a
commit file, ``<out>/commits/<id>.json``, which is put in place by one rename.
So a run that is killed at any moment has either catalogued its files and
recorded its ids, or neither; the next run finds the files of uncommitted
plans, plans them again, and their copies end at once where the file is whole.

The commit files are the table of runs as well: files, failures, run-level
files and bytes of each, counted by the copy itself while it runs.
What other readers want elsewhere (catalog CSV, ledger table) is published
after the commit, and once more by the next run where that was cut short.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PLAN_SCHEMA = "run string, workflow string, sample string, origin string, file string, timestamp string, dest string"
CATALOG_SCHEMA = "id string, workflow string, run string, file string, timestamp string, origin string, current string"
RUNS_SCHEMA = "run_id string, files bigint, failed bigint, run_level bigint, bytes bigint, committed_at double"


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system): works on every store that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, store = _path(spark, path)
    return store.exists(p)


def stage(df: DataFrame, out: str, run_id: str, kind: str) -> DataFrame:
    """Write one table of a run and read it back; nobody else sees it yet."""
    where = f"{out}/transfers/{kind}/run_id={run_id}"
    df.write.mode("overwrite").parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def commit(spark: SparkSession, out: str, run_id: str, facts: dict) -> None:
    """Make all tables of a run visible, by the rename of one small file."""
    text = json.dumps({"run_id": run_id, **facts})
    temporary, store = _path(spark, f"{out}/commits/_{run_id}.json")
    final, _ = _path(spark, f"{out}/commits/{run_id}.json")
    f = store.create(temporary, True)
    f.write(bytearray(text.encode()))
    f.close()
    if not store.rename(temporary, final) and not store.exists(final):
        raise OSError(f"the commit of {run_id} could not be put in place")


def runs(spark: SparkSession, out: str) -> DataFrame:
    """The committed runs with their counters, one row a run."""
    if not _exists(spark, f"{out}/commits"):
        return spark.createDataFrame([], RUNS_SCHEMA)
    return spark.read.schema(RUNS_SCHEMA).json(f"{out}/commits").where("run_id is not null")


def _staged(spark: SparkSession, out: str, kind: str, schema: str) -> DataFrame:
    where = f"{out}/transfers/{kind}"
    if not _exists(spark, where):
        return spark.createDataFrame([], f"{schema}, run_id string")
    return spark.read.schema(f"{schema}, run_id string").parquet(where)


def committed(spark: SparkSession, out: str, kind: str, schema: str) -> DataFrame:
    """Rows of a table from committed runs only, with their ``run_id``."""
    return _staged(spark, out, kind, schema).join(runs(spark, out).select("run_id"), "run_id", "left_semi")


def uncommitted(spark: SparkSession, out: str, kind: str, schema: str) -> DataFrame:
    """Rows of a table that runs left behind which never came to their commit."""
    return _staged(spark, out, kind, schema).join(runs(spark, out).select("run_id"), "run_id", "left_anti")


def arrived(spark: SparkSession, out: str, lake: DataFrame) -> DataFrame:
    """The listing ``lake`` (path) without files that only uncommitted plans brought: they have no catalog row yet."""
    lost = uncommitted(spark, out, "plan", PLAN_SCHEMA).select(F.col("dest").alias("path"))
    known = committed(spark, out, "catalog", CATALOG_SCHEMA).select(F.col("current").alias("path"))
    return lake.join(lost.join(known, "path", "left_anti"), "path", "left_anti")


def counted(status: DataFrame) -> tuple[DataFrame, Observation]:
    """The copies with counters that the action which makes them fills in."""
    seen = Observation("copies")
    here = F.col("ok") & F.contains(F.col("dest"), F.lit("/id=null/"))
    return status.observe(seen, F.count_if("ok").alias("files"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(here).alias("run_level"),
                          F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")), seen


def carry_out(spark: SparkSession, out: str, run_id: str, pending: DataFrame, copier, catalog: Callable[[DataFrame], DataFrame],
              ledger: Callable[[DataFrame], DataFrame] | None = None, batch_size: int | None = None,
              interval: float = 0.0) -> tuple[DataFrame, dict]:
    """Copy a plan and commit it: ``(moved rows, counters)``.

    ``catalog`` makes catalog rows of moved ones; ``ledger`` makes ledger rows
    of the copy status, if the job keeps a ledger.  Every step is written
    before the next one reads it, so copies are made once and an executor
    that is lost repeats its own tasks only.  With ``batch_size`` the plan
    carries batch numbers in destination order, and a batch is released
    every ``interval`` seconds.
    """
    import time

    from ..operators.ranking import batch_number
    from .copy import copy_files
    if batch_size:
        pending = batch_number(pending, ["dest"], batch_size)
    plan = stage(pending, out, run_id, "plan")
    status, seen = counted(copy_files(plan, copier, slot="batch" if batch_size else None, interval=interval))
    status = stage(status, out, run_id, "status")
    facts = {k: int(v or 0) for k, v in seen.get.items()}
    moved = plan.join(status.where("ok").select("dest"), "dest", "left_semi")
    stage(catalog(moved), out, run_id, "catalog")
    if ledger is not None:
        stage(ledger(status), out, run_id, "ledger")
    commit(spark, out, run_id, {**facts, "committed_at": time.time()})
    return moved, facts


def publish(spark: SparkSession, out: str) -> None:
    """Catalog CSV folders ``<out>/meta/<run_id>.csv`` of committed runs that moved files and have none yet.

    Called after a commit and before a run: usually one run is missing, never all of them.
    """
    from ..sources.listing import list_folders
    from .writers import write_csv
    there = list_folders(spark.createDataFrame([(f"{out}/meta",)], "path string"), glob="_SUCCESS")
    there = there.select(F.regexp_extract("path", r"/([^/]+)\.csv/_SUCCESS$", 1).alias("run_id"))
    for r in runs(spark, out).where("files > 0").join(there, "run_id", "left_anti").select("run_id").toLocalIterator():
        rows = committed(spark, out, "catalog", CATALOG_SCHEMA).where(F.col("run_id") == r["run_id"]).drop("run_id")
        write_csv(rows, f"{out}/meta/{r['run_id']}.csv")
