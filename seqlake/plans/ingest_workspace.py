"""JOB2 ``ingest_workspace_tables``: copy the objects referenced by
workspace tables, and the tables themselves, into the results lake
(SRC1, SRC12, SRC13, SRC18, FLT4-FLT6, JON1, JON2, JON5, JON8, PRJ10,
PRJ11, EXP1, EXP3, SET1, SNK1-SNK3).

Inputs are landed files: the run samplesheet, one monitor summary TSV
per workspace, one exported TSV per (workspace, table) and a listing of
the referenced objects with their times.  Nothing talks to the
workspace service here.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import base_name, uri_text
from ..functions.predicates import absent, has_uri
from ..sinks.committed import arrived, carry_out, committed, publish
from ..sinks.ledger import read_ledger, record
from ..operators.joins import missing_from, present_in
from .ingest_runs import catalog_rows, pending_transfers, transfer_plan
from .submissions import retained_summary, tables_to_export


def table_uris(tables: DataFrame, marker: str = "gs://", explode_lists: bool = False) -> DataFrame:
    """Exported table rows ``(workflow, run, file_path, header, cells)`` ->
    ``(workflow, run, sample, file)`` for every cell holding an object URI.

    The sample id is the row's ``<run>_id`` column (each table is named
    after its entity type, the run); every cell of the row is a candidate,
    the id cell included.  A list-valued attribute is exported as list
    text (``['gs://a', 'gs://b']``); with ``explode_lists`` its items become
    candidates one by one, otherwise the whole text is one candidate (and
    never exists as an object).
    """
    pos = F.array_position("header", F.concat("run", F.lit("_id"))).cast("int")
    with_id = tables.withColumn("sample", F.when(pos > 0, F.try_element_at("cells", pos)))
    cells = with_id.select("workflow", "run", "sample", F.explode("cells").alias("file"))
    if explode_lists:
        as_json = F.regexp_replace(F.col("file"), "'", '"')
        items = F.when(F.col("file").rlike(r"^\s*\[.*\]\s*$"), F.from_json(as_json, "array<string>"))
        cells = cells.withColumn("file", F.explode(F.coalesce(items, F.array(F.col("file")))))
    return cells.where(has_uri("file", marker))


def plan_workspace(tables: DataFrame, table_files: DataFrame, objects: DataFrame, out: str,
                   marker: str = "gs://") -> DataFrame:
    """Transfer plan of referenced objects that exist plus the exported
    tables themselves (run-level, no sample).  Each file is versioned by
    its own time, rounded to whole seconds.

    ``table_files``: ``(workflow, run, file, modified_ms)`` of the exported
    tables; ``objects``: listing ``(path, modified_ms)`` of the URIs.
    """
    refs = present_in(table_uris(tables, marker).distinct(), objects, ["file"], ["path"])
    run_level = table_files.select("workflow", "run", F.lit(None).cast("string").alias("sample"), "file")
    files = refs.unionByName(run_level).withColumn("seconds", F.lit(None).cast("decimal(18,3)"))
    times = objects.select("path", "modified_ms").unionByName(
        table_files.select(F.col("file").alias("path"), "modified_ms"))
    return transfer_plan(files, out, file_times=times)


def table_origins(tables: DataFrame, table_files: DataFrame, marker: str = "gs://") -> DataFrame:
    """(project, workspace, run, origin): every object that a landed table
    stands for, the table file itself included.  Both inputs carry project
    and workspace; ``run`` is the table."""
    scope = ["project", "workspace", "run"]
    cells = tables.select(*scope, F.explode("cells").alias("origin")).where(has_uri("origin", marker))
    both = cells.unionByName(table_files.select(*scope, F.col("file").alias("origin")))
    return both.withColumn("origin", uri_text("origin")).distinct()


def finished_submissions(new: DataFrame, landed: DataFrame, origins: DataFrame, failed: DataFrame) -> DataFrame:
    """(project, workspace, submissionId) whose work is done and may go to
    the ledger.

    ``new``: submissions of this check ``(project, workspace, entity,
    submissionId)``; ``landed``: tables ``(project, workspace, run)`` that were
    read; ``origins``: :func:`table_origins`; ``failed``: ``(origin)`` of copies
    that did not succeed.  A submission whose table has not landed yet, or
    one of whose files failed, is left for the next run; other tables and
    other workspaces are not held up by it.
    """
    scope = ["project", "workspace", "run"]
    broken = present_in(origins, failed, ["origin"]).select(*scope)
    done = missing_from(landed.select(*scope).distinct(), broken, scope)
    ours = present_in(new.withColumnRenamed("entity", "run"), done, scope)
    return ours.select("project", "workspace", "submissionId").distinct()


def ingest_workspace_tables(spark: SparkSession, samplesheet: str, landing: str, outdir: str, objects: DataFrame,
                            cache: DataFrame | None = None, copier=None, run_id: str | None = None,
                            marker: str = "gs://", ledger_path: str | None = None) -> dict:
    """Run JOB2 over landed files.

    Layout under ``landing``: ``summary/<project>/<workspace>.tsv`` (monitor
    summaries) and ``tables/<project>/<workspace>/<table>.tsv`` (exports).
    ``cache``: ``(project, workspace, submissionId)`` already ingested.
    ``ledger_path``: a ledger of the same columns, read in place of ``cache``;
    the submissions whose table was read and all of whose files are in the
    lake are appended, so those that failed or whose table lands later are
    taken up again and finished ones are not.
    """
    from ..session import send_package
    from ..sinks.copy import local_copy
    from ..sources import files as src

    out = outdir.rstrip("/")
    land = landing.rstrip("/")
    run_id = run_id or f"{int(time.time())}-{uuid.uuid4()}"
    send_package(spark)
    publish(spark, out)
    sheet = src.read_csv(spark, samplesheet)
    if "run" not in sheet.columns:
        sheet = sheet.withColumn("run", F.lit(None).cast("string"))
    names = ["submissionId", "methodConfigurationName", "submissionEntity", "submissionDate", "status", "workflowStatuses"]
    summary = src.read_named(spark, f"{land}/summary/*/*.tsv", names, sep="\t").withColumnRenamed("file_path", "_src")
    summary = summary.withColumn("project", F.regexp_extract("_src", r"/summary/([^/]+)/[^/]+\.tsv$", 1)) \
        .withColumn("workspace", F.regexp_extract("_src", r"/summary/[^/]+/([^/]+)\.tsv$", 1)).drop("_src")
    ids = ["project", "workspace", "submissionId"]
    if ledger_path is not None:
        _publish_ledger(spark, out, ledger_path, ids)       # of a run that was cut short after its commit
        cache = read_ledger(spark, ledger_path, ids)
    if cache is None:
        cache = spark.createDataFrame([], "project string, workspace string, submissionId string")
    wanted = tables_to_export(sheet, summary, cache)
    # Table names decide which exports to read: a handful per run.
    picks = wanted.select("project", "workspace", "entity_table", "workflow").distinct().collect()
    paths = sorted({f"{land}/tables/{r['project']}/{r['workspace']}/{r['entity_table']}.tsv" for r in picks})
    listing = src.list_files(spark, f"{land}/tables").select("path", "modified_ms") if picks else \
        spark.createDataFrame([], "path string, modified_ms long")
    present = [r[0] for r in listing.where(F.col("path").isin(paths)).select("path").collect()]
    rows = src.read_tables_with_header(spark, present)
    keyed = rows.withColumn("project", F.regexp_extract("file_path", r"/tables/([^/]+)/", 1)) \
        .withColumn("workspace", F.regexp_extract("file_path", r"/tables/[^/]+/([^/]+)/", 1)) \
        .withColumn("run", F.regexp_extract(base_name("file_path"), r"^(.*)\.tsv$", 1))
    tables = keyed.join(wanted.select("project", "workspace", F.col("entity_table").alias("run"), "workflow"),
                        ["project", "workspace", "run"])
    table_files = (listing.join(wanted.select(
        F.concat(F.lit(f"{land}/tables/"), "project", F.lit("/"), "workspace", F.lit("/"), "entity_table",
                 F.lit(".tsv")).alias("path"), "workflow", F.col("entity_table").alias("run")), "path")
        .select("workflow", "run", F.col("path").alias("file"), "modified_ms"))
    plan = plan_workspace(tables, table_files, objects, out, marker)
    pending = pending_transfers(plan, arrived(spark, out, _lake(spark, out)))
    landed = listing.select(F.col("path").alias("file"), *[F.regexp_extract("path", r"/tables/([^/]+)/([^/]+)/([^/]+)\.tsv$", i + 1).alias(c)
                                                          for i, c in enumerate(("project", "workspace", "run"))])

    def finished(status: DataFrame) -> DataFrame:
        asked = present_in(summary, sheet.where(absent("run")), ["project", "workspace"])
        new = missing_from(retained_summary(asked), cache, ids)
        read = present_in(landed, new.withColumnRenamed("entity", "run"), ["project", "workspace", "run"])
        return finished_submissions(new, read, table_origins(keyed, read, marker), status.where("NOT ok").select("origin"))

    _, counts = carry_out(spark, out, run_id, pending, copier or local_copy, catalog_rows, finished if ledger_path is not None else None)
    publish(spark, out)
    if ledger_path is not None:
        _publish_ledger(spark, out, ledger_path, ids)
    return {"run_id": run_id, "files": counts["files"], "failed": counts["failed"], "catalog": f"{out}/meta/{run_id}.csv" if counts["files"] else None}


LEDGER_SCHEMA = "project string, workspace string, submissionId string"


def _publish_ledger(spark: SparkSession, out: str, ledger_path: str, ids: list[str]) -> None:
    """Bring the ledger table up to the committed runs of the lake."""
    new = missing_from(committed(spark, out, "ledger", LEDGER_SCHEMA).select(*ids).distinct(), read_ledger(spark, ledger_path, ids), ids)
    if not new.isEmpty():
        record(new, ledger_path, ids)


def _lake(spark: SparkSession, out: str) -> DataFrame:
    from .ingest_runs import _lake_listing
    return _lake_listing(spark, f"{out}/data")
