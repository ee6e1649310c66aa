"""JOB6 ``check_submissions`` and the submission side of JOB2.

API form (FLT7, FN5, FN20, AGG4, JON13, JON6, LIM1, PRJ8) and monitor
summary form (FLT5, FLT6, FN12, JON1, JON2, SET1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from ..functions.predicates import absent, present, summary_retained
from ..functions.text import entity_name, strip_set
from ..functions.timefmt import epoch_micros
from ..operators.joins import missing_from, present_in
from ..operators.latest import first_rows_marked, rows_matching_latest

# Fixed value: of many new runs, the first so many start at once.
FIRST_WAVE = 19


def _status_map(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, MapType):
        return F.col(col)
    return F.from_json(F.col(col), MapType(StringType(), StringType()))


def candidates(subs: DataFrame, entity_types: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Done submissions with a succeeded workflow on a known entity type
    (``<type>_set`` counts as ``<type>``).  ``scope`` names columns, such as
    the workspace, that part the rows into checks of their own."""
    s = subs.withColumn("entity_type", strip_set("entity_raw"))
    keep = (F.col("status") == "Done") & F.map_contains_key(_status_map(s, "workflow_statuses"), F.lit("Succeeded"))
    s = s.where(keep).select(*scope, "submission_id", "method", "entity_type", "submission_date")
    return present_in(s, entity_types.select(*scope, "entity_type"), [*scope, "entity_type"])


def newest_per_entity(cands: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Rows equal in (method, entity, date) to the newest submission of
    their entity; the newest is the latest date, first id on ties."""
    return rows_matching_latest(
        cands.withColumn("_t", epoch_micros("submission_date")),
        keys=[*scope, "entity_type"], match=["method", "submission_date"], newest_first=["_t"],
        then_ascending=["submission_id"]).drop("_t")


def not_in_ledger(rows: DataFrame, ledger: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Ids never processed; an empty ledger lets everything through."""
    return missing_from(rows, ledger, [*scope, "submission_id"])


def first_wave(rows: DataFrame, size: int = FIRST_WAVE, scope: Sequence[str] = ()) -> DataFrame:
    """Every new submission, with ``start``: whether it belongs to the first
    wave (the oldest ``size``).  The others stay listed for the next check."""
    return first_rows_marked(rows, "submission_id", size, ["submission_date", "submission_id"], by=scope)


def new_by_workspace(asked: DataFrame, subs: DataFrame, entity_types: DataFrame, ledger: DataFrame, size: int = FIRST_WAVE) -> DataFrame:
    """The check of every workspace in ``asked`` (workspace), as one plan.

    ``subs``, ``entity_types`` and ``ledger`` carry a ``workspace`` column; a
    workspace has its own newest submissions and its own first wave.
    """
    scope = ["workspace"]
    mine = candidates(present_in(subs, asked, scope), entity_types, scope)
    return first_wave(not_in_ledger(newest_per_entity(mine, scope), ledger, scope), size, scope)


def job_rows(rows: DataFrame, project: str, workspace: str | Column, outdir: str) -> DataFrame:
    """One ingest work item per new submission (nothing is submitted);
    ``start`` marks the first wave where the rows carry it."""
    start = ["start"] if "start" in rows.columns else []
    workspace = F.lit(workspace) if isinstance(workspace, str) else workspace
    return rows.select(
        F.lit(project).alias("project"), workspace.alias("workspace"),
        F.col("submission_id"), F.col("method").alias("workflow"), F.col("entity_type").alias("entity"),
        F.lit(outdir).alias("outdir"),
        F.concat_ws("_", F.lit(project), workspace, F.col("submission_id")).alias("job_name"),
        *start,
    )


# ------------------------------------------------- monitor summary (TSV)
def retained_summary(summary: DataFrame) -> DataFrame:
    """Rows kept by the summary rule, as (project, workspace, entity,
    submissionId, submissionDate)."""
    return summary.where(summary_retained()).select(
        "project", "workspace", entity_name("submissionEntity").alias("entity"), "submissionId", "submissionDate")


def submission_diff(summary: DataFrame, cache: DataFrame) -> DataFrame:
    """Retained submissions not yet in the per-workspace cache, reduced to
    distinct (project, workspace, entity)."""
    new = missing_from(retained_summary(summary), cache, ["project", "workspace", "submissionId"])
    return new.select("project", "workspace", "entity").distinct()


def tables_to_export(sheet: DataFrame, summary: DataFrame, cache: DataFrame) -> DataFrame:
    """(project, workspace, entity_table, workflow) to export.

    Run-less sheet rows ask for new entities of their workspace; each new
    entity is paired with every workflow listed for the workspace (rows
    with an explicit run included), then the explicit-run rows are added.
    """
    asked = present_in(summary, sheet.where(absent("run")), ["project", "workspace"])
    new = submission_diff(asked, cache)
    wf = sheet.select("project", "workspace", "workflow")
    from_monitor = new.join(wf, ["project", "workspace"], "inner").select(
        "project", "workspace", F.col("entity").alias("entity_table"), "workflow")
    explicit = sheet.where(present("run")).select("project", "workspace", F.col("run").alias("entity_table"), "workflow")
    return from_monitor.unionByName(explicit)


# ---------------------------------------------------------------- runner
SUBMISSION_SCHEMA = ("array<struct<submissionId:string, methodConfigurationName:string, "
                     "submissionEntity:struct<entityType:string, entityName:string>, submissionDate:string, "
                     "status:string, workflowStatuses:map<string,bigint>>>")


def submissions_from_json(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Submission list documents (``(file_path, json)``) -> flat rows."""
    from ..functions.timefmt import parse_iso
    rows = docs.select(*keep, F.explode(F.from_json("json", SUBMISSION_SCHEMA)).alias("s"))
    return rows.select(
        *keep, F.col("s.submissionId").alias("submission_id"), F.col("s.methodConfigurationName").alias("method"),
        F.col("s.submissionEntity.entityType").alias("entity_raw"),
        parse_iso(F.col("s.submissionDate")).alias("submission_date"), F.col("s.status").alias("status"),
        F.col("s.workflowStatuses").alias("workflow_statuses"))


def entity_types_from_json(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Entity type metadata documents -> ``(entity_type)``."""
    m = F.from_json("json", "map<string, struct<count:bigint, idName:string>>")
    return docs.select(*keep, F.explode(F.map_keys(m)).alias("entity_type")).distinct()


def check_workspaces(spark, workspaces: str, landing: str, ledger_path: str, project: str, outdir: str) -> DataFrame:
    """JOB6 for a comma-separated list of workspaces, whose documents lie in
    ``<landing>/<workspace>/submissions.json`` and ``entities.json``; one
    plan reads them all.

    The ledger holds ``(submission_id)``: ids are unique across workspaces.
    """
    from ..sinks.ledger import read_ledger
    from ..sources.files import read_json_docs
    root = landing.rstrip("/")
    names = list(dict.fromkeys(w.strip() for w in workspaces.split(",") if w.strip()))
    if not names:
        raise ValueError("no workspace is named")

    def docs(file: str) -> DataFrame:
        found = read_json_docs(spark, [f"{root}/{w}/{file}" for w in names])
        return found.withColumn("workspace", F.regexp_extract("file_path", r"/([^/]+)/[^/]+$", 1))

    scope = ["workspace"]
    subs = submissions_from_json(docs("submissions.json"), scope)
    mine = candidates(subs, entity_types_from_json(docs("entities.json"), scope), scope)
    fresh = not_in_ledger(newest_per_entity(mine, scope), read_ledger(spark, ledger_path, ["submission_id"]))
    return job_rows(first_wave(fresh, scope=scope), project, F.col("workspace"), outdir)


def check_submissions(spark, submissions_json: str, entity_types_json: str, ledger_path: str,
                      project: str, workspace: str, outdir: str) -> DataFrame:
    """JOB6 against files: the work items for new submissions (nothing is
    started; append their ids to the ledger once the ingest succeeded)."""
    from ..sinks.ledger import read_ledger
    from ..sources.files import read_json_docs
    subs = submissions_from_json(read_json_docs(spark, submissions_json))
    et = entity_types_from_json(read_json_docs(spark, entity_types_json))
    fresh = not_in_ledger(newest_per_entity(candidates(subs, et)), read_ledger(spark, ledger_path, ["submission_id"]))
    return job_rows(first_wave(fresh), project, workspace, outdir)
