"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (through :mod:`seqlake.sources.derived`)
and runs one operator or job of the library over all of their rows.
The equivalent DuckDB SQL is in :mod:`seqlake.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import analysis as an
from .plans import catalog as cat
from .sources import derived as d

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _meta_alt(spark, sf):
    return cat.clean_catalog(d.meta(spark, sf))


# ------------------------------------------------------------- catalog
@query("catalog_clean")
def catalog_clean(spark, sf):
    return _meta_alt(spark, sf)


@query("catalog_results")
def catalog_results(spark, sf):
    return cat.result_tables(_meta_alt(spark, sf))


@query("catalog_reads")
def catalog_reads(spark, sf):
    return cat.read_files(_meta_alt(spark, sf))


@query("catalog_assemblies")
def catalog_assemblies(spark, sf):
    return cat.assembly_files(_meta_alt(spark, sf))


# ------------------------------------------------------------ analysis
@query("latest_result")
def latest_result(spark, sf):
    return an.latest_result(d.results(spark, sf))


@query("latest_passing")
def latest_passing(spark, sf):
    return an.latest_passing(d.results(spark, sf))


def _catalog_rows(spark, sf):
    """``meta_alt`` before its distinct: pairing and newest-assembly only
    take minima / arg-maxima, which duplicates cannot change."""
    return cat.clean_rows(d.meta(spark, sf))


@query("read_pairs")
def read_pairs(spark, sf):
    from .operators.pairs import read_pairs as pairs
    return pairs(cat.read_files(_catalog_rows(spark, sf)))


@query("latest_assembly")
def latest_assembly(spark, sf):
    from .operators.pairs import newest_assembly
    return newest_assembly(cat.assembly_files(_catalog_rows(spark, sf)))


def _analysis(spark, sf):
    rows = _catalog_rows(spark, sf)
    return an.analysis_table(d.results(spark, sf), cat.read_files(rows), cat.assembly_files(rows))


@query("analysis_table")
def analysis_table(spark, sf):
    return _analysis(spark, sf)


@query("analysis_ok")
def analysis_ok(spark, sf):
    return an.split_complete(_analysis(spark, sf))[0]


@query("analysis_missing")
def analysis_missing(spark, sf):
    return an.split_complete(_analysis(spark, sf))[1]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis table: catalog clean-up, latest passing result, read
    pairs and assemblies in one plan."""
    return _analysis(spark, sf_dir).withColumn("complete", an.complete())


# -------------------------------------------------------- read export
def _fastq(spark, sf):
    return cat.read_files(_meta_alt(spark, sf))


@query("new_reads")
def new_reads(spark, sf):
    from .plans.export_reads import new_reads as nr
    return nr(_fastq(spark, sf), d.NOW)


@query("new_reads_latest")
def new_reads_latest(spark, sf):
    from .plans import export_reads as ex
    return ex.one_per_destination(ex.new_reads(_fastq(spark, sf), d.NOW))


@query("new_reads_pending")
def new_reads_pending(spark, sf):
    """Second export 15 days after a first one: only names the first did
    not upload."""
    from .plans import export_reads as ex
    from .functions.timefmt import whole_seconds
    fastq = _fastq(spark, sf)
    then = d.NOW - 15 * ex.DAY
    existed = fastq.where(whole_seconds("timestamp") <= then)
    earlier = ex.one_per_destination(ex.new_reads(existed, then)).select(F.col("dest_name").alias("key"))
    return ex.pending_uploads(ex.new_reads(fastq, d.NOW), earlier)


# -------------------------------------------------------- submissions
def _cands(spark, sf):
    from .plans import submissions as sub
    return sub.candidates(d.submissions(spark, sf), d.entity_types(spark, sf))


def _fresh(spark, sf):
    from .plans import submissions as sub
    return sub.not_in_ledger(sub.newest_per_entity(_cands(spark, sf)), d.ledger(spark, sf))


@query("submission_candidates")
def submission_candidates(spark, sf):
    return _cands(spark, sf)


@query("latest_submission")
def latest_submission(spark, sf):
    from .plans import submissions as sub
    return sub.newest_per_entity(_cands(spark, sf))


@query("new_submissions")
def new_submissions(spark, sf):
    return _fresh(spark, sf)


@query("capped_submissions")
def capped_submissions(spark, sf):
    """All new submissions; ``start`` marks the first wave."""
    from .plans import submissions as sub
    return sub.first_wave(_fresh(spark, sf))


@query("job_rows")
def job_rows(spark, sf):
    from .plans import submissions as sub
    return sub.job_rows(sub.first_wave(_fresh(spark, sf)), "proj", "ws", d.LAKE_ROOT)


@query("submission_diff")
def submission_diff(spark, sf):
    from .operators.joins import present_in
    from .functions.predicates import absent
    from .plans import submissions as sub
    sheet = d.workspace_sheet(spark, sf)
    asked = present_in(d.monitor_summary(spark, sf), sheet.where(absent("run")), ["project", "workspace"])
    return sub.submission_diff(asked, d.workspace_cache(spark, sf))


@query("submission_tables")
def submission_tables(spark, sf):
    from .plans import submissions as sub
    return sub.tables_to_export(d.workspace_sheet(spark, sf), d.monitor_summary(spark, sf),
                                d.workspace_cache(spark, sf))


# ---------------------------------------------------------- retention
def _expanded(spark, sf):
    from .operators.retention import expand_rules
    expanded = expand_rules(d.manifest_runs(spark, sf), d.manifest_rows(spark, sf), d.rules(spark))
    return expanded.select("run", "workflow", "sample", "file")


@query("retention_candidates")
def retention_candidates(spark, sf):
    return _expanded(spark, sf)


@query("retention_expand")
def retention_expand(spark, sf):
    from .operators.retention import existing_files
    return existing_files(_expanded(spark, sf), d.source_listing(spark, sf))


@query("retention_infer")
def retention_infer(spark, sf):
    from .functions.paths import relative_to
    from .operators.retention import infer_rules
    listing = d.source_listing(spark, sf).where(F.startswith("path", F.lit(d.RUN_ROOT + "/")))
    run = F.regexp_extract("path", "^" + d.RUN_ROOT + "/([^/]+)", 1)
    files = listing.select(run.alias("run"), "path").select(
        "run", relative_to("path", F.concat(F.lit(d.RUN_ROOT + "/"), "run")).alias("rel"))
    samples = d.manifest(spark, sf).select("run", "sample", F.col("c_custkey").alias("ord"))
    return infer_rules(files, samples)


# ------------------------------------------------------ run transfers
def _window():
    from .plans.ingest_runs import time_window
    return time_window(start=d.WINDOW_START, end=d.WINDOW_END)


def _plan(spark, sf):
    from .plans.ingest_runs import plan_runs
    return plan_runs(d.run_folders(spark, sf), d.run_manifests(spark, sf), d.manifest_rows(spark, sf),
                     d.rules(spark), d.source_listing(spark, sf), d.run_workflows(spark, sf), _window(), d.LAKE_ROOT)


def _pending(spark, sf):
    from .plans.ingest_runs import pending_transfers
    return pending_transfers(_plan(spark, sf), d.transferred_objects(spark, sf))


@query("run_window")
def run_window(spark, sf):
    from .functions.timefmt import seconds_text
    from .plans.ingest_runs import runs_in_window
    runs = runs_in_window(d.run_folders(spark, sf), d.run_manifests(spark, sf), _window())
    return runs.select("run_path", "run", seconds_text("seconds").alias("timestamp"))


@query("transfer_plan")
def transfer_plan(spark, sf):
    return _plan(spark, sf)


@query("transfer_pending")
def transfer_pending(spark, sf):
    return _pending(spark, sf)


@query("transfer_batches")
def transfer_batches(spark, sf):
    from .plans.ingest_runs import transfer_batches as tb
    return tb(_pending(spark, sf)).select("dest", "batch")


@query("run_summary")
def run_summary(spark, sf):
    from .plans.ingest_runs import run_summary as rs
    return rs(_pending(spark, sf))


@query("transfer_catalog")
def transfer_catalog(spark, sf):
    from .plans.ingest_runs import catalog_rows
    return catalog_rows(_pending(spark, sf))


# ---------------------------------------------------- workspace tables
@query("wide_uris")
def wide_uris(spark, sf):
    from .operators.reshape import uri_cells
    return uri_cells(d.wide(spark, sf), "id")


@query("wide_uris_text")
def wide_uris_text(spark, sf):
    from .operators.reshape import uri_cells_from_lines
    return uri_cells_from_lines(d.wide_lines(spark, sf))


@query("entity_pages")
def entity_pages(spark, sf):
    from .operators.reshape import entity_attributes, entity_table
    id_name, attrs, _ = entity_attributes(d.entity_type_meta(spark, sf), "supplier")
    return entity_table(d.entity_pages(spark, sf), id_name, attrs)


# ------------------------------------------------------------ id text
@query("normalize_ids")
def normalize_ids(spark, sf):
    from .functions.ids import normalize_sample_id, sanitize
    ids = d.meta(spark, sf).select("id", "workflow", "run").unionByName(d.legacy_ids(spark, sf)).distinct()
    return ids.select("id", normalize_sample_id("id").alias("id_norm"),
                      sanitize(F.concat("workflow", F.lit(", "), "run")).alias("label"))


@query("extract_last_pattern")
def extract_last_pattern(spark, sf):
    from .functions.ids import extract_last_match
    files = d.meta(spark, sf).select("file").distinct()
    return files.select("file", extract_last_match("file", [r"_R[12]_\d{3}", r"WA\d{7}"]).alias("match"))


@query("resolve_headers")
def resolve_headers(spark, sf):
    from .operators.headers import ALTERNATIVES, resolve_results
    return resolve_results(d.header_rows(spark, sf), alternatives=ALTERNATIVES, keep=["event_id"])


# -------------------------------------------------------- samplesheet
@query("sheet_errors")
def sheet_errors(spark, sf):
    from .operators.samplesheet import sheet_errors as se
    return se(d.sheet(spark, sf))


@query("sheet_valid")
def sheet_valid(spark, sf):
    from .operators.samplesheet import clean_lines, sheet_valid as sv
    return sv(clean_lines(d.sheet(spark, sf)))


@query("sheet_duplicates")
def sheet_duplicates(spark, sf):
    from .operators.samplesheet import sheet_duplicates as sd
    return sd(d.sheet(spark, sf))


# ----------------------------------------------------------- streaming
@query("stream_new_ids")
def stream_new_ids(spark, sf):
    """Submissions landed as files and streamed through the ledger sink;
    equals the batch ``candidates - ledger``."""
    from .streaming.ingest import stream_new_submissions
    return stream_new_submissions(spark, d.submissions(spark, sf), d.entity_types(spark, sf), d.ledger(spark, sf))


@query("stream_windowed_dedupe")
def stream_windowed_dedupe(spark, sf):
    """Every submission landed twice, deduplicated within a 30-day
    watermark; equals the distinct submissions."""
    from .streaming.ingest import stream_deduped_submissions
    return stream_deduped_submissions(spark, d.submissions(spark, sf))


# ----------------------------------------------------- events and URIs
@query("upload_trigger_runs")
def upload_trigger_runs(spark, sf):
    """Catalog origins seen as object-created events; only summary uploads
    name a run to ingest (batch form of the upload trigger)."""
    from .functions.paths import uri_bucket, uri_key
    from .streaming.ingest import upload_triggers
    m = d.meta(spark, sf).select(F.col("origin"))
    events = m.select(uri_bucket("origin").alias("bucket"), uri_key("origin").alias("key"),
                      F.lit(None).cast("timestamp").alias("eventTime"))
    return upload_triggers(events).select("run", "workflow").distinct()


@query("uri_parts")
def uri_parts(spark, sf):
    from .functions.paths import base_name, parent_dir, uri_bucket, uri_key, uri_scheme
    m = d.meta(spark, sf).select("current").distinct()
    return m.select("current", uri_scheme("current").alias("scheme"), uri_bucket("current").alias("bucket"),
                    uri_key("current").alias("key"), base_name("current").alias("name"),
                    parent_dir("current").alias("parent"))


@query("run_job_names")
def run_job_names(spark, sf):
    """Run list ``workflow,run_uri/`` built from the catalog -> job names."""
    from .functions.paths import job_name
    runs = d.meta(spark, sf).select("workflow", F.concat(F.lit(d.SOURCE_ROOT + "/"), "run", F.lit("/")).alias("run"))
    return runs.distinct().select("workflow", "run", job_name("workflow", "run").alias("job_name"))


@query("sheet_valid_skewed")
def sheet_valid_skewed(spark, sf):
    """``_T{n}`` numbering when one sample holds a third of the lines.
    Derived line numbers repeat, so the reads break ties."""
    from .operators.samplesheet import sheet_valid as sv
    return sv(d.skewed_sheet(spark, sf), tiebreak=("fastq_1", "fastq_2"))


@query("sheet_duplicates_skewed")
def sheet_duplicates_skewed(spark, sf):
    from .operators.samplesheet import sheet_duplicates as sd
    return sd(d.skewed_sheet(spark, sf))


# ------------------------------------------------------ further operators
@query("manifest_headers")
def manifest_headers(spark, sf):
    """Manifest columns found by name in each file's own header."""
    from .sources.files import named_cells
    return named_cells(d.manifest_lines(spark, sf), ["sample", "fastq_1", "fastq_2"], keep=["run"])


@query("newest_cache")
def newest_cache(spark, sf):
    from .sources.files import newest_file_per_key
    return newest_file_per_key(d.cache_listing(spark, sf), ["workspace"])


@query("table_uris")
def table_uris(spark, sf):
    from .plans.ingest_workspace import table_uris as tu
    return tu(d.exported_tables(spark, sf))


@query("workspace_plan")
def workspace_plan(spark, sf):
    from .plans.ingest_workspace import plan_workspace
    return plan_workspace(d.exported_tables(spark, sf), d.table_files(spark, sf), d.table_objects(spark, sf), d.LAKE_ROOT)


@query("run_level_present")
def run_level_present(spark, sf):
    from .operators.joins import present_in
    m = d.meta(spark, sf).where(F.col("id") == "null").distinct()
    return present_in(m, d.lake_objects(spark, sf), ["current"], ["path"])


@query("tables_without_sets")
def tables_without_sets(spark, sf):
    from .functions.predicates import not_set_table
    return d.submissions(spark, sf).select("entity_raw").distinct().where(not_set_table("entity_raw"))


@query("entity_subset")
def entity_subset(spark, sf):
    """Attributes asked for, in source order, with the number of pages that the count makes."""
    from .operators.reshape import entity_attributes, entity_table, page_count
    id_name, attrs, n = entity_attributes(d.entity_type_meta(spark, sf), "supplier", ["report", "nation", "absent"])
    return entity_table(d.entity_pages(spark, sf), id_name, attrs).withColumn("pages", F.lit(page_count(n, d.PAGE_SIZE)).cast("long"))


@query("workspaces_checked")
def workspaces_checked(spark, sf):
    """A list of workspaces per user, split, and the check of each: its new submissions and their first wave."""
    from .operators.reshape import explode_list
    from .plans.submissions import new_by_workspace
    asked = explode_list(d.workspace_lists(spark, sf), "workspaces", out="workspace").select("workspace").distinct()
    return new_by_workspace(asked, d.workspace_submissions(spark, sf), d.workspace_entity_types(spark, sf), d.workspace_ledger(spark, sf))


@query("capped_repeated")
def capped_repeated(spark, sf):
    """The first wave of a list in which ids repeat or are absent: no row is added or lost."""
    from .plans.submissions import first_wave
    return first_wave(d.repeated_candidates(_cands(spark, sf)))


@query("workspace_ledger")
def workspace_ledger(spark, sf):
    """Submissions to record after an ingest in which some tables had not landed and some copies failed."""
    from .operators.joins import missing_from, present_in
    from .functions.predicates import absent
    from .plans.ingest_workspace import finished_submissions, table_origins
    from .plans.submissions import retained_summary
    asked = present_in(d.monitor_summary(spark, sf), d.workspace_sheet(spark, sf).where(absent("run")), ["project", "workspace"])
    new = missing_from(retained_summary(asked), d.workspace_cache(spark, sf), ["project", "workspace", "submissionId"])
    landed = d.landed_tables(spark, sf)
    return finished_submissions(new, landed, table_origins(landed, landed), d.failed_copies(spark, sf))


@query("text_forms")
def text_forms(spark, sf):
    """Collapsed blanks, paths as text, ISO times and values as text."""
    from .functions.paths import uri_text
    from .functions.text import collapse_ws
    from .functions.timefmt import epoch_micros, parse_iso
    e = d.table(spark, sf, "events")
    eid = F.col("event_id").cast("string")
    path = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("file:///a/"), eid)).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit("file:/a/"), eid)).otherwise(F.concat(F.lit("s3://b/"), eid))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return e.select("event_id", collapse_ws(F.concat(F.lit("  "), "event_type", F.lit(" \t\n "), eid, F.lit(" "))).alias("collapsed"),
                    uri_text(path).alias("path_text"), epoch_micros(parse_iso(iso)).alias("micros"),
                    F.col("user_id").cast("string").alias("value_text"))


@query("transfer_plan_shared_names")
def transfer_plan_shared_names(spark, sf):
    """Kept files of two roots whose run folders have the same names; one root lacks the rules' folders."""
    from .functions.paths import base_name
    from .operators.retention import existing_files, expand_rules
    runs, rows, listing = d.alt_runs(spark, sf)
    expanded = expand_rules(d.manifest_runs(spark, sf).select("run", "workflow", "run_path").unionByName(runs),
                            d.manifest_rows(spark, sf).unionByName(rows), d.rules(spark))
    kept = existing_files(expanded, d.source_listing(spark, sf).unionByName(listing))
    return kept.select("run_path", "run", "workflow", "sample", base_name("file").alias("file"))


@query("results_to_analysis")
def results_to_analysis(spark, sf):
    """Result rows with varying headers, all fields resolved, newest row per sample."""
    from .operators.headers import resolve_results
    from .operators.latest import latest_by
    rows = resolve_results(d.header_rows(spark, sf), keep=["event_id"])
    return latest_by(rows, ["id"], ["event_id"])


@query("attribute_texts")
def attribute_texts(spark, sf):
    """Entity pages with attributes of every JSON type, each as the export writes it."""
    from .operators.reshape import entity_table
    return entity_table(d.typed_pages(spark, sf), "part_id", ["number", "flag", "brand", "reads", "ref", "list", "absent"])


@query("stream_versions")
def stream_versions(spark, sf):
    """Deliveries of object events, each landed twice, as a stream of versions: a new time of an object makes a version, a replay none."""
    from .streaming.ingest import stream_file_versions
    return stream_file_versions(spark, d.file_events(spark, sf))


@query("entity_file")
def entity_file(spark, sf):
    """Entity pages written as one ordered table file, and its lines read back with their numbers."""
    from .operators.ranking import line_numbers
    from .plans.export_entities import write_entities
    from .session import shared_dir
    path = f"{shared_dir(spark, 'entities')}/supplier.tsv"
    write_entities(d.entity_pages(spark, sf), d.entity_type_meta(spark, sf), "supplier", path)
    return line_numbers(spark.read.text(path)).select("line", F.col("value").alias("text"))


@query("sheet_file")
def sheet_file(spark, sf):
    """A checked samplesheet written as one CSV file in line order, and its lines read back with their numbers."""
    from .operators.ranking import line_numbers
    from .operators.samplesheet import clean_lines, sheet_valid as sv
    from .session import shared_dir
    from .sinks.onefile import write_ordered_file
    valid = sv(clean_lines(d.sheet(spark, sf)))
    path = f"{shared_dir(spark, 'sheet')}/sheet.csv"
    write_ordered_file(valid, path, ["line"], [c for c in valid.columns if c != "line"])
    return line_numbers(spark.read.text(path)).select("line", F.col("value").alias("text"))
