"""Lab-shaped inputs derived from the driver's parquet tables.

The lab's own inputs (catalog CSVs, run folders, workspace pages) are not
shipped, so the registered queries build the same shapes from the
driver tables with plain DataFrame expressions.  Every shape grows with
its source table.  The recipes are the ones in FIXTURES.md §2; the
oracle SQL repeats them as CTEs.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import lake_path
from .files import local_table
from ..functions.timefmt import epoch_seconds, ms_to_seconds, seconds_text
from ..operators.headers import ALTERNATIVES

# Fixed values of the derived shapes.
SOURCE_ROOT = "s3://prod"          # where workflow outputs land
LAKE_ROOT = "s3://results"         # the results lake
RUN_ROOT = "s3://prod/runs"        # run folders of the production ingest
READS_ROOT = "/reads"              # manifest read paths
WIDE_BUCKET = "gs://bkt"           # workspace object URIs
NOW = 999993600                    # fixed "now" for the read export
KNOWN_ENTITY_TYPES = 45            # entity_0 .. entity_44 exist
LEDGER_EVERY = 7                   # submission ids already processed
PAGE_SIZE = 1000                   # workspace entity page size
# Retention rules used with the derived manifests (workflow phoenix).
FIXTURE_RULES = [
    ("phoenix", "run_files", "/Phoenix_Summary.tsv"),
    ("phoenix", "run_files", "/versions.yml"),
    ("phoenix", "sample_files", "/<sample>/<sample>.synopsis"),
    ("phoenix", "sample_files", "/<sample>/<sample>.tax"),
    ("phoenix", "sample_files", "/<sample>/assembly/<sample>.scaffolds.fa.gz"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# ---------------------------------------------------------------- F1 meta
def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog ``meta`` (7 text columns) from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    sid = F.concat(F.lit("WA"), F.lpad(_s(F.col("l_orderkey") % 3000), 7, "0"),
                   F.when(F.col("l_suppkey") % 2 == 0, F.lit("-WA9")).otherwise(F.lit("")))
    line = F.col("l_linenumber")
    wf = (F.when(F.col("l_partkey") % 5 == 0, "PHoeNIx_v2").when(F.col("l_partkey") % 5 == 1, "TheiaProk_Illumina_PE")
          .when(F.col("l_partkey") % 5 == 2, "recapp").when(F.col("l_partkey") % 5 == 3, "BaseSpace_Fetch_PHB")
          .otherwise("mycosnp"))
    c = li.select(
        F.when(line.isin(6, 7), F.lit("null")).otherwise(sid).alias("id"),
        wf.alias("workflow"),
        F.concat(F.lit("run_"), _s(F.col("l_suppkey") % 20)).alias("run"),
        (F.when(line == 1, F.concat(sid, F.lit("_R1_001.fastq.gz")))
         .when(line == 2, F.concat(sid, F.lit("_R2_001.fastq.gz")))
         .when(line == 3, F.concat(sid, F.lit(".scaffolds.fa.gz")))
         .when(line == 4, F.concat(sid, F.lit("_contigs.fasta")))
         .when(line == 5, F.concat(sid, F.lit(".synopsis")))
         .when(line == 6, F.lit("Phoenix_Summary.tsv"))
         .otherwise(F.lit("terra_table.tsv"))).alias("file"),
        _s(epoch_seconds("l_shipdate")).alias("timestamp"),
    )
    return c.select(
        "id", "workflow", "run", "file", "timestamp",
        F.concat(F.lit(SOURCE_ROOT + "/"), "run", F.lit("/"), "file").alias("origin"),
        lake_path(LAKE_ROOT, "id", "workflow", "run", "file", "timestamp").alias("current"),
    )


# ------------------------------------------------------------- F2 results
def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysis rows with resolved headers, from orders."""
    o = table(spark, sf_dir, "orders")
    pri = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.concat(F.lit("WA"), F.lpad(_s(F.col("o_orderkey") % 3000), 7, "0")).alias("id"),
        epoch_seconds("o_orderdate").alias("timestamp"),
        F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "PASS").alias("qc"),
        F.when(pri == "5-LOW", F.lit(None).cast("string"))
         .otherwise(F.replace(F.replace(pri, F.lit(","), F.lit(";")), F.lit(" "), F.lit("_"))).alias("species"),
    )


# --------------------------------------------------------- F3 submissions
def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workspace submissions (API form, flattened), from events."""
    return _submissions(spark, sf_dir)


def _submissions(spark: SparkSession, sf_dir: str, *more) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        _s(eid).alias("submission_id"),
        F.col("event_type").alias("method"),
        F.concat(F.lit("entity_"), _s(F.col("user_id") % 50),
                 F.when(eid % 3 == 0, F.lit("_set")).otherwise(F.lit(""))).alias("entity_raw"),
        F.col("ts").alias("submission_date"),
        F.when(eid % 4 == 0, F.lit("Aborted")).otherwise(F.lit("Done")).alias("status"),
        F.when(eid % 5 == 0, F.lit('{"Failed":1}')).otherwise(F.lit('{"Succeeded":1}')).alias("workflow_statuses"),
        *more,
    )


def entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity types present in the workspace (``entity_0`` .. ``entity_44``
    where users exist)."""
    e = table(spark, sf_dir, "events")
    k = F.col("user_id") % 50
    return (e.where(k < KNOWN_ENTITY_TYPES).select(F.concat(F.lit("entity_"), _s(k)).alias("entity_type"))
            .distinct())


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission ids already ingested."""
    e = table(spark, sf_dir, "events")
    return e.where(F.col("event_id") % LEDGER_EVERY == 0).select(_s(F.col("event_id")).alias("submission_id"))


def monitor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor summary (TSV form) for two workspaces of one project.

    ``submissionEntity`` is ``<type>:<name>`` text and ``workflowStatuses``
    is text.  Users split over workspaces ``ws_a`` / ``ws_b``.
    """
    s = _submissions(spark, sf_dir, F.col("user_id"))
    return s.select(
        F.lit("proj").alias("project"),
        F.when(F.col("user_id") % 2 == 0, F.lit("ws_a")).otherwise(F.lit("ws_b")).alias("workspace"),
        F.col("submission_id").alias("submissionId"),
        F.col("method").alias("methodConfigurationName"),
        F.concat("entity_raw", F.lit(":"), F.lit("name_"), _s(F.col("user_id"))).alias("submissionEntity"),
        F.col("submission_date").alias("submissionDate"),
        F.col("status"),
        F.col("workflow_statuses").alias("workflowStatuses"),
    )


def workspace_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samplesheet of the workspace ingest: one run-less row per workspace
    and workflow (nation names), plus explicit-run rows."""
    n = table(spark, sf_dir, "nation")
    ws = F.when(F.col("n_nationkey") % 2 == 0, F.lit("ws_a")).otherwise(F.lit("ws_b"))
    runless = n.where(F.col("n_nationkey") % 5 < 4).select(
        F.lit("proj").alias("project"), ws.alias("workspace"),
        F.concat(F.lit("wf_"), F.lower("n_name")).alias("workflow"), F.lit(None).cast("string").alias("run"))
    explicit = n.where(F.col("n_nationkey") % 5 == 4).select(
        F.lit("proj").alias("project"), ws.alias("workspace"),
        F.concat(F.lit("wf_"), F.lower("n_name")).alias("workflow"),
        F.concat(F.lit("entity_"), _s(F.col("n_nationkey"))).alias("run"))
    return runless.unionByName(explicit)


# ----------------------------------------------------------- F4 manifests
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of each run, from customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("run_"), _s(F.col("c_nationkey"))).alias("run"),
        F.col("c_name").alias("sample"),
        F.col("c_custkey"),
        F.concat(F.lit(READS_ROOT + "/"), "c_name", F.lit("_R1.fastq.gz")).alias("fastq_1"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(READS_ROOT + "/"), "c_name", F.lit("_R2.fastq.gz"))).alias("fastq_2"),
    )


def rules(spark: SparkSession) -> DataFrame:
    return local_table(spark, FIXTURE_RULES, ["workflow", "kind", "pattern"])


def manifest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the derived manifests with their workflow and folder; every
    run that has a nation is a phoenix run."""
    c = table(spark, sf_dir, "customer")
    runs = c.select(F.concat(F.lit("run_"), _s(F.col("c_nationkey"))).alias("run"),
                    F.when(F.col("c_nationkey").isNotNull(), F.lit("phoenix")).alias("workflow")).distinct()
    return runs.withColumn("run_path", F.concat(F.lit(RUN_ROOT + "/"), "run"))


def run_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of the runs root: one entry per nation.

    Modification times step by 30 days from 2001-01-01 with a few
    milliseconds added, so times carry fractions; region 4 entries are
    plain files, not folders.
    """
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("bigint")
    ms = (F.lit(978307200) + k * 2592000) * 1000 + k * 250
    return n.select(
        F.concat(F.lit(RUN_ROOT + "/run_"), _s(k)).alias("path"),
        ms.alias("modified_ms"),
        (F.col("n_regionkey") != 4).alias("is_dir"),
    )


def run_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of ``manifest.csv`` objects: runs of every region but 3."""
    n = table(spark, sf_dir, "nation")
    return n.where(F.col("n_regionkey") != 3).select(
        F.concat(F.lit(RUN_ROOT + "/run_"), _s(F.col("n_nationkey")), F.lit("/manifest.csv")).alias("path"))


def source_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects present under the runs root: every run-level file of the
    rules, and sample and read files of customers with ``c_custkey % 3 <> 0``."""
    m = manifest(spark, sf_dir)
    r = rules(spark)
    runs = manifest_runs(spark, sf_dir)
    run_level = runs.join(F.broadcast(r.where(F.col("kind") == "run_files")), "workflow").select(
        F.concat(F.lit(RUN_ROOT + "/"), "run", "pattern").alias("path"))
    kept = m.where(F.col("c_custkey") % 3 != 0).join(runs.select("run", "workflow"), "run")
    sample_level = kept.join(F.broadcast(r.where(F.col("kind") == "sample_files")), "workflow").select(
        F.concat(F.lit(RUN_ROOT + "/"), "run", F.replace("pattern", F.lit("<sample>"), F.col("sample"))).alias("path"))
    reads = kept.select(F.explode(F.array("fastq_1", "fastq_2")).alias("path")).where(F.col("path").isNotNull())
    return run_level.unionByName(sample_level).unionByName(reads)


# ---------------------------------------------------------------- F5 wide
def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = _s(F.col("p_partkey"))
    return p.select(
        F.concat(F.lit("S"), key).alias("id"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(WIDE_BUCKET + "/"), key, F.lit(".fa.gz")))
         .otherwise(F.col("p_brand")).alias("c1"),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(WIDE_BUCKET + "/"), key, F.lit("_R1.fastq.gz")))
         .alias("c2"),
        F.col("p_type").alias("c3"),
    )


def wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``wide`` as exported TSV lines (absent cells are empty text)."""
    w = wide(spark, sf_dir)
    return w.select(F.concat_ws("\t", "id", *[F.coalesce(c, F.lit("")) for c in ("c1", "c2", "c3")]).alias("value"))


# --------------------------------------------------------------- F6 sheet
def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("line"),
        F.concat(F.lit("cust "), _s(F.col("o_custkey"))).alias("sample"),
        F.concat(F.lit("r"), _s(k), F.when(k % 50 == 0, F.lit(".bam")).otherwise(F.lit("_1.fastq.gz"))).alias("fastq_1"),
        F.when(k % 10 == 0, F.lit("")).when(k % 33 == 0, F.concat(F.lit("r"), _s(k), F.lit("_2.fq.gz")))
         .otherwise(F.concat(F.lit("r"), _s(k), F.lit("_2.fastq.gz"))).alias("fastq_2"),
    )


# ------------------------------------------------- workspace entity pages
def entity_pages(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Paged entity responses (one JSON document per page) from supplier.

    Entities are suppliers; attributes are the nation key, the supplier
    key and an object URI.  The URI is absent on every 7th supplier.
    """
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    attrs = F.map_from_arrays(F.array(F.lit("nation"), F.lit("suppkey"), F.lit("report")),
                              F.array(_s(F.col("s_nationkey")), _s(key),
                                      F.concat(F.lit(WIDE_BUCKET + "/suppliers/"), _s(key), F.lit(".tsv"))))
    attrs = F.when(key % 7 == 0, F.map_filter(attrs, lambda k, v: k != "report")).otherwise(attrs)
    ent = s.select(F.floor(key / page_size).alias("page"), key.alias("_k"),
                   F.struct(F.col("s_name").alias("name"), attrs.alias("attributes")).alias("e"))
    # A page holds at most page_size entities, so collecting one page is bounded.
    by_key = lambda a, b: F.when(a["_k"] < b["_k"], -1).when(a["_k"] > b["_k"], 1).otherwise(0)
    pages = ent.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("_k", "e")), by_key).alias("items"))
    return pages.select(F.col("page"), F.to_json(F.struct(F.transform("items", lambda x: x["e"]).alias("results")))
                        .alias("json"))


def entity_type_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity type metadata ``{type: {count, idName, attributeNames}}`` as JSON."""
    s = table(spark, sf_dir, "supplier")
    return s.agg(F.count(F.lit(1)).alias("n")).select(F.to_json(F.create_map(
        F.lit("supplier"), F.struct(F.col("n").alias("count"), F.lit("supplier_id").alias("idName"),
                                    F.array(F.lit("nation"), F.lit("suppkey"), F.lit("report")).alias("attributeNames"))
    )).alias("json"))


# --------------------------------------------------- header-variant rows
def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result-table rows whose header depends on the producing workflow.

    Each event becomes one row ``(header array, cells array)``; the
    header variant follows ``event_type``.
    """
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    kk = k.cast("bigint")
    eid = F.col("event_id")
    sid = F.concat(F.lit("WA"), F.lpad(_s(F.col("user_id")), 7, "0"),
                   F.when(eid % 2 == 0, F.lit("-WA2")).otherwise(F.lit("")))
    qc = F.when(kk % 3 == 0, F.lit("FAIL")).when(kk % 3 == 1, F.lit("PASS")).otherwise(F.lit(""))
    sp = (F.when(eid % 4 == 0, F.lit("Escherichia coli")).when(eid % 4 == 1, F.lit("Klebsiella pneumoniae"))
          .when(eid % 4 == 2, F.lit("")).otherwise(F.lit("Candida auris, clade I")))
    et = F.col("event_type")

    def arr(*xs):
        return F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs])

    # the fields without a value rule of their own hold "<field>, <k>"
    plain = [f for f in ALTERNATIVES if f not in ("qc", "species", "read_depth")]

    def names(variant: int) -> list[str]:
        return [ALTERNATIVES[f][variant] for f in plain if variant < len(ALTERNATIVES[f])]

    def values(variant: int) -> list:
        return [F.concat(F.lit(f + ", "), k) for f in plain if variant < len(ALTERNATIVES[f])]

    header = (F.when(et == "click", arr("ID", "Auto_QC_Outcome", "Species", "Estimated_Coverage", *names(0)))
              .when(et == "view", arr("samplename", "qc_outcome", "species", "estimated_coverage", *names(1)))
              .when(et == "purchase", arr("sample", "aa_qc_check", "fastani_genus_species", "est_coverage_clean", *names(2)))
              .when(et == "error", arr("ID", "Auto_QC_Outcome", "qc_outcome", "Species"))
              .otherwise(arr("entity_id", "Species", "species")))
    cells = (F.when(et == "click", arr(sid, qc, sp, k, *values(0))).when(et == "view", arr(sid, qc, sp, k, *values(1)))
             .when(et == "purchase", arr(sid, qc, sp, k, *values(2)))
             .when(et == "error", arr(sid, F.lit(""), qc, sp))
             .otherwise(arr(sid, sp, F.lit("other"))))
    return e.select(eid.alias("event_id"), header.alias("header"), cells.alias("cells"))


def workspace_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-workspace cache of seen submission ids (every 7th id)."""
    s = monitor_summary(spark, sf_dir)
    return s.where(F.col("submissionId").cast("bigint") % LEDGER_EVERY == 0).select(
        "project", "workspace", "submissionId")


# Time window of the derived production ingest: 2001-03-01 .. 2002-06-01.
WINDOW_START = 983404800
WINDOW_END = 1022889600


def run_workflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run samplesheet ``(run_path, workflow)``: runs of region 2 come from
    a workflow without retention rules (mycosnp), the others are phoenix."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit(RUN_ROOT + "/run_"), _s(F.col("n_nationkey"))).alias("run_path"),
                    F.when(F.col("n_regionkey") == 2, F.lit("mycosnp")).otherwise(F.lit("phoenix")).alias("workflow"))


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows keyed by their run folder."""
    m = manifest(spark, sf_dir)
    return m.select(F.concat(F.lit(RUN_ROOT + "/"), "run").alias("run_path"), "sample", "fastq_1", "fastq_2")


def legacy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older lab ids (``X<year>JQ-<5 digits>-WA<n>``) with workflow and run."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("X"), _s(F.year("l_shipdate")), F.lit("JQ-"), F.lpad(_s(F.col("l_orderkey") % 100000), 5, "0"),
                 F.lit("-WA"), _s(F.col("l_linenumber"))).alias("id"),
        F.lit("legacy").alias("workflow"),
        F.concat(F.lit("run_"), _s(F.col("l_suppkey") % 20)).alias("run"),
    )


def skewed_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read samplesheet from lineitem with one hot sample: a third of all
    lines belong to ``HOT``; reads repeat, so (sample, fastq_1) pairs recur."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    sample = F.when(k % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S "), _s(k % 1000)))
    return li.select(
        (k * 8 + F.col("l_linenumber")).alias("line"),
        sample.alias("sample"),
        F.concat(F.lit("r"), _s(F.col("l_partkey") % 500), F.lit("_1.fastq.gz")).alias("fastq_1"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("r"), _s(F.col("l_partkey") % 500), F.lit("_2.fastq.gz"))).alias("fastq_2"),
    )


# ------------------------------------------------- rows of further operators
def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows with the header of their file; three files' headers differ in order and columns."""
    m = manifest(spark, sf_dir)
    k = F.col("c_custkey") % 3
    f2 = F.coalesce("fastq_2", F.lit(""))
    lit = lambda *xs: F.array(*[F.lit(x) for x in xs])
    return m.select(
        "run",
        F.when(k == 0, lit("sample", "fastq_1", "fastq_2")).when(k == 1, lit("sample", "single_end", "fastq_1", "fastq_2"))
         .otherwise(lit("fastq_2", '"fastq_1"', "sample")).alias("header"),
        F.when(k == 0, F.array("sample", "fastq_1", f2)).when(k == 1, F.array(F.col("sample"), F.lit("x"), F.col("fastq_1"), f2))
         .otherwise(F.array(f2, F.concat(F.lit('"'), "fastq_1", F.lit('"')), F.col("sample"))).alias("cells"))


def cache_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached summary files of each workspace; two files in a row share a time."""
    e = table(spark, sf_dir, "events")
    ws = F.concat(F.lit("ws_"), _s(F.col("user_id") % 20))
    return e.select(ws.alias("workspace"), F.concat(F.lit("cache/"), ws, F.lit("/"), _s(F.col("event_id")), F.lit(".tsv")).alias("path"),
                    (F.floor(F.col("event_id") / 2) * 1000).alias("modified_ms"))


def exported_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of exported workspace tables; the id column is named after the table and stands first or last."""
    p = table(spark, sf_dir, "part")
    run = F.concat(F.lit("plate_"), _s(F.col("p_size") % 4))
    name = F.concat(F.lit("S"), _s(F.col("p_partkey")))
    uri = F.concat(F.lit(WIDE_BUCKET + "/"), _s(F.col("p_partkey")), F.lit(".fa.gz"))
    first = F.col("p_partkey") % 2 == 0
    return p.select(
        F.lit("wf").alias("workflow"), run.alias("run"), F.concat(F.lit("/tables/"), run, F.lit(".tsv")).alias("file_path"),
        F.when(first, F.array(F.concat(run, F.lit("_id")), F.lit("fa"), F.lit("note"))).otherwise(
            F.array(F.lit("note"), F.lit("fa"), F.concat(run, F.lit("_id")))).alias("header"),
        F.when(first, F.array(name, uri, F.col("p_type"))).otherwise(F.array(F.col("p_type"), uri, name)).alias("cells"))


def table_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects there are: files of parts whose key 3 does not divide, with fractional times."""
    p = table(spark, sf_dir, "part").where(F.col("p_partkey") % 3 != 0)
    return p.select(F.concat(F.lit(WIDE_BUCKET + "/"), _s(F.col("p_partkey")), F.lit(".fa.gz")).alias("path"),
                    (F.col("p_partkey") * 1000 + 1700000000500).alias("modified_ms"))


def table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported table files themselves."""
    t = exported_tables(spark, sf_dir).select("workflow", "run", F.col("file_path").alias("file")).distinct()
    return t.withColumn("modified_ms", F.lit(1700000000499).cast("long"))


def lake_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of lake objects: those of every run but run_0, run_3, ..."""
    m = meta(spark, sf_dir)
    return m.where(F.regexp_extract("run", r"(\d+)$", 1).cast("int") % 3 != 0).select(F.col("current").alias("path")).distinct()


def alt_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs, manifest rows, listing) of a second root whose run folders have the names of the first; its samples are suppliers."""
    s = table(spark, sf_dir, "supplier")
    root = F.concat(F.lit(SOURCE_ROOT + "/alt/run_"), _s(F.col("s_nationkey")))
    reads = F.concat(F.lit(READS_ROOT + "/"), "s_name", F.lit("_R1.fastq.gz"))
    runs = s.select(F.concat(F.lit("run_"), _s(F.col("s_nationkey"))).alias("run"), F.lit("mycosnp").alias("workflow"), root.alias("run_path")).distinct()
    rows = s.select(root.alias("run_path"), F.col("s_name").alias("sample"), reads.alias("fastq_1"), F.lit(None).cast("string").alias("fastq_2"))
    return runs, rows, s.where(F.col("s_suppkey") % 2 == 0).select(reads.alias("path"))


def transferred_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of the versioned objects that earlier ingests left in the lake.

    Runs 0, 3, 6, ... are there in their present version but for the
    ``.synopsis`` files; runs 1, 4, 7, ... in a version of the day before.
    """
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("bigint")
    ms = (F.lit(978307200) + k * 2592000) * 1000 + k * 250 - F.when(k % 3 == 1, 86400000).otherwise(0)
    runs = n.where(k % 3 != 2).select("n_nationkey", F.concat(F.lit("run_"), _s(k)).alias("run"),
                                      F.when(F.col("n_regionkey") == 2, F.lit("mycosnp")).otherwise(F.lit("phoenix")).alias("workflow"),
                                      seconds_text(ms_to_seconds(ms)).alias("timestamp"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_name").alias("id"))
    names = [F.concat("id", F.lit(x)) for x in (".tax", ".scaffolds.fa.gz", "_R1.fastq.gz", "_R2.fastq.gz")]
    sample_level = c.join(runs, "n_nationkey").select("id", "run", "workflow", "timestamp", F.explode(F.array(*names)).alias("file"))
    run_level = runs.select(F.lit("null").alias("id"), "run", "workflow", "timestamp",
                            F.explode(F.array(F.lit("Phoenix_Summary.tsv"), F.lit("versions.yml"))).alias("file"))
    return sample_level.unionByName(run_level).select(lake_path(LAKE_ROOT, "id", "workflow", "run", "file", "timestamp").alias("path"))


# ---------------------------------------------------------- workspaces
def workspace_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The workspaces each user asks for, as comma-separated text; lists overlap."""
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 3 == 0)
    k = F.col("n_nationkey")
    return n.select(F.col("n_name").alias("user"), F.concat(F.lit("ws_"), _s(k), F.lit(", ws_"), _s(k * 7 % 20), F.lit(",ws_"), _s(k)).alias("workspaces"))


def workspace_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions of 20 workspaces."""
    return _submissions(spark, sf_dir, F.concat(F.lit("ws_"), _s(F.col("user_id") % 20)).alias("workspace"))


def workspace_entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity types of each workspace; entity_45 and above are in none."""
    e = table(spark, sf_dir, "events")
    k = F.col("user_id") % 50
    return e.where(k < KNOWN_ENTITY_TYPES).select(F.concat(F.lit("ws_"), _s(F.col("user_id") % 20)).alias("workspace"),
                                                  F.concat(F.lit("entity_"), _s(k)).alias("entity_type")).distinct()


def workspace_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions already ingested, by workspace."""
    e = table(spark, sf_dir, "events")
    return e.where(F.col("event_id") % LEDGER_EVERY == 0).select(F.concat(F.lit("ws_"), _s(F.col("user_id") % 20)).alias("workspace"),
                                                                 _s(F.col("event_id")).alias("submission_id"))


def landed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported tables that have landed, with one object per event; those of every fourth entity have not."""
    e = table(spark, sf_dir, "events")
    k = F.col("user_id") % 50
    return e.where(k % 4 != 3).select(
        F.lit("proj").alias("project"), F.when(F.col("user_id") % 2 == 0, F.lit("ws_a")).otherwise(F.lit("ws_b")).alias("workspace"),
        F.concat(F.lit("entity_"), _s(k)).alias("run"),
        F.array(F.concat(F.lit("s"), _s(F.col("event_id"))), F.concat(F.lit(WIDE_BUCKET + "/"), _s(F.col("event_id")), F.lit(".fa"))).alias("cells"),
        F.concat(F.lit("/tables/entity_"), _s(k), F.lit(".tsv")).alias("file"))


def failed_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origins whose copy failed: one object in 401."""
    e = table(spark, sf_dir, "events").where(F.col("event_id") % 401 == 0)
    return e.select(F.concat(F.lit(WIDE_BUCKET + "/"), _s(F.col("event_id")), F.lit(".fa")).alias("origin"))


def repeated_candidates(cands: DataFrame) -> DataFrame:
    """Candidates of which some repeat and some lack their id."""
    k = F.col("submission_id").cast("bigint")
    return cands.unionByName(cands.where(k % 3 == 0)).unionByName(cands.where(k % 11 == 0).withColumn("submission_id", F.lit(None).cast("string")))


def typed_pages(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Entity pages whose attributes are texts, numbers, booleans, nulls, lists and references to other entities."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    uri = lambda i: F.concat(F.lit(f"{WIDE_BUCKET}/"), _s(k), F.lit(f"_R{i}.fq"))
    attributes = F.struct(
        k.alias("number"), (k % 2 == 0).alias("flag"), F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("brand"),
        F.when(k % 4 == 0, F.array(uri(1), F.lit(None).cast("string"))).otherwise(F.array(uri(1), uri(2))).alias("reads"),
        F.struct(F.lit("sample").alias("entityType"), F.concat(F.lit("it's "), _s(k)).alias("entityName"), (k % 5 == 0).alias("known")).alias("ref"),
        F.array(F.struct(k.alias("n"), F.lit('say "a"').alias("t"))).alias("list"))
    e = p.select(F.floor(k / page_size).alias("page"), F.struct(F.concat(F.lit("P"), _s(k)).alias("name"), attributes.alias("attributes")).alias("e"))
    pages = e.groupBy("page").agg(F.collect_list("e").alias("results"))      # a page holds at most page_size entities
    return pages.select("page", F.to_json(F.struct("results"), {"ignoreNullFields": "false"}).alias("json"))


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object events ``(run, sample, file, modified_ms, delivery)``: an object is written again on several days, a delivery holds six days."""
    e = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    ms = F.unix_date(F.to_date("ts")).cast("bigint") * 86400000
    return e.select(F.concat(F.lit("run_"), _s(F.col("user_id") % 20)).alias("run"), F.concat(F.lit("S"), _s(F.col("user_id"))).alias("sample"),
                    F.concat("event_type", F.lit(".tsv")).alias("file"), ms.alias("modified_ms"), F.floor((day - 1) / 6).cast("int").alias("delivery"))
