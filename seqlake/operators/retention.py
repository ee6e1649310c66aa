"""Retention rules: expand rules into files (EXP5, JON10, JON11, FN7, SET2)
and infer rules from an example run (JOB8: JON9, EXP6, AGG7, Q9, Q10).

Rules are a table ``(workflow, kind, pattern)`` with kind ``run_files`` or
``sample_files``; ``<sample>`` is the only placeholder.  The rule table
comes from a file; Spark picks the join by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.paths import fill_sample
from .joins import present_in

RULE_SCHEMA = "workflow string, kind string, pattern string"
# Sample names of one automaton and paths of one group: what a task holds of a run.
NAMES_PER_GROUP = 50_000
FILES_PER_GROUP = 200_000


def expand_rules(runs: DataFrame, manifest: DataFrame, rules: DataFrame) -> DataFrame:
    """Every file a run should keep: ``(run_path, run, workflow, sample, file)``.

    ``runs``: ``(run, workflow, run_path)``; ``manifest``: ``(run_path, sample,
    fastq_1, fastq_2)``.  A run is known by its whole path: two folders may
    share a name.  The patterns of a workflow are one list (as long as its
    block of the rule file), which its runs carry; a sample meets the list
    with its run and expands it where it stands.  So no sample is shuffled
    by workflow, of which there are few and one may hold nearly all samples.
    Read files come from the manifest.  An unknown workflow keeps only its reads.
    """
    patterns = rules.groupBy("workflow").agg(
        *[F.collect_list(F.when(F.col("kind") == k, F.col("pattern"))).alias(k) for k in ("run_files", "sample_files")])
    ruled = runs.select("run", "workflow", "run_path").join(patterns, "workflow", "left")
    run_files = ruled.select("run_path", "run", "workflow", F.lit(None).cast("string").alias("sample"),
                             F.explode("run_files").alias("pattern")).withColumn("pattern", F.concat("run_path", "pattern"))
    samples = manifest.select("run_path", "sample", "fastq_1", "fastq_2").join(ruled.drop("run_files"), "run_path")
    reads = F.filter(F.array("fastq_1", "fastq_2"), lambda f: f.isNotNull())
    kept = F.transform(F.coalesce("sample_files", F.array().cast("array<string>")),
                       lambda p: F.concat("run_path", fill_sample(p, "sample")))
    sample_files = samples.select("run_path", "run", "workflow", "sample", F.explode(F.concat(kept, reads)).alias("file"))
    return sample_files.unionByName(run_files.withColumnRenamed("pattern", "file"))


def existing_files(expanded: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """Keep files present in the storage listing (one semi join instead of
    one existence probe per file)."""
    return present_in(expanded, listing, ["file"], [path])


def sample_hits(files: DataFrame, samples: DataFrame, names_per_group: int = NAMES_PER_GROUP,
                files_per_group: int = FILES_PER_GROUP) -> DataFrame:
    """``(run, rel, sample, ord)``: which sample names each path of a run
    contains, one row a hit and nothing else (JON9, FLT19).

    The names of a run make an Aho-Corasick automaton inside a task, and its
    paths are run through it once.  A run with many names has several
    automata of about ``names_per_group`` names, one with many paths deals
    them into several groups of about ``files_per_group``; a group meets each
    automaton of its run, so no task holds a whole hot run.
    ``files``: distinct ``(run, rel)``; ``samples``: ``(run, sample, ord)``
    with names that are not empty.
    """
    def deal(rows: DataFrame, other: DataFrame, size: int, other_size: int, key: str, own: str, each: str) -> DataFrame:
        """Rows in groups of about ``size`` a run, one copy for every group of the other side."""
        n = rows.groupBy("run").agg(F.count(F.lit(1)).alias("_n"))
        m = other.groupBy("run").agg(F.count(F.lit(1)).alias("_m"))
        parts = n.join(m, "run").select("run", F.ceil(F.col("_n") / size).alias("_a"), F.ceil(F.col("_m") / other_size).alias("_b"))
        dealt = rows.join(parts, "run").withColumn(own, F.pmod(F.xxhash64(key), "_a"))
        return dealt.withColumn(each, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_b") - 1))).drop("_a", "_b")

    names = deal(samples, files, names_per_group, files_per_group, "sample", "_names", "_files")
    paths = deal(files, samples, files_per_group, names_per_group, "rel", "_files", "_names")
    kind = samples.schema["ord"].dataType
    order_type = to_arrow_type(kind)

    def match(paths, names):
        import ahocorasick
        import pyarrow as pa
        if not paths.num_rows or not names.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.string(), order_type)], ["run", "rel", "sample", "ord"])
        automaton, rows = ahocorasick.Automaton(), {}
        for name, order in zip(names.column("sample").to_pylist(), names.column("ord").to_pylist()):
            rows.setdefault(name, []).append(order)
        for name in rows:
            automaton.add_word(name, name)
        automaton.make_automaton()
        hit, found, orders = [], [], []
        for i, rel in enumerate(paths.column("rel").to_pylist()):
            for name in {n for _, n in automaton.iter(rel)}:
                for order in rows[name]:
                    hit.append(i)
                    found.append(name)
                    orders.append(order)
        at = paths.select(["run", "rel"]).take(pa.array(hit, pa.int64()))
        return pa.table({"run": at.column("run"), "rel": at.column("rel"), "sample": pa.array(found, pa.string()),
                         "ord": pa.array(orders, order_type)})

    schema = f"run string, rel string, sample string, ord {kind.simpleString()}"
    key = ["run", "_names", "_files"]
    return (paths.select(*key, "rel").groupBy(*key)
            .cogroup(names.select(*key, "sample", "ord").groupBy(*key)).applyInArrow(match, schema))


def infer_rules(files: DataFrame, samples: DataFrame, mode: str = "reference") -> DataFrame:
    """Rules ``(kind, pattern)`` from example runs.

    ``files``: ``(run, rel)`` paths relative to the run folder;
    ``samples``: ``(run, sample, ord)`` with ``ord`` the manifest order.

    The names that a path contains come from :func:`sample_hits`: rows are
    made for real hits only.  ``mode='reference'`` lists as run files the paths that miss at
    least one sample (so sample files also appear there when a run has two
    or more samples); ``'disjoint'`` lists the paths that contain none.
    Sample files have each contained name replaced by ``<sample>``, in
    manifest order, or longest name first in ``'disjoint'`` mode (names are
    literal text, not patterns).
    """
    if mode not in ("reference", "disjoint"):
        raise ValueError("mode must be 'reference' or 'disjoint'")
    s = samples.select("run", "sample", "ord").where(F.length("sample") > 0)
    n_samples = s.groupBy("run").agg(F.countDistinct("sample").alias("n_samples"))
    f = files.select("run", "rel").where(F.col("rel").isNotNull()).distinct()
    # Replacement order: manifest order (the lab's fold), or longest name
    # first in disjoint mode so that S1 never eats into S10.
    order = (F.struct(F.col("ord"), F.col("sample")) if mode == "reference"
             else F.struct((-F.length("sample")).alias("neg_len"), F.col("ord"), F.col("sample")))
    hits = sample_hits(f, s).groupBy("run", "rel").agg(F.sort_array(F.collect_set(order)).alias("found"))
    per_file = (f.join(hits, ["run", "rel"], "left").join(n_samples, "run", "left")
                .withColumn("n_found", F.coalesce(F.size("found"), F.lit(0))))
    if mode == "reference":
        # a name listed twice in the manifest counts once
        distinct = F.size(F.array_distinct(F.transform("found", lambda x: x["sample"])))
        run_files = per_file.where(F.coalesce(distinct, F.lit(0)) < F.coalesce("n_samples", F.lit(0)))
    else:
        run_files = per_file.where(F.col("n_found") == 0)
    sample_files = per_file.where(F.col("n_found") > 0).select(
        F.aggregate("found", F.col("rel"), lambda acc, x: F.replace(acc, x["sample"], F.lit("<sample>"))).alias("pattern"))
    return (run_files.select(F.lit("run_files").alias("kind"), F.col("rel").alias("pattern"))
            .unionByName(sample_files.select(F.lit("sample_files").alias("kind"), "pattern"))
            .distinct())


def infer_retention_rules(spark, run_dir: str, workflow: str, mode: str = "reference") -> DataFrame:
    """JOB8 on one example run folder: ``(workflow, kind, pattern)``."""
    from ..sources.files import list_files, read_csv

    root = run_dir.rstrip("/")
    files = list_files(spark, root).select(F.lit("run").alias("run"), F.col("path"))
    files = files.select("run", F.regexp_replace("path", r"^.*?" + _re_escape(root.split("://")[-1].lstrip("/")), "")
                         .alias("rel"))
    manifest = read_csv(spark, f"{root}/manifest.csv")
    from .ranking import global_index
    samples = global_index(manifest.select("sample").withColumn("_src", F.monotonically_increasing_id()),
                           ["_src"], out="ord").select(F.lit("run").alias("run"), "sample", "ord")
    return infer_rules(files, samples, mode).select(F.lit(workflow).alias("workflow"), "kind", "pattern")


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
