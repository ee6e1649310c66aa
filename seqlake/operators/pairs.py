"""Read pairing and newest assembly per sample (JON12, WIN4, AGG12, FLT14-15, AGG2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_first_mate, is_original_read, is_sample_assembly
from ..functions.timefmt import seconds_value
from .latest import latest_by


def read_pairs(files: DataFrame, key: str = "id_alt", file: str = "file", uri: str = "current") -> DataFrame:
    """One ``(key, fastq_1, fastq_2)`` row per sample that has a mate pair.

    The first mate is the smallest ``(file, uri)`` whose name fully
    matches ``.*_R1.*.fastq.gz``; its mate is the file named like it with
    every ``R1`` turned into ``R2``, taking the smallest URI of that name.

    One partial aggregate gives the smallest URI of every (sample, file).  Of
    what is left, a read stands under its own name, and a first mate under its
    mate's name as well: grouped by (sample, name) the two meet, and the smallest first mate
    of the sample is taken.  That is one scan and no join, and a sample with very many
    files is dealt by name before its few candidates meet.  Duplicate input
    rows do not change the result.  Run-level rows (``'null'``) have no sample and are left out before
    any grouping.
    """
    f, u = F.col("_f"), F.col("_u")
    reads = (files.where(is_original_read(file) & (F.col(key) != "null"))
             .groupBy(F.col(key).alias("_k"), F.col(file).alias("_f")).agg(F.min(uri).alias("_u")))
    plain = F.lit(None).cast("struct<f:string,u:string>")
    as_mate = F.struct(f.alias("name"), u.alias("mate"), plain.alias("first"))
    as_first = F.struct(F.replace(f, F.lit("R1"), F.lit("R2")).alias("name"), F.lit(None).cast("string").alias("mate"),
                        F.struct(f.alias("f"), u.alias("u")).alias("first"))
    stands = F.filter(F.array(as_mate, F.when(is_first_mate("_f"), as_first)), lambda x: x.isNotNull())
    named = reads.select("_k", F.explode(stands).alias("x")).select("_k", "x.*")
    pairs = named.groupBy("_k", "name").agg(F.min("first").alias("first"), F.min("mate").alias("mate")).where(F.col("first").isNotNull())
    best = pairs.groupBy("_k").agg(F.min(F.struct("first", "mate")).alias("b")).where(F.col("b.mate").isNotNull())
    return best.select(F.col("_k").alias(key), F.col("b.first.u").alias("fastq_1"), F.col("b.mate").alias("fastq_2"))


def newest_assembly(files: DataFrame, key: str = "id_alt", sample: str = "id", file: str = "file",
                    uri: str = "current", ts: str = "timestamp") -> DataFrame:
    """``(key, assembly)``: the newest ``<id>.scaffolds.fa.gz`` or
    ``<id>_contigs.fasta`` per sample, numeric time first, then URI."""
    asm = (files.where(is_sample_assembly(file, sample) & (F.col(key) != "null"))
           .select(F.col(key).alias("_k"), F.col(uri).alias("assembly"), seconds_value(ts).alias("_t")))
    best = latest_by(asm, ["_k"], ["_t"], ["assembly"])
    return best.select(F.col("_k").alias(key), "assembly")
