"""Header-variant result tables (PRJ4, PRJ6, FN3, FN6, Q2).

Each result table has its producer's header.  A row is carried as its
file's ``header`` array next to its ``cells`` array, so every file keeps
its own header even when many files are read together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import normalize_sample_id, sanitize

# Output field -> header names, in order of preference.
ALTERNATIVES: dict[str, list[str]] = {
    "qc": ["Auto_QC_Outcome", "qc_outcome", "aa_qc_check"],
    "qc_reason": ["Auto_QC_Failure_Reason", "qc_reason", "aa_qc_alert"],
    "read_depth": ["Estimated_Coverage", "estimated_coverage", "est_coverage_clean"],
    "assembly_len": ["Genome_Length", "genome_length", "assembly_length"],
    "n_contigs": ["#_of_Scaffolds_>500bp", "scaffold_count", "number_contigs"],
    "per_gc": ["GC_%", "gc_percent", "quast_gc_percent"],
    "species": ["Species", "species", "fastani_genus_species"],
    "species_conf": ["Taxa_Confidence", "taxa_confidence", "fastani_ani_estimate"],
    "mlst_1": ["MLST_1", "mlst_1"],
    "mlst_2": ["MLST_2", "mlst_2"],
    "mlst_1_scheme": ["MLST_Scheme_1", "mlst_scheme_1"],
    "mlst_2_scheme": ["MLST_Scheme_2", "mlst_scheme_2"],
    "beta_amr": ["GAMMA_Beta_Lactam_Resistance_Genes", "beta_lactam_resistance_genes"],
    "other_amr": ["GAMMA_Other_AR_Genes", "other_ar_genes"],
    "plasmids": ["Plasmid_Incompatibility_Replicons", "plasmid_incompatibility_replicons"],
    "vir_genes": ["Hypervirulence_Genes", "hypervirulence_genes"],
}
ID_HEADER = "ID"


def cell(header: Column, cells: Column, name: str) -> Column:
    """Value under ``name``; with a repeated name the last one wins (as a
    map built from the header would); a short line gives NULL."""
    pos_from_end = F.array_position(F.reverse(header), F.lit(name))
    idx = F.size(header) - pos_from_end + 1
    return F.when(pos_from_end > 0, F.try_element_at(cells, idx.cast("int")))


def places(header: Column, wanted: Sequence[Sequence[str]]) -> Column:
    """For each list of names, how far from the end of ``header`` the first
    name that it has stands (1: last cell); 0 where it has none.

    One short expression over a literal table of names, so that the generated
    code stays small enough to be compiled whatever the number of fields.
    """
    back = F.reverse(header)
    lists = F.array(*[F.array(*[F.lit(n) for n in names]) for names in wanted])
    at = lambda name: F.array_position(back, name)
    first = lambda names: F.coalesce(F.try_element_at(F.filter(F.transform(names, at), lambda p: p > 0), F.lit(1)), F.lit(0))
    return F.transform(lists, lambda names: first(names).cast("int"))


def resolve_results(rows: DataFrame, header: str = "header", cells: str = "cells",
                    alternatives: Mapping[str, Sequence[str]] = ALTERNATIVES,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Uniform result columns: ``id`` (normalised), then one column per
    field, each sanitised (``,`` -> ``;``, space -> ``_``)."""
    wanted = [[ID_HEADER], *alternatives.values()]
    at = F.col("_places")
    # the cells of all fields in one array; a short line or an absent field gives NULL
    picked = F.transform(at, lambda p: F.when(p > 0, F.try_element_at(F.col(cells), F.col("_end") - p)))
    rows = rows.withColumns({"_places": places(F.col(header), wanted), "_end": F.size(header) + 1})
    rows = rows.select(*keep, F.when(at[0] > 0, picked[0]).otherwise(F.try_element_at(F.col(cells), F.lit(1))).alias("_id"),
                       F.transform(picked, lambda v: sanitize(F.nullif(v, F.lit("")))).alias("_values"))
    return rows.select(*keep, normalize_sample_id(F.col("_id")).alias("id"),
                       *[F.col("_values")[i + 1].alias(out) for i, out in enumerate(alternatives)])
