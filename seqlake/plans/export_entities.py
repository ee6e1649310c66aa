"""Landed entity pages -> the table file that JOB2 reads (SRC10, SRC11, LIM5, PRJ5, PRJ9, SNK7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.reshape import entity_attributes, entity_table
from ..sinks.onefile import write_ordered_file


def write_entities(pages: DataFrame, type_meta: DataFrame, entity_type: str, path: str,
                   attr_list: Sequence[str] | None = None) -> int:
    """Every entity of the landed pages as one TSV, the id first, attributes
    in source order, rows by id (the order in which pages were asked for);
    returns the bytes written.  Repeated entities stay repeated."""
    id_name, attrs, _ = entity_attributes(type_meta, entity_type, attr_list)
    return write_ordered_file(entity_table(pages, id_name, attrs), path, [id_name], sep="\t", quoted=False)


def export_entity_table(spark: SparkSession, pages: str, type_meta: str, entity_type: str, landing: str, project: str,
                        workspace: str, attr_list: Sequence[str] | None = None) -> str:
    """Export one entity type of a workspace from landed JSON documents.

    ``pages``: files of one page each; ``type_meta``: the metadata document.
    The table goes to ``<landing>/tables/<project>/<workspace>/<type>.tsv``,
    where :func:`seqlake.plans.ingest_workspace.ingest_workspace_tables` looks for it.
    """
    from ..sources.files import read_json_docs
    path = f"{landing.rstrip('/')}/tables/{project}/{workspace}/{entity_type}.tsv"
    write_entities(read_json_docs(spark, pages), read_json_docs(spark, type_meta), entity_type, path, attr_list)
    return path
