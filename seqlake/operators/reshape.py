"""Wide workspace tables -> one row per object URI (EXP1-EXP4, EXP7, EXP8,
PRJ5, PRJ9, PRJ10, PRJ11, SRC10, SRC11, AGG9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType, VariantType

from ..functions.predicates import has_uri

PAGE_SCHEMA = StructType([StructField("results", ArrayType(StructType([
    StructField("name", StringType()),
    StructField("attributes", MapType(StringType(), VariantType())),
])))])
TYPE_META_SCHEMA = MapType(StringType(), StructType([
    StructField("count", LongType()),
    StructField("idName", StringType()),
    StructField("attributeNames", ArrayType(StringType())),
]))


def uri_cells(table: DataFrame, sample_col: str, marker: str = "gs://") -> DataFrame:
    """Every cell of a wide row (the id cell included) that holds a URI, as
    ``(sample, attribute, uri)``; NULL cells never match."""
    cols = table.columns
    long = table.withColumn("_sample", F.col(sample_col)).unpivot(
        ["_sample"], [F.col(c).cast("string").alias(c) for c in cols], "attribute", "uri")
    return long.where(has_uri("uri", marker)).withColumnRenamed("_sample", "sample")


def uri_cells_from_lines(lines: DataFrame, value: str = "value", marker: str = "gs://") -> DataFrame:
    """Same from raw TSV lines (header already removed): tabs and commas
    split cells, spaces become ``_``, the first cell is the id."""
    t = lines.select(F.split(F.translate(F.col(value), "\t ", ",_"), ",", -1).alias("_cells"))
    t = t.where(F.size("_cells") > 0).select(F.col("_cells")[0].alias("id"), F.explode("_cells").alias("uri"))
    return t.where(has_uri("uri", marker))


def explode_list(df: DataFrame, col: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """``a,b,c`` -> one row each (workspace lists and similar)."""
    return df.withColumn(out or col, F.explode(F.split(F.col(col), sep))).withColumn(
        out or col, F.trim(F.col(out or col)))


def entity_attributes(type_meta: DataFrame, entity_type: str, attr_list: Sequence[str] | None = None,
                      json_col: str = "json") -> tuple[str, list[str], int]:
    """(id column name, attribute names in source order, entity count).

    Reads the one metadata document of the entity type; this is schema,
    not data, so it is fetched to the driver to build the projection.
    """
    row = (type_meta.select(F.from_json(json_col, TYPE_META_SCHEMA)[entity_type].alias("m"))
           .where(F.col("m").isNotNull()).select("m.*").first())
    if row is None:
        raise KeyError(f"unknown entity type {entity_type}")
    names = list(row["attributeNames"] or [])
    if attr_list:
        wanted = set(attr_list)
        names = [a for a in names if a in wanted]
    return row["idName"], names, int(row["count"] or 0)


def page_count(count: int, page_size: int) -> int:
    return -(-int(count) // int(page_size))


# How the export writes JSON's three words, also inside lists and objects.
WORDS = {"true": "True", "false": "False", "null": "None"}


def nested_text(json: Column) -> Column:
    """Text of a JSON list or object as the export writes it: single quotes
    (double ones around a text with an apostrophe and no double quote), ``, ``
    and ``: `` between parts, ``True``, ``False`` and ``None``."""
    tokens = F.regexp_extract_all(json, F.lit(r'"(?:[^"\\]|\\.)*"|[\[\]{}]|[,:]|[^\[\]{},:"\s]+'), F.lit(0))

    def one(t: Column) -> Column:
        inner = F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('\\"'), F.lit('"'))
        double = F.contains(inner, F.lit("'")) & ~F.contains(inner, F.lit('"'))
        quoted = F.when(double, F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(inner, F.lit("'"), F.lit("\\'")), F.lit("'")))
        out = F.when(F.startswith(t, F.lit('"')), quoted).when(t.isin(",", ":"), F.concat(t, F.lit(" ")))
        for word, text in WORDS.items():
            out = out.when(t == word, F.lit(text))
        return out.otherwise(t)

    return F.array_join(F.transform(tokens, one), "")


def value_text(value: Column) -> Column:
    """Text of an attribute of any type (FN21): a text as it is, a number
    plainly, ``True`` or ``False``, a list or an object by
    :func:`nested_text`; an absent or null one is empty text."""
    kind = F.schema_of_variant(value)
    plain = F.try_variant_get(value, "$", "string")
    return (F.when(value.isNull() | F.is_variant_null(value), F.lit(""))
            .when(kind == "BOOLEAN", F.when(plain == "true", F.lit("True")).otherwise(F.lit("False")))
            .when(F.startswith(kind, F.lit("ARRAY")) | F.startswith(kind, F.lit("OBJECT")), nested_text(F.to_json(value)))
            .otherwise(plain))


def entity_table(pages: DataFrame, id_name: str, attributes: Sequence[str], json_col: str = "json") -> DataFrame:
    """Landed entity pages -> table with the id first, then the attributes
    in source order, each as text (:func:`value_text`): booleans, numbers,
    lists and objects included; an absent (or null) one is empty text."""
    rows = pages.select(F.explode(F.from_json(json_col, PAGE_SCHEMA)["results"]).alias("e"))
    return rows.select(
        F.col("e.name").alias(id_name),
        *[value_text(F.col("e.attributes")[a]).alias(a) for a in attributes],
    )


def entity_page(table: DataFrame, id_name: str, page: int, page_size: int, ascending: bool = True) -> DataFrame:
    """One page of entities in name order (LIM5) -- a preview; full reads
    use every landed page as a partition."""
    order = F.col(id_name).asc() if ascending else F.col(id_name).desc()
    return table.orderBy(order).offset((page - 1) * page_size).limit(page_size)
