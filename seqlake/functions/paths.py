"""Path and URI columns (FN7-FN11, FN19, FN23, FN26, SNK1, PRJ7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URI_RE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ends_in_break(c: Column) -> Column:
    """Texts that end in a line break: there ``$`` also matches before the break."""
    return F.endswith(c, F.lit("\n")) | F.endswith(c, F.lit("\r")) | F.endswith(c, F.lit("\u0085")) | F.endswith(c, F.lit("\u2028")) | F.endswith(c, F.lit("\u2029"))


def base_name(c: Column | str) -> Column:
    """Last non-empty path segment (``Path.getName()``, ``basename``).

    As ``([^/]+)/*$`` has it, without a search that tries every place of every segment."""
    c = _c(c)
    return F.when(_ends_in_break(c), F.regexp_extract(c, r"([^/]+)/*$", 1)).otherwise(F.substring_index(F.rtrim(c, F.lit("/")), "/", -1))


def parent_dir(c: Column | str) -> Column:
    """Everything before the last segment, without a trailing slash.

    As if ``/*[^/]+/*$`` were removed, without a search that tries every place of every segment."""
    c = _c(c)
    path = F.rtrim(c, F.lit("/"))
    before = F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)))
    return (F.when(_ends_in_break(c), F.regexp_replace(c, r"/*[^/]+/*$", ""))
            .when(path == "", c).otherwise(F.rtrim(before, F.lit("/"))))


def uri_scheme(c: Column | str) -> Column:
    return F.regexp_extract(_c(c), URI_RE, 1)


def uri_bucket(c: Column | str) -> Column:
    return F.regexp_extract(_c(c), URI_RE, 2)


def uri_key(c: Column | str) -> Column:
    return F.regexp_extract(_c(c), URI_RE, 3)


def uri_text(c: Column | str) -> Column:
    """Path -> text that keeps the scheme; local ``file:`` paths lose it.

    Listing sources return ``file:/x`` or ``file:///x`` for local files and
    ``s3://b/k`` for objects; the catalog stores ``/x`` and ``s3://b/k``.
    """
    return F.regexp_replace(_c(c), r"^file:(//)?(?=/)", "")


def local_path(p: str) -> str:
    """Driver-side form of :func:`uri_text` for one path string."""
    for prefix in ("file://", "file:"):
        if p.startswith(prefix) and p[len(prefix):].startswith("/"):
            return p[len(prefix):]
    return p


def relative_to(c: Column | str, root: Column | str) -> Column:
    """Strip a root prefix (``f.toString().replace(root, '')``)."""
    c, root = _c(c), (F.lit(root) if isinstance(root, str) else root)
    return F.when(F.startswith(c, root), F.substr(c, F.length(root) + 1)).otherwise(c)


def fill_sample(pattern: Column | str, sample: Column | str) -> Column:
    """Literal placeholder substitution ``f.replace('<sample>', sample)``."""
    return F.replace(_c(pattern), F.lit("<sample>"), _c(sample))


def null_text(c: Column | str) -> Column:
    """Run-level files carry no sample; paths and the catalog say ``null``."""
    return F.coalesce(_c(c), F.lit("null"))


def lake_path(out: str, sample: Column | str, workflow: Column | str, run: Column | str,
              file: Column | str, timestamp: Column | str) -> Column:
    """Versioned destination in the Hive layout
    ``<out>/data/id=/workflow=/run=/file=/timestamp=/<file>``.  A NULL
    part reads ``null``, so every level is always there."""
    file = null_text(file)
    return F.concat_ws(
        "/",
        F.lit(out.rstrip("/")),
        F.lit("data"),
        F.concat(F.lit("id="), null_text(sample)),
        F.concat(F.lit("workflow="), null_text(workflow)),
        F.concat(F.lit("run="), null_text(run)),
        F.concat(F.lit("file="), file),
        F.concat(F.lit("timestamp="), null_text(timestamp)),
        file,
    )


def job_name(workflow: Column | str, run_uri: Column | str) -> Column:
    """``<workflow>_<second-last segment of the run URI, '.' -> '-'>``."""
    seg = F.try_element_at(F.split(_c(run_uri), "/"), F.lit(-2))
    return F.concat_ws("_", _c(workflow), F.replace(seg, F.lit("."), F.lit("-")))


def read_export_name(sample: Column | str, file: Column | str) -> Column:
    """Upload name ``<id>_R1.fastq.gz`` / ``<id>_R2.fastq.gz`` (R1 if the
    name contains ``R1``, else R2)."""
    mate = F.when(F.contains(_c(file), F.lit("R1")), F.lit("R1")).otherwise(F.lit("R2"))
    return F.concat(_c(sample), F.lit("_"), mate, F.lit(".fastq.gz"))
