"""One named, ordered file without one task over the data (AGG11, SNK4, SNK7, SNK8).

Rows are range-partitioned and sorted, each task turns its rows into lines
and writes them as a part, and parts come in the order of their ranges.
The byte offset of a part is the sum of the sizes before it, so on a shared
POSIX file system tasks copy the parts into one file next to each other, each
at its own offset; a repeated task writes the same bytes to the same place.
The file gets its name by a rename when all bytes are there.

Object stores cannot be written at an offset.  There one task streams the
finished parts, a block of bytes at a time; sorting and formatting stay spread.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 8 << 20


def csv_line(columns: Sequence[Column | str], sep: str = ",") -> Column:
    """A row as CSV text, quoted where needed; null is empty text."""
    return F.to_csv(F.struct(*columns), {"sep": sep, "quote": '"', "escape": '"', "emptyValue": ""})


def plain_line(columns: Sequence[Column | str], sep: str = "\t") -> Column:
    """Values joined without quotes, as readers that split on ``sep`` want
    them; a separator or line break inside a value becomes a blank."""
    cells = [F.regexp_replace(F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")),
                              f"[{sep}\r\n]", " ") for c in columns]
    return F.concat_ws(sep, *cells)


def write_ordered_file(df: DataFrame, path: str, order: Sequence[str], columns: Sequence[str] | None = None,
                       sep: str = ",", quoted: bool = True) -> int:
    """Write ``columns`` of ``df`` (all, if not named) as one text file with
    a header, rows in ``order`` (nulls first; rows that tie in it follow
    their text), and return its size in bytes.

    An empty frame writes the header alone.  A folder of that name, as other
    exports make it, or a file is replaced.  ``quoted=False`` joins values plainly.
    """
    from ..session import send_package, shared_dir
    from .committed import _path

    spark = df.sparkSession
    send_package(spark)
    names = list(columns or df.columns)
    line = csv_line([F.col(f"`{c}`") for c in names], sep) if quoted else plain_line([F.col(f"`{c}`") for c in names], sep)
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(order)]
    rows = df.select(*keys, line.alias("_line"))
    by = [f"_k{i}" for i in range(len(keys))] + ["_line"]
    staged = shared_dir(spark, "file-parts")
    rows.repartitionByRange(*by).sortWithinPartitions(*by).select("_line").write.text(staged)
    # one row a part: as many as the shuffle has partitions
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(staged).select("path", "length").collect()
    parts = sorted(((r["path"], r["length"]) for r in parts), key=lambda r: r[0].rsplit("/", 1)[-1])
    titles = [F.lit(c).alias(f"c{i}") for i, c in enumerate(names)]
    head = spark.range(1).select((csv_line(titles, sep) if quoted else plain_line(titles, sep)).alias("h")).first()["h"].encode() + b"\n"
    total = len(head) + sum(n for _, n in parts)

    final, store = _path(spark, path)
    if store.exists(final) and store.getFileStatus(final).isDirectory():
        store.delete(final, True)                     # as an overwriting export does
    if store.getScheme() == "file":
        _place(spark, final.toUri().getPath(), head, parts, total)
    else:
        _stream(spark, path, head, parts)
    return total


def _blocks(path: str) -> Iterator[bytes]:
    from pyarrow import fs

    from .copy import _local
    store, where = fs.FileSystem.from_uri(_local(path))
    with store.open_input_stream(where) as f:
        while block := f.read(BLOCK):
            yield block


def _place(spark, dest: str, head: bytes, parts: list[tuple[str, int]], total: int) -> None:
    """Every part at its offset of one file, which is named when it is whole."""
    os.makedirs(os.path.dirname(dest) or ".", exist_ok=True)
    temporary = f"{os.path.dirname(dest)}/.{os.path.basename(dest)}-{uuid.uuid4().hex[:8]}"
    with open(temporary, "wb") as f:
        f.truncate(total)
        f.write(head)
    at, rows = len(head), []
    for part, size in parts:
        rows.append((part, at, size))
        at += size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = []
            for part, start, size in zip(b["path"], b["start"], b["size"]):
                wrote = 0
                f = os.open(temporary, os.O_WRONLY)
                try:
                    for block in _blocks(part):
                        view = memoryview(block)
                        while view:
                            n = os.pwrite(f, view, int(start) + wrote)
                            wrote, view = wrote + n, view[n:]
                    os.fsync(f)
                finally:
                    os.close(f)
                if wrote != size:
                    raise OSError(f"{part} has {wrote} bytes, not {size}")
                done.append(wrote)
            yield pd.DataFrame({"wrote": done})

    if rows:
        todo = spark.createDataFrame(rows, "path string, start long, size long").repartition(len(rows), "start")
        wrote = todo.mapInPandas(run, "wrote long").agg(F.sum("wrote")).first()[0] or 0
        if wrote + len(head) != total:
            raise OSError(f"{dest}: {wrote} of {total - len(head)} bytes were written")
    os.replace(temporary, dest)


def _stream(spark, path: str, head: bytes, parts: list[tuple[str, int]]) -> None:
    """One task passes the parts on, block by block."""
    names = [p for p, _ in parts]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        from .copy import _local
        for b in batches:
            if len(b):
                store, where = fs.FileSystem.from_uri(_local(path))
                with store.open_output_stream(where) as out:
                    out.write(head)
                    for name in names:
                        for block in _blocks(name):
                            out.write(block)
                yield pd.DataFrame({"done": [True]})

    spark.range(0, 1, 1, 1).mapInPandas(run, "done boolean").collect()
