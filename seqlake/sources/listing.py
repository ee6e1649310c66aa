"""Listing and reading of folders named by rows (SRC4, SRC7, SRC8, SRC20).

A job that has to look into very many run folders holds their names in a
DataFrame.  The folders are dealt over tasks, and each task asks the store for
its own ones, a directory at a time: the driver neither learns the names nor
makes a call a folder, and a lost task repeats its own folders only.
"""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import uri_text

LISTING_SCHEMA = "parent string, path string, name string, modified_ms bigint, length bigint, is_dir boolean"
LINE_SCHEMA = "file_path string, line_no bigint, line string"
# Rows of a batch and bytes read at a time.
BATCH_ROWS = 5_000
BLOCK_BYTES = 1 << 20


def _store(uri: str):
    """(file system, its path, prefix that makes a URI of such a path again)."""
    from pyarrow import fs
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    store, path = fs.FileSystem.from_uri(uri)
    prefix = "" if isinstance(store, fs.LocalFileSystem) else uri[:len(uri.rstrip("/")) - len(path.rstrip("/"))]
    return store, path, prefix


def entries(folder: str, recursive: bool, glob: str | None) -> Iterator[tuple]:
    """Entries below a folder, one directory after the other; none for a folder that is not there."""
    from pyarrow import fs
    store, root, prefix = _store(folder)
    todo = [root]
    while todo:
        here = todo.pop()
        for e in store.get_file_info(fs.FileSelector(here, allow_not_found=True)):
            is_dir = e.type == fs.FileType.Directory
            if is_dir and recursive:
                todo.append(e.path)
            if glob is None or fnmatch(e.base_name, glob):
                stamp = e.mtime_ns
                yield prefix + e.path, e.base_name, None if stamp is None else stamp // 1_000_000, None if is_dir else e.size, is_dir


def status(path: str) -> Iterator[tuple]:
    """The entry of a path itself; none where nothing is."""
    from pyarrow import fs
    store, at, prefix = _store(path)
    e = store.get_file_info(at.rstrip("/") or at)
    if e.type != fs.FileType.NotFound:
        is_dir = e.type == fs.FileType.Directory
        yield prefix + e.path, e.base_name, None if e.mtime_ns is None else e.mtime_ns // 1_000_000, None if is_dir else e.size, is_dir


def _dealt(folders: DataFrame, col: str) -> DataFrame:
    """Distinct names in about as many tasks as they need: by hash, at least one task for every core there is."""
    names = folders.select(F.col(col).alias("folder")).where(F.col(col).isNotNull()).distinct()
    tasks = max(folders.sparkSession.sparkContext.defaultParallelism, int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return names.repartition(tasks, "folder")


def list_folders(folders: DataFrame, col: str = "path", recursive: bool = True, glob: str | None = None) -> DataFrame:
    """Entries of every folder in column ``col``: ``(parent, path, name,
    modified_ms, length, is_dir)``, ``parent`` being the folder as given.

    ``recursive`` goes down all the way, ``glob`` keeps entries whose name
    matches.  Absent folders have no rows; one named twice is listed once; a
    null one is left out.  Works on every store that pyarrow knows (local,
    ``hdfs://``, ``s3://``, ``gs://``).
    """
    return _asked(_dealt(folders, col), lambda folder: entries(folder, recursive, glob))


def paths_status(paths: DataFrame, col: str = "path") -> DataFrame:
    """The given paths that are there, in the columns of :func:`list_folders`."""
    return _asked(_dealt(paths, col), status)


def _asked(names: DataFrame, ask) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["parent", "path", "name", "modified_ms", "length", "is_dir"]
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        rows = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=columns)
            rows.clear()
            return out

        for b in batches:
            for folder in b.column(0).to_pylist():
                for e in ask(folder):
                    rows.append((folder, *e))
                    if len(rows) >= BATCH_ROWS:
                        yield batch()
        yield batch()

    return names.mapInArrow(run, LISTING_SCHEMA).withColumn("path", uri_text("path"))


def read_lines(files: DataFrame, col: str = "path") -> DataFrame:
    """``(file_path, line_no, line)`` of text files named by rows, numbered from 0.

    A file is streamed by one task, block by block, whatever its size: meant
    for many small files, such as the manifests of runs.  Absent files have no
    lines.  One huge file is better read by Spark's own text source.
    """
    def lines(path: str) -> Iterator[str]:
        store, at, _ = _store(path)
        with store.open_input_stream(at) as f:
            rest = b""
            while block := f.read(BLOCK_BYTES):
                *whole, rest = (rest + block).split(b"\n")
                yield from (x.removesuffix(b"\r").decode("utf-8", "replace") for x in whole)
            if rest:
                yield rest.removesuffix(b"\r").decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                if not any(status(path)):
                    continue
                held, first = [], 0
                for line in lines(path):
                    held.append(line)
                    if len(held) >= BATCH_ROWS:
                        yield _numbered(path, first, held)
                        first, held = first + len(held), []
                yield _numbered(path, first, held)

    out = _dealt(files, col).mapInArrow(run, LINE_SCHEMA)
    return out.withColumn("file_path", uri_text("file_path"))


def _numbered(path: str, first: int, held: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(held), pa.string()), pa.array(range(first, first + len(held)), pa.int64()),
                                       pa.array(held, pa.string())], names=["file_path", "line_no", "line"])
