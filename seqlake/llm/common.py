"""Helpers shared by the training-data operators.

Tables are read through Spark only, intermediate results go to the shared
folder named by ``spark.checkpoint.dir``, and text is handed to numpy as
the raw UTF-8 buffer of an Arrow batch, cut into slices of whole documents
so that temporary arrays stay small whatever the batch holds.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes per numpy slice; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20
#: Rows of the training split: crc32(doc_id as text) mod 4 is not this.
HELD_OUT = 2


#: Whether Spark deletes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows per Arrow batch, where the session has Spark's default: texts may be long.
BATCH_ROWS = 1000
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, and keep Arrow batches small."""
    sc = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    tmp = tempfile.TemporaryDirectory(prefix="seqlake-source-")     # Spark serves the file to executors from here
    name = Path(tmp.name) / f"{root.name}-{sc.applicationId}.zip"
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(name))
    _shipped[sc.applicationId] = tmp


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; queries start here, so the package is sent along."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows that no model may learn from (a null id counts as the text '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a private one only in local mode without a setting."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root and sc.getCheckpointDir():
        root = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="seqlake-shared-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts the lineage.

    The shuffle files of the write go when it is done.  The read has the written schema, so an empty table stays readable.
    """
    path = new_path(df.sparkSession, name)
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(SHUFFLE_CLEANUP)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the folder of a table from :func:`written` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column with nulls as empty strings."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string array and the n + 1 offsets into them."""
    off = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of at most ``limit`` bytes, or one text."""
    data, off = buffers(col)
    lo, n = 0, len(col)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


# -- hashing ------------------------------------------------------------------
# Polynomial hash modulo 2**64 of bytes that a fixed random table replaced;
# powers and inverse powers let any span be cut out of one running sum.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    while len(_pow) < n:
        k = len(_pow)
        _pow = np.concatenate([_pow, _pow * np.uint64(pow(_BASE, k, 1 << 64))])
        _inv = np.concatenate([_inv, _inv * np.uint64(pow(_BASE_INV, k, 1 << 64))])
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    power, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end)."""
    _, inverse = _powers(len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


_b = np.arange(256)
#: Words as the near-duplicate contract has them: runs of bytes other than blanks.
BLANK_WORDS = ~((_b == 32) | ((_b >= 9) & (_b <= 13)))
#: Words for scoring: runs of ASCII letters, digits and non-ASCII bytes.
LETTER_WORDS = ((_b >= 48) & (_b <= 57)) | ((_b >= 65) & (_b <= 90)) | ((_b >= 97) & (_b <= 122)) | (_b >= 128)
_LOWER = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)


class Words:
    """The words of a slice of texts: byte spans, 64-bit hashes and the range of words of each text."""

    def __init__(self, data: np.ndarray, off: np.ndarray, kind: np.ndarray = BLANK_WORDS):
        low = _LOWER[data]
        inside = kind[low]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, off)
        self.count = np.diff(self.bounds)
        self.sums = prefix_sums(low)
        self.hash = span_hash(self.sums, self.start, self.end)
        self.low = low

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def rolling(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of every run of n consecutive word hashes (len(words) - n + 1 of them)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    m = len(words) - n + 1
    acc = np.full(m, np.uint64(seed))
    for j in range(n):
        acc = (acc ^ words[j:j + m]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return mix(acc)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from fn(b)
    return df.mapInArrow(run, schema)
