"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counting: every task adds up the n-gram buckets of its documents per
language and hands on one row per language and non-empty bucket; Spark sums
these.  The log-probability matrix (buckets x languages, a size that does not
depend on the corpus) is broadcast, and whole texts are scored in numpy
through the sparse list of their buckets.

Texts are lower-cased; a run of anything but letters counts as one blank.
A text that is null or has no letter gets `und` with score 0, as does every
text when nothing was learned.  Ties go to the language that sorts first.
Rows with null text or language teach nothing; repeated rows count as often
as they come; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import held_out, slices, spare, table, texts_of

#: n-gram orders, hash buckets, added count, and the largest matrix that is broadcast.
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
MAX_MATRIX_BYTES = 256 << 20

_table: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point its lower-case letter, or a blank; made once per Python worker."""
    global _table
    if _table is None:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (ch := chr(c)).isalpha():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _table = t
    return _table


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a slice of texts, the text of each, and the number of letters of each text."""
    whole = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = heads[off]
    doc = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(at))
    c = letters()[whole]
    blank = c == 32
    n_letters = np.bincount(doc[~blank], minlength=len(off) - 1)
    keep = np.ones(len(c), bool)
    keep[1:] = ~(blank[1:] & blank[:-1]) | (doc[1:] != doc[:-1])
    c, doc = c[keep], doc[keep]
    out, docs = [], []
    acc = np.zeros(len(c), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        acc = (acc[:m] * np.uint32(0x01000193)) ^ (c[n - 1:] * np.uint32(0x85EBCA6B))
        if n in ORDERS:
            h = (acc ^ (acc >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            h = (h ^ (h >> np.uint32(13))) * np.uint32(0x297A2D39 + 2 * n)
            one = doc[:m] == doc[n - 1:]
            out.append((h >> np.uint32(32 - BUCKETS.bit_length() + 1))[one])
            docs.append(doc[:m][one])
    if not out:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32), n_letters
    return np.concatenate(out), np.concatenate(docs), n_letters


@dataclass
class Model:
    """Languages in sorted order and log probabilities, one row per bucket, the last row their prior."""
    languages: list[str]
    log_p: np.ndarray


def counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) summed over all rows of (text, lang); bucket -1 counts texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column(1).to_pylist(), object)
            for lo, hi, data, off in slices(texts_of(b)):
                bucket, doc, n_letters = grams(data, off)
                names, code = np.unique(langs[lo:hi].astype(str), return_inverse=True)
                for k, name in enumerate(names):
                    t = total.setdefault(str(name), np.zeros(BUCKETS + 1, np.int64))
                    t[:-1] += np.bincount(bucket[code[doc] == k] if len(names) > 1 else bucket, minlength=BUCKETS)
                    t[-1] += int(((code == k) & (n_letters > 0)).sum())
        for name, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(np.where(at == BUCKETS, -1, at).astype(np.int32)), pa.array(t[at])],
                names=["lang", "bucket", "n"])

    src = docs.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    return src.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Model:
    """Learn from all rows of (text, lang). The driver receives bucket totals: at most (BUCKETS + 1) a language."""
    rows = counts(docs).toPandas()
    languages = sorted(rows["lang"].unique())
    if BUCKETS * len(languages) * 4 > MAX_MATRIX_BYTES:
        raise ValueError(f"{len(languages)} languages need more than the {MAX_MATRIX_BYTES} bytes that may be broadcast")
    n = np.zeros((BUCKETS + 1, len(languages)))
    n[rows["bucket"].to_numpy(), rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64) if len(rows) else []] = rows["n"].to_numpy()
    log_p = np.empty((BUCKETS + 1, len(languages)), np.float32)
    if languages:
        smooth = n[:-1] + SMOOTHING
        log_p[:-1] = np.log(smooth / smooth.sum(0))
        log_p[-1] = np.log((n[-1] + SMOOTHING) / (n[-1] + SMOOTHING).sum())
    return Model(languages, log_p)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), pred_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """The columns ``keep`` of documents with the predicted language and its posterior probability."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p))
    schema = StructType(docs.select(*keep).schema.fields).add(pred_col, "string").add(score_col, "double")

    text = spare(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_p = shared.value
        for b in batches:
            pred, score = np.full(b.num_rows, "und", object), np.zeros(b.num_rows)
            for lo, hi, data, off in slices(texts_of(b, text)):
                bucket, doc, n_letters = grams(data, off)
                if not languages or not len(bucket):
                    continue
                size = hi - lo
                total = np.stack([np.bincount(doc, log_p[:, k][bucket], minlength=size) for k in range(len(languages))], 1) + log_p[-1]
                best = total.argmax(1)
                p = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                real = n_letters > 0
                pred[lo:hi][real] = np.array(languages, object)[best[real]]
                score[lo:hi][real] = p[real]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(pred, pa.string()), pa.array(score)], names=[*b.schema.names[:-1], pred_col, score_col])

    return docs.select(*keep, F.col("text").alias(text)).mapInArrow(run, schema)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
