"""Toxicity: a factorization machine over hashed terms.

A text's features are its distinct words and word beginnings, hashed.  The
score adds a weight per feature and, through a short vector per feature, a
weight for every pair of features in a text, so that two harmless terms can
weigh together.  The sum over pairs is worked out as
``(sum v)**2 - sum v**2``, in time proportional to the features.

A feature is learned if its own share of toxic texts stands out, or if it is
in a pair whose share is not what the shares of its two features explain:
so terms that mean nothing alone and much together are learned too.

The machine is fitted on a sample of labelled rows of fixed size
(``MAX_TRAIN_ROWS``, those with the smallest hash of doc_id), on the driver;
its tables have a fixed size and are broadcast.  Every whole text is scored.

Null and empty texts have no features and get the score of the bias alone.
Rows of labels without toxic, or whose document is missing, teach nothing; a
document labelled twice counts twice.  With no labelled rows every score is 0.
Repeated rows repeat; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import LETTER_WORDS, Words, held_out, mix, slices, span_hash, spare, table, texts_of

#: Hash buckets, length of the feature vectors, bytes of the word beginnings.
BUCKETS = 1 << 20
FACTORS = 4
BEGINNINGS = (4, 5)
#: Labelled rows the machine is fitted on; a feature gets a weight if this many of them share it and its share
#: of toxic rows is this many standard deviations from the overall share,
MAX_TRAIN_ROWS = 12_000
MIN_ROWS = 4
MIN_DEVIATIONS = 4.0
#: or if it is in a pair that is in this many rows and whose share is this many standard deviations from what
#: the two features' own shares make together.  Pairs are counted among so many features, the most frequent ones.
PAIR_ROWS = 16
PAIR_DEVIATIONS = 10.0
PAIR_TERMS = 4096
#: Features and rows whose pairs are counted at once.
TILE = 512
EPOCHS, BATCH, RATE, SHRINK = 20, 64, 0.3, 1e-2
THRESHOLD = 0.3


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bounds): the distinct feature buckets of each text of a slice, one after another."""
    w = Words(data, off, LETTER_WORDS)
    doc = w.doc()
    size = w.end - w.start
    hashes, docs = [w.hash], [doc]
    for n in BEGINNINGS:
        long = size > n
        hashes.append(mix(span_hash(w.sums, w.start[long], w.start[long] + n) + np.uint64(n)))
        docs.append(doc[long])
    key = np.concatenate(docs).astype(np.uint64) << np.uint64(32) | (np.concatenate(hashes) >> np.uint64(64 - BUCKETS.bit_length() + 1))
    key = np.unique(key)
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64), np.searchsorted(key >> np.uint64(32), np.arange(len(off), dtype=np.uint64))


@dataclass
class Model:
    """Bias, weight per bucket and vector per bucket; zero where nothing was learned."""
    bias: float
    weight: np.ndarray
    vector: np.ndarray

    def knows(self, bucket: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether each text has a feature with a weight."""
        n = np.append(0, np.cumsum(self.weight[bucket] != 0))
        return n[bounds[1:]] > n[bounds[:-1]]

    def logits(self, bucket: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        known = self.weight[bucket] != 0
        text = np.repeat(np.arange(n), np.diff(bounds))[known]
        bucket = bucket[known]
        out = np.full(n, self.bias) + np.bincount(text, self.weight[bucket], minlength=n)
        for f in range(self.vector.shape[1]):
            v = self.vector[bucket, f]
            out += 0.5 * (np.bincount(text, v, minlength=n) ** 2 - np.bincount(text, v * v, minlength=n))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def shares(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, toxic rows) of each bucket, counted over blocks of rows: numpy widens what it counts."""
    seen, toxic = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS)
    for at in range(0, len(rows), 1024):
        block = rows[at:at + 1024]
        flat = np.concatenate(block)
        seen += np.bincount(flat, minlength=BUCKETS)
        toxic += np.bincount(flat, np.repeat(labels[at:at + 1024], [len(r) for r in block]), minlength=BUCKETS)
    return seen, toxic


def pair_features(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Buckets of features whose pairs stand out from the sum of their own weights.

    The pair counts are two products of 0-1 matrices (all rows, toxic
    rows), made of blocks of rows.  Rows of equal features and label count
    once: the terms of a text that was copied often go together anyway.
    """
    distinct = {(sha256(r.tobytes()).digest(), y): i for i, (r, y) in enumerate(zip(rows, labels))}
    at = sorted(distinct.values())
    rows, labels = [rows[i] for i in at], labels[at]
    seen, toxic = shares(rows, labels)
    share = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    common = np.flatnonzero(seen >= PAIR_ROWS)
    common = np.sort(common[np.lexsort((common, -seen[common]))[:PAIR_TERMS]])
    k = len(common)
    if k < 2:
        return common[:0]
    index = np.full(BUCKETS, -1, np.int64)
    index[common] = np.arange(k)
    own = np.clip((toxic[common] + 2 * share) / (seen[common] + 2), 1e-4, 1 - 1e-4)
    log_odds = np.log(own / (1 - own))
    found = np.zeros(k, bool)
    for lo in range(0, k, TILE):                    # so many features against all, to hold no whole table
        size = min(TILE, k - lo)
        both, bad = np.zeros((size, k), np.float32), np.zeros((size, k), np.float32)
        for at in range(0, len(rows), TILE):
            block = rows[at:at + TILE]
            x = np.zeros((len(block), k), np.float32)
            col = index[np.concatenate(block)]
            line = np.repeat(np.arange(len(block)), [len(r) for r in block])
            x[line[col >= 0], col[col >= 0]] = 1
            both += x[:, lo:lo + size].T @ x
            x = x[labels[at:at + TILE] > 0]
            bad += x[:, lo:lo + size].T @ x
        for i in range(size):
            n, p = both[i], sigmoid(log_odds[lo + i] + log_odds - np.log(share / (1 - share)))
            off = (n >= PAIR_ROWS) & (np.abs(bad[i] - n * p) >= PAIR_DEVIATIONS * np.sqrt(n * p * (1 - p)))
            off[lo + i] = False
            found[lo + i] = off.any()
    return common[found]


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """AdaGrad over mini-batches; rows are arrays of distinct buckets."""
    weight, vector = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32)
    if not len(rows):
        return Model(-40.0, weight, vector)
    seen, toxic = shares(rows, labels)
    share = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    alone = np.flatnonzero((seen >= MIN_ROWS) & (np.abs(toxic - share * seen) >= MIN_DEVIATIONS * np.sqrt(share * (1 - share) * seen)))
    known = np.union1d(alone, pair_features(rows, labels))
    index = np.full(BUCKETS, -1, np.int64)
    index[known] = np.arange(len(known))
    rows = [(i := index[r])[i >= 0] for r in rows]
    rng = np.random.default_rng(seed)
    bias, bias_g = float(np.log(share / (1 - share))), 1.0
    w, w_g = np.zeros(len(known)), np.full(len(known), 1.0)
    v, v_g = rng.normal(0, 0.01, (len(known), FACTORS)), np.full((len(known), FACTORS), 1.0)
    order = np.arange(len(rows))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for k in range(0, len(order), BATCH):
            pick = order[k:k + BATCH]
            size = np.array([len(rows[i]) for i in pick])
            flat = np.concatenate([rows[i] for i in pick])
            at, inv = np.unique(flat, return_inverse=True)
            text = np.repeat(np.arange(len(pick)), size)
            n = len(pick)
            vf = v[at][inv]
            sums = np.stack([np.bincount(text, vf[:, f], minlength=n) for f in range(FACTORS)], 1)
            squares = np.bincount(text, (vf * vf).sum(1), minlength=n)
            logit = bias + np.bincount(text, w[at][inv], minlength=n) + 0.5 * ((sums ** 2).sum(1) - squares)
            g = sigmoid(logit) - labels[pick]
            each = g[text]
            gw = np.bincount(inv, each, minlength=len(at)) + SHRINK * w[at]
            w_g[at] += gw ** 2
            w[at] -= RATE * gw / np.sqrt(w_g[at])
            pair = each[:, None] * (sums[text] - vf)
            gv = np.stack([np.bincount(inv, pair[:, f], minlength=len(at)) for f in range(FACTORS)], 1) + SHRINK * v[at]
            v_g[at] += gv ** 2
            v[at] -= 0.1 * RATE * gv / np.sqrt(v_g[at])
            gb = g.sum()
            bias_g += gb ** 2
            bias -= RATE * gb / np.sqrt(bias_g)
    weight[known], vector[known] = w, v
    return Model(bias, weight, vector)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in slices(texts_of(b)):
                bucket, bounds = features(data, off)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(bucket.astype(np.int32))), b.column(1).slice(lo, hi - lo)],
                    names=["features", "toxic"])

    sample = (labels.where("toxic is not null and doc_id is not null").where(~held_out()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows))
    # the sample has at most max_rows rows of two numbers, so it may be broadcast
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic", F.xxhash64("doc_id").alias("h"), "doc_id")
    got = picked.mapInArrow(lambda it: (x for b in it for x in run([b])), "features array<int>, toxic int").toArrow()
    # the rows are views of what arrived, in whatever chunks
    rows = [x.values.to_numpy() for chunk in got.column("features").chunks for x in chunk]
    # the order of arrival may differ from run to run
    order = sorted(range(len(rows)), key=lambda i: (len(rows[i]), rows[i].tobytes()))
    labels_of = np.asarray(got.column("toxic").to_numpy(), float)
    return train([rows[i] for i in order], labels_of[order] if len(order) else labels_of)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), score_col: str = "score", known_col: str | None = None) -> DataFrame:
    """The columns ``keep`` of documents with the probability that the text is toxic and, in ``known_col`` if named,
    whether the text has any feature with a weight."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weight, model.vector))
    schema = StructType(docs.select(*keep).schema.fields).add(score_col, "double")
    if known_col:
        schema = schema.add(known_col, "boolean")

    text = spare(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in batches:
            out, known = np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
            for lo, hi, data, off in slices(texts_of(b, text)):
                found = features(data, off)
                out[lo:hi], known[lo:hi] = sigmoid(m.logits(*found)), m.knows(*found)
            more = [pa.array(out), pa.array(known)] if known_col else [pa.array(out)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *more], names=schema.names)

    return docs.select(*keep, F.col("text").alias(text)).mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
