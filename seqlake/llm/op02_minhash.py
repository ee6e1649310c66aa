"""Near-duplicate classes by min-max hashing.

Each permutation of the 64-bit shingle hashes gives two values, the smallest
and the largest, so 48 permutations make a signature of 96 values; four
minima or four maxima of different permutations make a band, 24 bands in all.
Two texts of similarity 0.85 (0.80) share no band with probability 2e-8
(3e-6); texts that share one are candidates, and every link is confirmed on the
full shingle sets.

Equal texts are one class from the start, by a 128-bit hash of their words, so
copies cost one row each.  Within a bucket of a band no list of all pairs is
made:

1. Every class is compared with the bucket's leader, the member with most
   company over all its buckets (in a group of edited copies, their common source).
2. Buckets whose other members do not all belong to one component yet are
   resolved in blocks: members outside the bucket's largest component, in chunks,
   meet all members, in chunks, and one index lookup per member gives its
   intersections with a whole chunk.  Pairs already connected are not looked
   at; all others are, so components are exact for the candidates.

Words are runs of bytes other than blanks, with A-Z in lower case; shingles are
five words, or all words of a shorter text.  Null and blank texts have no
shingles and no links; rows of one doc_id are the same document; a null doc_id
is a document of its own class's text.  Repeated rows repeat; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import Words, map_batches, mix, rolling, slices, table, texts_of, written
from .components import components

SHINGLE = 5
PERMUTATIONS, BAND = 48, 4
#: Similarity of a link in percent, and classes per chunk of a block.
PERCENT = 85
CHUNK = 512

_rng = np.random.default_rng(20240612)
_FACTOR = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    w = Words(data, off)
    full = rolling(w.hash, SHINGLE, SHINGLE)
    out = []
    for k, (a, n) in enumerate(zip(w.bounds[:-1].tolist(), w.count.tolist(), strict=True)):
        if n >= SHINGLE:
            out.append(np.unique(full[a:a + n - SHINGLE + 1]))
        else:
            out.append(rolling(w.hash[a:a + n], n, n) if n else np.zeros(0, np.uint64))
    return out


def word_key(text: bytes) -> bytes:
    """128-bit hash of a text's words."""
    return hashlib.md5(b" ".join(text.lower().split()), usedforsecurity=False).digest()


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Band keys of non-empty shingle sets, one row a set."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low, high = np.empty((len(sets), PERMUTATIONS), np.uint64), np.empty((len(sets), PERMUTATIONS), np.uint64)
    v = np.empty_like(flat)
    for p in range(PERMUTATIONS):
        np.multiply(flat, _FACTOR[p], out=v)
        v += _SHIFT[p]
        low[:, p] = np.minimum.reduceat(v, at)
        high[:, p] = np.maximum.reduceat(v, at)
    keys = []
    for values in (low, high):
        for b in range(0, PERMUTATIONS, BAND):
            acc = np.full(len(sets), np.uint64(len(keys) + 1))
            for j in range(BAND):
                acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + values[:, b + j])
            keys.append(acc)
    return np.stack(keys, 1).view(np.int64)


def _signatures(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for lo, hi, data, off in slices(texts_of(batch)):
        sets = shingle_sets(data, off)
        some = [i for i, s in enumerate(sets) if len(s)]
        lists: list[np.ndarray | None] = [None] * len(sets)
        if some:
            for i, row in zip(some, bands([sets[i] for i in some]), strict=True):
                lists[i] = row
        yield pa.RecordBatch.from_arrays([
            batch.column(0).slice(lo, hi - lo),
            pa.array([word_key(data[off[i]:off[i + 1]].tobytes()) if len(s) else None for i, s in enumerate(sets)], pa.binary()),
            pa.array([len(s) for s in sets], pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "cls", "n", "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, cls, n, bands): class key (null without words), size of the shingle set and band keys."""
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _signatures,
                       "doc_id bigint, cls binary, n bigint, bands array<bigint>")


def _links(percent: int):
    """Streams blocks sorted by (block, side): side 0 is kept, each row of side 1 is compared with all of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, index = None, [], None
        parent: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for b in batches:
            a_out, b_out = [], []
            keys, sides, cls, comps = (b.column(k).to_pylist() for k in range(4))
            for lo, hi, data, off in slices(texts_of(b)):
                for i, s in zip(range(lo, hi), shingle_sets(data, off), strict=True):
                    if word_key(data[off[i - lo]:off[i - lo + 1]].tobytes()) != cls[i]:
                        continue                    # another text under the same doc_id
                    if keys[i] != now:
                        now, kept, index, parent = keys[i], [], None, {}
                    if sides[i] == 0:
                        kept.append((cls[i], comps[i], s))
                        continue
                    if not kept:
                        continue
                    if index is None:
                        flat = np.concatenate([x[2] for x in kept])
                        owner = np.repeat(np.arange(len(kept)), [len(x[2]) for x in kept])
                        order = np.argsort(flat, kind="stable")
                        index = flat[order], owner[order], np.array([len(x[2]) for x in kept])
                    flat, owner, sizes = index
                    first, last = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
                    some = last > first
                    first, count = first[some], (last - first)[some]
                    if not len(first):
                        continue
                    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
                    both = np.bincount(owner[at], minlength=len(kept))
                    for k in np.flatnonzero(100 * both >= percent * (sizes + len(s) - both)):
                        x, y = find(kept[k][1]), find(comps[i])
                        if x != y:
                            parent[y] = x
                            a_out.append(kept[k][0])
                            b_out.append(cls[i])
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.binary()), pa.array(b_out, pa.binary())], names=["a", "b"])
    return run


def _compare(blocks: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links found in blocks (block, side, cls, comp); texts (cls, text)."""
    rows = blocks.join(texts, "cls").select("block", "side", "cls", "comp", "text")
    return rows.repartition("block").sortWithinPartitions("block", "side").mapInArrow(_links(percent), "a binary, b binary")


def classes_of(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, cls, root): component_id is the smallest doc_id reachable over links; cls is the
    class key of the text and root that of its component, null without words."""
    sig = written(signatures(docs), "minhash-signatures")
    one = sig.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    bucket = one.select(F.explode("bands").alias("key"), "cls", "rep", "n")
    sizes = bucket.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(bucket.join(sizes, "key"), "minhash-buckets")

    # texts of all classes that have company
    needed = shared.select("cls", "rep").distinct()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    texts = written(d.join(needed, d["doc_id"].eqNullSafe(needed["rep"])).select("cls", "text"), "minhash-texts")

    # 1. every member against the leader of its bucket
    company = shared.groupBy("cls").agg(F.sum("size").alias("company"))
    shared = shared.join(company, "cls")
    leaders = shared.groupBy("key").agg(F.max(F.struct("company", "cls", "n")).alias("lead"))
    led = written(shared.join(leaders, "key").select("key", "cls", "n", F.col("lead.cls").alias("leader"), F.col("lead.n").alias("leader_n")), "minhash-led")
    stars = led.where("cls <> leader").where(100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n")).select("leader", "cls").distinct()
    parts = stars.groupBy("leader").agg(F.ceil(F.count("*") / CHUNK).alias("parts"))
    dealt = stars.join(parts, "leader").select("leader", "cls", F.pmod(F.xxhash64("cls"), "parts").alias("part"))
    block = F.concat("leader", F.lit(":").cast("binary"), F.col("part").cast("string").cast("binary"))
    sides = dealt.select(block.alias("block"), F.lit(1).alias("side"), "cls").unionByName(
        dealt.select(block.alias("block"), F.lit(0).alias("side"), F.col("leader").alias("cls")).distinct())
    first = written(_compare(sides.withColumn("comp", F.col("cls")), texts, percent), "minhash-links")
    found = written(components(first), "minhash-components")

    # 2. buckets whose members other than the leader are not all in one component
    rest = led.where("cls <> leader").select("key", "cls").join(found.withColumnRenamed("node", "cls"), "cls", "left").select(
        "key", "cls", F.coalesce("root", "cls").alias("comp"))
    per = rest.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("sum"))
    mixed = per.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("most"), F.sum("c").alias("members"), F.count("*").alias("comps"), F.sum("sum").alias("sum")).where("comps > 1")
    # buckets of the same members are one
    mixed = mixed.groupBy("members", "sum", "comps").agg(F.min(F.struct("key", "most")).alias("x")).select(
        "members", F.col("x.key").alias("key"), F.col("x.most.comp").alias("most"), (F.col("members") - F.col("x.most.c")).alias("others"))
    rest = rest.join(mixed, "key").withColumns({"a": F.ceil(F.col("others") / CHUNK), "b": F.ceil(F.col("members") / CHUNK)})
    names = lambda i, j: F.concat_ws(":", "key", i.cast("string"), j.cast("string")).cast("binary")
    own = lambda n: F.pmod(F.xxhash64("cls"), F.col(n))
    until = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asked = rest.where("comp <> most").select("key", "cls", "comp", own("a").alias("i"), until("b").alias("j")).select(
        names(F.col("i"), F.col("j")).alias("block"), F.lit(0).alias("side"), "cls", "comp")
    met = rest.select("key", "cls", "comp", until("a").alias("i"), own("b").alias("j")).select(
        names(F.col("i"), F.col("j")).alias("block"), F.lit(1).alias("side"), "cls", "comp")
    second = _compare(asked.unionByName(met), texts, percent)
    # links of classes stand for links of their components so far
    found = components(written(first.unionByName(second), "minhash-links"))

    root = one.select("cls", "rep").join(found.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    root = written(root, "minhash-roots")
    least = root.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = root.join(least, "root").select("cls", "root", "component_id")
    return sig.select("doc_id", "n", "cls").join(of, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "cls", "root")


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """The documents with the class key of their text as a further column."""
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = (t.as_py() for t in b.column(text))
            keys = [word_key(t.encode()) if t and t.encode().split() else None for t in raw]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes_of(docs).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


ORACLE_OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""
