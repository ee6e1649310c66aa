"""Exact top-k search by incremental multi-index hashing of binary codes.

A vector's code has one bit per component: whether it is above zero.  Codes
are cut into 16-bit segments.  A code at Hamming distance d from the query
differs by at most floor(d / m) bits in one of its m segments, so a search that
has looked up, in the first j + 1 segments, all segment values within r bits
and in the others all within r - 1 has met every code up to distance
``m * r + j``.  Each search grows r, one segment at a time, until that covers
its kth verified distance (or a bound known before).

Equal codes are one entry that keeps its smallest k + 1 ids, so a very common
vector costs one entry.  Distinct codes are dealt into blocks by hash.  A query
first searches one block, which bounds its kth distance, then the others within
that bound; a block answers a query by its local top k, and Spark merges these.
Queries go to blocks, code by code; no task holds more than one block and one
chunk of queries.

Queries are all rows whose vec_id is divisible by 50, against all rows but the
query's own id; ties go to the smaller vec_id.  Rows with null id or vector are
neither found nor searched; missing components and NaN count as not above zero;
an id that comes twice is found once for each distinct code.  An empty table
gives an empty table.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import table, written

#: Neighbours per query, distinct codes per index block.
K = 10
BLOCK_CODES = 1 << 15
QUERY_CHUNK = 512


def codes(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, code): ``dims`` bits rounded up to whole 16-bit segments."""
    width = -(-dims // 16) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            size = np.minimum(np.diff(col.offsets.to_numpy()), dims)
            flat = np.nan_to_num(np.asarray(col.values.to_numpy(zero_copy_only=False), np.float64)) > 0
            bits = np.zeros((len(col), width * 8), np.uint8)
            start = col.offsets.to_numpy()[:-1]
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                bits[at[:, None], np.arange(n)] = flat[start[at][:, None] + np.arange(n)]
            packed = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in packed], pa.binary())], names=["vec_id", "code"])

    return vectors.where("vec_id is not null and embedding is not null").select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).mapInArrow(
        run, "vec_id bigint, code binary")


@lru_cache(maxsize=17)
def masks(r: int) -> np.ndarray:
    """All 16-bit values of r bits."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(16), r)], np.uint16)


class Block:
    """Segment tables of a block of distinct codes (n x m array of 16-bit segments)."""

    def __init__(self, segments: np.ndarray, ids: np.ndarray):
        self.seg, self.n_ids = segments, ids
        self.order = [np.argsort(segments[:, s], kind="stable") for s in range(segments.shape[1])]
        self.table = [np.searchsorted(segments[o, s], np.arange((1 << 16) + 1)) for s, o in enumerate(self.order)]

    def search(self, query: np.ndarray, k: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """(code numbers, distances) of all codes up to the distance by which k ids are met, none above bound."""
        n, m = self.seg.shape
        met = np.zeros(n, bool)
        found, dist = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        by_distance = np.zeros(16 * m + 1, np.int64)          # ids at each verified distance
        for r in range(17):
            for s in range(m):
                keys = (query[s] ^ masks(r)).astype(np.int64)
                lo, hi = self.table[s][keys], self.table[s][keys + 1]
                some = hi > lo
                lo, size = lo[some], (hi - lo)[some]
                total = int(size.sum())
                if total:
                    at = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
                    new = self.order[s][at]
                    new = new[~met[new]]
                    met[new] = True
                    d = np.bitwise_count(self.seg[new] ^ query).sum(1).astype(np.int64)
                    found.append(new)
                    dist.append(d)
                    by_distance += np.bincount(d, self.n_ids[new], minlength=len(by_distance)).astype(np.int64)
                covered = m * r + s
                kth = int(np.searchsorted(np.cumsum(by_distance), k))    # distance of the kth id met so far
                if covered >= min(kth, bound):
                    f, d = np.concatenate(found), np.concatenate(dist)
                    keep = d <= min(kth, bound)
                    return f[keep], d[keep]
        f, d = np.concatenate(found), np.concatenate(dist)
        keep = d <= min(kth, bound)
        return f[keep], d[keep]


def _search_blocks(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query, code, distance) of the local answers; index (block, code, n), asked (block, query, bound)."""
    left = index.select("block", F.lit(0).alias("kind"), "code", F.col("n").cast("int").alias("n"))
    right = asked.select("block", F.lit(1).alias("kind"), F.col("query").alias("code"), F.col("bound").cast("int").alias("n"))
    rows = left.unionByName(right).repartition("block").sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, block = None, [], None

        def answers(queries: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(queries), QUERY_CHUNK):
                q, c, d = [], [], []
                for code, bound in queries[at:at + QUERY_CHUNK]:
                    f, dist = block.search(np.frombuffer(code, np.uint16), k, bound)
                    q += [code] * len(f)
                    c += [own[i][0] for i in f]
                    d.append(dist)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.binary()), pa.array(c, pa.binary()), pa.array(np.concatenate(d).astype(np.int32))],
                                                 names=["query", "code", "distance"])

        for b in batches:
            ask: list[tuple[bytes, int]] = []
            for key, kind, code, n in zip(*(col.to_pylist() for col in b.columns), strict=True):
                if key != now:
                    if ask:
                        yield from answers(ask)
                        ask = []
                    now, own, block = key, [], None
                if kind == 0:
                    own.append((code, n))
                elif own:
                    if block is None:
                        block = Block(np.frombuffer(b"".join(x for x, _ in own), np.uint16).reshape(len(own), -1), np.array([x for _, x in own]))
                    ask.append((code, n))
            if ask:
                yield from answers(ask)

    return rows.mapInArrow(run, "query binary, code binary, distance int")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block_codes: int = BLOCK_CODES) -> DataFrame:
    """(query_id, rank, vec_id, distance) of the k nearest of ``vectors`` for each row of ``queries``, by Hamming distance."""
    both = vectors.select(F.max(F.size("embedding")).alias("d")).unionByName(queries.select(F.max(F.size("embedding")).alias("d")))
    dims = max(1, both.agg(F.max("d")).first()[0] or 1)
    coded = codes(vectors, dims)
    # the smallest k + 1 ids of every code, one of which may be the query itself
    ranked = coded.dropDuplicates(["vec_id", "code"]).withColumn("at", F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    entries = written(ranked.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "topk-codes")
    n_blocks = max(1, -(-entries.count() // block_codes))
    home = lambda c: F.pmod(F.xxhash64(c), F.lit(n_blocks))
    index = entries.select(home("code").alias("block"), "code", F.size("ids").alias("n"))
    asked = written(codes(queries, dims).dropDuplicates(["vec_id", "code"]).select(F.col("vec_id").alias("query_id"), F.col("code").alias("query")), "topk-queries")
    distinct = asked.select("query").distinct()
    limit = 16 * (-(-dims // 16))
    first = written(_search_blocks(index, distinct.select(home("query").alias("block"), "query", F.lit(limit).alias("bound")), k + 1), "topk-first")
    # a home block with at least k + 1 ids bounds the distance in all others
    size = entries.select("code", F.size("ids").alias("n"))
    bound = (first.join(size, "code").groupBy("query").agg(F.sum("n").alias("ids"), F.max("distance").alias("far"))
             .select("query", F.when(F.col("ids") > k, F.col("far")).otherwise(F.lit(limit)).alias("bound")))
    others = (distinct.join(bound, "query", "left").select("query", F.coalesce("bound", F.lit(limit)).alias("bound"), home("query").alias("home"),
              F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block")).where("block <> home"))
    answers = first.unionByName(_search_blocks(index, others.select("block", "query", "bound"), k + 1))
    pairs = answers.join(entries, "code").select("query", "distance", F.explode("ids").alias("vec_id"))
    near = pairs.withColumn("at", F.row_number().over(Window.partitionBy("query").orderBy("distance", "vec_id"))).where(F.col("at") <= k + 1)
    lists = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("near"))
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = asked.join(lists, "query").select("query_id", F.posexplode(own).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.distance").alias("distance"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


ORACLE_OP8 = """
WITH p AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
    CAST(list_sum([CASE WHEN (q.embedding[i] > 0) <> (v.embedding[i] > 0) THEN 1 ELSE 0 END for i in generate_series(1, 64)]) AS INTEGER) AS distance
  FROM embeddings q JOIN embeddings v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10"""
