"""Centroid clustering with an incremental matrix of dot products.

Vectors become integers, so that every sum is exact.  A row keeps its squared
norm and its dot product with every centroid.  A new centroid differs from the
one before in some components; the dot products change by those components
only, and the nearest centroid is found anew from

    distance = |x|^2 - 2 x.c + |c|^2

Each round writes its rows to the shared folder, so a lost executor repeats
its tasks of the round only.  Component sums of a cluster are added up in
the tasks first; the driver receives clusters x components numbers.

Kept are vectors of exactly ``width`` components, none null or non-finite, and
none beyond ``MAX_VALUE``: no long could hold the distances of those beyond.
The others have no row in the result.  A null vec_id hashes as the empty text;
of vectors with one hash the smaller components come first; repeated rows are
vectors of their own; fewer vectors than clusters make as many clusters as
vectors; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Components, units of a component, clusters, rounds that move centroids, and the text before an id that is hashed to draw them.
WIDTH = 64
UNITS = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
#: Largest component: with it, WIDTH squared differences of UNITS-fold values fit in a long.
MAX_VALUE = float(1 << 21)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding", width: int = WIDTH, units: int = UNITS) -> DataFrame:
    """(vec_id, v array<int>) of the vectors that are kept."""
    x = F.col(col).cast("array<double>")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= MAX_VALUE))
    kept = vectors.where((F.size(col) == width) & usable)
    return kept.select(F.col(id_col).alias("vec_id"), F.transform(x, lambda e: F.floor(e * units).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: str = SEED, width: int = WIDTH) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, one row each."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(text.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), width)


def _matrix(col: pa.Array, width: int, kind: type) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(col), width)


def assign(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """(vec_id, v, norm, dots, cluster, distance) with the dot products brought from the old centroids to the new ones.

    Rows without dot products yet (v alone) have those of the zero centroids.
    """
    k, width = new.shape
    moved = [(i, at, (new - old)[i, at]) for i in range(k) if len(at := np.flatnonzero((new - old)[i]))]
    square = (new * new).sum(1)
    known = "dots" in state.columns
    kind = state.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column(1), width, np.int64)
            if known:
                norm, dots = b.column(2).to_numpy(), _matrix(b.column(3), k, np.int64).copy()
            else:
                norm, dots = (v * v).sum(1), np.zeros((len(v), k), np.int64)
            for i, at, by in moved:
                dots[:, i] += v[:, at] @ by
            distance = norm[:, None] - 2 * dots + square[None, :]
            cluster = distance.argmin(1)                # the smaller number of equally near ones
            off = pa.array(np.arange(len(v) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(norm), pa.ListArray.from_arrays(off, pa.array(dots.reshape(-1))),
                pa.array(cluster.astype(np.int32)), pa.array(distance[np.arange(len(v)), cluster])],
                names=["vec_id", "v", "norm", "dots", "cluster", "distance"])

    columns = ["vec_id", "v", *(["norm", "dots"] if known else [])]
    return state.select(*columns).mapInArrow(run, f"vec_id {kind}, v array<int>, norm bigint, dots array<bigint>, cluster int, distance bigint")


def cluster_sums(state: DataFrame, width: int) -> DataFrame:
    """(cluster, n, place, total): members and component sums of every non-empty cluster, added up in the tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for b in batches:
            cluster, v = b.column(0).to_numpy(), _matrix(b.column(1), width, np.int64)
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                n[c] = n.get(c, 0) + int(mine.sum())
                total[c] = total.get(c, 0) + v[mine].sum(0)
        for c in n:
            yield pa.RecordBatch.from_arrays([pa.array([c] * width, pa.int32()), pa.array([n[c]] * width), pa.array(range(width), pa.int32()), pa.array(total[c])],
                                             names=["cluster", "n", "place", "total"])

    parts = state.select("cluster", "v").mapInArrow(run, "cluster int, n bigint, place int, total bigint")
    return parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))


def moved_centroids(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Every non-empty cluster's componentwise floor of sum / count; empty ones stay."""
    new = old.copy()
    for r in cluster_sums(state, old.shape[1]).collect():           # clusters x components rows
        new[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return new


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, width: int = WIDTH,
            units: int = UNITS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, v, norm, dots, cluster, distance) after the last assignment, and the final centroids."""
    kept = written(integer_vectors(vectors, width=width, units=units), "centroid-vectors")
    now = first_centroids(kept, clusters, seed, width)
    state, before = kept, np.zeros_like(now)
    for _ in range(rounds):
        state = written(assign(state, before, now), "centroid-state")
        before, now = now, moved_centroids(state, now)
    return written(assign(state, before, now), "centroid-state"), now


def report(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    sums = state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()       # one row a cluster
    own = {r["cluster"]: r["s"] for r in sums}
    rows = [(i, own.get(i, 0), sum(own.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    facts = state.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(facts), "cluster").select(      # as many rows as clusters
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))


def _rounds() -> str:
    """The rounds as common table expressions: a{r} assigns to the centroids c{r}, c{r + 1} are the centroids after it."""
    out = []
    for r in range(ROUNDS + 1):
        out.append(f"""d{r} AS (SELECT x.rid, c.k, sum((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{r} c USING (j) GROUP BY x.rid, c.k),
a{r} AS (SELECT rid, min({{'d': d, 'k': k}}) AS best FROM d{r} GROUP BY rid)""")
        if r < ROUNDS:
            out.append(f"""s{r} AS (SELECT a.best.k AS k, x.j, sum(x.x)::HUGEINT AS s, count(*) AS n FROM a{r} a JOIN x USING (rid) GROUP BY 1, 2),
c{r + 1} AS (SELECT c.k, c.j, coalesce((s.s - ((s.s % s.n) + s.n) % s.n) // s.n, c.x)::BIGINT AS x FROM c{r} c LEFT JOIN s{r} s ON s.k = c.k AND s.j = c.j)""")
    return ",\n".join(out)


ORACLE_OP13 = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor({UNITS} * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS (SELECT rid, unnest(generate_series(1, {WIDTH})) AS j, unnest(v) AS x FROM v),
f AS (SELECT rid, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k FROM v),
c0 AS (SELECT f.k, x.j, x.x FROM f JOIN x USING (rid) WHERE f.k < {CLUSTERS}),
{_rounds()},
h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k),
r AS (SELECT v.vec_id, a.best.k::INTEGER AS cluster, a.best.d::BIGINT AS distance FROM v JOIN a{ROUNDS} a USING (rid))
SELECT r.vec_id, r.cluster, r.distance, sum(r.distance) OVER (PARTITION BY r.cluster)::BIGINT AS cluster_inertia,
  sum(r.distance) OVER ()::BIGINT AS inertia, h.centroid_sha256
FROM r JOIN h ON h.k = r.cluster"""
