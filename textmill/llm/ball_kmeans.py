"""Centroid clustering by ball k-means, in whole numbers.

A cluster is a ball: its centroid and a radius that covers its members. Only centroids whose distance is at most twice the radius are
neighbours of a ball. Sorted by distance, half the distance to each neighbour cuts the ball into a stable core, whose members can't be nearer to any other centroid,
and annuli: a member of the i-th annulus is compared with the first i neighbours and with nothing else.

Components are whole numbers, so sums, means, distances and ties are exact and do not depend on how rows are dealt. Each round is one pass over the vectors,
written to the shared folder with their clusters; each task adds a few rows of partial sums and radii, which Spark adds up. The driver holds the centroids
alone (k times the dimension). The radius after a move is the radius before it plus the length of the move.

Cases: vectors that are null, of another length, or with a null, infinite or undefined component are left out. Ties go to the smaller cluster number. Repeated rows are vectors
of their own, and rows with a null id take part but come last in the choice of the first centroids (equal ids: by components). With fewer vectors than clusters there are as many
clusters as vectors; an empty table gives no rows. Further columns are not read. Distances are long; very large components are compared in Python's whole numbers, and a distance or sum beyond
the largest long is given as that. A component beyond 2^40 after scaling counts as 2^40.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import materialize, remove

DIMENSION, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, "2"
LONGEST, MOST = (1 << 63) - 1, 1 << 40


def quantised(df: DataFrame, key: str, vector: str, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """``id`` and ``q``: floor(scale * x) of each component, for vectors that count."""
    x = F.col(vector).cast("array<double>")
    bound = F.lit(float(MOST))
    whole = F.transform(x, lambda v: F.floor(F.least(F.greatest(v * scale, -bound), bound)).cast("long"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where((F.size(vector) == dimension) & F.coalesce(finite, F.lit(False))).select(F.col(key).alias("id"), whole.alias("q"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(order.alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(k).collect()
    return np.array([r["q"] for r in rows], dtype=object).reshape(len(rows), len(rows[0]["q"]) if rows else 0)


class Balls:
    """Centroids with their neighbours, for the assignment of vectors."""

    def __init__(self, centroids: np.ndarray, radii: list[int] | None):
        """``radii``: squared bounds of the members' distances, or None where no vector has a cluster yet; ``centroids`` are Python integers."""
        self.k, largest = len(centroids), max((abs(x) for x in centroids.flat), default=0)
        self.largest, self.whole = largest, centroids
        between = [[sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for y in centroids] for x in centroids]
        self.neighbours: list[list[int]] = []
        self.borders: list[np.ndarray] = []
        for i in range(self.k if radii is not None else 0):
            near = sorted((between[i][j], j) for j in range(self.k) if j != i and between[i][j] <= 4 * radii[i])
            self.neighbours.append([j for _, j in near])
            self.borders.append(np.array([d for d, _ in near], dtype=object if any(d > LONGEST for d, _ in near) else np.int64))

    def _typed(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        most = max(self.largest, int(max(q.max(), -q.min()))) if q.size else self.largest
        squared = 4 * q.shape[1] * most * most  # bounds a distance, exact in doubles below 2^53; four of them are compared
        kind = np.float64 if squared < 1 << 53 else np.int64 if squared < 1 << 61 else object
        return q.astype(kind), self.whole.astype(kind)

    @staticmethod
    def _squared(q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Squared distances of all rows of ``q`` to all rows of ``c``, exact."""
        if q.dtype == np.float64:
            return ((q * q).sum(1)[:, None] - 2 * (q @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
        return np.stack([((q - x) ** 2).sum(1) for x in c], 1) if len(c) else np.zeros((len(q), 0), dtype=q.dtype)

    def assign(self, q: np.ndarray, cluster: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Clusters, squared distances, and how many distances to other centroids were computed."""
        rows, c = self._typed(q)
        if cluster is None:
            d = self._squared(rows, c)
            best = d.argmin(1)  # the first of equals
            return best.astype(np.int32), d[np.arange(len(d)), best], d.size
        compared, found = 0, cluster.copy()
        far = np.zeros(len(q), dtype=object if rows.dtype == object else np.int64)
        for i in np.unique(cluster):
            at = np.flatnonzero(cluster == i)
            own = self._squared(rows[at], c[i : i + 1])[:, 0]
            far[at] = own
            annulus = np.searchsorted(self.borders[i], 4 * own, side="right")  # 0: the stable core
            for m in np.unique(annulus[annulus > 0]):
                part = np.flatnonzero(annulus == m)
                rivals = np.sort(np.array([i, *self.neighbours[i][:m]]))
                d = self._squared(rows[at[part]], c[rivals])
                best = d.argmin(1)
                found[at[part]], far[at[part]] = rivals[best], d[np.arange(len(d)), best]
                compared += len(part) * int(m)
        return found, far, compared


_FIELDS = "cluster int, distance long, members long, radius decimal(38,0), inertia decimal(38,0), sums array<decimal(38,0)>, compared long"


def assigned(vectors: DataFrame, centroids: np.ndarray, radii: list[int] | None) -> DataFrame:
    """Rows of vectors (id, q, cluster, distance) and, from each task, a row of sums for each cluster (members, radius, inertia, sums, compared)."""
    key = dict(vectors.dtypes)["id"]
    seen = radii is not None
    rows = vectors.select("id", "q", "cluster") if seen else vectors.select("id", "q")
    wide = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = Balls(centroids, radii)
        k, members, radius, inertia, compared = balls.k, [0] * balls.k, [0] * balls.k, [0] * balls.k, 0
        sums = [[0] * centroids.shape[1] for _ in range(k)]
        kind, listed = None, None
        for batch in batches:
            kind, listed = batch.schema.field("id").type, batch.schema.field("q").type
            if not batch.num_rows:
                continue
            q = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            cluster, d, more = balls.assign(q, batch.column(2).to_numpy(zero_copy_only=False) if seen else None)
            compared += more
            small = max(int(q.max()), -int(q.min())) * len(q) < LONGEST
            for i in np.unique(cluster):
                at = cluster == i
                own, part = d[at], q[at] if small else q[at].astype(object)
                members[i] += int(at.sum())
                radius[i] = max(radius[i], int(own.max()))
                inertia[i] += sum(own.tolist())
                sums[i] = [a + int(b) for a, b in zip(sums[i], part.sum(0), strict=True)]
            distance = pa.array([min(int(x), LONGEST) for x in d], pa.int64())
            n = batch.num_rows
            none = [pa.nulls(n, t) for t in (pa.int64(), wide, wide, pa.list_(wide), pa.int64())]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), distance, *none], names=_NAMES)
        own = [i for i in range(k) if members[i]]
        if own:
            n = len(own)
            made = [pa.array([members[i] for i in own], pa.int64()), pa.array([radius[i] for i in own], wide), pa.array([inertia[i] for i in own], wide)]
            made += [pa.array([sums[i] for i in own], pa.list_(wide)), pa.array([compared if i == own[0] else 0 for i in own], pa.int64())]
            yield pa.record_batch([pa.nulls(n, kind), pa.nulls(n, listed), pa.array(own, pa.int32()), pa.nulls(n, pa.int64()), *made], names=_NAMES)

    return rows.mapInArrow(run, f"id {key}, q array<long>, {_FIELDS}")


_NAMES = ["id", "q", "cluster", "distance", "members", "radius", "inertia", "sums", "compared"]


def _totals(table: DataFrame) -> dict[int, dict]:
    """What the tasks found about each cluster: k rows, with sums of a bounded number of components."""
    rows = table.where("members IS NOT NULL").select("cluster", "members", "radius", "inertia", "compared", F.posexplode("sums").alias("at", "part"))
    own = F.when(F.col("at") == 0, F.lit(1)).otherwise(0)
    parts = rows.groupBy("cluster", "at").agg(
        F.sum("part").alias("part"), F.sum(F.col("members") * own).alias("members"), F.max("radius").alias("radius"), F.sum(F.col("inertia") * own).alias("inertia"), F.sum(F.col("compared") * own).alias("compared"))
    out: dict[int, dict] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["cluster"], r["at"])):
        if r["at"] == 0:
            out[r["cluster"]] = {"members": r["members"], "radius": int(r["radius"]), "inertia": int(r["inertia"]), "compared": r["compared"], "sums": []}
        out[r["cluster"]]["sums"].append(int(r["part"]))
    return out


def _moved(centroids: np.ndarray, totals: dict[int, dict]) -> tuple[np.ndarray, list[int]]:
    """New centroids, and squared bounds of the members' distances to them."""
    new, radii = centroids.copy(), [0] * len(centroids)
    for i, t in totals.items():
        new[i] = [s // t["members"] for s in t["sums"]]
        move = sum((int(a) - int(b)) ** 2 for a, b in zip(new[i], centroids[i], strict=True))
        radii[i] = (isqrt(t["radius"]) + isqrt(move) + 2) ** 2
    return new, radii


def ball_kmeans(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray, dict[int, dict]]:
    """Vectors (id, q) with cluster and distance after ``rounds`` moves and a last assignment; the final centroids; members, inertia and comparisons of each cluster."""
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return vectors.selectExpr("id", "q", "CAST(null AS int) AS cluster", "CAST(null AS long) AS distance").where("false"), centroids, {}
    table, radii = vectors, None
    for n in range(rounds + 1):
        table, before = materialize(assigned(table, centroids, radii), "balls"), table
        remove(before)
        totals = _totals(table)
        if n < rounds:
            centroids, radii = _moved(centroids, totals)
        table, made = table.where("members IS NULL").select("id", "q", "cluster", "distance"), table
        table.written_to = made.written_to
    return table, centroids, totals


def clusters(df: DataFrame, key: str, vector: str, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """``id``, cluster, distance, inertia of the cluster and of all, and the final centroid's digest."""
    table, centroids, totals = ball_kmeans(quantised(df, key, vector), k, rounds, seed)
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    whole = sum(t["inertia"] for t in totals.values())
    known = [(i, min(t["inertia"], LONGEST), min(whole, LONGEST), digest[i]) for i, t in totals.items()]
    known = df.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return table.drop("q").join(F.broadcast(known), "cluster")


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), "vec_id", "embedding")
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
