"""Operator 13: centroid clustering, nearest centroids by the threshold algorithm.

Vectors become integers, so sums, means and distances are exact and the same in any order of
the rows.  For each component there is a list of the centroids sorted by their value there.
From a vector's own value each list is walked outwards, the nearer side first.  A centroid that
comes up in some list for the first time gets its exact distance.  The squared steps at the
frontiers of all lists add up to the least distance of any centroid not yet met, and the walk
ends when that is strictly above the best exact one: then neither a nearer centroid nor an
equally near one of a smaller number is left.

The vectors of a batch walk together as numpy arrays.  Each round of the clustering is one map
over the stored vectors, which hands on one row for each cluster and task; only sums by
cluster and component reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import shipped, stored
from tillroll.llm.common import unused

COMPONENTS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
# Scaled components are kept within this, so that a distance of any two vectors fits a long.
LARGEST = 1 << 27
_ADDED = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
# Vectors that walk together.
_TOGETHER = 1024


class Nearest:
    """Nearest of some centroids by the threshold algorithm."""

    def __init__(self, centroids: np.ndarray):
        """``centroids`` has a row for each, of int64."""
        self.centroids = centroids
        order = np.argsort(centroids, axis=0, kind="stable")
        self.names = order.T.copy()
        self.values = np.take_along_axis(centroids, order, axis=0).T.copy()
        # Exact distances that were asked for, of all pairs there are.
        self.computed = self.pairs = 0

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and its squared distance, for each row; of equally
        near ones the smallest number."""
        names = np.empty(len(vectors), dtype=np.int64)
        distances = np.empty(len(vectors), dtype=np.int64)
        for low in range(0, len(vectors), _TOGETHER):
            some = slice(low, low + _TOGETHER)
            names[some], distances[some] = self._walk(vectors[some])
        return names, distances

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, width = self.centroids.shape
        rows = np.arange(width)
        # The next place to the right and to the left in each list of each vector.
        right = np.stack([np.searchsorted(self.values[d], vectors[:, d]) for d in rows], axis=1)
        left = right - 1
        met = np.zeros((len(vectors), k), dtype=bool)
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        name = np.full(len(vectors), k)
        open_ = np.arange(len(vectors))
        for _ in range(k):
            v, a, b = vectors[open_], left[open_], right[open_]
            far = np.iinfo(np.int64).max
            down = np.where(a >= 0, v - self.values[rows, np.maximum(a, 0)], far)
            up = np.where(b < k, self.values[rows, np.minimum(b, k - 1)] - v, far)
            lower = down <= up
            at = np.where(lower, a, b)
            left[open_], right[open_] = a - lower, b + ~lower
            frontier = np.where(lower, down, up)
            fresh = np.zeros((len(open_), k), dtype=bool)
            fresh[np.arange(len(open_))[:, None], self.names[rows, at]] = True
            fresh &= ~met[open_]
            met[open_] |= fresh
            which, centroid = np.nonzero(fresh)
            # In the order of the centroids' numbers, so that the first of equals stays.
            exact = np.full((len(open_), k), far)
            exact[which, centroid] = ((v[which] - self.centroids[centroid]) ** 2).sum(axis=1)
            self.computed += len(which)
            found = exact.argmin(axis=1)
            nearest = exact[np.arange(len(open_)), found]
            now, had = best[open_], name[open_]
            better = (nearest < now) | ((nearest == now) & (found < had) & (nearest < far))
            best[open_], name[open_] = np.where(better, nearest, now), np.where(better, found, had)
            # As float64 a sum may be off by its last bits: such a vector walks on.
            least = (frontier.astype(np.float64) ** 2).sum(axis=1) * (1 - 1e-12)
            open_ = open_[~(least > best[open_])]
            if not len(open_):
                break
        self.pairs += k * len(vectors)
        return name, best


def scaled(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, name: str = "scaled") -> DataFrame:
    """The rows whose vectors have just so many components, none of them null or not finite,
    with the integers floor(``scale`` * component) as ``name``.

    Integers beyond ``LARGEST`` are set to it, on either side.
    """
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where((F.size(vector) == components) & whole).withColumn(name, F.transform(
        numbers, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x * scale)))
        .cast("bigint")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors of the rows (name, scaled) with the smallest hashes of seed and name."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), "name"), 256)
    found = rows.select(key.alias("key"), "scaled").orderBy("key", "scaled").limit(clusters).collect()
    return np.array([r.scaled for r in found], dtype=np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of their vectors' means; without vectors they stay."""
    k, width = centroids.shape
    held = rows.sparkSession.sparkContext.broadcast(Nearest(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("scaled"), width)
                names, _ = held.value(vectors)
                counts += np.bincount(names, minlength=k)
                for c in np.unique(names):
                    sums[c] += vectors[names == c].sum(axis=0)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(counts[at]),
             pa.array(sums[at].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = rows.select("scaled").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    # Exact beyond 64 bits: a sum of sums may be longer than a long.
    added = (parts.select("cluster", "n", F.posexplode("sums").alias("component", "s"))
             .groupBy("cluster", "component")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")))
    made = centroids.copy()
    for r in added.collect():
        made[r.cluster, r.component] = int(r.s) // r.n
    return made


def clustered(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
              components: int = COMPONENTS, scale: int = SCALE, clusters: int = CLUSTERS,
              rounds: int = ROUNDS, seed: int = SEED,
              columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``df`` that have a whole vector, with ``cluster``, ``distance``,
    ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    ``columns`` are the ones to keep, by default all.  Underscores are added to a name that
    ``df`` has already.  Vectors that are null, of another
    length or with a component that is null or not finite are left out; a null id hashes as
    the empty text; repeated rows count each; where ids are repeated the lesser vector is the
    first centroid.  A sum of distances beyond a long is given as the largest long.  With fewer
    vectors than ``clusters`` there are as many centroids; without
    any the result is empty.  The centroids are small and the same for all tasks; vectors
    are written once and never shuffled.
    """
    spark = shipped(df.sparkSession)
    kept = [F.col(f"`{c}`") for c in (df.columns if columns is None else columns)]
    integers, name, *made = unused(df, "scaled", "vec_name", *_ADDED)
    cluster, distance, own, whole, sha = made
    rows = scaled(df, vector, components, scale, integers).withColumn(
        name, F.coalesce(F.col(vec_id).cast("string"), F.lit("")))
    rows = stored(rows.select(*kept, name, integers), "vectors")
    plain = rows.select(F.col(name).alias("name"), F.col(integers).alias("scaled"))
    rows = rows.drop(name)
    centroids = first_centroids(plain, clusters, seed)
    if not len(centroids):
        return rows.drop(integers).withColumns({
            cluster: F.lit(None).cast("int"), distance: F.lit(None).cast("bigint"),
            own: F.lit(None).cast("bigint"), whole: F.lit(None).cast("bigint"),
            sha: F.lit(None).cast("string")})
    for _ in range(rounds):
        now = moved(plain, centroids)
        if (now == centroids).all():
            break
        centroids = now
    held = spark.sparkContext.broadcast(Nearest(centroids))
    schema = rows.drop(integers).withColumns({
        cluster: F.lit(None).cast("int"), distance: F.lit(None).cast("bigint")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(integers)
            rest = [i for i in range(batch.num_columns) if i != at]
            names, distances = held.value(_matrix(batch.column(at), centroids.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest] + [pa.array(names.astype(np.int32)),
                                                   pa.array(distances)],
                names=[batch.schema.names[i] for i in rest] + [cluster, distance])

    assigned = stored(rows.mapInArrow(run, schema), "assigned")
    # A row for each centroid: as many as the parameter says.
    inertia = {r[0]: int(r[1]) for r in assigned.groupBy(cluster).agg(
        F.sum(F.col(distance).cast("decimal(20,0)"))).collect()}
    most = (1 << 63) - 1
    known = spark.createDataFrame(
        [(c, min(n, most), min(sum(inertia.values()), most),
          hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, n in sorted(inertia.items())],
        f"`{cluster}` int, `{own}` bigint, `{whole}` bigint, `{sha}` string")
    return assigned.join(F.broadcast(known), cluster).select(*kept, *made)


def centroid_clusters(embeddings: DataFrame, vec_id: str = "vec_id",
                      vector: str = "embedding") -> DataFrame:
    """Per whole vector its id and what ``clustered`` adds.  Other columns are not read."""
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding"))
    return clustered(rows, columns=["vec_id"])


def _sql_rounds() -> str:
    """SQL for the rounds, each an assignment and the floors of the means."""
    made = []
    for n in range(ROUNDS + 1):
        made.append(f"""
a{n} AS MATERIALIZED (
  SELECT uid, vec_id, x, d.c AS cluster, d.s AS distance FROM (
    SELECT uid, vec_id, x, (SELECT min(struct_pack(
        s := CAST(list_sum([(x[i] - y[i]) * (x[i] - y[i]) for i in range(1, {COMPONENTS + 1})]) AS BIGINT),
        c := c)) FROM c{n}) AS d
    FROM v))""")
        if n < ROUNDS:
            made.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT c, coalesce(z, y) AS y FROM c{n} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS z FROM (
      SELECT cluster, i, sum(x[i]) AS s, count(*) AS n
      FROM a{n}, (SELECT unnest(range(1, {COMPONENTS + 1})) AS i) GROUP BY cluster, i)
    GROUP BY cluster) ON c = cluster)""")
    return ",".join(made)


ORACLE = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id,
    [CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT) for e in embedding] AS x
  FROM embeddings WHERE len(embedding) = {COMPONENTS}
    AND len([e for e in embedding if e IS NOT NULL AND isfinite(e)]) = {COMPONENTS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x AS y FROM (
    SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v
    ORDER BY h, x LIMIT {CLUSTERS})),{_sql_rounds()}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(y, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON cluster = c
"""
