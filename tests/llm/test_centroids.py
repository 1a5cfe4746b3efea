"""Centroid clustering against plain integers, and the walk against all distances."""

import hashlib
import math
import random

import numpy as np

from tillroll.llm import centroids

FIELDS = "vec_id long, embedding array<float>, label int, cluster string, scaled int, name string"


def plain(rows, components=64, clusters=8, rounds=10):
    """Rows (vec_id, cluster, distance, cluster inertia, inertia, hash), with plain loops."""
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != components:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector]))
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (
        hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [list(v) for _, v in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(middle))
                for _, v in kept]

    for _ in range(rounds):
        names = [c for _, c in assign()]
        for i in range(len(middle)):
            own = [v for (_, v), c in zip(kept, names) if c == i]
            if own:
                middle[i] = [sum(x) // len(own) for x in zip(*own)]
    final = assign()
    return [(vec_id, c, d, sum(x for x, k in final if k == c), sum(x for x, _ in final),
             hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest())
            for (vec_id, _), (d, c) in zip(kept, final)]


def rows_of(n, seed=2):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = []
    for i in range(n):
        middle = rng.choice(middles)
        rows.append((i, [m + rng.gauss(0, .4) for m in middle]))
    # Copies of one vector, ties, repeated and missing ids, and vectors that are no whole ones.
    rows += [(1000 + i, [0.25] * 64) for i in range(n // 2)]
    rows += [(3, rows[3][1]), (3, [0.5] * 64), (None, [-0.5] * 64), (None, [-0.25] * 64)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 65),
             (2004, [1.0] * 63 + [None]), (2005, [math.nan] + [0.0] * 63),
             (2006, [math.inf] + [0.0] * 63), (2007, [0.0] * 63 + [-math.inf])]
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in rows], FIELDS)


def test_equals_plain_version(spark):
    rows = rows_of(150)
    got = centroids.centroid_clusters(frame_of(spark, rows).repartition(5))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                           "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_keeps_columns_and_their_names(spark):
    rows = rows_of(20)
    got = centroids.clustered(frame_of(spark, rows))
    assert got.columns == ["vec_id", "embedding", "label", "cluster", "scaled", "name", "cluster_",
                           "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want = {(w[0], w[1], w[2]) for w in plain(rows)}
    assert {(r.vec_id, r.cluster_, r.distance) for r in got.collect()} == want


def test_few_vectors_and_none(spark):
    for n in (0, 1, 3):
        rows = rows_of(30)[:n] + [(9, None)]
        got = centroids.centroid_clusters(frame_of(spark, rows))
        assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows))
    assert centroids.centroid_clusters(spark.createDataFrame([], FIELDS)).count() == 0


def test_huge_components_have_a_result(spark):
    rows = [(i, [3e38 * (-1) ** (i + j) for j in range(64)]) for i in range(12)]
    got = centroids.centroid_clusters(frame_of(spark, rows)).collect()
    assert len(got) == 12 and all(0 <= r.distance <= r.cluster_inertia <= r.inertia for r in got)


def test_walk_finds_the_first_nearest():
    rng = np.random.default_rng(4)
    for k, width, spread in [(1, 3, 5), (2, 1, 3), (8, 64, 1000), (40, 3, 4), (200, 2, 50),
                             (50, 4, 1 << 27)]:
        middle = rng.integers(-spread, spread + 1, (k, width))
        vectors = rng.integers(-spread, spread + 1, (3000, width))
        vectors[:50] = middle[rng.integers(0, k, 50)]
        names, distances = centroids.Nearest(middle)(vectors)
        exact = ((vectors[:, None, :] - middle[None]) ** 2).sum(axis=2)
        assert (distances == exact.min(axis=1)).all()
        assert (names == exact.argmin(axis=1)).all()


def test_walk_ends_early():
    """Where centroids lie apart in few components, most distances are never asked for."""
    rng = np.random.default_rng(6)
    middle = rng.integers(-100_000, 100_000, (500, 2))
    nearest = centroids.Nearest(middle)
    nearest(rng.integers(-100_000, 100_000, (2000, 2)))
    assert nearest.computed < 0.2 * nearest.pairs


def test_no_vector_crosses_an_exchange(spark):
    frame = frame_of(spark, rows_of(60))
    plan = centroids.clustered(frame, columns=["vec_id"])._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan
