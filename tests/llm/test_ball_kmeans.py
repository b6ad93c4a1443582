"""Ball k-means against plain Lloyd steps in exact integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import ball_kmeans as B

SCHEMA = "vec_id long, embedding array<float>, i int, v string, cluster int, h string, p double"


def lloyd(rows, k=B.K, rounds=B.ROUNDS, dims=B.DIMS):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [v for _, v in first]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for n in range(rounds + 1):
        at = [min((dist(v, c), j) for j, c in enumerate(cents)) for _, v in kept] if cents else []
        if n < rounds:
            for j in range(len(cents)):
                own = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == j]
                if own:
                    cents[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    inertia = lambda j: sum(d for d, c in at if c == j)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, c, d, inertia(c), sum(x for x, _ in at), sha[c]) for (i, _), (d, c) in zip(kept, at, strict=True)] if cents else []


def make(n, seed, groups=9):
    r = random.Random(seed)
    middle = [[r.gauss(0, 1) for _ in range(64)] for _ in range(groups)]
    rows = [(k * 3 % 1009, [x + r.gauss(0, 0.2) for x in r.choice(middle)]) for k in range(n)]
    one = [1.0] * 64
    rows += [(5000, one), (5001, one), (5000, one), (None, one), (5002, None), (5003, []), (5004, one[:63]), (5005, [None] + one[1:]), (5006, [math.nan] + one[1:]), (5007, [math.inf] + one[1:]), (5008, [-math.inf] + one[1:]), (5009, [0.0] * 64), (-1, [-0.001] * 64)]
    r.shuffle(rows)
    return rows


def written(spark, rows, path):
    spark.createDataFrame([(i, e, 1, "x", 2, "y", 0.5) for i, e in rows], SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def same(got, want):
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("n", [0, 20, 400])
def test_query(spark, tmp_path, n):
    rows = make(n, n)
    same(B.op13(spark, written(spark, rows, tmp_path)).collect(), lloyd(rows))


def test_many_equal_vectors_and_centroids(spark, tmp_path):
    """Equal first centroids: ties go to the smaller number, the others stay empty and where they are."""
    rows = [(k, [0.5 * (k % 3)] * 64) for k in range(90)]
    same(B.op13(spark, written(spark, rows, tmp_path)).collect(), lloyd(rows))


def test_no_rows(spark, tmp_path):
    got = B.op13(spark, written(spark, [(1, None)], tmp_path))
    assert got.collect() == [] and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_nearest_from_any_assignment():
    r = np.random.default_rng(1)
    for k, dims, size in ((1, 2, 5), (7, 2, 6), (40, 3, 4), (12, 64, 300)):
        c = r.integers(-size, size, (k, dims))
        x = r.integers(-size, size, (300, dims))
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        for _ in range(5):
            number, distance, _ = B.nearest(x, c, r.integers(0, k, 300))
            assert (number == d.argmin(1)).all() and (distance == d.min(1)).all()


def test_stable_core_is_not_compared():
    """Balls far apart have no neighbours; touching ones compare the members of their annuli only."""
    r = np.random.default_rng(2)
    c = r.integers(-100_000, 100_000, (20, 8))
    at = r.integers(0, 20, 1000)
    number, _, compared = B.nearest(c[at] + r.integers(-9, 9, (1000, 8)), c, at)
    assert (number == at).all() and compared == 0
    x = np.array([[0, 0], [4, 0], [5, 0], [6, 0]])
    number, _, compared = B.nearest(x, np.array([[0, 0], [10, 0], [0, 40]]), np.zeros(4, int))
    assert number.tolist() == [0, 0, 0, 1] and compared == 2


def test_blocks_do_not_matter(spark, tmp_path, monkeypatch):
    rows = make(150, 8)
    monkeypatch.setattr(B, "BLOCK", 7)
    same(B.op13(spark, written(spark, rows, tmp_path)).collect(), lloyd(rows))


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(k, [1e9] * 64) for k in range(3)], "vec_id long, embedding array<float>")
    with pytest.raises(OverflowError):
        B.cluster(df)


def test_only_bounded_tables_are_left(spark):
    assert B.integers(spark.createDataFrame(make(10, 3), "vec_id long, embedding array<float>"), "vec_id", "embedding", 64, 256).agg(F.max(F.size("v"))).first()[0] == 64
