"""Centroid clustering against plain Python integers."""
import hashlib
import math
import random

from pyspark.sql import functions as F

from paperlane.llm import centroids


def brute(rows, k, rounds, dims, seed=1, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c
              for n, c in enumerate(cs)]
    made = [(i, *near(v)) for i, v in kept]
    each = {n: sum(d for _, d, m in made if m == n) for n in range(len(cs))}
    return [(i, n, d, each[n], sum(each.values())) for i, d, n in made], cs


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def check(spark, rows, k, rounds, dims):
    got, final = centroids.cluster(frame(spark, rows), k, rounds, dims)
    want, cs = brute(rows, k, rounds, dims)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and final == cs
    return got


def test_random_vectors(spark):
    r = random.Random(1)
    check(spark, [(i, [r.gauss(i % 3, 1) for _ in range(5)]) for i in range(300)], 7, 3, 5)


def test_ties_repeats_and_empty_clusters(spark):
    same = [0.5, -0.5, 0.25]
    rows = [(i, same) for i in range(20)] + [(3, same), (None, same), (None, [1.0, 1.0, 1.0]), (50, [0.5, -0.5, 0.26])]
    got = check(spark, rows, 6, 3, 3)
    assert got.filter(F.col("vec_id") == 3).count() == 2


def test_what_cannot_be_compared_is_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 0.0]), (5, [inf, 0.0]), (6, [1.0]), (7, [1.0, 2.0, 3.0]),
            (8, [-0.001, 0.0])]
    got = check(spark, rows, 16, 3, 2)
    assert [r.vec_id for r in got.collect()] == [8]
    none, final = centroids.cluster(frame(spark, rows[:3]), 16, 3, 2)
    assert final == [] and not none.withColumn("s", centroids.centroid_digests(final)).collect()


def test_huge_components_saturate(spark):
    rows = [(1, [1e300, -1e300]), (2, [-1e300, 1e300])]
    got, final = centroids.cluster(frame(spark, rows), 1, 1, 2)
    assert final == [[0, 0]] or final == [[-1, -1]]
    assert all(0 < r.distance <= 2 * centroids.LIMIT ** 2 * 2 for r in got.collect())


def test_extra_columns_and_floats(spark):
    rows = [(i, [i / 7, -i / 3], "x", 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, norm int")
    got, _ = centroids.cluster(df, 4, 2, 2)
    plain, _ = centroids.cluster(df.select("vec_id", "embedding"), 4, 2, 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_the_main_path_has_no_python(spark):
    got, _ = centroids.cluster(frame(spark, [(i, [float(i), 0.0]) for i in range(9)]), 3, 1, 2)
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
