"""Centroid clustering with integer vectors, in column expressions.

Components become integers, so distances, sums and centroids are exact and do
not depend on the order of rows. A round is one pass over the integer vectors:
for each centroid, a literal array, ``zip_with`` and ``aggregate`` give the
product with the vector and so the squared distance; ``array_min`` over structs
(distance, number) chooses the nearest, ties to the smaller number; one sum for
each component, grouped by the chosen number, gives the new centroids.

Scale: a round shuffles at most (tasks x centroids) rows of partial sums, also
where one cluster holds every vector. The integer vectors are written once to
the shared folder and read by each round, so a lost executor costs tasks only.
What the driver sees is ``k`` rows of ``dims`` sums.

Defined cases: vectors that are null, not of ``dims`` components, or hold a
null or non-finite component are left out; integers saturate at
±:data:`LIMIT`, so a distance always fits a long (an inertia that doesn't is
null); fewer vectors than ``k`` give as many centroids; vectors with the same
id, or none, have the same hash and come in order of their components; repeated
rows are vectors of their own; an empty table gives an empty result; extra
columns of the input are ignored.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LIMIT = 1 << 27


def integer_vectors(vectors: DataFrame, dims: int, scale: int = 64, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v, norm)``: ``floor(scale * x)`` of each component of the
    vectors that can be compared, and the sum of their squares."""
    raw = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    inf = F.lit(float("inf"))
    whole = raw.filter((F.size("x") == dims) & F.forall(
        "x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)))
    v = F.transform("x", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))))
    made = whole.select("vec_id", v.alias("v"))
    return made.withColumn("norm", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the ``k`` smallest hashes of ``seed:vec_id``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.orderBy(key, F.col("vec_id").asc_nulls_last(), "v").limit(k)
    return [list(r.v) for r in chosen.select("v").collect()]  # k rows


def nearest(centroids: list[list[int]]) -> Column:
    """Struct ``(distance, cluster)`` of the nearest centroid to ``v``."""

    def one(number: int, centroid: list[int]) -> str:
        literal = ", ".join(f"{c}L" for c in centroid)
        product = f"aggregate(zip_with(v, array({literal}), (a, b) -> a * b), 0L, (s, x) -> s + x)"
        return (f"named_struct('distance', norm - 2L * {product} + {sum(c * c for c in centroid)}L, "
                f"'cluster', {number})")

    return F.expr(f"array_min(array({', '.join(one(i, c) for i, c in enumerate(centroids))}))")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid replaced by the floored mean of its vectors, if any."""
    dims = len(centroids[0])
    sums = (vectors.select("v", nearest(centroids).getField("cluster").alias("cluster")).groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims))))
    out = list(centroids)
    for r in sums.collect():  # at most one row for each centroid
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance, cluster_inertia, inertia)`` of every
    vector that can be compared, and the final centroids."""
    ints = written(integer_vectors(vectors, dims, scale, id_col, vector_col), "centroids-vectors")
    centroids = first_centroids(ints, k, seed)
    if not centroids:
        none = "cluster int, distance long, cluster_inertia long, inertia long"
        return ints.sparkSession.createDataFrame([], f"vec_id {dict(ints.dtypes)['vec_id']}, {none}"), []
    for _ in range(rounds):
        centroids = moved(ints, centroids)
    chosen = written(ints.select("vec_id", nearest(centroids).alias("n")), "centroids-chosen")
    sums = chosen.groupBy("n.cluster").agg(F.sum(F.col("n.distance").cast("decimal(19,0)")).alias("s")).collect()
    each = {r.cluster: int(r.s) for r in sums}  # at most one row for each centroid

    def long(n: int) -> Column:
        return F.lit(n if n < 1 << 63 else None).cast("long")

    inertias = F.array(*(long(each.get(i, 0)) for i in range(len(centroids))))
    out = chosen.select("vec_id", "n.cluster", "n.distance",
                        F.get(inertias, F.col("n.cluster")).alias("cluster_inertia"),
                        long(sum(each.values())).alias("inertia"))
    return out, centroids


def centroid_digests(centroids: list[list[int]]) -> Column:
    """Lowercase hex sha256 of the comma-joined centroid that ``cluster`` names."""
    made = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return F.get(F.array(*map(F.lit, made)).cast("array<string>"), F.col("cluster"))
