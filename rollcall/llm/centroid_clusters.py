"""Centroid clustering by built-in expressions: integer distances to literal centroids, column sums for new centroids."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.store import Kept
from rollcall.llm.text import need

DIM = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SALT = "2:"  # put before an id whose digest decides on the first centroids
LIMIT = 1 << 27  # integers are held within it, so that a squared distance over 64 of them fits a long


def integer_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, s) of the vectors of ``dim`` finite components: floor(scale * x) of each, and the sum of their squares."""
    fine = (F.size("embedding") == dim) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.greatest(F.least(
        F.floor(x.cast("double") * scale), F.lit(LIMIT - 1).cast("long")), F.lit(-LIMIT).cast("long")))
    return need(vectors, "vec_id", "embedding").where(fine).select("vec_id", whole.alias("v")).withColumn("s", dot("v", "v"))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda total, x: total + x)


def _array(values: list[int]) -> str:
    return "array(" + ", ".join(f"{x}L" for x in values) + ")"


def nearest(centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest literal centroid; of equal distances the smaller number.

    |v - c|^2 = |v|^2 - 2 v.c + |c|^2, all in integers, so the sum is exact.
    """
    table = F.expr("array(" + ", ".join(map(_array, centroids)) + ")")
    squares = F.expr(_array([sum(x * x for x in c) for c in centroids]))
    return F.array_min(F.transform(table, lambda c, i: F.struct(
        (F.col("s") - 2 * dot("v", c) + F.get(squares, i)).alias("distance"), i.alias("cluster"))))


def first_centroids(rows: DataFrame, clusters: int, salt: str) -> list[list[int]]:
    """The vectors of the ids with the smallest digests, in their order; those of one id in the order of their components."""
    named = rows.where("vec_id is not null").select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).alias("h"), "v")
    return [list(r["v"]) for r in named.orderBy("h", "v").limit(clusters).collect()]


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid as the floor of the mean of its vectors; one without vectors stays.

    One scan; every task sends at most one row of sums per cluster.
    """
    dim = len(centroids[0])
    near = rows.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dim)])
    out = list(centroids)
    for r in sums.collect():  # at most one row per centroid
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
    return out


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            salt: str = SALT) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dim`` finite components.

    Null vectors, those of another length, and those with null or non-finite
    components are left out; components beyond 2^27 / ``scale`` count as that. A
    null id is clustered like others, but starts no cluster. Repeated rows count
    each, and may both start a cluster; fewer vectors than ``clusters`` start as
    many as there are; none give no rows. Other columns are not read. Sums beyond
    a long are null in the two inertia columns.

    The integers are written once and scanned once a round. Only the centroids
    are on the driver: ``clusters`` rows a round, however many vectors there are.
    """
    start = Kept(integer_vectors(vectors, dim, scale), "integer-vectors")
    rows, key = start.rows, vectors.schema["vec_id"].dataType
    centroids = first_centroids(rows, clusters, salt)
    if not centroids:
        return rows.where(F.lit(False)).select(
            "vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    placed = rows.select("vec_id", nearest(centroids).alias("at")).select("vec_id", "at.cluster", "at.distance")
    last = Kept(placed.withColumn("vec_id", F.col("vec_id").cast(key)), "nearest-centroids").rows
    start.drop()
    spread = {r["cluster"]: int(r["d"]) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}
    long = lambda n: n if n < 1 << 63 else None
    by_cluster = F.array(*[F.lit(long(spread.get(k, 0))).cast("long") for k in range(len(centroids))])
    digests = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids])
    return last.select(
        "vec_id", "cluster", "distance", F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(long(sum(spread.values()))).cast("long").alias("inertia"), F.get(digests, F.col("cluster")).alias("centroid_sha256"))
