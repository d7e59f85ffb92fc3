"""Centroid clustering in whole numbers: expressions over arrays assign, column sums move the centroids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored
from tidemark.llm.vectors import usable, whole

#: Number of centroids, components of a vector, rounds of moving and the seed of the first centroids.
CENTROIDS, COMPONENTS, ROUNDS, SEED = 40, 64, 5, 2

Centroids = Sequence[Sequence[int]]


def _literal(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _summed(products: Column) -> Column:
    return F.aggregate(products, F.lit(0).cast("long"), lambda s, x: s + x)


def _least(vector: str, centroids: Centroids) -> Column:
    """``struct(rest, cluster)`` of the nearest centroid, where rest is its squared distance less that of the vector from the origin.

    With x.x - 2 x.c + c.c for the distance, x.x is the same for all centroids and decides nothing. The centroids are literals of the
    expression: folded once, read by every task from its own code, nothing to broadcast.
    """

    def one(centroid: Sequence[int], number: int) -> Column:
        shared = _summed(F.zip_with(vector, _literal([2 * c for c in centroid]), lambda x, c: x * c))
        rest = F.lit(sum(c * c for c in centroid)).cast("long") - shared
        return F.struct(rest.alias("rest"), F.lit(number).alias("cluster"))

    return F.array_min(F.array(*[one(c, k) for k, c in enumerate(centroids)]))


def nearest(vector: str, centroids: Centroids) -> Column:
    """``struct(distance, cluster)`` of the nearest centroid by squared Euclidean distance, the smaller number at a tie."""
    own = _summed(F.transform(vector, lambda x: x * x))
    found = F.transform(F.array(_least(vector, centroids)), lambda b: F.struct((b["rest"] + own).alias("distance"), b["cluster"].alias("cluster")))
    return found[0]


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``; equal hashes by vector. Brings k rows to the driver."""
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = vectors.select("v", F.sha2(label, 256).alias("h")).orderBy("h", "v").limit(k)
    return [list(r.v) for r in sorted(chosen.collect(), key=lambda r: (r.h, r.v))]


def moved(vectors: DataFrame, centroids: Centroids, size: int) -> list[list[int]]:
    """Centroids at ``floor(sum / count)`` of their vectors, those without vectors where they were.

    One pass: sums of ``size`` columns by cluster, added up per task before the shuffle, so a cluster with most of the rows sends
    one row per task. The driver receives one row per cluster, whatever the number of vectors.
    """
    placed = vectors.select(_least("v", centroids).getField("cluster").alias("cluster"), *[F.col("v")[i].alias(f"x{i}") for i in range(size)])
    sums = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"x{i}") for i in range(size)])
    after = [list(c) for c in centroids]
    for r in sums.collect():
        after[r.cluster] = [r[f"x{i}"] // r.n for i in range(size)]
    return after


def clustered(
    embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = COMPONENTS, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every vector that takes part, stored, and the final centroids.

    Vectors (``vec_id, embedding``, any other columns) take part if they have exactly ``size`` components, none null or
    non-finite; others, null vectors included, give no row. Every row takes part on its own: repeated ids and equal rows are
    clustered as often as they occur, a null id like any other (it hashes as an empty text). With fewer than ``k`` vectors there
    are as many centroids as vectors; equal first centroids are allowed, and the smaller number wins all ties, so the other stays
    empty and where it is. An empty table gives no row and no centroid. A component beyond 2^31 / 256 raises an error.

    The scaled vectors are written once; each round reads them once and shuffles one row per task and cluster.
    """
    vectors = embeddings.filter(usable("embedding") & (F.size("embedding") == size)).select("vec_id", whole("embedding").alias("v"))
    vectors = stored(vectors, "vectors")
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids, size)
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    best = vectors.select("vec_id", nearest("v", centroids).alias("b"))
    return stored(best.select("vec_id", "b.cluster", "b.distance"), "clusters"), centroids


def cluster_report(embeddings: DataFrame, **settings: int) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part.

    As :func:`clustered`; inertia is the sum of the distances of a cluster and of all vectors. What is joined to the vectors is one row
    per cluster, at most ``k``.
    """
    placed, centroids = clustered(embeddings, **settings)
    spark = embeddings.sparkSession
    hashed = spark.createDataFrame([(i, ",".join(map(str, c))) for i, c in enumerate(centroids)], "cluster int, components string")
    sums = {r.cluster: r.total for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    totals = spark.createDataFrame([(i, t, sum(sums.values())) for i, t in sums.items()], "cluster int, cluster_inertia long, inertia long")
    facts = totals.join(hashed, "cluster").select("cluster", "cluster_inertia", "inertia", F.sha2("components", 256).alias("centroid_sha256"))
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
