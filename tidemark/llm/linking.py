"""Connected groups of items that share buckets, found without all pairs of a bucket.

Items meet in buckets. Every bucket first compares its members with one of them, its pivot. Members that this puts in the
pivot's group need no further comparison with each other. What stays outside is compared with every member of the bucket in
another group. So each pair that could join two groups is looked at, and a bucket of a million copies costs a million
comparisons instead of half a million million.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored

Admissible = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]
Verify = Callable[[DataFrame], DataFrame]


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every id in ``edges`` (a, b): the smallest id that links reach from it.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then its smaller
    neighbours. Both are joins on a node with one row per node, which adaptive execution splits where a node is hot.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo")
    now, last = stored(pairs.distinct(), "links"), None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())
        if mark == last:
            break
        last = mark
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        floor = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(floor, "hi")
            .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.*")
            .filter("hi <> lo")
            .distinct()
        )
        now = stored(small, "links")
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("root")).unionAll(
        now.select("lo", F.col("lo").alias("root")).distinct()
    )


def connect(
    members: DataFrame,
    verify: Verify,
    rank: Sequence[str],
    payload: Sequence[str] = (),
    admissible: Admissible = lambda a, b: F.lit(True),
    membership: DataFrame | None = None,
) -> DataFrame:
    """``id, root`` of all items that link with another one.

    ``members`` (bucket, gid, size, ``rank`` and ``payload`` columns) are groups of ``size`` items in buckets; ``membership`` (gid, id) lists
    the items of a group, one of which is called like the group. ``rank`` decides the pivot, smallest first. ``admissible`` may reject
    a pair by its columns. ``verify`` keeps the linked ones of the item pairs (a, b).
    """
    payload = [c for c in payload if c not in rank]
    fields = [*rank, "gid", *payload]

    def side(prefix: str) -> Callable[[str], Column]:
        return lambda c: F.col(f"{prefix}{c}")

    pivots = members.groupBy("bucket").agg(F.min(F.struct(*fields)).alias("p"), F.sum("size").alias("items")).filter("items > 1")
    pivots = stored(pivots.select("bucket", "items", *[F.col(f"p.{c}").alias(f"p_{c}") for c in fields]), "pivots")
    met = members.select("bucket", *[F.col(c).alias(f"m_{c}") for c in fields]).join(pivots, "bucket")
    star = met.filter(admissible(side("p_"), side("m_"))).select("p_gid", F.col("m_gid").alias("gid")).distinct()
    if membership is not None:
        star = star.join(membership, "gid")
    star = star.select(F.col("p_gid").alias("a"), F.col("gid" if membership is None else "id").alias("b")).filter("a <> b")
    first = stored(verify(star), "star")
    found = stored(components(first), "found")

    def rooted(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.join(found.select(F.col("id").alias(key), F.col("root").alias(name)), key, "left").withColumn(name, F.coalesce(name, key))

    # A bucket of two has been compared in full. In the others, those with anything outside the pivot's group are still open.
    centres = rooted(pivots.filter("items > 2").select("bucket", F.col("p_gid").alias("pivot")), "pivot", "pivot_root")
    items = members.select("bucket", "gid", *rank, *payload).join(centres, "bucket")
    items = items.withColumn("id", F.col("gid")) if membership is None else items.join(membership, "gid")
    placed = stored(rooted(items.drop("gid"), "id", "root"), "placed")
    whole = placed.groupBy("bucket").agg(F.max(F.col("root") != F.col("pivot_root")).alias("open")).filter("open").select("bucket")
    placed = placed.join(whole, "bucket", "left_semi")
    cols = ["id", "root", "pivot", "pivot_root", *rank, *payload]
    s = placed.filter("root <> pivot_root").select("bucket", *[F.col(c).alias(f"s_{c}") for c in cols])
    o = placed.select("bucket", *[F.col(c).alias(f"o_{c}") for c in cols])
    rest = (
        s.join(o, "bucket")
        .filter("s_root <> o_root and o_id <> o_pivot and (o_root = o_pivot_root or s_id < o_id)")
        .filter(admissible(side("s_"), side("o_")))
        .select(F.col("s_id").alias("a"), F.col("o_id").alias("b"))
        .distinct()
    )
    second = verify(rest)
    return components(first.select("a", "b").unionAll(second.select("a", "b")))
