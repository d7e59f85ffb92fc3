"""Hard negatives by exact inner-product search: anchors share sorted candidate lists and walk them until nothing better can follow.

Anchors are put into clusters. For a cluster with centre c and widest member angle w, no member can score more than
``|anchor| * |x| * cos(max(0, angle(x, c) - w))`` with a row x. One list per cluster holds all rows by falling bound, sorted once.
Members walk it from the top; once what they have found beats the bound of the next row, the rest is proven useless.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.store import stored
from tidemark.llm.vectors import usable, whole

#: Anchors of a cluster, the most clusters, and how many anchors their centres are fitted on. They steer speed, never the result.
MEMBERS, MAX_CLUSTERS, SAMPLE = 256, 64, 4096
#: Rows of a piece of a list and anchors that meet it in one task; a walk reads 1, then 8, then 64 .. pieces of each list.
PIECE, BLOCK, GROWTH = 4096, 2048, 8
#: Added to angles (radians) and bounds (a share), far above the rounding of the arithmetic, so that bounds stay proven.
SLACK = 1e-6

_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def dense(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers as a matrix of ``width`` columns; missing components are 0, those beyond are left out."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = at < width
    out[row[inside], at[inside]] = flat[inside]
    return out


def centres(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Up to ``k`` directions that the rows of a bounded sample gather around; the same for the same sample."""
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.ones((1, max(1, vectors.shape[1]))) / math.sqrt(max(1, vectors.shape[1]))
    chosen = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        owner = np.argmax(unit @ chosen.T, axis=1)
        sums = np.zeros_like(chosen)
        np.add.at(sums, owner, unit)
        size = np.linalg.norm(sums, axis=1)
        chosen = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], chosen)
    return chosen


def angles(vectors: pa.Array, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of every row with every direction; a zero row has the angle 0 with all."""
    cosine = dense(vectors, directions.shape[1]).astype(float) @ directions.T / np.where(norms > 0, norms, 1)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)


def _placed(anchors: DataFrame, directions: np.ndarray) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = angles(batch.column("v"), batch.column("norm").to_numpy(), directions)
            best = np.argmin(found, axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best.astype(np.int32)), pa.array(found[np.arange(len(best)), best])],
                names=[*batch.schema.names, "cluster", "angle"],
            )

    schema = T.StructType([*anchors.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    return anchors.mapInArrow(place, schema)


def _lists(rows: DataFrame, directions: np.ndarray, width: dict[int, float]) -> DataFrame:
    """``cluster, bound, id, label, v, norm``: every row once for each cluster that has members."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = batch.column("norm").to_numpy()
            found = angles(batch.column("v"), norms, directions)
            for cluster, widest in width.items():
                bound = norms * np.cos(np.maximum(0.0, found[:, cluster] - widest - SLACK))
                cluster_column = pa.array(np.full(len(norms), cluster, np.int32))
                yield pa.RecordBatch.from_arrays([cluster_column, pa.array(bound), *batch.columns], names=["cluster", "bound", *batch.schema.names])

    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("bound", T.DoubleType()), *rows.schema.fields])
    return rows.mapInArrow(bounds, schema)


def scores(members: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: by the float unit where every sum fits 53 bits, else in 64-bit integers."""
    most = float(np.sqrt((members.astype(float) ** 2).sum(axis=1).max(initial=0) * (rows.astype(float) ** 2).sum(axis=1).max(initial=0)))
    if most < 2**52:
        return np.rint(members.astype(float) @ rows.astype(float).T).astype(np.int64)
    if most < 2**62:
        return members @ rows.T
    raise OverflowError("an inner product does not fit 63 bits")


def _meet(same: bool, k: int):
    """What a block of members finds in a piece of their list: up to ``k`` rows for each of their slots."""

    def meet(members: pa.Table, piece: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if members.num_rows and piece.num_rows:
            bound = piece["bound"].to_numpy()
            falling = np.argsort(-bound, kind="stable")
            bound, ids, labels = bound[falling], piece["id"].to_numpy()[falling], piece["label"].to_numpy()[falling]
            longest = [int(t["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()) for t in (members, piece)]
            rows, own = dense(piece["v"], min(longest))[falling], dense(members["v"], min(longest))
            norms, names, variants = members["norm"].to_numpy(), members["id"].to_numpy(), members["own"].to_numpy()
            wanted, slots = members["label"].to_numpy(), members["slots"].to_pylist()
            for first in range(0, len(names), 128):
                table = scores(own[first : first + 128], rows)
                for i in range(first, first + len(table)):
                    fits = ((labels == wanted[i]) == same) & (ids != names[i])
                    for slot in slots[i]:
                        # Rows of this piece past the last one whose bound reaches what is wanted need no look.
                        reach = len(bound) - int(np.searchsorted(bound[::-1] * norms[i] * (1 + SLACK) + SLACK, slot["least"]))
                        s = table[i - first, :reach]
                        at = np.flatnonzero(fits[:reach] & (s >= slot["least"]) & (s <= slot["most"]))
                        if len(at) > k:
                            at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
                        at = at[np.lexsort((ids[at], -s[at]))[:k]]
                        for column, values in zip(out, ([names[i]] * len(at), [variants[i]] * len(at), [slot["slot"]] * len(at), ids[at], s[at]), strict=True):
                            column.extend(values)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["a", "own", "slot", "found", "score"])

    return meet


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a", "own", "slot").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def walk(lists: DataFrame, pieces: DataFrame, seekers: DataFrame, same: bool, k: int) -> DataFrame:
    """``a, own, slot, found, score, rank``: the ``k`` best rows of every slot of every seeker, by score, then smaller id.

    ``seekers`` (id, own, label, v, norm, cluster, block, slots) ask for rows of their own label (``same``) or of other labels with
    scores from ``least`` to ``most`` of each slot. Each round compares the open seekers with the next pieces of their list and closes
    the slots whose k-th score, or least wanted score, exceeds the bound of the first piece not read. Pieces and
    blocks bound a task; what a round keeps is at most ``k`` rows a slot.
    """
    last = pieces.agg(F.max("place")).first()[0]
    found, start, width = None, 0, 1
    while True:
        now = pieces.filter((F.col("place") >= start) & (F.col("place") < start + width)).select("cluster", "piece")
        keys = seekers.select("cluster", "block").distinct().join(now, "cluster")
        keys = keys.select("cluster", "piece", F.col("cluster").alias("c"), F.col("piece").alias("p"), F.col("block").alias("b"))
        left = seekers.join(now, "cluster").groupBy("cluster", "piece", "block")
        right = lists.join(keys, ["cluster", "piece"]).select("c", "p", "b", "bound", "id", "label", "v").groupBy("c", "p", "b")
        met = left.cogroup(right).applyInArrow(_meet(same, k), "a long, own long, slot int, found long, score long")
        found = stored(_best(met if found is None else met.unionByName(found.drop("rank")), k), "found")
        start, width = start + width, width * GROWTH
        if start > last:
            return found
        bound = pieces.filter(F.col("place") >= start).groupBy("cluster").agg(F.max("bound").alias("next"))
        worst = found.groupBy(F.col("a").alias("id"), "own", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst")).filter(F.col("n") == k)
        slots = seekers.select("id", "own", "norm", "cluster", F.explode("slots").alias("s")).select("*", "s.*").drop("s")
        slots = slots.join(worst, ["id", "own", "slot"], "left").join(bound, "cluster")
        slots = slots.withColumn("least", F.greatest("least", F.coalesce("worst", "least")))
        can = F.col("norm") * F.col("next") * F.when(F.col("next") > 0, 1 + SLACK).otherwise(1 - SLACK) + SLACK
        slots = slots.filter(F.col("least") <= can).groupBy("id", "own").agg(F.collect_list(F.struct("slot", "least", "most")).alias("slots"))
        seekers = stored(seekers.drop("slots").join(slots, ["id", "own"]), "seekers")
        if seekers.isEmpty():
            return found


def mined(
    embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, piece: int = PIECE
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every anchor and each of its positives.

    ``embeddings`` (vec_id, embedding, label, any others); ``is_anchor`` is a condition on these columns. Components become ``floor(256 x)``;
    scores are exact integer inner products, higher first, ties by smaller id. An anchor's positives are its best ``positives`` other
    rows of its label; a positive's negatives are the best ``negatives`` rows of other labels whose score n satisfies
    ``low_percent * p <= 100 * n <= 100 * p`` for the positive's score p. Fewer are returned where there are fewer; a positive without
    negatives, such as one with a negative score, gives no row.

    Rows with a null id, label or vector or a null or non-finite component take no part, neither as anchors nor as candidates. Equal rows
    count once. Rows of one id with different labels or vectors are rows of their own, but an anchor never meets its own id.
    Vectors of different lengths are compared as if zeros followed the shorter one; an empty vector scores 0 with all. A component
    beyond 2^31 / 256, or a score beyond 63 bits, raises an error. An empty table, or none with an anchor, gives an empty result.
    """
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = embeddings.filter(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole("embedding").alias("v"), is_anchor.alias("anchor"))
    rows = stored(rows.distinct().withColumn("norm", size), "rows")
    anchors = rows.filter("anchor").drop("anchor").withColumn("own", F.xxhash64("label", "v"))
    spark, many, all_rows = embeddings.sparkSession, anchors.count(), rows.count()
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not many:
        return spark.createDataFrame([], empty)
    sample = anchors.orderBy(F.xxhash64("id"), "id", "own").limit(SAMPLE).select("v").toArrow()["v"]
    longest = max(1, int(sample.combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()))
    directions = centres(dense(sample, longest).astype(float), min(MAX_CLUSTERS, math.ceil(many / MEMBERS)))
    placed = stored(_placed(anchors, directions), "anchors")
    clusters = placed.groupBy("cluster").agg(F.max("angle").alias("angle"), F.count(F.lit(1)).alias("n")).collect()  # at most MAX_CLUSTERS rows
    blocks = F.create_map(*[F.lit(x) for r in clusters for x in (r.cluster, math.ceil(r.n / BLOCK))])
    placed = placed.drop("angle").withColumn("block", F.pmod(F.xxhash64("id", "own"), F.element_at(blocks, F.col("cluster"))))

    lists = _lists(rows.drop("anchor"), directions, {r.cluster: r.angle for r in clusters})
    count = max(1, math.ceil(all_rows * len(clusters) / piece))
    lists = lists.repartitionByRange(count, "cluster", F.desc("bound"), "id").sortWithinPartitions("cluster", F.desc("bound"), "id")
    lists = stored(lists.withColumn("piece", F.spark_partition_id()), "lists")
    pieces = lists.groupBy("cluster", "piece").agg(F.max("bound").alias("bound"))
    order = Window.partitionBy("cluster").orderBy("piece")  # one row per piece of thousands of rows
    pieces = stored(pieces.withColumn("place", F.row_number().over(order) - 1), "pieces")

    def slot(number, least, most) -> Column:
        return F.struct(number.cast("int").alias("slot"), least.cast("long").alias("least"), most.cast("long").alias("most"))

    near = walk(lists, pieces, placed.withColumn("slots", F.array(slot(F.lit(0), F.lit(_LOWEST), F.lit(_HIGHEST)))), True, positives)
    near = near.filter("score >= 0").select(F.col("a").alias("id"), "own", F.col("rank").alias("slot"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    p = F.col("positive_score").cast("decimal(19,0)")
    asked = near.groupBy("id", "own").agg(F.collect_list(slot(F.col("slot"), F.ceil(p * low_percent / 100), F.col("positive_score"))).alias("slots"))
    seekers = stored(placed.join(asked, ["id", "own"]), "seekers")
    hard = walk(lists, pieces, seekers, False, negatives)
    hard = hard.select(F.col("a").alias("id"), "own", "slot", "rank", F.col("found").alias("negative_id"), F.col("score").alias("negative_score"))
    return hard.join(near, ["id", "own", "slot"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
