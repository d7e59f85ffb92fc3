"""Keyed state from change rows, and change rows from keyed states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHANGE_TYPE = "_change_type"
INSERT, PREIMAGE, POSTIMAGE, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def row_digest(df: DataFrame) -> Column:
    """A hash of the business columns, the last resort for ordering versions that tie on everything else."""
    return F.xxhash64(*[F.col(c) for c in sorted(df.columns) if not c.startswith("_")])


def version_order(df: DataFrame, sequence: Column, is_delete: Column) -> list[Column]:
    """A total order of the versions of one key: by sequence, deletes last among equals, then by content."""
    return [
        sequence.alias("sequence"),
        F.coalesce(is_delete, F.lit(False)).alias("deleted"),
        row_digest(df).alias("digest"),
    ]


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the greatest in ``order``.

    Spark turns the first-row filter into a limit per key before the shuffle, so a key that holds most of the rows
    sends one row per input partition and no task ever sees the whole group. Unlike ``max_by`` over a struct, a
    window lets unused columns be pruned from the scan.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def scd1_apply(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Column,
    is_delete: Column,
    keep_deleted: bool = False,
    narrow: bool = False,
) -> DataFrame:
    """Current state of every key: its latest change, and nothing when that change is a delete.

    The result depends only on the set of change rows, not on the order or grouping they arrive in. With ``narrow`` what orders them is
    computed before the shuffle, so columns that nobody reads stay behind; in the window itself the digest takes every column
    along, which lets two readers of different columns share one shuffle.
    """
    order = version_order(changes, sequence, is_delete)
    if narrow:
        at, gone, digest = order
        changes, order = changes.withColumns({"_at": at, "_digest": digest}), [F.col("_at"), gone, F.col("_digest")]
    latest = latest_by_key(changes, keys, order).drop(*["_at", "_digest"] * narrow)
    return latest if keep_deleted else latest.filter(~F.coalesce(is_delete, F.lit(False)))


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], preimages: bool = True) -> DataFrame:
    """The row changes that lead from one state to another; both states are unique by key."""
    columns = after.columns
    old = before.select(*keys, F.struct(*columns).alias("_old"))
    new = after.select(*keys, F.struct(*columns).alias("_new"))

    def event(image: str, kind: str) -> Column:
        return F.struct(F.lit(kind).alias(CHANGE_TYPE), *[F.col(image)[c].alias(c) for c in columns])

    updated = [event("_old", PREIMAGE)] if preimages else []
    events = (
        F.when(F.col("_old").isNull(), F.array(event("_new", INSERT)))
        .when(F.col("_new").isNull(), F.array(event("_old", DELETE)))
        .otherwise(F.array(*updated, event("_new", POSTIMAGE)))
    )
    changed = ~F.col("_old").eqNullSafe(F.col("_new"))
    return old.join(new, list(keys), "full_outer").filter(changed).select(F.inline(events))


def drop_preimages(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col(CHANGE_TYPE) != PREIMAGE)


def apply_feed(state: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after a change feed of one step: changed keys are replaced, deleted keys removed. One join."""
    columns = state.columns
    before = state.select(*keys, F.struct(*columns).alias("_old"))
    final = drop_preimages(feed).select(*keys, F.struct(*columns).alias("_new"), F.col(CHANGE_TYPE).alias("_kind"))
    rows = before.join(final, list(keys), "full_outer").filter(F.coalesce(F.col("_kind") != DELETE, F.lit(True)))
    return rows.select(F.when(F.col("_kind").isNull(), F.col("_old")).otherwise(F.col("_new")).alias("_row")).select("_row.*")


def inferred_members(
    facts: DataFrame, members: DataFrame, key: str, defaults: dict[str, Column] | None = None
) -> DataFrame:
    """The members plus a flagged placeholder for every key that only the facts know.

    Keys are made distinct before they are compared, so a key that fills the fact table costs one row.
    """
    known = members.withColumn("_is_inferred", F.lit(False))
    missing = facts.select(key).filter(F.col(key).isNotNull()).distinct().join(members.select(key), key, "left_anti")
    fill = {c: v for c, v in (defaults or {}).items()}
    placeholders = missing.withColumns(fill | {"_is_inferred": F.lit(True)})
    return known.unionByName(placeholders, allowMissingColumns=True)


def missing_members(keys: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The rows of ``keys`` (one per key) that no known member has; both are first cut down to keys by the caller."""
    return keys.join(known.select(key), key, "left_anti")


def resolve_members(members: DataFrame, arrivals: DataFrame, key: str) -> DataFrame:
    """Replace placeholders by the real members that arrived since."""
    real = arrivals.withColumn("_is_inferred", F.lit(False))
    kept = members.join(arrivals.select(key), key, "left_anti")
    return kept.unionByName(real, allowMissingColumns=True)


def union_by_name(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Stack frames by column name; a column some of them lack is NULL there."""
    for df in more:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def evolve_schema(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` with the columns of ``target`` first, absent ones NULL, followed by its own new columns."""
    added = {f.name: F.lit(None).cast(f.dataType) for f in target.schema.fields if f.name not in df.columns}
    extra = [c for c in df.columns if c not in target.columns]
    return df.withColumns(added).select(*target.columns, *extra)
