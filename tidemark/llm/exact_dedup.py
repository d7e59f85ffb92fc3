"""Exact duplicates by content hash, built from DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _hash() -> Column:
    return F.unhex(F.md5(_text()))


def copy_groups(docs: DataFrame, keep: str = "min") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs`` (doc_id, text, any others).

    Rows are grouped by the 128-bit MD5 of the text and, inside a hash, by the bytes of the text itself, so colliding texts form
    groups of their own. The smallest id of a group stays, or with ``keep="max"`` the largest. Partial aggregation folds copies before
    the shuffle: a text that a third of all rows share sends one row per task. Rows find their group by the MD5 and the
    SHA-256 of their text, in a join that adaptive execution can split.

    A null text is an empty one. Rows without an id count in ``group_size`` but stay only if their whole group has none. Equal
    rows of the id that stays are all kept: they are one document. An empty table gives an empty result.
    """
    best = F.min if keep == "min" else F.max
    groups = docs.groupBy(_hash().alias("h"), _text().alias("t")).agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("h", F.sha2("t", 256).alias("text_sha256"), "keep_id", "group_size")
    rows = docs.select("doc_id", _hash().alias("h"), F.sha2(_text(), 256).alias("text_sha256"))
    return rows.join(groups, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def without_copies(docs: DataFrame, keep: str = "min") -> DataFrame:
    """One row of ``docs`` for each distinct text, with all its columns: the one :func:`copy_groups` keeps.

    Of equal ids in a group one row stays, chosen by a hash of all columns. The hash groups the rows and the bytes of the text
    decide inside a hash; the copies of a task are folded before the shuffle.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    last = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    first = F.struct(F.col("doc_id").isNotNull(), "doc_id", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    chosen = F.min_by(row, last) if keep == "min" else F.max_by(row, first)
    return docs.groupBy(_hash().alias("_hash"), _text().alias("_text")).agg(chosen.alias("_row")).select("_row.*")
