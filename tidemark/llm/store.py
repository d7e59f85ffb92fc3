"""Intermediate tables and bounded summaries that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.words import Bits
from tidemark.session import scratch

#: Largest bitmap, as a power of two of its bits (16 MB). A fuller bitmap lets more rows pass; it never loses one.
MAX_BITS = 27


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: a lost executor costs no earlier step."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bitmap(hashes: DataFrame, column: str, rows: int):
    """A broadcast :class:`Bits` of a column of 64-bit hashes, with about 16 bits for each of ``rows``."""
    spark = hashes.sparkSession
    bits = min(MAX_BITS, max(16, math.ceil(math.log2(16 * rows + 1))))
    hash_ = F.col(column)
    folded = [hash_, *[hash_.bitwiseXOR(F.shiftrightunsigned(hash_, s)) for s in Bits.SHIFTS]]
    slots = F.array(*[h.bitwiseAND(F.lit((1 << bits) - 1)) + 1 for h in folded])
    parts = (
        hashes.select(F.explode(slots).alias("_slot"))
        .groupBy(F.expr("bitmap_bucket_number(_slot)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_slot))").alias("part"))
    )
    data = {r.bucket: bytes(r.part) for r in parts.collect()}  # at most 2^(bits - 15) rows of 4 kB
    return spark.sparkContext.broadcast(Bits(data, bits))


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells apart rows of one id with different texts; equal rows share it."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the documents that no model may learn from. A null id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
