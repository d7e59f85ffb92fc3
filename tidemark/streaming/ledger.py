"""What a stream has to remember, as append folders of Parquet that are looked up by hash bucket.

    g=<n>/_batch=<name>/_bucket=<b>/    what one micro-batch added
    g=<n>/_batch=base/_bucket=<b>/      what folding kept of generation n - 1

A micro-batch reads the buckets its keys fall into and writes its own folder, which a repetition of it replaces and never reads. So
a small micro-batch touches few files, whatever the size of the ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.folders import matching, remove
from tidemark.sources.landing import STORED_AS

BUCKETS = 64
BASE = "base"
#: So many keys go to every task at most; more of them are left to a shuffle.
FEW = 1 << 16


def same_values(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of the columns of two aliased frames in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


class Ledger:
    """Rows of a fixed schema, bucketed by ``keys``. One writer at a time is assumed, as with any streaming sink."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)

    def _generation(self) -> int:
        folded = matching(self.spark, f"{self.path}/g=*/_batch={BASE}/_SUCCESS")
        return max([0, *(int(p.split("/g=")[-1].split("/")[0]) for p in folded)])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def batches(self, generation: int | None = None) -> list[str]:
        """The folders of finished micro-batches."""
        generation = self._generation() if generation is None else generation
        return [p.removesuffix("/_SUCCESS") for p in matching(self.spark, f"{self.path}/g={generation}/_batch=*/_SUCCESS")]

    def holds(self, batch: str) -> bool:
        """Whether micro-batches other than this one have added anything."""
        return any(not p.endswith(f"/_batch={batch}") for p in self.batches())

    def rows(self, without: str | None = None) -> DataFrame:
        """Everything that was added, or all but one micro-batch's part."""
        generation = self._generation()
        paths = [p for p in self.batches(generation) if not p.endswith(f"/_batch={without}")]
        if not paths:
            return self.spark.createDataFrame([], self.schema).withColumn("_bucket", F.lit(0))
        return self._read(generation, paths)

    def part(self, batch: str) -> DataFrame:
        """What one micro-batch added."""
        generation = self._generation()
        return self._read(generation, [f"{self.path}/g={generation}/_batch={batch}"]).drop("_bucket")

    def _read(self, generation: int, paths: Sequence[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("_batch", T.StringType()), T.StructField("_bucket", T.IntegerType())])
        return self.spark.read.option("basePath", f"{self.path}/g={generation}").schema(schema).parquet(*paths).drop("_batch")

    def lookup(self, wanted: DataFrame, batch: str, exact: bool = True) -> DataFrame:
        """What other micro-batches added under the keys of ``wanted``; reads their buckets only, and nothing while there are none.

        Without ``exact`` other keys of these buckets come too if over ``FEW`` are wanted: for a caller that brings rows of one key together
        anyway, leaving them out costs a shuffle more than it saves.
        """
        if not self.holds(batch):
            return self.spark.createDataFrame([], self.schema)
        keys = wanted.select(*self.keys)
        touched = {r[0]: r[1] for r in keys.groupBy(self._bucket()).agg(F.count(F.lit(1))).collect()}  # at most BUCKETS numbers
        held = self.rows(without=batch).filter(F.col("_bucket").isin([*touched])).drop("_bucket")
        few, keys = sum(touched.values()) <= FEW, keys.distinct()
        if not few and not exact:
            return held
        return held.alias("h").join((F.broadcast(keys) if few else keys).alias("k"), same_values("h", "k", self.keys), "left_semi")

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their ``_bucket``, range-partitioned by bucket and key: tasks of equal size, all rows of a key in one. Computes them twice."""
        return rows.withColumn("_bucket", self._bucket()).repartitionByRange("_bucket", *self.keys)

    def put(self, dealt: DataFrame, batch: str) -> None:
        """Write the part of a micro-batch, rows that come from :meth:`dealt`."""
        target = f"{self.path}/g={self._generation()}/_batch={batch}"
        self._write(dealt.select(*self.schema.fieldNames(), "_bucket"), target)

    @staticmethod
    def _write(rows: DataFrame, target: str) -> None:
        rows.write.mode("overwrite").option("compression", STORED_AS).partitionBy("_bucket").parquet(target)

    def add(self, rows: DataFrame, batch: str, stored: bool = False) -> None:
        """Write the part of a micro-batch, dealt by bucket so that a bucket gets a file or two.

        ``stored`` rows can be read twice at no cost; they are range-partitioned by bucket and key, into tasks of equal size.
        """
        target = f"{self.path}/g={self._generation()}/_batch={batch}"
        rows = rows.select(*self.schema.fieldNames(), self._bucket().alias("_bucket"))
        dealt = rows.repartitionByRange("_bucket", *self.keys) if stored else rows.repartition("_bucket")
        self._write(dealt, target)

    def fold(self, reduced: Callable[[DataFrame], DataFrame]) -> None:
        """Replace all folders by one that holds ``reduced`` of their rows. The generation before the last is removed."""
        generation = self._generation()
        rows = reduced(self.rows().drop("_bucket")).select(*self.schema.fieldNames(), self._bucket().alias("_bucket"))
        self._write(rows.repartition(F.col("_bucket")), f"{self.path}/g={generation + 1}/_batch={BASE}")
        remove(self.spark, f"{self.path}/g={generation - 1}")
