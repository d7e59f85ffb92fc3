"""A table with one current row per key, kept as plain Parquet folders of change rows.

    changes/_v=<n>/_batch=<name>/   the last change of every key of one merge, deletes included
    base/_v=<n>/                   the state after merge n, deleted keys included, that compaction folded

A merge writes what it was given and nothing else. The current state is the newest base and the changes after it, reduced to
the latest change per key; order, repetition and lateness of the changes do not matter. A folder counts once it holds the
success marker of its write, and a merge that is run again under its name replaces its own folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.operators.cdc import CHANGE_TYPE, DELETE, INSERT, POSTIMAGE, PREIMAGE, latest_by_key, version_order
from tidemark.operators.quality import all_present
from tidemark.sources.landing import STORED_AS

COMMIT_VERSION = "_commit_version"
_HIDDEN = ("_order", "_deleted")
_FOLDER = ("_v", "_batch")


class KeyedTable:
    """One writer at a time is assumed, as with any streaming sink."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    # -- folders -------------------------------------------------------------------------------------------------

    def _glob(self, pattern: str) -> list[str]:
        """Paths under the table by a pattern, through the file system the session reads it with."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        system = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().toString() for s in system.globStatus(hadoop) or []]

    def _remove(self, folder: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def _bytes(self, pattern: str) -> int:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        system = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sum(system.getContentSummary(s.getPath()).getLength() for s in system.globStatus(hadoop) or [])

    @staticmethod
    def _value(path: str, part: str) -> str:
        return next(p for p in path.split("/") if p.startswith(f"{part}=")).split("=", 1)[1]

    def _changes(self, batch: str = "*") -> dict[int, str]:
        """The finished change folders by version."""
        found = [p.rsplit("/", 1)[0] for p in self._glob(f"changes/_v=*/_batch={batch}/_SUCCESS")]
        return {int(self._value(p, "_v")): p for p in found}

    def _bases(self) -> list[int]:
        return sorted(int(self._value(p, "_v")) for p in self._glob("base/_v=*/_SUCCESS"))

    def latest_version(self) -> int:
        """The newest version, 0 for a table that does not exist yet."""
        return max([0, *self._changes(), *self._bases()])

    # -- reading -------------------------------------------------------------------------------------------------

    def _state(self, version: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The latest change of every key as of a version, deletes included; ``only`` of the keys it lists."""
        version = self.latest_version() if version is None else version
        base = max((b for b in self._bases() if b <= version), default=0)
        folders = [p for v, p in sorted(self._changes().items()) if base < v <= version]
        paths = [f"{self.path}/base/_v={base}"] * bool(base) + folders
        if not paths:
            raise ValueError(f"{self.path} has no version {version or ''}".rstrip())
        rows = self.spark.read.option("mergeSchema", True).parquet(*paths)
        rows = rows.drop(*_FOLDER)
        if only is not None:
            rows = rows.join(only.distinct(), only.columns, "left_semi")
        return rows if len(paths) == 1 else latest_by_key(rows, self.keys, [F.col("_order")])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version that compaction has not folded away, the newest one by default."""
        return self._state(version).filter(~F.col("_deleted")).drop(*_HIDDEN)

    def can_read(self, version: int) -> bool:
        """Whether the folders are still there that make up a version."""
        bases, changes = self._bases(), self._changes()
        base = max((b for b in bases if b <= version), default=0)
        return 0 < version <= self.latest_version() and max(bases, default=0) <= version and all(v in changes for v in range(base + 1, version + 1))

    def read_all(self, only: DataFrame | None = None) -> DataFrame:
        """The latest change of every key with its ``_order`` and whether it is ``_deleted``.

        ``only`` names the keys that are asked for by some of the table's key columns; no other row is moved or reduced.
        """
        return self._state(only=only)

    def read_changes(self, start: int, end: int | None = None, preimages: bool = False) -> DataFrame:
        """Row changes of the merges ``start`` to ``end``, both included, against the state before each.

        The state before ``start`` is read once, for the keys of these merges only; from there every change is compared with the
        greatest earlier one of its key, in one window that holds at most one row per merge.
        """
        last = self.latest_version() if end is None else end
        folders = [p for v, p in sorted(self._changes().items()) if start <= v <= last]
        if not folders:
            return self._events(self._state(last).limit(0).withColumn("_v", F.lit(last)), preimages)
        new = self.spark.read.option("mergeSchema", True).option("basePath", f"{self.path}/changes").parquet(*folders).drop("_batch")
        if min([*self._changes(), *self._bases()]) < start:
            before = self._state(start - 1, only=new.select(*self.keys)).withColumn("_v", F.lit(start - 1))
            new = new.unionByName(before, allowMissingColumns=True)
        return self._events(new, preimages).filter(F.col(COMMIT_VERSION) >= start)

    def _events(self, rows: DataFrame, preimages: bool) -> DataFrame:
        """What each row of ``_v`` changes, given the rows of its key with a smaller ``_v``."""
        columns = [c for c in rows.columns if c not in (*_HIDDEN, "_v")]
        rows = rows.select(*self.keys, F.struct(*columns).alias("_new"), "_order", "_deleted", "_v")
        earlier = Window.partitionBy(*self.keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_last", F.max_by(F.struct("_new", "_order", "_deleted"), "_order").over(earlier))
        rows = rows.filter(F.col("_last").isNull() | (F.col("_order") > F.col("_last._order")))
        lived = F.col("_last").isNotNull() & ~F.col("_last._deleted")

        def event(row: str, kind: str) -> Column:
            return F.struct(*[F.col(row)[c].alias(c) for c in columns], F.lit(kind).alias(CHANGE_TYPE))

        updated = F.array(*[event("_last._new", PREIMAGE)] * preimages, event("_new", POSTIMAGE))
        events = (
            F.when(~F.col("_deleted") & ~lived, F.array(event("_new", INSERT)))
            .when(~F.col("_deleted"), updated)
            .when(lived, F.array(event("_last._new", DELETE)))
        )
        return rows.filter(lived | ~F.col("_deleted")).select(F.inline(events), F.col("_v").cast("int").alias(COMMIT_VERSION))

    def change_stream(self, max_files: int | None = None) -> DataFrame:
        """The change rows of every merge as a stream: upserts as post-images, and deletes.

        A change that loses to an earlier one, or comes twice, is in the stream as well; the sequence that it carries settles that
        downstream, as it does here.
        """
        schema = self._state().schema
        fields = [*schema.fields, T.StructField("_v", T.IntegerType()), T.StructField("_batch", T.StringType())]
        reader = self.spark.readStream.schema(T.StructType(fields))
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        rows = reader.parquet(f"{self.path}/changes")
        kind = F.when(F.col("_deleted"), F.lit(DELETE)).otherwise(F.lit(POSTIMAGE))
        columns = [c for c in schema.fieldNames() if c not in _HIDDEN]
        return rows.select(*columns, kind.alias(CHANGE_TYPE), F.col("_v").alias(COMMIT_VERSION))

    # -- writing -------------------------------------------------------------------------------------------------

    def merge(self, changes: DataFrame, sequence: Column, is_delete: Column, batch: str | None = None, reduced: bool = False) -> int:
        """Add change rows and return the version they led to; writes the last change of each of their keys, in one pass.

        A change counts only if it comes later in sequence than what is known of its key. ``batch`` names the merge: one that was
        stopped, or is run again, takes the place of its first try. Rows whose key is not whole cannot be merged; the
        rules of the pipeline have put them into quarantine before. ``reduced`` rows hold each key once, as the state of a keyed table
        does, and are written as they come, without a shuffle.
        """
        batch = batch or uuid.uuid4().hex
        again = self._glob(f"changes/_v=*/_batch={batch}")
        version = int(self._value(again[0], "_v")) if again else self.latest_version() + 1
        changes = changes.filter(all_present(self.keys))
        at, gone, digest = version_order(changes, sequence, is_delete)
        rows, order = changes.withColumn("_digest", digest), [at, gone, F.col("_digest").alias("digest")]
        if not reduced:  # the digest alone is added to what is shuffled; the rest of the order follows from the row
            rows = latest_by_key(rows, self.keys, order)
        rows = rows.withColumn("_order", F.struct(*order)).drop("_digest").withColumn("_deleted", F.col("_order.deleted"))
        rows.write.mode("overwrite").option("compression", STORED_AS).parquet(f"{self.path}/changes/_v={version}/_batch={batch}")
        return version

    def compact(self, forget_before: Column | None = None, version: int | None = None) -> int:
        """Fold the changes up to a version into a base; ``forget_before`` drops deleted keys with an older sequence.

        Changes stay until :meth:`clean`, so older versions can still be read.
        """
        version = self.latest_version() if version is None else version
        self._write_base(self._state(version), version, forget_before)
        return version

    def _write_base(self, rows: DataFrame, version: int, forget_before: Column | None = None) -> None:
        if forget_before is not None:
            rows = rows.filter(~F.col("_deleted") | (F.col("_order.sequence") >= forget_before))
        # A base is written beside what it is made of, then takes its place.
        part = f"{self.path}/base/_part={uuid.uuid4().hex}"
        rows.write.option("compression", STORED_AS).parquet(part)
        target = f"{self.path}/base/_v={version}"
        self._remove(target)
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        hadoop(part).getFileSystem(self.spark._jsc.hadoopConfiguration()).rename(hadoop(part), hadoop(target))

    def clean(self) -> None:
        """Remove the changes and bases that the newest base replaces; call it when no stream still has to read them."""
        base = max(self._bases(), default=0)
        for version, folder in self._changes().items():
            if version <= base:
                self._remove(folder.rsplit("/", 1)[0])
        for version in self._bases():
            if version < base:
                self._remove(f"{self.path}/base/_v={version}")

    def upkeep(self, share: float = 0.5) -> bool:
        """Compact and clean once the changes since the base hold more than ``share`` of its bytes.

        The first merge of a table holds one row per key, as a base does, so it is the base until there is another.
        """
        base = max(self._bases(), default=0)
        folders = [f"_v={v}" for v in sorted(self._changes()) if v > base]
        held = f"base/_v={base}" if base else f"changes/{folders.pop(0)}" if folders else None
        if not folders or sum(self._bytes(f"changes/{f}") for f in folders) <= share * self._bytes(held):
            return False
        self.compact()
        self.clean()
        return True

    def rollback(self, version: int) -> int:
        """Make an earlier version the newest one; readers of the change stream should read the table anew."""
        newest = self.latest_version() + 1
        self._write_base(self._state(version), newest)
        return newest
