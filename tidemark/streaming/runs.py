"""Streaming steps. Each runs over everything available, then stops; a later run picks up where it ended."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.entities import DAY_PARTS, ENTITIES, OP
from tidemark.operators.quality import REASON, observed, reasons
from tidemark.plans import silver, star
from tidemark.sources.keyed import COMMIT_VERSION, KeyedTable
from tidemark.sources.landing import DAY, ORIGIN, RECEIVED, STORED_AS, bronze_metadata, landing_stream, source_lineage

ROW_ID, RELEASED_BY = "_row_id", "_released_by"


def append(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append a stream to a Parquet table."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).option("compression", STORED_AS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.outputMode("append").trigger(availableNow=True).start()


def for_each_batch(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Run ``step`` on every micro-batch with a name that only a repetition of the same micro-batch has again.

    The name begins with the id that the checkpoint was created with: a new checkpoint counts its batches from 0 but
    never takes the place of an older one's.
    """

    def named(rows: DataFrame, batch_id: int) -> None:
        marker = rows.sparkSession.read.text(f"{checkpoint}/metadata").first()[0]
        step(rows, f"{json.loads(marker)['id']}-{batch_id}")

    writer = stream.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def bronze_append(
    spark: SparkSession,
    landing: str,
    bronze: str,
    table: str,
    now: datetime | None = None,
    max_files: int | None = None,
    added: Sequence[T.StructField] = (),
) -> StreamingQuery:
    """Raw append table of one entity by day folder, with time of receipt and file of origin; no shuffle."""
    rows = bronze_metadata(source_lineage(landing_stream(spark, landing, table, max_files, added)), now)
    return append(rows, f"{bronze}/{table}", f"{bronze}/_checkpoints/{table}", DAY)


def bronze_schema(table: str, added: Sequence[T.StructField] = ()) -> T.StructType:
    extra = [T.StructField(RECEIVED, T.TimestampNTZType()), T.StructField(ORIGIN, T.StringType())]
    return T.StructType([*ENTITIES[table].change_schema.fields, *added, *extra, *DAY_PARTS.fields])


def read_bronze(spark: SparkSession, bronze: str, table: str, added: Sequence[T.StructField] = ()) -> DataFrame:
    return spark.read.schema(bronze_schema(table, added)).parquet(f"{bronze}/{table}")


def read_stream(
    spark: SparkSession, bronze: str, table: str, max_files: int | None = None, added: Sequence[T.StructField] = ()
) -> DataFrame:
    """An append table as a stream; every consumer keeps its own position in its checkpoint."""
    reader = spark.readStream.schema(bronze_schema(table, added))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{bronze}/{table}")


def scd1_stream(
    stream: DataFrame, table: KeyedTable, sequence: Column, is_delete: Column, checkpoint: str
) -> StreamingQuery:
    """Keep a keyed table current from a stream of change rows."""
    return for_each_batch(stream, checkpoint, lambda rows, batch: table.merge(rows, sequence, is_delete, batch))


def silver_stream(
    stream: DataFrame,
    entity: str,
    table: KeyedTable,
    quarantine_path: str,
    checkpoint: str,
    now: datetime | None = None,
    waiting: KeyedTable | None = None,
    parents: Callable[[], Mapping[str, DataFrame]] | None = None,
    metrics_path: str | None = None,
    **options,
) -> StreamingQuery:
    """Split each micro-batch by the rules: good rows merge into the keyed table, the others into the quarantine.

    Tagged rows are kept for both outputs, so a micro-batch is read and judged once. The quarantine writes to a folder of
    its own per micro-batch, which a repeated micro-batch replaces. With ``parents`` rows must refer to known ones; those that do not
    are merged into ``waiting``, from where :func:`release_stream` lets them out. What the pass counted goes to ``metrics_path``, in a folder of
    the micro-batch as well.
    """
    spec = ENTITIES[entity]
    named = reasons(spec.rules, spec.references if parents is not None else ())

    def step(rows: DataFrame, batch: str) -> None:
        known = {} if parents is None else {"parents": parents()}
        counted = Observation()
        marked = observed(silver.tagged(rows.drop(*DAY), entity, **options, **known), named, counted).persist()
        try:
            bad = silver.quarantine_part(marked, entity, now)
            if waiting is not None:
                for_parent = [r.reason for r in spec.references]
                hold(waiting, bad.filter(F.col(REASON).isin(for_parent)), batch)
                bad = bad.filter(~F.col(REASON).isin(for_parent))
            bad.write.mode("overwrite").partitionBy("_quarantine_date").parquet(f"{quarantine_path}/batch={batch}")
            table.merge(silver.clean_part(marked, now), silver.silver_sequence(), silver.is_delete(), batch)
            if metrics_path is not None:
                store_metrics(rows.sparkSession, counted.get, entity, named, f"{metrics_path}/batch={batch}")
        finally:
            marked.unpersist()

    return for_each_batch(stream, checkpoint, step)


METRICS = "table_name string, reason string, rows long"


def store_metrics(spark: SparkSession, counts: Mapping[str, int], entity: str, named: Sequence[str], path: str) -> None:
    """One row for what was read, what was clean (reason NULL) and each reason that occurred; a repeated micro-batch replaces its own."""
    found = [(entity, "read", counts["read"]), (entity, None, counts["clean"])]
    found += [(entity, r, counts[f"r{i}"]) for i, r in enumerate(named) if counts[f"r{i}"]]
    spark.createDataFrame(found, METRICS).coalesce(1).write.mode("overwrite").parquet(path)


def _row_id(rows: DataFrame) -> Column:
    """What a waiting row is called: a hash of all it says, so that one that is delivered twice waits once."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(rows.columns) if not c.startswith("_")]
    return F.sha2(F.concat_ws("\x1f", *said), 256)


def hold(waiting: KeyedTable, rows: DataFrame, batch: str) -> None:
    """Keep rejected rows until they are let out; a row that was let out before does not come back."""
    held = rows.withColumns({ROW_ID: _row_id(rows), RELEASED_BY: F.lit(None).cast("string")})
    waiting.merge(held, F.lit(0), F.lit(False), batch)


def release_stream(
    parent_changes: DataFrame,
    key: str,
    entity: str,
    waiting: KeyedTable,
    table: KeyedTable,
    parents: Callable[[DataFrame], Mapping[str, DataFrame]],
    checkpoint: str,
    now: datetime | None = None,
) -> StreamingQuery:
    """Let rows of an entity out of the waiting table once their parents have come, into the keyed table.

    Each micro-batch of the parent's changes looks at the rows that wait for these keys only; ``parents`` gives the current rows of every parent
    for a set of waiting rows. A row leaves the waiting table under the name of the micro-batch, so a repetition finds the same
    rows again and leaves the same state behind.
    """

    def step(changed: DataFrame, batch: str) -> None:
        if not waiting.latest_version():
            return
        here = ~F.col("_deleted") | F.col(RELEASED_BY).eqNullSafe(batch)
        held = waiting.read_all().join(changed.select(key).distinct(), key, "left_semi").filter(here).drop("_deleted", "_order")
        judged = silver.judged_again(held, entity, parents(held)).persist()
        try:
            free = judged.filter(F.col(REASON).isNull()).drop(ROW_ID, RELEASED_BY, "_quarantine_table_name", "_quarantine_date", "_quarantine_failed_at")
            table.merge(silver.clean_part(free, now), silver.silver_sequence(), silver.is_delete(), batch)
            gone = judged.filter(F.col(REASON).isNull()).withColumn(RELEASED_BY, F.lit(batch))
            waiting.merge(gone, F.lit(1), F.lit(True), batch, reduced=True)
        finally:
            judged.unpersist()

    return for_each_batch(parent_changes, checkpoint, step)


def gold_stream(
    changes: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    table: KeyedTable,
    checkpoint: str,
    sequence: Column | None = None,
    of_table: bool = False,
) -> StreamingQuery:
    """Turn a silver change feed into gold rows and merge them, deletions included.

    ``stage`` closes over snapshots read before the run, so all micro-batches see the same other side. A feed ``of_table`` is the change
    stream of a keyed table with the keys of the gold one: one merge holds each key once, so a micro-batch of one merge is not reduced.
    """

    def step(rows: DataFrame, batch: str) -> None:
        staged = stage(rows)
        op = F.when(star.feed_is_delete(), "D").otherwise(F.col(OP))
        rows_out = staged.withColumn(OP, op).drop(*star.FEED_COLUMNS)
        reduced = of_table and len(rows.select(COMMIT_VERSION).distinct().take(2)) < 2
        table.merge(rows_out, star.gold_sequence() if sequence is None else sequence, silver.is_delete(), batch, reduced)

    return for_each_batch(changes, checkpoint, step)


def run_all(queries: Mapping[str, StreamingQuery] | list[StreamingQuery]) -> None:
    """Wait for queries that run side by side; the first failure is raised."""
    for q in list(queries.values()) if isinstance(queries, Mapping) else queries:
        q.awaitTermination()
