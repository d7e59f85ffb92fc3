"""Current state per key held by the stream itself: RocksDB state that a micro-batch looks up for the hash buckets of its own keys only.

The other form, :func:`tidemark.streaming.runs.scd1_stream`, stores change rows and reduces them when they are read; it is what runs use. Here every
change is settled as it comes, and the stream's output is the change feed with the row before and the row after. The row
function is Python, one call per bucket and micro-batch that is given the bucket's state along with its rows. With 16,384 buckets a bulk load
costs that many calls at most; a small micro-batch reads and writes the buckets it falls into. It is on no default path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.cdc import CHANGE_TYPE, DELETE, INSERT, POSTIMAGE, PREIMAGE, version_order
from tidemark.sources.landing import STORED_AS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: How RocksDB stores states, and their value: rows as text, which zstd makes smaller than the default. Files of either kind can be read.
COMPRESSION, SMALL = "spark.sql.streaming.stateStore.rocksdb.compression", "zstd"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How rows are written into the state: whole microseconds, so that they come back as they were.
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: State of a bucket: its keys, the last change of each (its place in the order of versions, then the row) and when a deletion is forgotten.
_KEPT = "keys array<string>, said array<string>, until array<bigint>"
#: Hash buckets of keys that have their state, and their call of Python, in common; a checkpoint is tied to this number.
BUCKETS = 1 << 14
#: In the text of an order: where the flag of deletions stands, and the length of the whole.
_GONE, _ORDER = 26, 47


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State stores started inside are RocksDB's, compressed by zstd unless the session says how."""
    before = {name: spark.conf.get(name, None) for name in (PROVIDER, COMPRESSION)}
    spark.conf.set(PROVIDER, ROCKSDB)
    spark.conf.set(COMPRESSION, before[COMPRESSION] or SMALL)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _latest_changes(forget_after: int | None) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Keeps the last change of every key of a bucket: a living row for good, a deleted one for ``forget_after`` milliseconds.

    While a deletion is remembered, older changes of its key cannot revive it.
    """

    def step(bucket: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs() if forget_after else 0
        held = {k: (said, until) for k, said, until in zip(*state.get, strict=True) if until is None or until > now} if state.exists else {}
        latest: dict[str, str] = {}
        if not state.hasTimedOut:
            for part in parts:
                for key, said in zip(part["s_key"].tolist(), part["s_said"].tolist(), strict=True):
                    if key not in latest or said > latest[key]:
                        latest[key] = said
        events = []
        for key, said in latest.items():
            before = held[key][0] if key in held else None
            if before is not None and said[:_ORDER] <= before[:_ORDER]:
                continue
            gone, lived = said[_GONE] == "1", before is not None and before[_GONE] == "0"
            held[key] = (said, now + forget_after if gone and forget_after else None)
            if gone:
                events += [(DELETE, before[_ORDER:])] if lived else []
            else:
                events += [(PREIMAGE, before[_ORDER:]), (POSTIMAGE, said[_ORDER:])] if lived else [(INSERT, said[_ORDER:])]
        if held:
            state.update((list(held), [said for said, _ in held.values()], [until for _, until in held.values()]))
            ends = [until for _, until in held.values() if until is not None]
            if ends:
                state.setTimeoutDuration(min(ends) - now)
        elif state.exists:
            state.remove()
        if events:
            yield pd.DataFrame(events, columns=["kind", "row"])

    return step


def settled(changes: DataFrame, keys: Sequence[str], sequence: Column, is_delete: Column, forget_after: int | None = None) -> DataFrame:
    """The change feed, pre-images included, that a stream of change rows makes of the state per key.

    A change counts if it is later than what the state has, whatever the order of arrival, as in
    :func:`tidemark.operators.cdc.scd1_apply`; a sequence is a timestamp. Rows whose key is not whole are left out.
    """
    fields = [f for f in changes.schema.fields]
    order = F.struct(*version_order(changes, sequence, is_delete))
    row = F.to_json(F.struct(*[f.name for f in fields]), _JSON)
    at = F.rpad(F.coalesce(F.date_format("_o.sequence", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("")), _GONE, " ")
    digest = F.col("_o.digest").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    # One text that sorts as the order does, all of its parts of fixed width, followed by the row.
    said = F.concat(at, F.col("_o.deleted").cast("int").cast("string"), F.lpad(digest.cast("string"), _ORDER - _GONE - 1, "0"), "_row")
    packed = changes.withColumns({"_o": order, "_row": row}).dropna(subset=list(keys))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("s_bucket")
    packed = packed.select(bucket, F.to_json(F.struct(*keys), _JSON).alias("s_key"), said.alias("s_said"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if forget_after else GroupStateTimeout.NoTimeout
    events = packed.groupBy("s_bucket").applyInPandasWithState(_latest_changes(forget_after), "kind string, row string", _KEPT, "update", timeout)
    return events.select(F.from_json("row", T.StructType(fields), _JSON).alias("r"), F.col("kind").alias(CHANGE_TYPE)).select("r.*", CHANGE_TYPE)


def settle(
    changes: DataFrame, keys: Sequence[str], sequence: Column, is_delete: Column, path: str, checkpoint: str, forget_after: int | None = None
) -> StreamingQuery:
    """Run :func:`settled` over what is available, its feed written to ``path`` by micro-batch; a repeated micro-batch replaces its part."""

    def step(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").option("compression", STORED_AS).parquet(f"{path}/batch={batch_id}")

    with rocksdb(changes.sparkSession):
        feed = settled(changes, keys, sequence, is_delete, forget_after)
        writer = feed.writeStream.foreachBatch(step).outputMode("update").option("checkpointLocation", checkpoint)
        # State that expires asks for another micro-batch without end, so those streams take what there is as one.
        return (writer.trigger(once=True) if forget_after else writer.trigger(availableNow=True)).start()


def _held(spark: SparkSession, checkpoint: str, gone: bool, schema: T.StructType) -> DataFrame:
    state = spark.read.format("statestore").option("path", checkpoint).load().select(F.inline(F.arrays_zip("value.groupState.said", "value.groupState.until")))
    until = F.col("until")
    kept = state.filter((F.substring("said", _GONE + 1, 1) == str(int(gone))) & (until.isNull() | (until > F.unix_millis(F.current_timestamp()))))
    return kept.select(F.from_json(F.substr("said", F.lit(_ORDER + 1)), schema, _JSON).alias("r")).select("r.*")


def living_rows(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The current rows, read back from the state of a stopped or running stream."""
    return _held(spark, checkpoint, False, schema)


def remembered_deletions(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The deletions the state still remembers."""
    return _held(spark, checkpoint, True, schema)
