"""State held by the stream against the batch reduction, for changes in any order."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set
from tidemark.operators.cdc import scd1_apply
from tidemark.streaming import keyed_state
from tidemark.streaming.keyed_state import living_rows, remembered_deletions, settle

SCHEMA = "k string, n int, at timestamp_ntz, OP string, v double, note string"


def gone():
    return F.col("OP") == "D"


@pytest.fixture
def deliver(spark, tmp_path):
    """Writes rows as one file and lets the stream settle what is new."""
    sent = []

    def run(rows, forget_after=None):
        df = spark.createDataFrame(rows, "k string, n int, at string, OP string, v double, note string").withColumn("at", F.col("at").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        sent.extend(rows)
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        settle(stream, ["k", "n"], F.col("at"), gone(), str(tmp_path / "feed"), str(tmp_path / "cp"), forget_after).awaitTermination()
        return df

    run.sent, run.cp, run.feed = sent, str(tmp_path / "cp"), str(tmp_path / "feed")
    return run


def test_state_equals_the_batch_for_shuffled_arrivals(spark, deliver):
    rng = random.Random(4)
    rows = [
        (f"k{rng.randrange(9)}", rng.randrange(2), f"2020-01-01 00:00:{s % 60:02d}.{s:06d}", rng.choice("IUUD"), rng.choice([None, 0.1, -1e9]), rng.choice([None, "é \n\"x\""]))
        for s in range(120)
    ]
    rng.shuffle(rows)
    rows.append((None, 1, "2020-01-01 00:00:00", "I", 1.0, None))
    for part in (rows[:50], rows[50:80], rows[80:]):
        deliver(part)
    all_rows = spark.createDataFrame(rows, "k string, n int, at string, OP string, v double, note string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    batch = scd1_apply(all_rows.dropna(subset=["k", "n"]), ["k", "n"], F.col("at"), gone())
    columns = batch.columns
    assert as_set(living_rows(spark, deliver.cp, batch.schema), *columns) == as_set(batch, *columns) != set()
    feed = spark.read.parquet(deliver.feed)
    weight = F.when(F.col("_change_type").isin("insert", "update_postimage"), 1).otherwise(-1)
    left = feed.groupBy(*columns).agg(F.sum(weight).alias("w")).filter("w <> 0")
    assert as_set(left, *columns) == as_set(batch, *columns) and left.filter("w <> 1").count() == 0


def test_a_deletion_is_remembered_until_it_expires(spark, deliver):
    schema = deliver([("a", 1, "2020-01-01 00:00:05", "D", None, None)], 15_000).schema
    deliver([("a", 1, "2020-01-01 00:00:01", "U", 1.0, "late")], 15_000)
    assert living_rows(spark, deliver.cp, schema).count() == 0
    assert as_set(remembered_deletions(spark, deliver.cp, schema), "k") == {("a",)}
    time.sleep(16)
    deliver([("a", 1, "2020-01-01 00:00:02", "U", 2.0, "later"), ("b", 1, "2020-01-01 00:00:02", "I", 2.0, None)], 15_000)
    assert as_set(living_rows(spark, deliver.cp, schema), "k", "v") == {("a", 2.0), ("b", 2.0)}


def test_keys_of_a_bucket_share_a_call_and_stay_apart(spark, deliver, monkeypatch):
    monkeypatch.setattr(keyed_state, "BUCKETS", 4)
    rows = [(f"k{i}", i % 2, "2020-01-01 00:00:05", "I", float(i), None) for i in range(100)]
    schema = deliver(rows).schema
    deliver([(f"k{i}", i % 2, f"2020-01-01 00:00:0{3 + i % 4}", "DU"[i % 4 == 3], -1.0, None) for i in range(100)])
    assert spark.read.format("statestore").option("path", deliver.cp).load().count() <= 4
    want = {(f"k{i}", -1.0 if i % 4 == 3 else float(i)) for i in range(100) if i % 4 != 2}
    assert as_set(living_rows(spark, deliver.cp, schema), "k", "v") == want
    assert as_set(remembered_deletions(spark, deliver.cp, schema), "k") == {(f"k{i}",) for i in range(100) if i % 4 == 2}


def test_states_are_stored_compressed_unless_the_session_says_how(spark):
    names = (keyed_state.PROVIDER, keyed_state.COMPRESSION)
    before = [spark.conf.get(n, None) for n in names]
    with keyed_state.rocksdb(spark):
        assert [spark.conf.get(n) for n in names] == [keyed_state.ROCKSDB, "zstd"]
    assert [spark.conf.get(n, None) for n in names] == before
    spark.conf.set(keyed_state.COMPRESSION, "lz4")
    try:
        with keyed_state.rocksdb(spark):
            assert spark.conf.get(keyed_state.COMPRESSION) == "lz4"
        assert spark.conf.get(keyed_state.COMPRESSION) == "lz4"
    finally:
        spark.conf.unset(keyed_state.COMPRESSION)
