import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set
from tidemark.sources.keyed import KeyedTable

SCHEMA = "k int, seq int, OP string, v string"


def gone():
    return F.col("OP") == "D"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), ["k"])


def merge(table, *rows, schema=SCHEMA, **kwargs):
    return table.merge(table.spark.createDataFrame(rows, schema), F.col("seq"), gone(), **kwargs)


def test_versions_and_feed(table):
    merge(table, (1, 1, "I", "a"), (2, 1, "I", "b"))
    merge(table, (1, 2, "U", "c"), (2, 3, "D", None), (3, 1, "I", "d"))
    assert as_set(table.read(1), "k", "v") == {(1, "a"), (2, "b")}
    assert as_set(table.read(), "k", "v") == {(1, "c"), (3, "d")}
    feed = table.read_changes(2, preimages=True)
    assert as_set(feed, "_change_type", "_commit_version", "k", "v") == {
        ("update_preimage", 2, 1, "a"),
        ("update_postimage", 2, 1, "c"),
        ("delete", 2, 2, "b"),
        ("insert", 2, 3, "d"),
    }


def test_deleted_keys_stay_deleted_until_a_later_insert(table):
    merge(table, (1, 5, "D", None))
    merge(table, (1, 3, "U", "late"))
    assert table.read().count() == 0
    assert table.read_changes(1).count() == 0
    merge(table, (1, 6, "I", "back"))
    assert as_set(table.read(), "v") == {("back",)}
    assert as_set(table.read_changes(3), "_change_type") == {("insert",)}


def test_a_batch_is_applied_once(table):
    assert merge(table, (1, 1, "I", "a"), batch="s-0") == 1
    assert merge(table, (1, 2, "U", "b"), batch="s-0") == 1
    assert as_set(table.read(), "v") == {("b",)} and table.read_changes(1).count() == 1
    assert merge(table, (1, 3, "U", "c"), batch="other-0") == 2
    assert as_set(table.read(), "v") == {("c",)}


def test_an_empty_batch_keeps_the_table(table):
    merge(table, (1, 1, "I", "a"))
    empty = table.spark.createDataFrame([], SCHEMA)
    table.merge(empty, F.col("seq"), gone(), "s-4")
    assert as_set(table.read(), "v") == {("a",)} and table.latest_version() == 2


def test_repeated_rows_leave_no_trace_in_the_feed(table):
    merge(table, (1, 1, "I", "a"))
    merge(table, (1, 1, "I", "a"))
    assert table.read_changes(2).count() == 0


def test_new_columns_appear_and_old_rows_lack_them(table):
    merge(table, (1, 1, "I", "a"))
    merge(table, (2, 1, "I", "b", 7), schema=SCHEMA + ", extra int")
    merge(table, (3, 1, "I", "c"))
    assert as_set(table.read(), "k", "v", "extra") == {(1, "a", None), (2, "b", 7), (3, "c", None)}


def test_compaction_and_rollback(table):
    merge(table, (1, 1, "I", "a"), (2, 1, "D", None), (4, 9, "D", None))
    merge(table, (1, 2, "U", "b"))
    table.compact(forget_before=F.lit(5))
    assert as_set(table.read(), "v") == {("b",)}
    assert table.read_changes(3).count() == 0
    merge(table, (2, 0, "U", "forgotten"), (4, 0, "U", "still gone"))
    assert as_set(table.read(), "k") == {(1,), (2,)}
    table.rollback(1)
    assert as_set(table.read(), "v") == {("a",)}
    assert table.read(2).count() == 1
    table.clean()
    assert as_set(table.read(), "v") == {("a",)}
    with pytest.raises(ValueError):
        table.read(2)


def test_a_merge_writes_its_own_rows_only(spark, table):
    table.merge(spark.range(20_000).selectExpr("int(id) k", "1 seq", "'I' OP", "'a' v"), F.col("seq"), gone())
    table.merge(spark.range(200).selectExpr("int(id * 97) k", "2 seq", "'U' OP", "'b' v"), F.col("seq"), gone())
    assert spark.read.parquet(f"{table.path}/changes/_v=2").count() == 200
    assert table.read().filter("v = 'b'").count() == 200 and table.read().count() == 20_000
    assert not table.upkeep(share=10) or table.latest_version() == 2
    assert table.read().count() == 20_000


def test_rows_without_key_are_left_out(table):
    merge(table, (None, 1, "I", "a"), (1, 1, "I", "b"))
    assert as_set(table.read(), "v") == {("b",)}


def test_feed_as_a_stream(table, tmp_path):
    merge(table, (1, 1, "I", "a"), (2, 1, "I", "b"))
    merge(table, (1, 2, "U", "c"))

    def run():
        query = (
            table.change_stream()
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "cp"))
            .option("path", str(tmp_path / "out"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return as_set(table.spark.read.parquet(str(tmp_path / "out")), "_change_type", "k", "v")

    first = run()
    assert first == {("update_postimage", 1, "a"), ("update_postimage", 2, "b"), ("update_postimage", 1, "c")}
    merge(table, (2, 4, "D", None))
    assert run() - first == {("delete", 2, None)}


def test_reading_nothing(table):
    with pytest.raises(ValueError):
        table.read()


def test_reduced_rows_are_written_without_comparing_them(table, monkeypatch):
    merge(table, (1, 1, "I", "a"), (1, 2, "U", "b"))
    with monkeypatch.context() as patched:
        patched.setattr("tidemark.sources.keyed.latest_by_key", lambda *_: pytest.fail("reduced"))
        merge(table, (1, 1, "U", "late"), (2, 3, "I", "c"), (None, 4, "I", "no key"), reduced=True)
    assert as_set(table.read(), "k", "v") == {(1, "b"), (2, "c")}
    assert [f.name for f in table.read_all().schema["_order"].dataType] == ["sequence", "deleted", "digest"]


def test_a_version_can_be_read_while_its_folders_are_there(table):
    assert not table.can_read(0) and not table.can_read(1)
    for k in range(3):
        merge(table, (k, 1, "I", "a"))
    assert table.can_read(1) and table.can_read(3) and not table.can_read(4)
    table.compact(version=2)
    assert table.can_read(3) and not table.can_read(1)
    table.clean()
    assert table.can_read(2) and not table.can_read(1)
