import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set, ts
from tidemark.entities import COMMIT_TS
from tidemark.operators import changelog
from tidemark.operators.profiling import describe, null_counts, uniqueness, value_counts
from tidemark.operators.ranking import carts, numbered, quantiles, running_sum


def test_numbers_match_a_plain_window_with_one_hot_group(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(20)}", rng.randrange(50), i) for i in range(4000)]
    data += [(None, 1, 5000), (None, None, 5001)]
    df = spark.createDataFrame(data, "g string, at int, id int")
    got = as_set(numbered(df, ["at", "id"], ["g"], "n"), "id", "n")
    groups = {}
    for g, at, i in data:
        groups.setdefault(g, []).append((at is not None, at or 0, i))
    want = {(i, n) for rows in groups.values() for n, (_, _, i) in enumerate(sorted(rows), 1)}
    assert got == want


def test_numbers_spread_a_single_group_over_tasks(spark):
    df = spark.range(0, 50_000, 1, 8).selectExpr("id", "'hot' as g")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, False)
    try:
        ranked = numbered(df, ["id"], ["g"])
    finally:
        spark.conf.set(merging, True)
    assert ranked.filter("row_number <> id + 1").count() == 0
    assert ranked.select(F.spark_partition_id()).distinct().count() > 4


def test_running_sum(spark):
    df = spark.range(1, 1001).select((F.col("id") * 3).alias("k"), F.col("id").alias("x"))
    got = running_sum(df, "k", "x")
    assert got.filter("running_sum <> (k / 3) * (k / 3 + 1) / 2").count() == 0


def brute_force_carts(data):
    result, by_person = set(), {}
    for person, at, _ in data:
        if at is not None:
            by_person.setdefault(person, []).append(at)
    for person, times in by_person.items():
        times.sort()
        cart = [times[0]]
        for t in times[1:] + [None]:
            if t is not None and t - cart[-1] <= timedelta(seconds=1):
                cart.append(t)
            else:
                result.add((person, cart[0], cart[-1], len(cart)))
                cart = [t]
    return result


def test_carts_match_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2018, 1, 1, 0, 59, 50)
    data = []
    for i in range(3000):
        person = "hot" if rng.random() < 0.5 else f"u{rng.randrange(40)}"
        near_full_hours = timedelta(hours=rng.randrange(4), milliseconds=rng.randrange(0, 20_000, 100))
        data.append((person, start + near_full_hours if rng.random() > 0.01 else None, f"o{i}"))
    df = spark.createDataFrame(data, "who string, at timestamp_ntz, id string")
    got = carts(df, "who", "at", "id")
    assert as_set(got, "who", "cart_start", "cart_end", "orders") == brute_force_carts(data)


def test_one_second_apart_is_one_cart_and_more_is_not(spark):
    rows = [("u", ts("2018-01-01 00:00:00.500000"), "a"), ("u", ts("2018-01-01 00:00:01.500000"), "b")]
    rows += [("u", ts("2018-01-01 00:00:02.500001"), "c")]
    got = carts(spark.createDataFrame(rows, "who string, at timestamp_ntz, id string"), "who", "at", "id")
    assert sorted(r.orders for r in got.collect()) == [1, 2]


@pytest.mark.parametrize("n", [1, 2, 3, 101])
def test_quantiles_interpolate(spark, n):
    values = [float(v * v % 37) for v in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = quantiles(df, "x", (0.25, 0.5, 0.75)).first()
    exact = df.agg(*[F.percentile("x", p).alias(c) for p, c in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]).first()
    for c in ("p25", "p50", "p75"):
        assert got[c] == pytest.approx(exact[c])


def test_profile_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "x double")
    r = describe(df, "x").first()
    assert r["count"] == 0 and r["p50"] is None and r["mean"] is None
    u = uniqueness(df, "x").first()
    assert (u.distinct_values, u.row_count, u.unique_pct) == (0, 0, None)


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "s string, n int")
    assert as_set(null_counts(df), "column_name", "null_rows") == {("s", 1), ("n", 1)}
    assert [tuple(r) for r in value_counts(df, "s").collect()] == [("a", 2)]
    assert uniqueness(df, "s").first().distinct_values == 1
    assert uniqueness(df, "s", approximate=True).first().distinct_values == 1


def test_windows_are_half_open_and_bounded(spark):
    start = datetime(2018, 8, 6)
    times = ["2018-08-05 23:59:59", "2018-08-06 00:00:00", "2018-08-06 05:59:59", "2018-08-06 06:00:00"]
    times += ["2018-08-19 23:59:59", "2018-08-20 00:00:00"]
    df = spark.createDataFrame([(t, ts(t)) for t in times], f"id string, {COMMIT_TS} timestamp_ntz")
    got = {r.id: (r.window_index, r.window_start) for r in changelog.capture_windows(df, start).collect()}
    assert got == {
        times[1]: (0, start),
        times[2]: (0, start),
        times[3]: (1, datetime(2018, 8, 6, 6)),
        times[4]: (55, datetime(2018, 8, 19, 18)),
    }


def test_chunks_of_a_window(spark):
    start = datetime(2018, 8, 6)
    df = spark.range(250).selectExpr("concat('o', id) as id", "timestamp_ntz'2018-08-06 01:00:00' as " + COMMIT_TS)
    captured = changelog.capture_windows(df, start)
    chunks = changelog.chunk_rows(captured, ["id"]).groupBy("chunk_index").count()
    assert as_set(chunks, "chunk_index", "count") == {(1, 100), (2, 100), (3, 50)}
    manifest = changelog.chunk_manifest({"orders": captured, "items": captured.limit(3)})
    assert as_set(manifest, "chunk_index", "table_name", "rows") == {
        (1, "orders", 100),
        (2, "orders", 100),
        (3, "orders", 50),
        (1, "items", 3),
    }
    assert changelog.total_chunks({"orders": captured}).first().total_chunks == 3


def test_operations_of_captured_orders(spark):
    rows = [("D", "created"), ("I", "created"), ("I", "shipped"), (None, None)]
    df = spark.createDataFrame(rows, "OP string, order_status string")
    assert [r.OP for r in changelog.stamp_op(df, "orders").collect()] == ["D", "I", "U", "U"]
    assert [r.OP for r in changelog.stamp_op(df, "payments").collect()] == ["I"] * 4
