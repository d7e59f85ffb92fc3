"""Layouts that let a filter on any of several columns skip files."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources.files import file_ranges, write_clustered
from tidemark.session import READ_AT_ONCE, small_reads
from tidemark.sources.layout import interleaved, ranked, share_read, write_interleaved


@pytest.fixture
def points(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(10**9), f"c{rng.randrange(1000):04d}", float(int(rng.paretovariate(0.5))), None if i % 50 == 0 else rng.random()) for i in range(20_000)]
    return spark.createDataFrame(rows, "a long, b string, skewed double, c double")


def shares(spark, path, *columns):
    return {c: share_read(spark, path, c).first().share for c in columns}


def test_every_column_skips_files(spark, points, tmp_path):
    write_interleaved(points, str(tmp_path / "z"), ["a", "b"], 16)
    write_clustered(points, str(tmp_path / "s"), ["a", "b"], 16)
    z, s = shares(spark, str(tmp_path / "z"), "a", "b"), shares(spark, str(tmp_path / "s"), "a", "b")
    assert max(z.values()) < 1 / 3
    assert s["a"] < 0.15 and s["b"] > 0.8
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.columns == points.columns and back.exceptAll(points).count() == 0 == points.exceptAll(back).count()


def test_three_columns_with_skew_and_nulls(spark, points, tmp_path):
    write_interleaved(points, str(tmp_path / "z"), ["a", "skewed", "c"], 64)
    found = shares(spark, str(tmp_path / "z"), "a", "c")
    assert max(found.values()) < 0.5
    assert spark.read.parquet(str(tmp_path / "z")).count() == 20_000


def test_share_read_counts_the_files_that_hold_a_value(spark, points, tmp_path):
    path = str(tmp_path / "t")
    write_interleaved(points, path, ["a", "b"], 9)
    ranges = [tuple(r) for r in file_ranges(spark, path, "b").select("low", "high", "rows").collect()]
    n = sum(r for _, _, r in ranges)
    want = sum(rows * sum(lo <= low <= hi for lo, hi, _ in ranges) for low, _, rows in ranges) / n / len(ranges)
    assert share_read(spark, path, "b").first().share == pytest.approx(want)


def test_ranks_are_even_and_ordered(spark, points):
    df = ranked(points, ["a", "b", "skewed"], 4)
    for i, c in enumerate(("a", "b")):
        steps = {r[0]: r[1] for r in df.groupBy(f"_r{i}").count().collect()}
        assert set(steps) == set(range(16)) and max(steps.values()) < 2 * min(steps.values())
        edges = df.groupBy(f"_r{i}").agg(F.min(c).alias("lo"), F.max(c).alias("hi")).orderBy(f"_r{i}").collect()
        assert all(x.hi <= y.lo for x, y in zip(edges, edges[1:]))
    assert df.filter("skewed = 1.0").select("_r2").distinct().count() == 1


def test_bits_are_interleaved(spark):
    got = spark.createDataFrame([(5, 3)], "x int, y int").select(interleaved([F.col("x"), F.col("y")], 3)).first()[0]
    assert got == int("100111", 2)


def test_an_empty_table(spark, tmp_path):
    write_interleaved(spark.createDataFrame([], "a long, b string"), str(tmp_path / "e"), ["a", "b"])
    assert spark.read.schema("a long, b string").parquet(str(tmp_path / "e")).count() == 0


def test_wide_rows_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def wide(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    points = spark.range(500).selectExpr("id a", "id % 7 b", "string(id) note")
    write_interleaved(points.mapInArrow(wide, points.schema), str(tmp_path / "z"), ["a", "b"], 4)
    assert seen.value == 2 * 500  # once for the stored columns, once for the files
    assert spark.read.parquet(str(tmp_path / "z")).count() == 500


def test_small_reads_keep_a_setting(spark, tmp_path):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    small_reads(spark)
    assert spark.conf.get(name) == READ_AT_ONCE
    spark.conf.set(name, "5m")
    small_reads(spark)
    assert spark.conf.get(name) == "5m"
    spark.conf.unset(name) if before is None else spark.conf.set(name, before)
