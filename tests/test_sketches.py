"""Answers that start from sketches against plain ones."""

import math
import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches
from tidemark.operators.sketches import _long, _picked, daily_profile, distinct_estimates, distinct_sketches, drifting_days, exact_quantiles, merged, shared_estimate


def linear(values, p):
    at = p * (len(values) - 1)
    low, high = sorted(values)[math.floor(at)], sorted(values)[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize("n", [1, 2, 1000, 40_000])
def test_quantiles_are_exact_beyond_the_size_of_a_sketch(spark, n):
    rng = random.Random(n)
    rows = [(rng.gauss(0, 1), float(rng.randrange(3)), None if i % 3 else rng.random()) for i in range(n)] + [(None, float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probabilities = (0.0, 0.1, 0.5, 0.999, 1.0)
    got = {(r.column, r.probability): r.quantile for r in exact_quantiles(df, ["a", "b", "c"], probabilities, k=64 if n > 10_000 else 4096).collect()}
    for k, name in enumerate("abc"):
        values = [r[k] for r in rows if r[k] is not None and not math.isnan(r[k])]
        for p in probabilities:
            assert got[name, p] == pytest.approx(linear(values, p), rel=1e-12)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    monkeypatch.setattr(sketches, "RANK_ERROR", -0.2)
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    got = {(r.g, r.probability): r.quantile for r in exact_quantiles(df, ["v"], (0.25, 0.9), ["g"]).collect()}
    assert got == {(g, p): pytest.approx(linear(range(g, 5000, 2), p)) for g in (0, 1) for p in (0.25, 0.9)}


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), ["v"], (0.5,)).collect() == []


def verdicts(rows, days, band, null_band):
    by_day = {}
    for d, v in rows:
        by_day.setdefault(d, []).append(v)
    out = {}
    for d in by_day:
        before = [v for back in range(1, days + 1) for v in by_day.get(d - timedelta(back), [])]
        own, past = [v for v in by_day[d] if v is not None], [v for v in before if v is not None]
        m, p = statistics.median_low(own) if own else None, statistics.median_low(past) if past else None
        median = m is not None and p is not None and (m > p * (1 + band) or m < p * (1 - band))
        nulls = bool(before) and abs(1 - len(own) / len(by_day[d]) - (1 - len(past) / len(before))) > null_band
        out[d] = (median, nulls)
    return out


@pytest.mark.parametrize("k", [8, 4096])
def test_drifting_days_are_exact(spark, k, monkeypatch):
    """With a tiny sketch all doubtful days go through the exact count."""
    if k == 8:
        monkeypatch.setattr(sketches, "K", 8)
        monkeypatch.setattr(sketches, "RANK_ERROR", 0.45)
    rng, start = random.Random(2), date(2020, 1, 1)
    rows = []
    for i in range(40):
        level = 100 * (1.0 + 0.4 * (i in (12, 13, 30)) - 0.5 * (i == 21)) if i % 9 else None
        for _ in range(rng.randrange(0, 60)):
            rows.append((start + timedelta(i), None if level is None or rng.random() < 0.3 * (i == 17) else round(level * rng.uniform(0.7, 1.3), 1)))
    df = spark.createDataFrame(rows, "day date, v double")
    profiles = daily_profile(df.filter("v > 90 or v is null"), "day", "v", k).unionByName(daily_profile(df.filter("v <= 90"), "day", "v", k))
    got = {r.day: (r.median_drifts, r.nulls_drift) for r in drifting_days(df, profiles, "day", "v", 7, 0.25, 0.1).collect()}
    want = verdicts(rows, 7, 0.25, 0.1)
    assert got == want
    assert {True, False} == {m for m, _ in want.values()} == {z for _, z in want.values()}


def test_only_doubtful_days_are_read_again(spark, monkeypatch):
    asked, real = [], sketches._median_drifts
    monkeypatch.setattr(sketches, "_median_drifts", lambda df, doubtful, *a: asked.append(doubtful.count()) or real(df, doubtful, *a))
    df = spark.range(3000).select(F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 30).cast("int")).alias("day"), (F.col("id") % 100 + 100.0).alias("v"))
    drifting_days(df, daily_profile(df, "day", "v"), "day", "v").collect()
    assert asked == [0]


def test_profiles_add_up(spark):
    df = spark.range(1000).select(F.lit(date(2020, 1, 1)).alias("day"), F.when(F.col("id") % 4 > 0, F.col("id") * 1.0).alias("v"))
    halves = [df.filter(c) for c in ("v < 300", "v >= 300 or v is null")]
    parts = daily_profile(halves[0], "day", "v").unionByName(daily_profile(halves[1], "day", "v"))
    one = merged(parts, "day").select("rows", "nulls", F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)), F.hll_sketch_estimate("distinct")).first()
    assert one[:2] == (1000, 250) and one[2] == 499.0 and abs(one[3] - 750) < 20


def test_distinct_sketches_merge_and_intersect(spark):
    df = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 5000).alias("who"), (F.col("id") % 7).alias("what"))
    stored = distinct_sketches(df, ("month",), {"people": "who", "things": "what"})
    assert distinct_estimates(stored, ["things"]).first().things == 7
    whole = distinct_estimates(stored, ["people"]).first().people
    assert abs(whole - 5000) < 250
    by = {r.month: r.people for r in distinct_estimates(stored, ["people"], ["month"]).collect()}
    exact = {r.month: r.n for r in df.groupBy("month").agg(F.count_distinct("who").alias("n")).collect()}
    assert all(abs(by[m] - exact[m]) <= 0.05 * exact[m] for m in exact)
    shared = shared_estimate(stored, "people", F.col("month") < 3, F.col("month") >= 3).first().shared
    real = df.filter("month < 3").select("who").intersect(df.filter("month >= 3").select("who")).count()
    assert abs(shared - real) <= 0.06 * 5000


def test_values_of_a_column_are_not_gathered_in_one_task(spark, capfd):
    df = spark.range(20_000).selectExpr("id % 701 a", "id b")
    exact_quantiles(df, ["a", "b"], (0.25, 0.5)).collect()  # verified brackets are kept: nothing is planned over the values any more
    values = _long(df, ["a", "b"], ())
    wanted = values.groupBy("column").agg(F.count(F.lit(1)).alias("n")).selectExpr("column", "0.5D probability", "0L low", "0L high", "n", "-1D a", "1D b").checkpoint()
    capfd.readouterr()
    _picked(values, wanted, ["column"], ()).explain()
    assert "BroadcastHashJoin" in capfd.readouterr().out
