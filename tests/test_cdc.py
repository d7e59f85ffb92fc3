import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import as_set
from tidemark.operators.cdc import apply_feed, change_feed, inferred_members, resolve_members, scd1_apply
from tidemark.sources.keyed import KeyedTable

SCHEMA = "k int, seq int, OP string, v string"


def is_delete():
    return F.col("OP") == "D"


def expected(changes):
    best = {}
    for k, seq, op, v in changes:
        if k not in best or seq > best[k][0]:
            best[k] = (seq, op, v)
    return {(k, s, v) for k, (s, op, v) in best.items() if op != "D"}


changes_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.sampled_from("IUD"), st.sampled_from(["a", "b", None])), min_size=1, max_size=25
).map(lambda rows: [(k, i, op, v) for i, (k, op, v) in enumerate(rows)])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=changes_strategy, seed=st.integers(0, 99), cuts=st.integers(1, 3))
def test_state_does_not_depend_on_arrival(spark, tmp_path_factory, changes, seed, cuts):
    mixed = changes[:]
    random.Random(seed).shuffle(mixed)
    once = scd1_apply(spark.createDataFrame(mixed, SCHEMA), ["k"], F.col("seq"), is_delete())
    assert as_set(once, "k", "seq", "v") == expected(changes)
    table = KeyedTable(spark, str(tmp_path_factory.mktemp("t")), ["k"])
    for i in range(cuts):
        part = mixed[i::cuts]
        if part:
            table.merge(spark.createDataFrame(part, SCHEMA), F.col("seq"), is_delete())
    assert as_set(table.read(), "k", "seq", "v") == expected(changes)


def test_equal_sequences_resolve_the_same_way_in_any_order(spark):
    ties = [(1, 5, "I", "a"), (1, 5, "U", "b"), (2, 5, "D", None), (2, 5, "U", "x")]
    results = set()
    for order in (ties, ties[::-1]):
        df = spark.createDataFrame(order, SCHEMA).repartition(4)
        results.add(frozenset(as_set(scd1_apply(df, ["k"], F.col("seq"), is_delete()), "k", "v")))
    (only,) = results
    assert {k for k, _ in only} == {1}


def test_missing_sequence_is_the_oldest(spark):
    df = spark.createDataFrame([(1, None, "I", "old"), (1, 1, "U", "new")], SCHEMA)
    assert as_set(scd1_apply(df, ["k"], F.col("seq"), is_delete()), "v") == {("new",)}


def test_a_hot_key_shrinks_before_the_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 0, cast(id as int)) as k", "cast(id as int) as seq", "'U' as OP", "'v' as v"
    )
    state = scd1_apply(df, ["k"], F.col("seq"), is_delete())
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("hashpartitioning") < plan.index("Partial")
    assert state.filter("k = 0").first().seq == 199_998


def test_feed_leads_from_one_state_to_the_next(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "c"), (4, None)], "k int, v string")
    feed = change_feed(before, after, ["k"])
    assert as_set(feed, "_change_type", "k", "v") == {
        ("update_preimage", 2, "b"),
        ("update_postimage", 2, "c"),
        ("delete", 3, None),
        ("insert", 4, None),
    }
    assert as_set(apply_feed(before, feed, ["k"]), "k", "v") == as_set(after, "k", "v")


def test_placeholders_come_and_go(spark):
    facts = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    members = spark.createDataFrame([("a", "A")], "id string, name string")
    with_gaps = inferred_members(facts, members, "id", {"name": F.lit("?")})
    assert as_set(with_gaps, "id", "name", "_is_inferred") == {("a", "A", False), ("b", "?", True)}
    arrived = spark.createDataFrame([("b", "B")], "id string, name string")
    assert as_set(resolve_members(with_gaps, arrived, "id"), "id", "name", "_is_inferred") == {
        ("a", "A", False),
        ("b", "B", False),
    }
