import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import HARD, documents, similar
from tidemark.llm import exact_dedup, jaccard_join
from tidemark.llm.linking import components, connect


def words(n, seed):
    r = random.Random(seed)
    return [r.choice("abcdefghij") + str(k) for k in range(n)]


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups(spark, keep):
    rows = [*HARD, (20, "one id"), (21, "one id"), (22, "One id")]
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = min if keep == "min" else max
    expected = Counter()
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        stays = best(ids) if ids else None
        expected[(i, stays, len(groups[t or ""]), i == stays, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    df = documents(spark, rows)
    assert Counter(tuple(r) for r in exact_dedup.copy_groups(df, keep).collect()) == expected
    kept = exact_dedup.without_copies(df, keep)
    assert kept.columns == df.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter(dict.fromkeys(groups, 1))
    assert exact_dedup.copy_groups(df.limit(0)).count() == exact_dedup.without_copies(df.limit(0)).count() == 0


def test_exact_dedup_runs_no_python(spark):
    for df in (exact_dedup.copy_groups(documents(spark, HARD[:0])), exact_dedup.without_copies(documents(spark, HARD[:0]))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text


def edited(n, base, seed, first=100):
    """Copies of a text with a few words changed, cut or left alone."""
    r, out = random.Random(seed), []
    for i in range(n):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 2, 3, 4])):
            w[r.randrange(len(w))] = f"z{r.randrange(10**6) if r.random() < 0.6 else r.randrange(4)}"
        out.append((first + i, " ".join(w[: r.randrange(40, len(w))] if r.random() < 0.3 else w)))
    return out


def test_similar_documents_equal_brute_force(spark):
    rows = [(i, t) for i, t in HARD if i is not None and i not in (8, 9)] + edited(150, words(60, 1), 2) + edited(30, words(200, 3), 4, 500)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_documents(documents(spark, rows)).collect()}
    assert got == similar(rows)


def test_similar_documents_of_hard_rows(spark):
    """Rows without an id link too, but never name a group; rows of one id are one document."""
    text = "the same words in the same order make one set of shingles"
    df = documents(spark, [*HARD, (None, text), (30, text), (31, text)])
    got = Counter(tuple(r) for r in jaccard_join.similar_documents(df).collect())
    assert got[(None, 8, 30)] == 1 and got[(30, 8, 30)] == 1 and got[(31, 8, 30)] == 1
    assert got[(8, 3, 8)] == 2 and got[(4, 1, 4)] == 1 and got[(5, 1, 4)] == 1 and got[(1, 0, 1)] == 1
    assert sum(got.values()) == len(HARD) + 3
    assert jaccard_join.similar_documents(df.limit(0)).count() == 0


def test_one_of_each_keeps_columns_and_singles(spark):
    rows = edited(40, words(60, 5), 6) + [(1, None), (2, ""), (3, "alone")]
    df, found = documents(spark, rows), similar(rows)
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in found.items() if i == c}


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(61)}


def test_a_bucket_is_not_compared_pair_by_pair(spark):
    """600 items around one pivot: the pairs that are looked at stay near the number of items."""
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs

    members = spark.range(600).select(F.lit(1).alias("bucket"), F.col("id").alias("gid"), F.lit(1).alias("size"), F.col("id").alias("rank"))
    roots = connect(members, verify, rank=("rank",))
    assert {tuple(r) for r in roots.collect()} == {(i, 0) for i in range(600)}
    assert sum(seen) == 599


def test_bitmaps_lose_nothing(spark):
    import numpy as np

    from tidemark.llm.store import bitmap

    df = spark.range(2000).select(F.xxhash64("id").alias("h"))
    bits = bitmap(df, "h", 2000).value
    known = np.array([r.h for r in df.collect()], np.int64).view(np.uint64)
    others = np.array([r.h for r in spark.range(5000, 25000).select(F.xxhash64("id").alias("h")).collect()], np.int64).view(np.uint64)
    assert bits.has(known).all() and bits.has(others).mean() < 0.02


def test_one_id_with_two_texts_keeps_the_text_that_is_alone(spark):
    base = [f"word{k}" for k in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(base + ["more"])), (2, "a text that exists nowhere else at all")]
    kept = jaccard_join.one_of_each(documents(spark, rows))
    assert {(r.doc_id, r.text) for r in kept.collect()} == {rows[0], rows[2]}
