"""Every stage against a plain version of it, on the rows that reached it."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm.brute import HARD, documents, lower, similar
from tidemark.llm import toxicity
from tidemark.llm.store import read, stored


@pytest.fixture(scope="module")
def passed(spark):
    sf = "/root/testdata/sf0.01"
    docs = read(spark, sf, "documents")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = stored(stage(spark, docs, sf), "test-stage")
    return inputs | {"result": docs}


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_return_the_columns_of_documents(passed):
    columns = passed["toxicity"].columns
    assert all(df.columns == columns for name, df in passed.items() if name != "result")


def test_toxic_rows_go(spark, passed):
    model = toxicity.fit(passed["toxicity"], read(spark, "/root/testdata/sf0.01", "labels")).scorer()
    rows = passed["toxicity"].select("doc_id", "text").collect()
    assert ids(passed["exact_dedup"]) == {r.doc_id for r in rows if model.score(r.text) < 0.5} != {r.doc_id for r in rows}


def test_the_smallest_id_of_equal_texts_stays(passed):
    first = {}
    for r in passed["exact_dedup"].select("doc_id", "text").collect():
        first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    assert ids(passed["jaccard_join"]) == set(first.values())


def test_one_of_similar_texts_stays(passed):
    found = similar([(r.doc_id, r.text) for r in passed["jaccard_join"].select("doc_id", "text").collect()])
    assert ids(passed["decontamination"]) == {i for i, (_, c) in found.items() if i == c} != set(found)


def test_contaminated_rows_go(spark, passed):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = set()
    for r in read(spark, "/root/testdata/sf0.01", "benchmark").collect():
        w = find(lower(r.text))
        windows |= {tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12))} if w else set()
    clean = set()
    for r in passed["decontamination"].select("doc_id", "text").collect():
        w = find(lower(r.text))
        hit = {p for m in {len(x) for x in windows} for k in range(len(w) - m + 1) if tuple(w[k : k + m]) in windows for p in range(k, k + m)}
        if not hit or 20 * len(hit) < len(w):
            clean.add(r.doc_id)
    assert ids(passed["packing"]) == clean


def test_all_that_is_left_is_packed(passed):
    assert ids(passed["result"]) == ids(passed["packing"])
    lengths, totals = defaultdict(int), {}
    for r in passed["result"].collect():
        lengths[r.doc_id] += r.length
        totals[r.doc_id] = r.doc_tokens
    assert lengths == totals


SF = "/root/testdata/sf0.001"


def test_stages_take_hard_rows_with_clashing_columns(spark):
    """Nulls, repeated ids and rows, ties, very long texts and columns named like computed ones, through every stage in turn."""
    docs = documents(spark, [*HARD, (11, "x y z"), (12, None), (12, None)])
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), f"hard-{name}")
        assert docs.columns == columns
        kept.append(sorted(((r.doc_id, (r.text or "")[:20]) for r in docs.select("doc_id", "text").collect()), key=repr))
    toxic, exact, near, clean = kept
    assert len(toxic) == len(HARD) + 3
    assert len([t for _, t in exact if not t]) == 1 and (1, "") in exact
    assert exact.count((8, "twice the same row, ")) == 1 and {t for i, t in exact if i == 9} == {"one id", "two texts"}
    assert near == clean == [r for r in exact if r[0] != 5]  # the words of 4, written otherwise
    packed = corpus_pipeline.pack(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in clean} and all(r.offset + r.length <= 4096 for r in packed)


def test_stages_take_an_empty_table(spark):
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert found.count() == 0
        assert name == "packing" or found.columns == docs.columns
