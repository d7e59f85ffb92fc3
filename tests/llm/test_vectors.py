"""Hard negatives and centroid clusters against plain Python on whole numbers, and the rows they must survive."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids, hard_negatives
from tidemark.llm.queries import op11_hard_negatives, op12_centroid_clusters
from tidemark.llm.store import read

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, cluster int, distance long, norm double, piece int"


def vectors(spark, rows):
    """Vectors from (vec_id, embedding, label) with columns that share names with what operators compute."""
    return spark.createDataFrame([(*r, 1, "v", 2, 3, 0.5, 4) for r in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return tuple(math.floor(256 * x) for x in np.float32(v).astype(float)) if len(v) else ()


def mine(rows, anchor, positives=5, negatives=5):
    known = sorted({(i, whole(v), y) for i, v, y in rows if i is not None and y is not None and usable(v)})
    out = []
    for a in known:
        if not anchor(a[0]):
            continue
        scored = sorted((-sum(p * q for p, q in zip(a[1], x[1], strict=False)), x[0], x[2]) for x in known if x[0] != a[0])
        for s, p, _ in [r for r in scored if r[2] == a[2]][:positives]:
            hard = [r for r in scored if r[2] != a[2] and 80 * -s <= 100 * -r[0] <= 100 * -s][:negatives]
            out += [(a[0], p, k, n, -s, -t) for k, (t, n, _) in enumerate(hard, 1)]
    return sorted(out)


def close(rng, n, labels=4, size=8, spread=0.3):
    """Vectors around a few directions, so that scores are high and tie."""
    middles = [[rng.uniform(-1, 1) for _ in range(size)] for _ in range(6)]
    return [(i, [x + rng.uniform(-spread, spread) for x in rng.choice(middles)], rng.randrange(labels)) for i in range(n)]


HARD_ROWS = [
    (1000, None, 1),
    (1010, [1.0, None, 2.0], 1),
    (1020, [float("nan"), 1.0], 1),
    (1030, [float("inf")], 1),
    (1040, [], 1),
    (1050, [0.0] * 8, 2),
    (1060, [1.0, 1.0], 2),
    (1060, [1.0, 1.0], 2),
    (1070, [1.0, 1.0], 1),
    (1070, [1.0, 1.0], 2),
    (1080, [1.0, 1.0], None),
    (None, [1.0] * 8, 1),
    (1090, [1.0] * 70, 0),
]


def mined(spark, rows, every=10, **settings):
    return sorted(map(tuple, hard_negatives.mined(vectors(spark, rows), F.col("vec_id") % every == 0, **settings).collect()))


@pytest.mark.parametrize("piece", [16, 4096])
def test_mined_rows_equal_brute_force(spark, piece):
    rows = close(random.Random(3), 400) + HARD_ROWS
    got = mined(spark, rows, piece=piece)
    assert got == mine(rows, lambda i: i % 10 == 0) != []


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 0.5, -0.25], i % 3) for i in range(120)] + [(i, [0.5, 0.25, 0.0], 1) for i in range(120, 130)]
    assert mined(spark, rows, piece=16) == mine(rows, lambda i: i % 10 == 0) != []


def test_tight_clusters_stop_early(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "MEMBERS", 4)
    rng = random.Random(5)
    rows = [(i, [*(10.0 * (j == i % 6) + rng.uniform(-0.2, 0.2) for j in range(6))], rng.randrange(3)) for i in range(1200)]
    met, real = [], hard_negatives.stored
    monkeypatch.setattr(hard_negatives, "stored", lambda df, name: met.append(name) or real(df, name))
    got = mined(spark, rows, every=25, piece=16)
    assert got == mine(rows, lambda i: i % 25 == 0) != []
    assert met.count("found") <= 6  # a list of 75 pieces takes four rounds to its end, and there are two walks


def test_no_anchor_no_row(spark):
    assert mined(spark, []) == [] == mined(spark, [(1, [1.0], 0)])
    assert mined(spark, [(10, [1.0], 0)]) == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    rows, members = rng.integers(-300, 300, (500, 16)), rng.integers(-300, 300, (40, 16))
    direction = hard_negatives.centres(members.astype(float), 1)
    norms = np.linalg.norm(rows, axis=1)
    at = np.arccos(np.clip(rows @ direction[0] / norms, -1, 1))
    widest = max(np.arccos(np.clip(m @ direction[0] / np.linalg.norm(m), -1, 1)) for m in members)
    bound = norms * np.cos(np.maximum(0, at - widest - hard_negatives.SLACK))
    assert (members @ rows.T <= np.linalg.norm(members, axis=1)[:, None] * bound + hard_negatives.SLACK).all()


def test_large_products_stay_exact(spark):
    top = float(2**21)
    rows = [(i, [top + i, top, 1.0 * (i % 3)], i % 2) for i in range(0, 40)]
    assert mined(spark, rows) == mine(rows, lambda i: i % 10 == 0) != []
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(10, [1e20], 0), (11, [1.0], 0)])


def cluster(rows, k, rounds, size, seed):
    kept = [(i, whole(v)) for i, v, _ in rows if usable(v) and len(v) == size]
    hashed = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    middle = [list(v) for _, v in hashed[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        owner = [nearest(v)[1] for _, v in kept]
        for n in range(len(middle)):
            own = [v for (_, v), o in zip(kept, owner, strict=True) if o == n]
            if own:
                middle[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {n: sum(d for _, o, d in found if o == n) for n in range(len(middle))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, o, d, inertia[o], sum(inertia.values()), digest[o]) for i, o, d in found), key=repr)


@pytest.mark.parametrize("k", [1, 5, 40])
def test_clusters_equal_brute_force(spark, k):
    rows = close(random.Random(7), 150) + HARD_ROWS + [(3, [0.1] * 8, 1)] * 20
    got = centroids.cluster_report(vectors(spark, rows), k=k, size=8).collect()
    assert sorted(map(tuple, got), key=repr) == cluster(rows, k, 5, 8, 2)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, -0.5], 0), (2, [0.5, -0.5], 0), (None, [0.1, 0.3], 0), (4, [1.0], 0)]
    got = centroids.cluster_report(vectors(spark, rows), size=2).collect()
    assert sorted(map(tuple, got), key=repr) == cluster(rows, 40, 5, 2, 2)
    assert centroids.cluster_report(vectors(spark, [])).collect() == []


def test_centroids_are_literals_and_sums_are_folded(spark):
    rows = spark.createDataFrame([([1, 2],), ([3, 4],)], "v array<bigint>")
    plan = rows.groupBy(centroids.nearest("v", [[1, 2], [5, 5]])["cluster"]).agg(F.sum(F.col("v")[0]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and not any(w in text for w in ("Python", "Arrow", "Broadcast"))


def test_queries_on_the_test_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in read(spark, SF, "embeddings").collect()]
    turned = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    assert sorted(map(tuple, op11_hard_negatives(spark, SF).collect())) == mine(turned, lambda i: i % 100 == 0)
    assert sorted(map(tuple, op12_centroid_clusters(spark, SF).collect()), key=repr) == cluster(rows, 40, 5, 64, 2)
