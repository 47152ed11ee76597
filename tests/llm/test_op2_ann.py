"""Multi-index hashing against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendstream.llm import ann
from trendstream.llm import queries as Q
from trendstream.llm.ann import Coder, learn, nearest_neighbours
from trendstream.session import ship_package
from tests.conftest import SF_SMALL

DDL = "vec_id long, embedding array<float>, score string, rank int"


def brute(rows, k, asks):
    """query -> {vec_id: distance}, and each query's k nearest."""
    dims = {}
    good = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.append((i, tuple(np.float32(x) for x in v)))
        dims[len(v)] = dims.get(len(v), 0) + 1
    usual = min(dims, key=lambda d: (-dims[d], d)) if dims else 0
    good = sorted({g for g in good if len(g[1]) == usual})
    ids, x = np.array([g[0] for g in good]), np.array([g[1] for g in good], dtype=float).reshape(len(good), -1)
    out = {}
    for q in sorted({i for i in ids if asks(i)}):
        best = {}
        for mine in x[ids == q]:
            for i, d in zip(ids, np.sqrt(((x - mine) ** 2).sum(axis=1))):
                if i != q:
                    best[int(i)] = min(best.get(int(i), np.inf), d)
        out[int(q)] = sorted(best.items(), key=lambda p: (p[1], p[0]))[:k]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    return hits / sum(len(w) for w in want.values())


def vectors(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims))
    return [[float(np.float32(y)) for y in centres[rng.integers(20)] + 0.4 * rng.normal(size=dims)] for _ in range(n)]


def test_recall_and_exact_scores(spark):
    ship_package(spark)
    rows = list(enumerate(vectors(3000, 24)))
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], DDL).repartition(6)
    got = answers(nearest_neighbours(df, F.col("vec_id") % 100 == 0))
    want = brute(rows, 10, lambda i: i % 100 == 0)
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    assert recall(got, want) >= 0.9
    x = np.array([v for _, v in rows])
    assert all(abs(np.linalg.norm(x[q] - x[i]) - s) < 1e-12 for q, g in got.items() for i, s in g)


def test_edge_rows_ties_copies_and_few_candidates(spark):
    ship_package(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300, 3)]                       # a vector that many share
    rows += [(1, [1.0, 2.0, 4.0]), (100, [1.0, 2.0, 4.0]), (200, [5.0, 0.0, 1.0]), (200, [5.0, 0.0, 1.0]), (400, [-0.0, 1.0, 1.0]),
             (401, [0.0, 1.0, 1.0])]
    bad = [(500, None), (600, [0.0, 0.0, 0.0]), (700, [nan, 1.0, 1.0]), (800, [inf, 1.0, 1.0]), (900, [None, 1.0, 1.0]),
           (1000, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (1100, [])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows + bad], DDL).repartition(4)
    got = answers(nearest_neighbours(df, F.col("vec_id") % 100 == 0))
    want = brute(rows + bad, 10, lambda i: i % 100 == 0)
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
    assert np.allclose([s for q in want for _, s in got[q]], [s for q in want for _, s in want[q]], atol=1e-12)


def test_equidistant_distinct_vectors_by_smallest_id(spark):
    """Far more distinct vectors at the same distance than are asked for, in any order of arrival."""
    ship_package(spark)
    rows = [(100, [1.0] * 8)]
    for i in range(40):
        v = [1.0] * 8
        v[i % 8] += 3.0 if i < 8 else -3.0 if i < 16 else 0.0
        v[(i + 1) % 8] += 0.0 if i < 16 else 3.0 * (-1) ** i
        rows.append((1 + (i * 7) % 40 if i < 16 else 200 + i, v))
    want = brute(rows, 5, lambda i: i % 100 == 0)
    for parts in (1, 4):
        df = spark.createDataFrame([(i, v, "", 0) for i, v in rows], DDL).repartition(parts)
        got = answers(nearest_neighbours(df, F.col("vec_id") % 100 == 0, k=5))
        assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}


def test_all_candidates_when_there_are_few(spark):
    ship_package(spark)
    df = spark.createDataFrame([(0, [1.0, 0.0], "", 0), (7, [0.0, 1.0], "", 0), (100, [-1.0, 0.5], "", 0)], DDL)
    got = answers(nearest_neighbours(df, F.col("vec_id") % 100 == 0))
    assert {q: [i for i, _ in g] for q, g in got.items()} == {0: [7, 100], 100: [7, 0]}


def test_empty_table_and_no_query(spark):
    empty = spark.createDataFrame([], DDL)
    assert nearest_neighbours(empty, F.col("vec_id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(5, [1.0, 1.0], "", 0)], DDL)
    assert nearest_neighbours(one, F.col("vec_id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(100, [1.0, 1.0], "", 0)], DDL)
    assert nearest_neighbours(alone, F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 3, 7, 20, 33, 64])
def test_allowed_bits_cover_the_radius(radius):
    allowed = Coder(np.zeros(1), np.zeros((1, 64)), radius).allowed()
    assert sum(a + 1 for a in allowed) == radius + 1        # each substring over its threshold needs radius + 1 bits


def test_every_code_within_the_radius_is_retrieved():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 32))
    coder = learn(x, 5)
    subs = coder.substrings(x)
    total = np.bitwise_count(subs[:, None] ^ subs[None]).sum(axis=2)
    near = np.bitwise_count(subs[:, None] ^ subs[None]) <= np.array(coder.allowed())
    assert (near.any(axis=2) | (total > coder.radius)).all()
    packed = np.ascontiguousarray(subs).view(np.uint64)[:, 0]
    hits = np.zeros_like(total)
    for s in range(ann.SUBSTRINGS):
        for q in range(len(x)):
            rows = np.flatnonzero(near[q, :, s])
            hits[q, rows[ann._first_here(packed[rows] ^ packed[q], s, coder.allowed())]] += 1
    assert ((hits == 1) == near.any(axis=2)).all()


def test_op2_query_recall(spark):
    ship_package(spark)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got, want = answers(Q.op2_nearest_neighbours(spark, SF_SMALL)), brute(rows, 10, lambda i: i % 100 == 0)
    assert set(got) == set(want) and recall(got, want) >= 0.9
