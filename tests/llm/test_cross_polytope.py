"""Nearest neighbours against brute force: exact scores and order, recall, every awkward vector."""

import math

import numpy as np
import pytest
from helpers import write

from tradeledger.llm import cross_polytope as cp
from tradeledger.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    """{(query_id, vector): [(score, vec_id)]} of (vec_id, vector) rows, all by plain loops over numpy rows."""
    kept = set()
    for i, v in rows:
        if v and None not in v and np.isfinite(np.float32(v)).all() and any(v):
            kept.add((i, tuple(float(np.float32(x)) for x in v)))
    kept = list(kept)
    made = {}
    for i, v in kept:
        if i is None or i % 100:
            continue
        others = [(j, w) for j, w in kept if (j, w) != (i, v) and len(w) == len(v)]
        found = [(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in others]
        made[i, v] = sorted(found, key=lambda r: (r[0], r[1] is None, r[1] or 0))[:k]
    return made


def answers(df):
    made = {}
    for r in df.orderBy("query_id", "rank").collect():
        made.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return made


def recall(got, want):
    hits = total = 0
    for (i, _), near in want.items():
        own = [x for _, _, x in got.get(i, [])]
        total += len(near)
        hits += sum(j in own for _, j in near)
    return hits / total


def well_formed(got, rows, k=10):
    vectors = {i: np.float32(v).astype(float) for i, v in rows}
    for i, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert [(s, j) for _, s, j in found] == sorted((s, j) for _, s, j in found)
        assert i not in [j for _, _, j in found] and len({j for _, _, j in found}) == len(found)
        for _, s, j in found:
            assert math.isclose(s, math.dist(vectors[i], vectors[j]), rel_tol=1e-12, abs_tol=1e-15)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = answers(queries.QUERIES["op11_nearest_neighbours"](spark, folder)), brute(rows)
    well_formed(got, rows)
    assert len(got) == len(want) and all(len(x) == 10 for x in got.values())
    assert recall(got, want) >= 0.9


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    x = centres[rng.integers(0, 20, n)] + 0.1 * rng.normal(size=(n, dim))
    x[: n // 3] = centres[0] + 0.01 * rng.normal(size=(n // 3, dim))  # a hot group of near copies
    x[n // 3 : n // 2] *= rng.uniform(0.1, 30, (n // 2 - n // 3, 1))  # not of unit length
    return [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]


@pytest.mark.parametrize("dim", [1, 3, 40])
def test_recall_over_clusters_of_any_length(spark, dim, monkeypatch):
    monkeypatch.setattr(cp, "SHARD_ROWS", 50)  # the hot group's shard is split
    rows = clustered(1500, dim, dim)
    got = answers(cp.neighbours(spark.createDataFrame(rows, SCHEMA), lambda i: i % 100 == 0))
    pairs = [r[:2] for r in rows]
    well_formed(got, pairs)
    assert recall(got, brute(pairs)) >= 0.9 and all(len(x) == 10 for x in got.values())


def test_awkward_vectors(spark):
    """Few enough rows that every query gets all its candidates."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [1.0, inf]),
        (None, [1.0, 0.5]), (100, [1.0, 0.0]), (200, [-0.0, 3.0]), (300, [1.0, 2.0, 3.0]), (400, [5.0]), (8, [0.0, 2.0]), (0, [1.0, 0.0]),
        (9, [3.0, 2.0, 1.0]),
    ]
    given = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).selectExpr("*", "1 as key", "2 as score", "3 as rank", "'own' as vec")
    got = answers(cp.neighbours(given, lambda i: i % 100 == 0))
    want = brute(rows)
    assert set(got) == {0, 100, 200, 300}  # 400 is alone with its length
    for (i, _), near in want.items():
        assert [(s, j) for _, s, j in got.get(i, [])] == near


def test_equal_vectors_and_ties(spark):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(300)] + [(1000 + i, [2.0 if j == i else 1.0 for j in range(3)]) for i in range(3)]
    rows += [(500, [1.0, 2.0, 0.5]), (500, [9.0, 9.0, 9.0])]
    got = answers(cp.neighbours(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), lambda i: (i % 100 == 0) & (i < 400)))
    for (i, _), near in brute(rows).items():
        if i < 400:
            assert [(s, j) for _, s, j in got[i]] == near


def test_doubles_and_integers(spark):
    rows = [(i, [float(i), 1e200 * (i % 2)]) for i in range(1, 8)] + [(100, [1.0, 0.0])]
    got = answers(cp.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 100 == 0))
    assert [j for _, _, j in got[100]][:3] == [2, 4, 6] and len(got[100]) == 7
    whole = spark.createDataFrame([(i, [i, 1]) for i in range(1, 8)] + [(100, [2, 1])], "vec_id long, embedding array<int>")
    assert [j for _, _, j in answers(cp.neighbours(whole, lambda i: i % 100 == 0))[100]] == [2, 1, 3, 4, 5, 6, 7]


def test_empty_table_and_no_queries(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    folder = write(spark, tmp_path, embeddings=empty)
    got = queries.QUERIES["op11_nearest_neighbours"](spark, folder)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.collect() == []
    assert cp.neighbours(spark.createDataFrame([(1, [1.0], 0)], SCHEMA), lambda i: i % 100 == 0).collect() == []
    assert cp.neighbours(spark.createDataFrame([(100, [1.0], 0)], SCHEMA), lambda i: i % 100 == 0).collect() == []


def test_rotations_keep_lengths_and_levels_grow():
    x = np.random.default_rng(0).normal(size=(9, 20))
    t = cp.Tables(20, 1000)
    got = t.coordinates(cp.unit(x), 0, 0)
    assert got.shape == (9, 64) and np.allclose((got[:, :32] ** 2).sum(axis=1), 1)
    assert cp.Tables(64, 1000).levels == 2 and cp.Tables(64, 10**9).levels == 5 - 1 and cp.Tables(64, 10**9).depth == 3
    eye = np.eye(8)
    assert np.allclose(cp.hadamard(cp.hadamard(eye)), eye)
