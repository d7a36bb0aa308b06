"""Operator 5 against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>"


def vectors(kind: str, n=900, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    if kind == "clusters":
        x = x * 0.4 + rng.standard_normal((12, dim))[rng.integers(0, 12, n)]
    if kind == "lengths":
        x = x * rng.uniform(0.2, 3.0, n)[:, None]
    return x.astype(np.float32)


def exact(ids, x, k=20, every=20):
    x = x.astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = (x * x[i]).sum(axis=1)
        others = np.flatnonzero(ids != ids[i])
        best = others[np.lexsort((ids[others], -scores[others]))[:k]]
        out[int(ids[i])] = [(int(ids[b]), float(scores[b])) for b in best]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


@pytest.mark.parametrize("kind", ["even", "clusters", "lengths"])
def test_recall_and_scores(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 400)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 16)
    x = vectors(kind)
    ids = np.arange(len(x))
    want, got = exact(ids, x), run(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)])
    assert got.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        scores = dict(got[q])
        assert len(got[q]) == 20 and q not in scores
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
        hits += len(scores.keys() & dict(best).keys())
        for v, s in got[q]:
            assert s == pytest.approx(float((x[v].astype(np.float64) * x[q].astype(np.float64)).sum()), rel=1e-12, abs=1e-12)
    assert hits / (20 * len(want)) >= 0.95


def test_odd_rows_take_no_part(spark):
    x = vectors("even", 60, 8)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, []), (120, [0.0] * 8), (140, [nan] * 8), (160, [inf] + [1.0] * 7), (180, [None] + [1.0] * 7), (None, x[0].tolist())]
    got, want = run(spark, rows + odd), exact(np.arange(60), x)
    assert {q: [v for v, _ in p] for q, p in got.items()} == {q: [v for v, _ in p] for q, p in want.items()}


def test_ties_repeated_rows_other_dimensions_and_few_candidates(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(i, same) for i in (0, 7, 3, 9, 9, 20)] + [(40, [1.0, 0.0]), (41, [0.5, 0.5]), (60, [1.0, 2.0, 3.0, 4.0])]
    got = run(spark, rows, k=4)
    assert [v for v, _ in got[0]] == [3, 7, 9, 9] and {s for _, s in got[0]} == {9.0}
    assert [v for v, _ in got[20]] == [0, 3, 7, 9]
    assert got[40] == [(41, 0.5)] and 60 not in got


def test_a_very_common_vector(spark):
    x = vectors("even", 300, 16)
    x[40:200] = x[40]
    ids = np.arange(300)
    want, got = exact(ids, x), run(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)])
    assert [v for v, _ in got[60]] == [v for v, _ in want[60]]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect() == []
