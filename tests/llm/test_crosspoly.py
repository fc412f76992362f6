import math
import random

import numpy as np
from pyspark.sql import functions as F

from fathomline.llm import crosspoly


def exact(rows, k=5, every=50):
    """Each query's k nearest, compared with all rows."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    wide = max((len(v) for _, v in ok), default=0)
    first = {}
    for i, v in ok:
        if i % every == 0:
            first[i] = min(first.get(i, v), v)
    m = lambda v: np.pad(np.array(v, float), (0, wide - len(v)))
    out = {}
    for q, v in first.items():
        a = m(v)
        s = [(-float(a @ m(w) / math.sqrt((a @ a) * (m(w) @ m(w)))), i) for i, w in ok if i != q]
        out[q] = sorted((round(x, 12), i) for x, i in s)[:k]
    return out


def run(spark, rows, k=5, every=50):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit(1).alias("v"), F.lit(2).alias("cid"), F.lit(3).alias("Vec_Id2"))
    got = {}
    for r in crosspoly.search(df, F.col("vec_id") % every == 0, k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for v in got.values():
        v.sort()
        assert [x[0] for x in v] == list(range(1, len(v) + 1))
    return {q: [(round(-s, 12), i) for _, i, s in v] for q, v in got.items()}


def recall(got, want):
    """By scores, so that equal ones may stand for each other."""
    hits = sum(sum(x[0] <= w[-1][0] + 1e-9 for x in got.get(q, [])) for q, w in want.items() if w)
    return hits / sum(len(w) for w in want.values())


def test_the_transform_is_a_rotation():
    y = crosspoly.hadamard(np.eye(16))
    assert np.allclose(y @ y.T, np.eye(16)) and set(np.round(np.abs(y), 9).ravel()) == {0.25}
    h = crosspoly.Hash(50, 5000)
    x = crosspoly.normed(np.random.default_rng(1).normal(size=(20, 50)))
    assert h.wide == 64 and h.axes == [64, 1]
    for t in range(crosspoly.TABLES):
        z = h.coordinates(x, t)[0]
        assert np.allclose((z[:, :64] ** 2).sum(axis=1), 1)
        # the own bucket costs nothing, and probes hold just what is within the radius
        code, probes = h.codes(x, t), h.probes(x, t, 0.05)
        assert all(c in p for c, p in zip(code, probes))
        for i in range(20):
            near = {int(c) for c, k in zip(code, h.penalty(np.repeat(x[i : i + 1], 20, axis=0), x, t)) if k <= 0.05}
            assert near == set(code.tolist()) & set(probes[i].tolist())


def test_recall_and_scores(spark, monkeypatch):
    rng = np.random.default_rng(4)
    plain = rng.normal(size=(3000, 32))
    centre = rng.normal(size=(30, 32)) * 3
    groups = centre[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 32))
    for x in (plain, groups):
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        want = exact(rows)
        got = run(spark, rows)
        assert recall(got, want) >= 0.9 and all(len(got[q]) == 5 for q in want)
        true = {q: {i: s for s, i in exact_all} for q, exact_all in exact(rows, k=3000).items()}
        assert all(abs(true[q][i] - s) < 1e-9 for q, v in got.items() for s, i in v)
    monkeypatch.setattr(crosspoly, "CANDIDATES", 100)
    monkeypatch.setattr(crosspoly, "QUERIES", 7)
    assert run(spark, rows) == got


def test_copies_and_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(crosspoly, "CANDIDATES", 64)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(300)]
    same = [rng.gauss(0, 1) for _ in range(16)]
    rows += [(1000 + i, same) for i in range(200)]
    rows += [(2000 + i, [x + rng.gauss(0, 1e-4) for x in same]) for i in range(300)]
    rows += rows[:20]
    want, got = exact(rows), run(spark, rows)
    assert recall(got, want) >= 0.9
    for q in (1000, 1050, 1100):  # of copies the least ids but the query's own
        assert [i for _, i in got[q]] == [i for i in range(1000, 1007) if i != q][:5]


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0]), (6, []), (None, [1.0, 1.0]), (7, [0.0, -0.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]),
            (50, [3.0, -1.0, 5.0]), (50, [3.0, -1.0, 5.0]), (9, [1e300, 2e300]), (10, [1e-300, -1e-300]), (100, [-1.0, 0.5])]
    got = run(spark, rows)
    assert [i for _, i in got[0]] == [8, 9, 5, 50, 10][: len(got[0])] or [i for _, i in got[0]][:3] == [8, 9, 5]
    assert set(got) == {0, 50, 100} and all(i not in (1, 2, 3, 4, 6, 7) for v in got.values() for _, i in v)
    assert run(spark, [(0, [1.0])]) == {} and run(spark, []) == {} and run(spark, [(3, [1.0])]) == {}
