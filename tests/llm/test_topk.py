import math
import random

from pyspark.sql import functions as F

from fathomline.llm import topk


def brute(rows, k=10):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v in ok:
        if i % 100 == 0:
            first[i] = min(first.get(i, v), v)
    out = []
    for q, v in first.items():
        s = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q))[:k]
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit(1).alias("v"), F.lit(2).alias("score"))
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, k).collect())


def test_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(700)]
    same = [rng.gauss(0, 1) for _ in range(64)]
    rows += [(1000 + i, same) for i in range(300)]  # ties
    assert run(spark, rows) == brute(rows)


def test_queries_and_candidates_meet_by_shards_too(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(900)]
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    assert run(spark, rows) == brute(rows)


def shares(x, k=10, block=8192):
    """The share of pairs that reach the exact product, and the results by query."""
    import numpy as np

    ids = np.arange(len(x), dtype=np.int64)
    q_id = ids[ids % 100 == 0]
    least, reached, best = np.full(len(q_id), -np.inf), 0, {}
    for at in range(0, len(x), block):
        a, c, s, n = topk.best_of_block(x[q_id], q_id, x[at : at + block], ids[at : at + block], k, least)
        reached += n
        for q, v, p in zip(a.tolist(), c.tolist(), s.tolist(), strict=True):
            best.setdefault(q, []).append((-p, v))
    return reached / (len(q_id) * len(x)), {q: sorted(v)[:k] for q, v in best.items()}


def test_bounds_leave_few_pairs():
    import numpy as np

    rng = np.random.default_rng(9)
    plain = np.floor(1024 * rng.normal(size=(4000, 64)))
    steps = np.floor(1024 * np.cumsum(rng.normal(size=(4000, 64)), axis=1))  # neighbours in a vector are alike
    centre = rng.normal(size=(40, 64)) * 4
    groups = np.floor(1024 * (centre[rng.integers(0, 40, 4000)] + 0.1 * rng.normal(size=(4000, 64))))
    for x, most in ((plain, 0.65), (steps, 0.05), (groups, 0.1)):
        for block in (8192, 500):
            share, best = shares(x, block=block)
            assert share <= most, share
            products = x[::100] @ x.T
            for i, q in enumerate(range(0, len(x), 100)):
                want = sorted((-int(p), j) for j, p in enumerate(products[i]) if j != q)[:10]
                assert best[q] == want


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0]), (6, []), (None, [1.0, 1.0]), (7, [-0.0001, 0.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (100, [3.0, -1.0, 5.0]), (100, [3.0, -1.0, 5.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_very_large_components_saturate(spark):
    big = [(0, [1e17, 1e17]), (1, [1e17, 1e17]), (2, [-1e17, -1e17])]
    assert [r[3] for r in run(spark, big)] == [2**63 - 1, -(2**63)]
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice((0, 8, 14, 300)) for _ in range(5)]) for i in range(300)]
    clipped = lambda v: max(-(2**63), min(2**63 - 1, v))
    own = [(i, [math.floor(max(-1e300, min(1e300, 1024 * x))) for x in v]) for i, v in rows]
    want = []
    for q, v in own[::100]:
        s = sorted((-clipped(sum(a * b for a, b in zip(v, w))), i) for i, w in own if i != q)[:10]
        want += [(q, n + 1, i, -p) for n, (p, i) in enumerate(s)]
    assert run(spark, rows) == sorted(want)
