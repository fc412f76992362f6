import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fathomline.llm import mixing
from tests.llm.helpers import SCHEMA, hard, words


def water(sizes, weights=(1, 2, 3), cap=3.0):
    """Targets by sharing again and again what exceeds the caps."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, total = {}, sum(sizes.values())
    free = set(order)
    while True:
        left = total - sum(target.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            free.discard(s)
        if not free:
            return target


def check(rows, docs):
    sizes = defaultdict(int)
    for _, text, source, _ in docs:
        sizes[source] += len(words(text))
    target = water(dict(sizes))
    source_of = {d[0]: d[2] for d in docs}
    taken, biggest = defaultdict(int), defaultdict(int)
    for r in rows:
        s = source_of[r["doc_id"]]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        assert r["target"] == pytest.approx(target[s], abs=1e-5) and r["source_size"] == sizes[s]
        taken[s] += r["taken"]
        biggest[s] = max(biggest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= biggest[s], s
    return taken, target


def test_targets_and_taken(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), rng.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(600)]
    df = spark.createDataFrame(docs, SCHEMA)
    rows = mixing.mix_sizes(df).collect()
    assert len(rows) == 600
    check(rows, docs)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sizes(df.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mix_repeats_rows_as_sizes_say(spark):
    docs = [(i, f"w{i} " * (1 + i % 9), "abc"[i % 3] if i % 10 else "a", i) for i in range(200)]
    df = spark.createDataFrame(docs, SCHEMA)
    sizes = {r["doc_id"]: r for r in mixing.mix_sizes(df).collect()}
    n = {r["doc_id"]: r["count"] for r in mixing.mix(df).groupBy("doc_id").count().collect()}
    for i, r in sizes.items():
        assert n.get(i, 0) * r["size"] == r["taken"]
    assert mixing.mix(df).columns == df.columns


def test_unequal_importance(spark):
    docs = [(i, "w " * 10, "a", 1 + i % 4) for i in range(400)] + [(1000 + i, "w " * 10, "b", 1) for i in range(100)]
    df = spark.createDataFrame(docs, SCHEMA)
    rows = mixing.mix_sizes(df, importance="n_chars").collect()
    by = defaultdict(int)
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        if r["doc_id"] < 1000:
            by[r["doc_id"] % 4] += r["taken"]
    assert by[0] < by[1] < by[3]
    total = sum(by.values())
    assert abs(total - rows[0]["target"]) <= 20 or rows[0]["doc_id"] >= 1000


def test_awkward_rows(spark):
    df = hard(spark)
    rows = mixing.mix_sizes(df).collect()
    assert len(rows) == df.count() and {r["doc_id"]: r["size"] for r in rows}[2] == 0
    assert mixing.mix(df).columns == df.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert mixing.mix_sizes(empty.select("*", F.lit(1).alias("size"))).columns == ["doc_id", "size", "source_size", "target", "taken"]
