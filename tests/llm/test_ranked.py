import math
import random
import re
from collections import Counter

import numpy as np

from fathomline.llm import ranked
from tests.llm.helpers import HARD, LONG, hard

ITEMS = [(0, "one two"), (1, "Four four FIVE zzz"), (2, ""), (3, None), (None, "one"), (4, "lorem ipsum"), (5, "ünïcödé text 日本語"), (6, "here"), (6, "here"), (7, "one"), (7, "at all")]


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    held = [(d, Counter(tokens(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in {(i, t) for i, t in items if i is not None and t is not None}:
        asked.setdefault(i, Counter()).update(tokens(t))
    out = []
    for i, q in asked.items():
        scores = []
        for d, c in held:
            m = 100 - 75 + 75 * sum(c.values()) * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, r in q.items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, docs, items, k=10):
    d = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(tuple(r) for r in ranked.search(d, spark.createDataFrame(items, "item_id long, text string"), k).collect())


def some(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Ünder", "X", "ß", "日本"]
    return [(i, " ".join(rng.choice(words[: rng.choice([5, 20, 64])]) for _ in range(rng.choice([0, 1, 5, 40, 200])))) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    docs = some(rng, 400)
    docs += [(1000 + i, docs[7][1]) for i in range(50)]  # ties
    items = [(i, t) for i, t in some(rng, 30)]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    monkeypatch.setattr(ranked, "DOCUMENTS", 17)
    monkeypatch.setattr(ranked, "PIECE", 5)
    monkeypatch.setattr(ranked, "ITEM_BYTES", 1000)  # several passes
    assert run(spark, docs, items) == want


def test_hard_rows(spark):
    docs = hard(spark)
    assert run(spark, docs, ITEMS) == brute([r[:2] for r in HARD], ITEMS)
    assert run(spark, [(1, "one")], []) == [] and run(spark, [], ITEMS) == [] and run(spark, [(1, None)], ITEMS) == []
    assert len(list(ranked.terms(LONG))) == 1


def test_whole_numbers_need_more_than_64_bits():
    sizes = np.array([10**9, 4 * 10**9, 3], np.int64)
    places, times, starts = np.array([0, 1, 2], np.int32), np.array([10**9, 4 * 10**9, 1], np.int64), np.array([0, 3], np.int64)
    n, total = 10**11, 7 * 10**13
    want = [9 * (1_000_000_000 * int(t) // (1000 * int(t) + 8 * (25 + 75 * int(s) * n // total))) for s, t in zip(sizes, times)]
    large = ranked.impacts(sizes, starts, places, np.append(times[:2], 10**10), np.array([9], np.int64), n, total)
    assert ranked.impacts(sizes, starts, places, times, np.array([9], np.int64), n, total).tolist() == want and large[:2].tolist() == want[:2]


def test_ties_keep_the_first_places():
    assert ranked.best(np.array([5, 7, 5, 5, 0, 7]), 3).tolist() == [1, 5, 0]
    assert ranked.best(np.array([0, 0]), 3).tolist() == []
