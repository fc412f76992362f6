import random

from pyspark.sql import functions as F

import corpus_pipeline
from fathomline.llm import near_copies, simhash
from tests.llm.helpers import SCHEMA, hard


def brute(texts):
    """The least place that pairs of similarity 0.8 reach, for each place."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def some_texts():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(60)}"
    texts = [None, "", " \n"]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 6, 12, 60, 150, 300]))]
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w if rng.random() < 0.7 else ["one", "line", "that", "many", "texts", "share", "to", "the", "end", *w]))
    return texts


def test_against_all_pairs(spark, monkeypatch):
    texts = some_texts()
    df = spark.createDataFrame([(i, t, "a", 0) for i, t in enumerate(texts)], SCHEMA)
    want = dict(enumerate(brute(texts)))
    for most, often, paired in ((near_copies.HEAVY, near_copies.OFTEN, 32), (5, 2, 2), (1000, 2, 4), (0, 8, 2)):
        monkeypatch.setattr(near_copies, "PAIRED", paired)
        assert {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, most, often).collect()} == want
    assert len(set(want.values())) < len(texts) - 10


def test_the_stage_drops_copies_with_a_few_changed_words(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(1000)}" for _ in range(200)]
    near = list(base)
    near[50] = near[120] = near[180] = "changed"
    a, b = " ".join(base), " ".join(near)
    assert (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() > 2
    df = spark.createDataFrame([(1, a, "a", 0), (2, b, "a", 0), (3, "some other text", "a", 0)], SCHEMA)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, df, "").collect()) == [1, 3]


def test_hard_rows(spark):
    got = [r[0] for r in corpus_pipeline.near_dedup_stage(spark, hard(spark), "").collect()]
    assert sorted(got, key=str) == [1, 2, 7, 8, None]
    assert corpus_pipeline.near_dedup_stage(spark, hard(spark).limit(0), "").count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    rows = [(None, "all of this is one text", "a", 1), (None, "and that is quite another one", "b", 2), (3, "some third text", "a", 3), (3, "a fourth one with the same id", "a", 4),
            (4, "and that is QUITE  another one", "a", 5), (5, "twice the same row", "a", 6), (5, "twice the same row", "a", 6), (5, "twice the same row", "a", 5), (None, None, "a", 7), (None, "", "a", 8)]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        got = sorted((tuple(r) for r in corpus_pipeline.near_dedup_stage(spark, df, "").collect()), key=str)
        want = [(3, "a fourth one with the same id", "a", 4), (3, "some third text", "a", 3), (4, "and that is QUITE  another one", "a", 5), (5, "twice the same row", "a", 5), (None, "all of this is one text", "a", 1)]
        rest = [r for r in got if r not in want]
        assert len(got) == 6 and len(rest) == 1 and rest[0] in [(None, None, "a", 7), (None, "", "a", 8)]


def test_sketches_only_rule_out(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (0, 5, 300, 5000, 200_000):
        x = np.unique(rng.integers(-(2**63), 2**63, n))
        y = np.unique(np.concatenate([x[: n * 9 // 10], rng.integers(-(2**63), 2**63, n // 10)]))
        a, b = (near_copies.sketch(s).astype(int) for s in (x, y))
        full = bool(((a == 255) & (b == 255)).any())
        assert full == (n > 100_000) and (full or np.minimum(a, b).sum() >= len(np.intersect1d(x, y)))


def test_keys_are_the_same_in_both_ways(spark):
    from fathomline.llm.near_copies import key_column, key_of, line_of

    texts = ["", None, " ", "A b\t\x0b\x0c\r\nC", "  ÄÉ x ", "İ ß", "日本 語\u00a0x\u2003y", "x" * 5000, "\x1c a \x85 b", "a\0b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r["i"]: r["k"] for r in df.select("i", key_column(F.col("text")).alias("k")).collect()}
    assert got == {i: key_of(line_of(t)) for i, t in enumerate(texts)}
