import hashlib
import random

from fathomline.llm import line_dedup
from tests.llm.helpers import SCHEMA, hard, words


def brute(docs, sites=2, least=3):
    spread, first = {}, {}
    for i, text, source, _ in docs:
        for k, raw in enumerate((text or "").split("\n") if text is not None else []):
            line = raw.strip(" \t\r")
            if len(words(line)) >= least:
                spread.setdefault(line, set()).add(source)
                at = (i is None, i if i is not None else 0, k)
                first[line] = min(first.get(line, at), at)
    out = {}
    for i, text, _, _ in docs:
        if text is None:
            out[i] = (0, 0, None)
            continue
        ls = text.split("\n")
        kept = [raw for k, raw in enumerate(ls) if len(spread.get(raw.strip(" \t\r"), ())) < sites or first[raw.strip(" \t\r")] == (i is None, i if i is not None else 0, k)]
        out[i] = (len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def documents(seed=0, sites=12):
    rng = random.Random(seed)
    common = [f"this line is on many sites {i}" for i in range(6)] + ["All rights reserved.", "In.", "x y"]
    return [(i, "\n".join(rng.choice(["  ", ""]) + (rng.choice(common) if rng.random() < 0.3 else f"own line of doc {rng.randrange(200)}") for _ in range(rng.randrange(1, 12))), rng.choice([None, *[f"s{k}" for k in range(sites)]]), 0) for i in range(120)]


def test_against_brute_force(spark):
    docs = documents()
    df = spark.createDataFrame(docs, SCHEMA)
    for sites in (2, 5, 8):
        got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text_sha256"]) for r in line_dedup.line_report(df, sites).collect()}
        assert got == brute(docs, sites)


def test_hot_lines_and_many_lines(spark, monkeypatch):
    docs = documents(3)
    df = spark.createDataFrame(docs, SCHEMA)
    want = brute(docs)
    for hot, rows in ((2, 50_000), (20, 50_000), (2, 1), (1000, 1)):
        monkeypatch.setattr(line_dedup, "HOT", hot)
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", rows)
        got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text_sha256"]) for r in line_dedup.line_report(df).collect()}
        assert got == want, (hot, rows)


def test_many_lines_in_one_text_take_linear_time(spark):
    import time

    def took(n):
        text = "\n".join(f"shared line number {i}" for i in range(n))
        df = spark.createDataFrame([(1, text, "a", 0), (2, text, "b", 0)], SCHEMA)
        start = time.time()
        assert sorted(r["n_dropped"] for r in line_dedup.line_report(df).collect()) == [0, n]
        return time.time() - start

    took(100)
    few, many = took(15_000), took(120_000)
    assert many < 5 * few + 5  # by the square it would be 64 times


def test_texts_and_lengths(spark):
    docs = [(1, "keep me here now\nshared line of boilerplate", "a", 44), (2, "shared line of boilerplate\nother words stand here", "b", 48), (3, "shared line of boilerplate", "b", 26)]
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert out[1]["text"] == docs[0][1] and out[2]["text"] == "other words stand here" and out[3]["text"] == "" and out[2]["n_chars"] == 22


def test_awkward_rows(spark):
    df = hard(spark)
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.count() == df.count()
    assert line_dedup.line_report(df).count() == df.count()
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.line_report(empty).count() == 0
    same = {r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame([(5, "a b c d", "a", 1), (5, "a b c d", "b", 1)], SCHEMA)).collect()}
    assert same == {"a b c d"}  # rows equal in id and text are treated alike


def test_only_built_in_functions(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
