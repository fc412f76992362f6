import random

import pytest

from tests.llm.helpers import SCHEMA, SF, hard, have_tables, words


@pytest.mark.skipif(not have_tables, reason="the driver's tables aren't here")
def test_stages_against_their_parts(spark):
    import corpus_pipeline
    from fathomline.llm import line_dedup, mixing, pieces, simhash, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mix", "pieces"]
    step = docs
    bad = {r["doc_id"] for r in toxicity.scores(docs, labels).filter("predicted = 1").collect()}
    out = corpus_pipeline.STAGES[0][1](spark, step, SF).cache()
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()} - bad
    assert out.columns == docs.columns
    step, out = out, corpus_pipeline.STAGES[1][1](spark, out, SF).cache()
    assert out.count() == step.count() and out.columns == docs.columns
    dropped = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(step).collect()}
    was, now = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (step, out))
    assert all((was[i] == now[i]) == (n == 0) and len(was[i].split("\n")) - n == (len(now[i].split("\n")) if now[i] or n < len(was[i].split("\n")) else 0) for i, n in dropped.items())
    step, out = out, corpus_pipeline.STAGES[2][1](spark, out, SF).cache()
    firsts = {r["component_id"] for r in simhash.near_duplicates(step).collect()}
    assert {r["doc_id"] for r in out.collect()} == firsts and out.count() == len(firsts)
    step, out = out, corpus_pipeline.STAGES[3][1](spark, out, SF).cache()
    size = {r["doc_id"]: r for r in mixing.mix_sizes(step).collect()}
    times = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(times.get(i, 0) * r["size"] == r["taken"] for i, r in size.items())
    last = corpus_pipeline.STAGES[4][1](spark, out, SF)
    assert last.count() == out.count() and last.columns == [*docs.columns, "n_pieces", "piece_ids", "round_trip"]
    assert last.filter("not round_trip").count() == 0
    assert pieces is not None


def mixed_by_hand(docs, weights=(1, 2, 3), cap=3.0):
    """doc_id -> copies, by the rule, source by source: certain copies, then in the order of odds over odds, then one more."""
    import hashlib

    from fathomline.llm.mixing import SEED
    from tests.llm.test_mixing import water

    by = {}
    for i, text, source, _ in docs:
        key = hashlib.md5(f"{SEED}|{i}".encode()).hexdigest()
        by.setdefault(source, []).append((i, len(words(text)), key))
    target = water({s: sum(n for _, n, _ in d) for s, d in by.items()}, weights, cap)
    out = {}
    for source, own in by.items():
        weight = lambda n: max(1, n.bit_length())
        total, k, full = sum(n for _, n, _ in own), 0.0, set()
        if target[source] < cap * total * (1 - 1e-12):
            while True:
                free = [x for x in own if x[0] not in full]
                mass = sum(n * weight(n) for _, n, _ in free)
                k = (target[source] - sum(cap * n for i, n, _ in own if i in full)) / mass if mass else k
                more = {i for i, n, _ in free if weight(n) * k >= cap}
                if not more:
                    break
                full |= more
        else:
            k = float("inf")
        ranked, left = [], target[source]
        for i, n, key in own:
            rate = min(cap, k * weight(n))
            out[i] = int(rate)
            left -= out[i] * n
            if rate > int(rate):
                u, part = (int(key[:13], 16) + 0.5) / 2**52, rate - int(rate)
                ranked.append(((u / (1 - u)) / (part / (1 - part)), key, i, n))
        rest = []
        for rank, key, i, n in sorted(ranked):
            if not rest and n <= left:
                out[i] += 1
                left -= n
            else:
                rest.append((abs(left - n), rank, key, i, n))
        if close := [x for x in rest if x[4] and x[0] < left]:
            out[min(close)[3]] += 1
    return out


def test_run_against_brute_force(spark, tmp_path):
    """All five stages over a small table, each spelt out in plain loops."""
    import public_tokenizers
    import sentencepiece

    import corpus_pipeline
    from fathomline.llm import toxicity
    from tests.llm.test_near_copies import brute as near

    rng = random.Random(21)
    vocabulary = [f"{a}{b}" for a in ("ta", "ro", "mi", "ne", "lu", "so") for b in ("da", "ki", "pe", "wo", "na", "ge", "ri")]
    shared = [" ".join(rng.choice(vocabulary) for _ in range(8)) for _ in range(4)]
    docs, labels = [], []
    for i in range(160):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6, 40))) for _ in range(rng.randrange(1, 4))]
        if i % 5 == 0:
            lines.insert(0, rng.choice(shared))
        if i % 7 == 0:
            lines[-1] += rng.choice([" you idiot", " 1d10t", " what an i d i o t"])
        if i % 9 == 0 and i:
            lines = docs[i - 1][1].split("\n")
        docs.append((i, "\n".join(lines), rng.choice(["a", "a", "b", None]), 0))
        labels.append((i, 1, int("idiot" in docs[i][1] or "1d10t" in docs[i][1] or "i d i o t" in docs[i][1])))
    docs += [(200, None, "a", 0), (201, "", "b", 0)]
    docs = [(i, t, s, len(t or "")) for i, t, s, _ in docs]
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # toxicity: the trained scorer, text by text
    df = [spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in ("documents", "labels")]
    model, classifier = toxicity.fitted(*df)
    score = toxicity.scorer((model, classifier.weights, classifier.bias))
    left = [d for d in docs if score(d[1]) < 0.5]
    assert 0 < len(docs) - len(left) < 40 and all(dict((i, t) for i, _, t in labels).get(d[0], 0) for d in docs if d not in left)
    # lines on two sites or more stay where they come first
    sites, first = {}, {}
    for i, text, source, _ in left:
        for n, line in enumerate((text or "").split("\n")):
            if len(words(line)) >= 3:
                key = line.strip(" \t\r")
                sites.setdefault(key, set()).add(source)
                first[key] = min(first.get(key, (i, n)), (i, n))
    kept = [(i, None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if len(sites.get(x.strip(" \t\r"), ())) < 2 or first[x.strip(" \t\r")] == (i, n)), s, c) for i, text, s, c in left]
    assert kept != left
    # one of each group of near copies
    roots = near([t for _, t, _, _ in kept])
    groups = {}
    for d, r in zip(kept, roots, strict=True):
        groups.setdefault(r, []).append(d)
    ones = [min(g, key=lambda d: d[0]) for g in groups.values()]
    assert len(ones) < len(kept)
    copies = mixed_by_hand(ones)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((i, t or "", tuple(sp.encode(t or ""))) for i, t, _, _ in ones for _ in range(copies[i]))
    assert sorted((r["doc_id"], r["text"] or "", tuple(r["piece_ids"])) for r in got) == want
    assert all(r["round_trip"] and r["n_chars"] == len(r["text"] or "") for r in got)


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names; and no rows at all."""
    import corpus_pipeline

    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    full = hard(spark)
    for docs in (full, full.limit(0)):
        step = docs
        for name, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, str(tmp_path))
            assert step.columns[: len(docs.columns)] == docs.columns, name
            step = spark.createDataFrame(step.collect(), step.schema)
            assert (step.count() > 0) == (docs is full), name


@pytest.mark.skipif(not have_tables, reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", ["op1_mix_sources", "op4_topk_search", "op5_exact_dedup", "op7_archives", "op9_line_dedup", "op12_divergence", "op13_ranked_search"])
def test_queries_against_sql(spark, name):
    import os

    import duckdb

    from fathomline.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        p = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    df = QUERIES[name](spark, SF)
    got = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    show = lambda v: f"{v:.5f}" if isinstance(v, float) else str(v)
    mine = sorted(tuple(show(r[c]) for c in sorted(cols)) for r in df.collect())
    theirs = sorted(tuple(show(dict(zip(cols, r, strict=True))[c]) for c in sorted(cols)) for r in got.fetchall())
    assert mine == theirs
