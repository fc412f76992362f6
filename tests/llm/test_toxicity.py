import itertools
import random
import zlib

import numpy as np
import pytest

from fathomline.llm import toxicity as tx
from tests.llm.helpers import SCHEMA, hard

CLEAN = "the cat sat on a mat and some other people were reading in a garden with books near that old stone wall".split()


@pytest.fixture(scope="module")
def model():
    text = " ".join(CLEAN * 30 + ["you", "idiot", "stupid", "clown", "worthless", "people"] * 20)
    c = tx.codes(" " * 3 + text + " ").astype(np.int64)
    return tx.language_model(np.bincount(((c[:-3] * 28 + c[1:-2]) * 28 + c[2:-1]) * 28 + c[3:], minlength=28**4).astype(float))


def brute(segment, model):
    """The best reading by trying all."""
    best = None
    for way in itertools.product(*tx.readings(segment)):
        said = "".join(c for c, _ in way) + " "
        s = [0, 0, 0] + [tx._LETTER.get(c, 27 if c.isalpha() else 0) for c in said]
        cost = sum(p for _, p in way) - sum(float(model[s[i], s[i + 1], s[i + 2], s[i + 3]]) for i in range(len(said)))
        if best is None or cost < best[0] - 1e-9:
            best = (cost, said[:-1])
    return best


@pytest.mark.parametrize("segment", ["1d10t", "st0op!d", "cl0wn", "w0rthl3ss", "c.l.o.w.n", "i d i o t", "stuupid", "p3opl3", "aa1", "b00ks"])
def test_viterbi_against_all_readings(model, segment):
    cost, said = brute(segment, model)
    got = tx.decode(segment, model, beam=10**6)
    assert brute(segment, model)[0] == pytest.approx(cost)
    assert got == said


@pytest.mark.parametrize(("text", "word"), [("you 1d10t", "idiot"), ("You ID!OT!!", "idiot"), ("a c l o w n", "clown"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid###", "stupid"), ("w0rthless", "worthless"), ("$tupid", "stupid")])
def test_restores(model, text, word):
    assert word in tx.Restorer(model).words(text)


@pytest.mark.parametrize(("text", "word"), [("you iiddiioott", "idiot"), ("i   d   i   o   t", "idiot"), ("c/l/o/w/n", "clown"), ("y o u", "you"), ("y/o/u", "you"), ("a c7", "ct"), ("1d!07 here", "idiot"), ("cllown", "clown")])
def test_restores_all_forms_of_disguise(model, text, word):
    assert word in tx.Restorer(model).words(text)


@pytest.mark.parametrize("run", ["a55", "a$$", "@$$"])
def test_short_runs_with_signs_are_read(run):
    c = tx.codes("   " + "such an ass sat on a mat " * 50).astype(np.int64)
    m = tx.language_model(np.bincount(((c[:-3] * 28 + c[1:-2]) * 28 + c[2:-1]) * 28 + c[3:], minlength=28**4).astype(float))
    assert "ass" in tx.Restorer(m).words(f"you {run}")


def test_numbers_and_double_letters_stay(model):
    assert {"books", "all"} <= tx.Restorer(model).words("all books 455 1,234.50")
    assert tx.Restorer(model).words("455 1,234.50 2024") == set()


def test_the_decoder_that_runs_is_exact(model):
    rng = random.Random(4)
    for n in (1, 3, 5, 7, 8):
        for _ in range(12):
            segment = "".join(rng.choice("1!|i10lo.") for _ in range(n))
            got, cost = tx.decode(segment, model), brute(segment, model)[0]
            ways = {"".join(c for c, _ in w): sum(p for _, p in w) for w in sorted(itertools.product(*tx.readings(segment)), key=lambda w: -sum(p for _, p in w))}
            c = [0, 0, 0] + [tx._LETTER.get(x, 27 if x.isalpha() else 0) for x in got + " "]
            assert ways[got] - sum(float(model[tuple(c[i : i + 4])]) for i in range(len(got) + 1)) == pytest.approx(cost, abs=1e-4)
    long = "1!|i" * 40
    assert tx.decode(long, model) == tx.decode(long, model, beam=10**6)


@pytest.mark.parametrize("shift", range(8))
def test_words_across_any_place_of_long_passages(model, shift):
    spaced = " ".join("a" * shift + "idiot" * 60)
    assert tx.decode(spaced, model).count("idiot") == 60
    run = "x" * shift + "-1d10t" * 40
    assert tx.decode(run, model).count("idiot") == 40
    text = " ".join("the" * (20 + shift) + "worthless" + "the" * 20)
    assert "worthless" in "".join(sorted(tx.Restorer(model).words(text), key=lambda w: "worthless" not in w)[:1])


def test_plain_text_is_left_alone(model):
    t = "The cat, sat on 12 mats (2 books) at http://a.example/x1"
    assert {"the", "cat", "sat", "mats", "books"} <= tx.Restorer(model).words(t)


def docs_and_labels(n=400, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        ws = [rng.choice(CLEAN) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            for w in rng.sample(["idiot", "stupid", "clown", "worthless"], 2):
                w = rng.choice([w, w, w.replace("i", "1").replace("o", "0"), " ".join(w)])
                ws.insert(rng.randrange(len(ws)), w)
        docs.append((i, " ".join(ws), "a", 0))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = docs_and_labels()
    d, l = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = tx.scores(d, l).collect()
    assert len(rows) == len(docs)
    toxic = {a: c for a, _, c in labels}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows) and held
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in held) / len(held) >= 0.95
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)
    kept = {r["doc_id"] for r in tx.rejected_toxic(d, l).collect()}
    assert kept == {r["doc_id"] for r in rows if not r["predicted"]}


def test_held_out_recall_on_the_tables(spark):
    import os

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("the driver's tables aren't here")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in tx.scores(docs, labels).collect() if r["held_out"] and toxic.get(r["doc_id"]) is not None]
    bad = [r["predicted"] for r in held if toxic[r["doc_id"]]]
    assert bad and sum(bad) / len(bad) >= 0.9
    assert sum(r["predicted"] for r in held if not toxic[r["doc_id"]]) <= 0.02 * len(held)


def test_repeated_ids_count_once_in_the_sample(spark):
    docs, labels = docs_and_labels(60)
    d = spark.createDataFrame(docs * 20, SCHEMA)
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tx.language_model(tx.count_characters(d))
    seen = {}
    fit = tx.fit_logistic
    try:
        tx.fit_logistic = lambda x, y, **more: seen.update(n=len(y)) or fit(x, y, **more)
        tx.train(d, l, model, sample=10)
    finally:
        tx.fit_logistic = fit
    assert seen["n"] == 10


def test_held_out_labels_are_not_used(spark):
    docs, labels = docs_and_labels(200)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    d = spark.createDataFrame(docs, SCHEMA)
    a, b = (tx.scores(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    df = hard(spark)
    rows = tx.scores(df, labels).collect()
    assert len(rows) == df.count() and all(r["score"] is not None for r in rows)
    assert tx.rejected_toxic(df, labels).columns == df.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert tx.scores(empty, labels).count() == 0 and tx.rejected_toxic(empty, labels).count() == 0
    assert tx.scores(df, labels.filter("doc_id < 0")).filter("predicted = 1").count() == 0
