import random
import re

import xxhash

from fathomline.llm import simhash
from fathomline.llm.components import components
from tests.llm.helpers import SCHEMA, hard, words


def plain_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints():
    rng = random.Random(3)
    for text in ["", None, " \n", "One", "One TWO", "ÀÉ İ x", *[" ".join(rng.choice("abc DEF gh é".split()) for _ in range(n)) for n in (2, 3, 4, 50, 500)]]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_components_of_chains_stars_and_islands(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = plain_components({x for e in edges if e[0] != e[1] for x in e}, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near(a, b):
    return (a ^ b).bit_count() <= 2


def test_links_join_all_that_are_near(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for f in list(fps)[:60]:
        fps.add(f ^ (1 << rng.randrange(64)))
        fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
        fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    # a crowd within few bits of each other: over-full blocks
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << i) for i in range(64)} | {centre ^ (3 << i) for i in range(0, 60, 3)}
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    linked = [(r["a"], r["b"]) for r in simhash.links(df).collect()]
    assert all(near(a & (2**64 - 1), b & (2**64 - 1)) for a, b in linked)
    signed = [simhash._signed(f) for f in fps]
    want = plain_components(signed, [(x, y) for i, x in enumerate(signed) for y in signed[:i] if near(x & (2**64 - 1), y & (2**64 - 1))])
    assert plain_components(signed, linked) == want


def test_documents(spark):
    rng = random.Random(6)
    base = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(400)) for _ in range(10)]
    docs = [(i, base[i % 10] if i % 3 else base[i % 10].upper() + " extra", "a", 0) for i in range(40)] + [(100, "", "a", 0), (101, None, "a", 0)]
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()}
    fp = {d[0]: plain_fingerprint(d[1]) for d in docs}
    want = plain_components(list(fp), [(a, b) for a in fp for b in fp if a < b and near(fp[a], fp[b])])
    assert {k: r["component_id"] for k, r in rows.items()} == want
    kept = {r["doc_id"] for r in simhash.first_of_each(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert kept == set(want.values())


def test_awkward_rows(spark):
    df = hard(spark)
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == df.count()
    out = simhash.first_of_each(df)
    assert out.columns == df.columns and [r[0] for r in out.collect()].count(5) <= 1
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.first_of_each(empty).count() == 0
