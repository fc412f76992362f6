import random
import re
from collections import Counter

from pyspark.sql import functions as F

from fathomline.llm import divergence
from tests.llm.helpers import HARD, hard


def brute(docs, terms=10):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    rows = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text)))) for text, lang, source in docs]
    out = []
    for lang in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, c in here for t in c)
        kept = {t for t in df if df[t] >= 10}
        count = {s: Counter() for _, s, _ in here}
        for _, s, c in here:
            count[s].update({t: n for t, n in c.items() if t in kept})
        whole = Counter()
        for c in count.values():
            whole.update(c)
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        ps, q = {s: p(c) for s, c in count.items()}, p(whole)
        for s in count:
            pair = [(h, sum(f(ps[s][t], ps[h][t]) for t in kept)) for h in count if h != s]
            own = [(t, f(ps[s][t], q[t])) for t in kept if count[s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", own, terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:most])]
    return sorted(out)


def run(spark, docs):
    d = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "text string, lang string, source string")
    return sorted(tuple(r) for r in divergence.divergence(d).select("lang", "source", "part", "item", "value", "rank").collect())


def some(rng, sources, n):
    docs = []
    for _ in range(n):
        lang, s = rng.choice(["de", "en", None]), rng.randrange(sources)
        own = [f"own{chr(97 + s)}{chr(97 + rng.randrange(4))}" for _ in range(rng.randrange(4))]
        common = [f"Common{chr(97 + min(int(rng.expovariate(0.3)), 25))}" for _ in range(rng.randrange(30))]
        docs.append((" ".join(own + common + rng.choice([[], ["Ünder", "日本 x1y"]])), lang, rng.choice([f"s{s}", f"s{s}", f"t{s}"]) if s else None))
    docs += [(None, "de", "empty"), ("", "fr", "a"), ("!!", "fr", None)]
    return docs


def test_against_brute_force(spark, monkeypatch):
    docs = some(random.Random(2), 12, 900)
    want = brute(docs)
    assert run(spark, docs) == want and {r[2] for r in want} == {"pair", "term"}
    monkeypatch.setattr(divergence, "TERMS", 3)
    monkeypatch.setattr(divergence, "GROUPS", 4)  # several tiles of terms and of groups
    monkeypatch.setattr(divergence, "HELD", 10)
    monkeypatch.setattr(divergence, "PIECE", 6)
    assert run(spark, docs) == want
    for light in (1, 1000):
        monkeypatch.setattr(divergence, "LIGHT", light)
        assert run(spark, docs) == want


def test_hard_rows(spark):
    docs = hard(spark).withColumn("lang", F.when(F.col("c0") > 5, "x")).withColumn("gid", F.lit(1)).withColumn("term", F.lit("y"))
    for _ in range(3):
        docs = docs.union(docs)
    want = brute([(r[1], None, r[2]) for r in HARD] * 8)
    # the five kept terms are equally frequent in each source: all shares are one fifth
    assert run(spark, docs) == want and len(want) == 12 and all(r[2] == "pair" and r[4] == 0 for r in want)
    assert run(spark, docs.limit(0)) == []
