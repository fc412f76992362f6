import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from fathomline.llm import pii
from tests.llm.helpers import SCHEMA, hard

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    found, n = [], []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        k = 0
        for m in re.finditer(p, text or ""):
            g, d = m.group(), re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in g.split(".")), "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()
            if ok:
                k += 1
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
        n.append(k)
    return n, [x[2] for x in sorted(found)]


def check(spark, texts):
    rows = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame([(i, t, "a", 0) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        n, spans = brute(t)
        r = rows[i]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == n, t[:200]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), t[:200]
        assert set(spans) <= set(r["spans"].split(",")) or not spans
    return rows


def test_base_spans_against_the_patterns(spark):
    rng = random.Random(10)
    alphabet = "aZ0179.@+-%_ ()é\n😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(800)]
    texts += ["a@b.c_d@e.f", "a@b.c%x@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.004", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713!", "x@y", "a@b.c.", "1-2", "000000000000", "+12345678", "+1234567890123456", "é😀 a@b.cc 1.1.1.1"]
    check(spark, texts)


def test_long_texts_take_linear_time(spark):
    """What they hold is known; the plain patterns would take quadratic time on these."""
    texts = {"a" * 200_000: (0, 0), "1" * 200_000: (0, 0), "1 " * 50_000: (0, 0), "a@" * 50_000: (0, 0), "+1" * 50_000: (0, 0), "a@b.c " * 3_000: (3_000, 0), "1.2.3.4 " * 3_000: (0, 3_000), "." * 200_000: (0, 0)}
    df = spark.createDataFrame([(i, t, "a", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in pii.find_pii(df).collect()}
    assert got == {i: (*n, 0, 0) for i, n in enumerate(texts.values())}


@settings(max_examples=2, deadline=None)
@given(st.lists(st.text(alphabet="a1.@+- 4", max_size=40), min_size=1, max_size=50))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_added_spans(spark):
    texts = [f'words here token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and more' for i in range(30)] + [f"commit {hashlib.sha1(str(i).encode()).hexdigest()}/x" for i in range(10)] + ["plain words " * 20] * 50
    rows = check(spark, texts)
    assert all(rows[i]["spans"] == f"secret:{texts[i].index(chr(34)) + 1}:{texts[i].index(chr(34)) + 41}" for i in range(30))
    assert all(rows[i]["spans"] == "" for i in range(40, 90))


def test_estimates_tell_good_labelers_from_bad():
    rng = random.Random(11)
    patterns = {}
    for kind, sure in (("secret", (0.95, 0.9, 0.9, 0.55)), ("account", (0.55, 0.9, 0.9, 0.95))):
        for _ in range(4000):
            y = rng.random() < 0.4
            say = lambda p, y=y: (1 if y else -1) if rng.random() < p else (-1 if y else 1)
            v = (*map(say, sure), 0, 0, 0)
            patterns[kind, v, (0, 0, 0, 0, 0)] = patterns.get((kind, v, (0, 0, 0, 0, 0)), 0) + 1
    right = pii.estimated({(k, v): n for (k, v, _), n in patterns.items()})
    assert right["secret", (1, 1, 1, -1, 0, 0, 0)] > 0.95 and right["secret", (-1, -1, -1, 1, 0, 0, 0)] < 0.05
    # reliabilities are those of the kind
    assert right["account", (-1, 1, 1, 1, 0, 0, 0)] > 0.95 and right["account", (1, -1, -1, -1, 0, 0, 0)] < 0.05
    w = pii.trained(patterns)
    gain = lambda kind, i: w[kind, "vote", i, 1] - w[kind, "vote", i, -1]
    assert gain("secret", 0) > gain("secret", 3) and gain("account", 3) > gain("account", 0)


def test_looks_decide_where_votes_are_the_same():
    # spans with one look are mostly right, with another mostly wrong; a labeler that says nothing about some of them
    v, none = (1, 0, 1, 0, 1, 1, 1), (0,) * 7
    against = (-1, 0, -1, 0, -1, -1, -1)
    good, bad = (2, 2, 1, 1, 1), (0, 0, 0, 0, 0)
    w = pii.trained({("secret", v, good): 500, ("secret", against, bad): 500, ("secret", none, good): 20, ("secret", none, bad): 20})
    z = lambda vs, ws: sum(w.get(p, 0.0) for p in pii.parts_of("secret", vs, ws))
    assert z(none, good) > 0 > z(none, bad)


def test_bank_accounts_are_checked(spark):
    from pyspark.sql import functions as F

    texts = {"DE89 3704 0044 0532 0130 00": True, "GB82WEST12345698765432": True, "DE89 3704 0044 0532 0130 01": False, "GB82WEST12345698765433": False}
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    assert {r["m"]: r["ok"] for r in df.select("m", pii.iban_ok(F.col("m")).alias("ok")).collect()} == texts


def candidates_by_hand(text):
    """Spans of the added kinds that overlap no base span: the patterns, as they are, by another library."""
    import regex

    pattern = "|".join(f"(?:{p})" for p, _ in reversed(pii.ADDED.values()))
    taken = [(int(a), int(b)) for _, a, b in (x.split(":") for x in brute(text)[1])]
    out = []
    for m in regex.finditer(pattern, text):
        if not any(a < m.end() and m.start() < b for a, b in taken):
            out.append((next((k for k, f in pii.FORMS.items() if regex.search(f, m.group())), "secret"), m.start(), m.end()))
    return out


def test_added_spans_against_brute_force(spark):
    rng = random.Random(12)
    bits = ["Dr. Ann Lee", "Mr Élan", "ab.c (at) d-e (dot) org", "(415) 555-0134", "123-45-6789", "DE89 3704 0044 0532 0130 00", "api_key=", "token: ", "sha ", "aB3dE5" * 6, "x" * 25, "1.2.3.4", "a@b.cc", "+1 415 555 0134", " ", ", ", "é😀", "plain words", "4111 1111 1111 1111", "\n"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 14))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "a", 0) for i, t in enumerate(texts)], SCHEMA)
    found = {r["id"]: r["found"] or [] for r in pii.candidates(pii.base_spans(df)).collect()}
    for i, t in enumerate(texts):
        assert [(x["kind"], x["s"], x["e"]) for x in found[i]] == candidates_by_hand(t), t
    # the query accepts those that the trained classifier accepts
    patterns = {}
    for rows in found.values():
        for x in rows:
            key = (x["kind"], tuple(x["v"]), tuple(x["w"]))
            patterns[key] = patterns.get(key, 0) + 1
    w = pii.trained(patterns)
    number = {k: r for r, k in enumerate([*pii.BASE, *pii.ADDED])}
    for r in pii.find_pii(df).collect():
        own = [f"{x['kind']}:{x['s']}:{x['e']}" for x in found[r["doc_id"]] if sum(w.get(p, 0.0) for p in pii.parts_of(x["kind"], tuple(x["v"]), tuple(x["w"]))) >= 0]
        want = sorted([*brute(texts[r["doc_id"]])[1], *own], key=lambda x: (int(x.split(":")[1]), number[x.split(":")[0]]))
        assert r["spans"] == ",".join(want)


def test_awkward_rows(spark):
    df = hard(spark)
    rows = pii.find_pii(df).collect()
    assert len(rows) == df.count()
    assert {r["doc_id"]: r for r in rows}[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_built_in_functions(spark):
    df = spark.createDataFrame([(1, "a@b.cc", "a", 0)], SCHEMA)
    for out in (pii.candidates(pii.base_spans(df)), pii.find_pii(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_the_hint_is_in_all_candidates(spark):
    from pyspark.sql import functions as F

    rng = random.Random(11)
    pick = lambda xs: rng.choice(xs)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    make = {
        "secret": lambda: "".join(rng.choice("aZ09_+/-") for _ in range(rng.randrange(20, 60))),
        "email_spelt": lambda: f"ab.c{pick(['', ' '])}{pick('([')}at{pick(')]')}{pick(['', ' '])}d-e{pick(['.', ' . ', '(dot)', ' [dot] '])}org",
        "phone_local": lambda: f"{pick(['', '('])}{digits(3)}{pick(['', ')'])}{pick(' .-')}{digits(3)}{pick('.-')}{digits(4)}",
        "national_id": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "account": lambda: f"DE{digits(2)}" + "".join(f"{pick(['', ' '])}{pick(['ABCD', digits(4)])}" for _ in range(rng.randrange(3, 8))),
        "name": lambda: f"{pick(['Mr', 'Mrs', 'Ms', 'Dr', 'Prof'])}{pick(['', '.'])} {pick(['Ann', 'Élan'])}{pick(['', ' Lee'])}",
    }
    assert set(make) == set(pii.ADDED)
    df = spark.createDataFrame([(k, f()) for k, f in make.items() for _ in range(200)], "kind string, text string")
    matches = F.coalesce(*[F.when(F.col("kind") == k, F.col("text").rlike(p)) for k, (p, _) in pii.ADDED.items()])
    assert df.filter(matches).groupBy("kind").count().count() == len(make)
    assert df.filter(matches & ~F.col("text").rlike(pii.HINT)).collect() == []


def test_phones_with_a_bracket_and_a_dash_are_candidates(spark):
    texts = ["call (415)-555-0134 today", "tel (415).555.0134"]
    df = pii.candidates(pii.base_spans(spark.createDataFrame([(i, t, "a", 0) for i, t in enumerate(texts)], SCHEMA)))
    assert {r["id"]: [(x["kind"], x["s"], x["e"]) for x in r["found"]] for r in df.collect()} == {0: [("phone_local", 5, 19)], 1: [("phone_local", 4, 18)]}


def test_secrets_of_any_length_are_candidates(spark):
    texts = [f'token = "{"aB3dE5" * 10}" and', f'token = "{"aB3dE5" * 33}xyz" and', f'token = "{"aB3dE5" * 5000}" and', f'key: {hashlib.sha512(b"x").hexdigest() * 2}.']
    df = pii.candidates(pii.base_spans(spark.createDataFrame([(i, t, "a", 0) for i, t in enumerate(texts)], SCHEMA)))
    lengths = {0: [60], 1: [201], 2: [30_000], 3: [256]}
    assert {r["id"]: [x["e"] - x["s"] for x in r["found"] if x["kind"] == "secret"] for r in df.collect()} == lengths
