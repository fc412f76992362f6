"""Personal data: exact base kinds by pattern, more kinds by weak supervision.

Base spans (email, ip, card, phone) are the leftmost matches of fixed patterns that pass their checks. Further
candidates (secrets, spelt-out emails, local phone numbers, national numbers, bank accounts, titled names) are found by a
wide pattern. Labelers vote on each, for, against or not at all: by a strict form, by check digits and number plans, by
gazetteers of words before it and of words inside it, by the signs around it, by its shape. Votes and what a span itself
looks like (length, digits, capitals, different characters, the sign before it) are counted over all documents: a table
whose size is bounded by the numbers of kinds, votes and classes, whatever the input. Expectation-maximisation estimates
how reliable each labeler is for each kind, and how likely each pattern of votes is right; a logistic span classifier over
the span's looks and the votes is trained on those probabilities, and its weights go back into the query as literals.
Candidates that it accepts, and that overlap no base span, are added; base spans always stay.

Texts are searched once: spans and candidates are written to the shared folder without the texts, and both the counts
and the result are read from there. Only built-in functions run on the data. Patterns are written so that each starts
where a match can start and never goes back into a run: long texts take time in proportion. Places come from the lengths
of what is between matches.

Defined results: null and empty texts have no spans, and the digest of an empty string; places count code points; repeated
rows get equal results; an empty table gives an empty result; without candidates nothing is added. Other columns don't
matter, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import packed, scratch

#: Base kinds in their order: pattern, and what a text must hold for the pattern to be tried.
#: \G lets a match start where the last one ended; else it starts where its first run starts.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@")),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", lambda t: t.rlike(r"[0-9]\.[0-9]")),
    "card": (r"(?:\G|(?<![0-9])(?<![0-9][\x20-]))[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike("[0-9]")),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+")),
}

#: Added kinds: pattern of a candidate, then a strict form. In this order they come after the base kinds.
ADDED = {
    "secret": (r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+", r"^(?=.*[0-9])(?=.*[A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[A-Z])(?=.*[a-z]).{20,})$"),
    "email_spelt": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]++)++", r"[(\[]dot[)\]]"),
    "phone_local": (r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9.-])", r"^\([0-9]{3}\) |^[0-9]{3}([.-])[0-9]{3}\1"),
    "national_id": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"),
    "account": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"^[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){2}"),
    "name": (r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? \p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)?", r" \p{Lu}\p{Ll}+ \p{Lu}"),
}

#: What tells a candidate's kind; a secret is none of these.
FORMS = {
    "email_spelt": r"[(\[]at[)\]]",
    "name": r"^(?:Mr|Mrs|Ms|Dr|Prof)\.? ",
    "national_id": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "phone_local": r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}$",
    "account": r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$",
}

# Words (of the four languages) that speak for a kind in the 40 characters before a candidate.
GAZETTEER = {
    "secret": ["token", "key", "secret", "password", "passwd", "pwd", "api", "auth", "bearer", "credential", "private", "access", "signature", "contraseña", "clave", "passwort", "schlüssel", "clé", "jeton", "passe"],
    "email_spelt": ["mail", "contact", "write", "reach", "address", "correo", "contacto", "escrib", "kontakt", "schreib", "adresse", "courriel", "écri"],
    "phone_local": ["phone", "tel", "call", "fax", "mobile", "cell", "dial", "contact", "number", "móvil", "llam", "ruf", "handy", "nummer", "appel", "portable", "numéro"],
    "national_id": ["ssn", "social", "security", "national", "insurance", "tax", "id", "seguro", "identidad", "ausweis", "steuer", "sécurité", "identité"],
    "account": ["iban", "account", "bank", "swift", "bic", "transfer", "payment", "cuenta", "banco", "konto", "überweis", "compte", "banque", "virement"],
    "name": ["by", "dear", "from", "contact", "patient", "signed", "attn", "author", "client", "customer", "sr", "estimad", "herr", "frau", "monsieur", "madame"],
}
# Words that speak against any kind there.
AGAINST = ["sha", "md5", "commit", "checksum", "digest", "hash", "isbn", "issn", "doi", "version", "release", "build", "http", "href", "src", "img", "version", "serial", "model", "part", "order", "page", "figure", "table", "chapter", "section"]
# What a candidate of a kind may hold: prefixes that services give their keys, ends of mail domains, countries
# of bank accounts, frequent given names.
INSIDE = {
    "secret": r"^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|sk_test_|sk-|pk_live_|rk_live_|xox[abprs]-|AIza|ya29|eyJ|SG\.|hf_|npm_|pypi-)",
    "email_spelt": r"(?i)(?:com|org|net|edu|gov|info|io|co|uk|de|fr|es|it|nl|ch|at|be|pt|pl|se|no|dk|fi|ie|eu|us|ca|mx|ar|br|au|nz|jp|in|example)$",
    "account": r"^(?:AD|AE|AL|AT|AZ|BA|BE|BG|BH|BR|BY|CH|CR|CY|CZ|DE|DK|DO|EE|EG|ES|FI|FO|FR|GB|GE|GI|GL|GR|GT|HR|HU|IE|IL|IQ|IS|IT|JO|KW|KZ|LB|LC|LI|LT|LU|LV|MC|MD|ME|MK|MR|MT|MU|NL|NO|PK|PL|PS|PT|QA|RO|RS|SA|SC|SE|SI|SK|SM|ST|SV|TL|TN|TR|UA|VA|VG|XK)",
    "name": r" (?:James|Mary|John|Patricia|Robert|Jennifer|Michael|Linda|William|Elizabeth|David|Barbara|Richard|Susan|Joseph|Jessica|Thomas|Sarah|Charles|Karen|Daniel|Nancy|Matthew|Lisa|Anthony|Betty|Mark|Sandra|Paul|Ashley|Steven|Emily|Andrew|Donna|George|Anna|Maria|José|Juan|Carmen|Antonio|Ana|Luis|Lucía|Carlos|Elena|Hans|Peter|Klaus|Wolfgang|Ursula|Monika|Petra|Stefan|Sabine|Jürgen|Pierre|Jean|Marie|Michel|Philippe|Nathalie|Isabelle|Claude|Sophie|Julien)\b",
}
LABELERS = ("strict", "check", "words", "inside", "before", "after", "shape")
#: How many classes each look of a span has.
LOOKS = {"length": 5, "digits": 4, "capitals": 3, "different": 3, "sign": 4}
#: A text must hold one of these for candidates to be looked for; whatever a pattern of ADDED matches holds one.
HINT = r"[A-Za-z0-9_+/-]{20}|[(\[]at[)\]]|[0-9]{3}\)?[ .-][0-9]{2,3}[.-][0-9]{4}|[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}|(?:Mr|Mrs|Ms|Dr|Prof)\.? "


def located(text: Column, pattern: str, when: Column) -> tuple[Column, Column]:
    """Matches, and what is between them (one more), where ``when``; else null."""
    return F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), F.when(when, F.split(text, pattern, -1))


def placed(matches: Column, gaps: Column) -> Column:
    """Structs m, s, e, before, after of matches. Sums of lengths go by blocks of the root of their number, not quadratically."""
    n = F.size(matches)
    lengths = F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    sums = lambda ls: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda b: add(F.slice(ls, b * block + 1, block)))
    both = F.struct(lengths.alias("ls"), sums(lengths).alias("sums"))

    def place(parts: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            at = F.floor(i / block).cast("int")
            s = add(F.slice(parts["sums"], F.lit(1), at)) + add(F.slice(parts["ls"], at * block + 1, i - at * block)) + F.length(F.get(gaps, i))
            return F.struct(m.alias("m"), s.alias("s"), (s + F.length(m)).alias("e"), F.right(F.get(gaps, i), F.lit(40)).alias("before"), F.substring(F.get(gaps, i + 1), 1, 1).alias("after"))

        return F.transform(matches, one)

    return F.when(n > 0, F.element_at(F.transform(F.array(both), place), 1))


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def checked(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.when(F.length(part(p)) <= 3, part(p).cast("int")).otherwise(999) <= 255))
    if kind == "card":
        digits = F.regexp_replace(m, "[ -]", "")
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


_SPAN = "array<struct<s: int, e: int, r: int>>"


def base_spans(docs: DataFrame) -> DataFrame:
    """id, text, and for each base kind its spans (s, e, r: rank of the kind)."""
    row, at = packed(docs)
    df = row.select(at["doc_id"].alias("id"), F.coalesce(at["text"], F.lit("")).alias("text"))
    found = {k: located(F.col("text"), p, hint(F.col("text"))) for k, (p, hint) in BASE.items()}
    df = df.select("id", "text", *[x for k, (m, g) in found.items() for x in (m.alias(f"{k}_m"), g.alias(f"{k}_g"))])
    df = df.select("id", "text", *[placed(F.col(f"{k}_m"), F.col(f"{k}_g")).alias(k) for k in BASE])

    def kept(kind: str, rank: int) -> Column:
        spans = F.transform(F.filter(F.col(kind), lambda x: checked(kind, x["m"])), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(rank).alias("r")))
        return F.coalesce(spans, F.array().cast(_SPAN)).alias(kind)

    return df.select("id", "text", *[kept(k, r) for r, k in enumerate(BASE)])


def iban_ok(m: Column) -> Column:
    """Letters count from 10; the number, its first four signs moved to the end, leaves 1 when divided by 97."""
    text = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    digit = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, "", -1), F.lit(0), lambda a, c: F.when(c == "", a).otherwise((a * F.when(digit(c) > 9, 100).otherwise(10) + digit(c)) % 97)) == 1


def votes(kind: Column, m: Column, before: Column, after: Column) -> list[Column]:
    """One column a labeler: 1 for, -1 against, 0 nothing."""
    by_kind = lambda f, of=ADDED: F.coalesce(*[F.when(kind == k, f(k)) for k in of], F.lit(0))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    low = F.lower(before)
    listed = lambda words: r"(?<!\p{L})(?:" + "|".join(dict.fromkeys(words)) + ")"
    strict = by_kind(lambda k: vote(m.rlike(ADDED[k][1]), F.lit(True)))
    check = F.when(kind == "account", vote(iban_ok(m), F.lit(True))).when(kind == "phone_local", vote(m.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]"), m.rlike(r"^\(?[01]"))).when(kind == "national_id", vote(m.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), F.lit(True))).otherwise(0)
    words = by_kind(lambda k: vote(low.rlike(listed(GAZETTEER[k])), low.rlike(listed(AGAINST))))
    inside = by_kind(lambda k: vote(m.rlike(INSIDE[k]), F.lit(False)), INSIDE)
    prior = vote(before.rlike(r"[=:]\s*[\"']?$"), before.rlike(r"[/.@#\\_-]$"))
    next_ = vote(after.rlike(r"[\"'\s,;.!?)]") | (after == ""), after.rlike(r"[\w/@=]"))
    digits = F.length(F.regexp_replace(m, "[^0-9]", "")) / F.greatest(F.length(m), F.lit(1))
    shape = F.when(kind == "secret", vote(digits.between(0.1, 0.9), digits == 0)).when(kind.isin("phone_local", "national_id", "account"), vote(digits >= 0.6, digits < 0.4)).otherwise(0)
    return [v.cast("int") for v in (strict, check, words, inside, prior, next_, shape)]


def looks(m: Column, before: Column) -> list[Column]:
    """Classes of what a span itself looks like, as ``LOOKS``: by length, shares of digits and capitals, number of different characters, sign before it."""
    n = F.greatest(F.length(m), F.lit(1))
    share = lambda p: F.length(F.regexp_replace(m, p, "")) / n
    cut_at = lambda x, *edges: sum((F.when(x >= e, 1).otherwise(0) for e in edges), F.lit(0))
    different = F.size(F.array_distinct(F.split(m, "", -1)))
    sign = F.when(before.rlike(r"[=:]\s*[\"']?$"), 1).when(before.rlike(r"\s$"), 2).when(before == "", 3).otherwise(0)
    return [c.cast("int") for c in (cut_at(n, 12, 20, 32, 48), cut_at(share("[^0-9]"), 0.1, 0.4, 0.8), cut_at(share("[^A-Z]"), 0.1, 0.4), cut_at(different, 8, 14), sign)]


def candidates(df: DataFrame) -> DataFrame:
    """``df`` with ``found``: candidates of added kinds that overlap no base span, with their votes (v) and looks (w)."""
    pattern = "|".join(f"(?:{p})" for p, _ in reversed(ADDED.values()))
    m, g = located(F.col("text"), pattern, F.col("text").rlike(HINT))
    df = df.select("*", m.alias("c_m"), g.alias("c_g")).select(*df.columns, placed(F.col("c_m"), F.col("c_g")).alias("c"))
    kind = lambda x: F.coalesce(*[F.when(x["m"].rlike(f), F.lit(k)) for k, f in FORMS.items()], F.lit("secret"))
    taken = F.concat(*[F.col(k) for k in BASE])
    free = lambda x: ~F.exists(taken, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    rows = F.transform(F.filter(F.col("c"), free), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), kind(x).alias("kind"), F.array(*votes(kind(x), x["m"], x["before"], x["after"])).alias("v"), F.array(*looks(x["m"], x["before"])).alias("w")))
    return df.select(*[c for c in df.columns if c != "c"], rows.alias("found"))


Votes = tuple[int, ...]
#: (kind, votes, looks) -> how many spans
Patterns = dict[tuple[str, Votes, Votes], int]


def estimated(patterns: dict[tuple[str, Votes], int], rounds: int = 60) -> dict[tuple[str, Votes], float]:
    """How likely each pattern of votes is right, by expectation-maximisation over labelers that err independently, each with a reliability of its own for each kind.

    Starts from the votes for, less those against; a small prior says labelers are right more often than not, which keeps
    the classes from changing places."""
    right = {x: min(0.95, max(0.05, 0.5 + sum(x[1]) / (2 * len(LABELERS)))) for x in patterns}
    for kind in {k for k, _ in patterns}:
        own = {x: n for x, n in patterns.items() if x[0] == kind}
        for _ in range(rounds):
            share = (sum(n * right[x] for x, n in own.items()) + 1.0) / (sum(own.values()) + 2.0)
            says: list[dict[tuple[int, int], float]] = []
            for k in range(len(LABELERS)):
                t = {(y, v): (3.0 if (v == 1) == bool(y) and v else 1.0) for y in (0, 1) for v in (-1, 0, 1)}
                for x, n in own.items():
                    t[1, x[1][k]] += n * right[x]
                    t[0, x[1][k]] += n * (1 - right[x])
                says.append({(y, v): c / sum(t[y, w] for w in (-1, 0, 1)) for (y, v), c in t.items()})
            for x in own:
                z = math.log(share / (1 - share)) + sum(math.log(says[k][1, v] / says[k][0, v]) for k, v in enumerate(x[1]))
                right[x] = 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
    return right


#: Weights of a classifier: for each kind, of its looks and of its votes by place and value, and a bias.
Weights = dict[tuple[str, str, int, int], float]


def parts_of(kind: str, vs: Votes, ws: Votes) -> list[tuple[str, str, int, int]]:
    """What a span has a weight for."""
    return [(kind, "bias", 0, 0), *[(kind, "look", i, w) for i, w in enumerate(ws)], *[(kind, "vote", i, v) for i, v in enumerate(vs)]]


def trained(patterns: Patterns, steps: int = 400) -> Weights:
    """The span classifier: a logistic regression for each kind on estimated labels."""
    by_votes: dict[tuple[str, Votes], int] = {}
    for (kind, vs, _), n in patterns.items():
        by_votes[kind, vs] = by_votes.get((kind, vs), 0) + n
    right = estimated(by_votes)
    weights: Weights = {}
    totals: dict[str, int] = {}
    for (kind, _, _), n in patterns.items():
        totals[kind] = totals.get(kind, 0) + n
    cases = [(n / totals[kind], right[kind, vs], parts_of(kind, vs, ws)) for (kind, vs, ws), n in sorted(patterns.items())]
    for _ in range(steps):
        slope: Weights = {}
        for share, y, parts in cases:
            z = sum(weights.get(p, 0.0) for p in parts)
            miss = share * (1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) - y)
            for p in parts:
                slope[p] = slope.get(p, 0.0) + miss
        for p, g in slope.items():
            weights[p] = weights.get(p, 0.0) - 0.3 * (g + 1e-3 * weights.get(p, 0.0))
    return weights


def span_patterns(df: DataFrame) -> Patterns:
    """Counts over all documents of the candidates' kinds, votes and looks: at most 6 x 3 ** 7 x 720 rows, in practice hundreds."""
    rows = df.select(F.explode("found").alias("x")).groupBy(F.col("x.kind").alias("kind"), F.col("x.v").alias("v"), F.col("x.w").alias("w")).agg(F.count("*").alias("n")).collect()
    return {(r["kind"], tuple(r["v"]), tuple(r["w"])): r["n"] for r in sorted(rows)}


def score(weights: Weights, x: Column) -> Column:
    """Log odds of a candidate by its kind, votes and looks."""

    def of(kind: str) -> Column:
        one = lambda what, i, value: weights.get((kind, what, i, value), 0.0)
        z = F.lit(one("bias", 0, 0))
        for i in range(len(LABELERS)):
            z = z + F.element_at(F.array(*[F.lit(one("vote", i, v)) for v in (-1, 0, 1)]), x["v"][i] + 2)
        for i, classes in enumerate(LOOKS.values()):
            z = z + F.element_at(F.array(*[F.lit(one("look", i, w)) for w in range(classes)]), x["w"][i] + 1)
        return z

    return F.coalesce(*[F.when(x["kind"] == k, of(k)) for k in ADDED])


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added)."""
    spark = docs.sparkSession
    path = scratch(spark, "pii")
    candidates(base_spans(docs)).select("id", *BASE, "found").write.parquet(path)
    df = spark.read.parquet(path)
    weights = trained(span_patterns(df))
    number = {k: r for r, k in enumerate([*BASE, *ADDED])}
    rank = lambda kind: F.coalesce(*[F.when(kind == k, number[k]) for k in ADDED])
    more = F.coalesce(F.transform(F.filter(F.col("found"), lambda x: score(weights, x) >= 0), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), rank(x["kind"]).alias("r"))), F.array().cast(_SPAN))
    names = F.array(*[F.lit(k) for k in number])
    # by start, then kind as listed
    ordered = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["r"].alias("r"), x["e"].alias("e")))), lambda x: F.concat_ws(":", F.element_at(names, x["r"] + 1), x["s"].cast("string"), x["e"].cast("string")))
    df = df.select("id", *BASE, F.concat(*[F.col(k) for k in BASE]).alias("base"), more.alias("more"))
    return df.select(F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE], F.sha2(F.array_join(ordered(F.col("base")), ","), 256).alias("base_sha256"), F.array_join(ordered(F.concat("base", "more")), ",").alias("spans"))
