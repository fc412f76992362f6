"""Source divergence audit: how far the words of each source are from those of the other sources of its language.

Words are counted once, combined in the tasks before the shuffle. A language keeps the terms of at least ``LEAST`` of its
documents; with smoothed shares p of kept terms (whole numbers, parts of ``UNIT``) two groups (language and source) differ by
the sum of f(p, q) = (p - q)^2 div (p + q) over all kept terms. The sum is split, exactly:

* Heavy terms, in more than ``LIGHT`` groups of the language, are dealt to tiles of about ``TERMS`` terms by ``GROUPS`` groups.
  Two tiles of the same terms meet once, as dense numpy matrices, and give the sums of all their pairs of groups.
* Light terms start from the sum as if no group had them, which needs only each group's share of an absent term. Then each
  group's own light terms are set right against absent ones, by a histogram of counts; and each pair of postings of a term
  (at most LIGHT of them) corrects what that got wrong for the pair.

A hot term, language or source has one row a task before the shuffle and one a (language, source, term) after it. What is
given back for pairs has a row for each ordered pair of sources of a language, as the audit asks for.

Defined results: null text, lang and source are ''; rows count once each, repeated or not; a group without terms takes part
with the share of absent terms; a language without kept terms has pairs of value 0 and no terms; equal values rank by
the UTF-8 bytes of the item; texts of any length are read whole; an empty table gives an empty result. Other columns don't
matter, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.llm.common import cut, picked, small_or_not, tidied

#: Fixed values of the audit: documents that a kept term is in, the unit of shares, what is added to counts.
LEAST, UNIT, ADDED = 10, 1_000_000_000, 2
#: Terms in more groups of their language are heavy.
LIGHT = 8
#: Terms and groups of a tile.
TERMS, GROUPS = 512, 256
#: Words that a task holds before it passes them on.
HELD = 1 << 18
#: Texts are read in pieces of about so many bytes; a word is never cut.
PIECE = 1 << 20

#: ASCII other than letters as spaces, A-Z as a-z; all bytes of other characters stay.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()


def words(text: str) -> Iterator[list[bytes]]:
    raw = text.encode("utf-8", "surrogatepass").translate(TERM_BYTES)
    at = 0
    while len(raw) - at > PIECE and (end := raw.find(b" ", at + PIECE)) >= 0:
        yield raw[at:end].split()
        at = end
    yield raw[at:].split()


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences of each term in a group and the documents there that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def passed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():
                if n:
                    term = pa.array(list(n), pa.binary()).cast(pa.string())
                    one = lambda s, m=len(n): pa.DictionaryArray.from_arrays(pa.array(np.zeros(m, np.int32)), pa.array([s])).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([one(lang), one(source), term, pa.array(list(n.values()), pa.int64()), pa.array([d[t] for t in n], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for b in batches:
            for text, lang, source in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                own: Counter = Counter()
                for part in words(text):
                    own.update(part)
                size -= len(n)
                n.update(own)
                d.update(own.keys())
                size += len(n)
                if size > HELD:
                    yield from passed()
                    size = 0
        yield from passed()

    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = picked(docs, text="text", lang="lang", source="source").select(empty("text"), empty("lang"), empty("source"))
    found = rows.mapInArrow(tidied(count), "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + ADDED) / (total + ADDED * kept)) without rounding; null where no term is kept."""
    whole = lambda c: c.cast("decimal(20,0)")
    parts = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * whole(n + ADDED), whole(total + ADDED * kept))
    return F.when(kept > 0, parts.cast("long") + 1)


def apart(p: Column, q: Column) -> Column:
    """f(p, q); shares are at most UNIT + 1, so that 64 bits hold it."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def tile(b: pa.RecordBatch, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, sum) over the terms of a tile for all pairs of its groups, a < b of the same tile or each a with each b of two."""
    n = b.column(0)[r].as_py()
    same = b.column(1)[r].as_py()
    sides = []
    for c in (2, 4):
        entries, groups = b.column(c)[r].values, b.column(c + 1)[r].values
        gid, base = (groups.field(k).to_numpy() for k in ("gid", "base"))
        by = np.argsort(gid)
        cells = [np.zeros(0, np.int64)] * 3 if entries is None else [entries.field(k).to_numpy() for k in ("gid", "tid", "p")]
        sides.append((gid[by], base[by], *cells))
    tids = np.unique(np.concatenate([s[3] for s in sides]))
    dense = []
    for gid, base, g, t, p in sides:
        m = np.repeat(base[:, None], len(tids), axis=1)
        m[np.searchsorted(gid, g), np.searchsorted(tids, t)] = p
        dense.append(m)
    rest = n - len(tids)  # terms of the tile that only groups elsewhere have
    out: list[tuple[np.ndarray, ...]] = []
    for i in range(len(sides[0][0])):
        j = slice(i + 1, None) if same else slice(None)
        other = sides[1][0][j]
        total = f(dense[0][i], dense[1][j]).sum(axis=1) + rest * f(sides[0][1][i], sides[1][1][j])
        out.append((np.full(len(other), sides[0][0][i]), other, total))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def dense_sums(heavy: DataFrame, groups: DataFrame) -> DataFrame:
    """a, b, value: sums over heavy terms for pairs of groups of a language, once each."""
    # tiles by counted terms and groups of a language
    terms = cut(heavy.select("lang", "tid").distinct().groupBy("lang").agg(F.count("*").alias("n_terms"), F.ceil(F.count("*") / TERMS).cast("long").alias("rows")))
    blocks = cut(groups.groupBy("lang").agg(F.ceil(F.count("*") / GROUPS).cast("long").alias("cols")))
    sizes = small_or_not(cut(terms.join(blocks, "lang")))
    col, row = F.pmod(F.xxhash64("gid"), F.col("cols")), F.pmod(F.xxhash64("tid"), F.col("rows"))
    members = cut(groups.join(sizes, "lang").withColumn("col", col).groupBy("lang", "col").agg(F.collect_list(F.struct("gid", "base")).alias("members")))
    dealt = cut(heavy.join(sizes, "lang").select("lang", row.alias("row"), col.alias("col"), "tid", "gid", "p"))
    n = dealt.select("lang", "row", "tid").distinct().groupBy("lang", "row").agg(F.count("*").alias("n"))
    parts = dealt.groupBy("lang", "row", "col").agg(F.collect_list(F.struct("gid", "tid", "p")).alias("entries"))
    # a tile without entries still has its groups' absent terms
    every = cut(n.join(members.select("lang", "col"), "lang").join(parts, ["lang", "row", "col"], "left"))
    whole = every.join(small_or_not(members), ["lang", "col"])
    left = whole.select("lang", "row", "col", "n", F.col("entries").alias("xe"), F.col("members").alias("xm"))
    right = whole.select(F.col("lang").alias("lang2"), F.col("row").alias("row2"), F.col("col").alias("col2"), F.col("entries").alias("ye"), F.col("members").alias("ym"))
    met = left.join(right, (F.col("lang") == F.col("lang2")) & (F.col("row") == F.col("row2")) & (F.col("col") <= F.col("col2"))).select("n", (F.col("col") == F.col("col2")).alias("same"), "xe", "xm", "ye", "ym")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in tile(b, r)], names=["a", "b", "value"])

    return met.mapInArrow(tidied(summed), "a long, b long, value long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value")


def posting_corrections(light: DataFrame) -> DataFrame:
    """a, b, value: for pairs of groups that share light terms, what those differ by from terms that one of the two lacks."""
    lists = light.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("gid", "p", "base"))).alias("at")).filter(F.size("at") > 1)  # at most LIGHT

    def corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column(0).value_lengths().to_numpy()
            flat = b.column(0).flatten()
            gid, p, base = (flat.field(k).to_numpy() for k in ("gid", "p", "base"))
            start = np.cumsum(sizes) - sizes
            found: list[tuple[np.ndarray, ...]] = []
            for i in range(LIGHT):
                for j in range(i + 1, LIGHT):
                    s = start[sizes > j]
                    x, y = s + i, s + j
                    found.append((gid[x], gid[y], f(p[x], p[y]) - f(p[x], base[y]) - f(base[x], p[y]) + f(base[x], base[y])))
            a, c, value = (np.concatenate(z) for z in zip(*found, strict=True))
            # combined here: a pair of groups shares many terms
            names, at = np.unique(np.stack([a, c]), axis=1, return_inverse=True)
            sums = np.zeros(names.shape[1], np.int64)
            np.add.at(sums, at.ravel(), value)
            yield pa.RecordBatch.from_arrays([pa.array(names[0]), pa.array(names[1]), pa.array(sums)], names=["a", "b", "value"])

    return lists.select("at").mapInArrow(tidied(corrected), "a long, b long, value long")


def divergence(docs: DataFrame, terms: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources of the language, furthest first, and a group's own ``terms``
    most telling terms."""
    counts = cut(counted(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.count("*").alias("held")).filter(F.col("docs") >= LEAST)
    kept = cut(kept.select("lang", "term", "lang_n", "held", F.monotonically_increasing_id().alias("tid")))
    by_lang = cut(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"), F.count_if(F.col("held") <= LIGHT).alias("n_light")))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    occurring = cut(picked(docs, lang="lang", source="source").select(empty("lang"), empty("source")).distinct().withColumn("gid", F.monotonically_increasing_id()))
    mine = cut(counts.join(kept, ["lang", "term"]).join(occurring, ["lang", "source"]).select("lang", "gid", "tid", "term", "n", "lang_n", "held"))
    totals = mine.groupBy("gid").agg(F.sum("n").alias("total"))
    v = F.coalesce("v", F.lit(0))
    groups = occurring.join(totals, "gid", "left").join(small_or_not(by_lang), "lang", "left").select(
        "lang", "source", "gid", F.coalesce("total", F.lit(0)).alias("total"), v.alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"), F.coalesce("n_light", F.lit(0)).alias("n_light"),
        share(F.lit(0), F.coalesce("total", F.lit(0)), v).alias("base"))
    groups = cut(groups)
    sized = small_or_not(groups.select("gid", "source", "total", "v", "lang_total", "base"))
    shares = cut(mine.join(sized, "gid").select("lang", "gid", "source", "tid", "term", "held", "base", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")))
    heavy, light = shares.filter(F.col("held") > LIGHT), shares.filter(F.col("held") <= LIGHT)
    both = cut(dense_sums(heavy.select("lang", "gid", "tid", "p"), groups.filter("v > 0").select("lang", "gid", "base")).unionByName(posting_corrections(light.select("tid", "gid", "p", "base"))).groupBy("a", "b").agg(F.sum("value").alias("value")))
    # a group's light terms by share: how many have it
    own = cut(light.groupBy("gid", "p").agg(F.count("*").alias("m")).groupBy("gid").agg(F.collect_list(F.struct("p", "m")).alias("own")))
    sides = cut(groups.join(own, "gid", "left").select("lang", "gid", "source", "v", "n_light", "base", "own"))
    x = sides.select("lang", F.col("gid").alias("a"), F.col("source").alias("a_source"), "v", "n_light", F.col("base").alias("a_base"), F.col("own").alias("a_own"))
    y = sides.select(F.col("lang").alias("lang2"), F.col("gid").alias("b"), F.col("source").alias("b_source"), F.col("base").alias("b_base"), F.col("own").alias("b_own"))
    absent = apart(F.col("a_base"), F.col("b_base"))
    against = lambda own, base: F.aggregate(F.coalesce(F.col(own), F.array().cast("array<struct<p:bigint,m:bigint>>")), F.lit(0).cast("long"), lambda s, e: s + e["m"] * (apart(e["p"], F.col(base)) - absent))
    sparse = F.when(F.col("v") > 0, F.col("n_light") * absent + against("a_own", "b_base") + against("b_own", "a_base")).otherwise(0)
    pairs = x.join(y, (F.col("lang") == F.col("lang2")) & (F.col("a") < F.col("b"))).select("lang", "a", "b", "a_source", "b_source", sparse.alias("sparse"))
    summed = cut(pairs.join(both, ["a", "b"], "left").select("lang", "a_source", "b_source", (F.col("sparse") + F.coalesce("value", F.lit(0))).alias("value")))
    one = lambda s, i: summed.select("lang", F.col(s).alias("source"), F.lit("pair").alias("part"), F.col(i).alias("item"), "value")
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = one("a_source", "b_source").unionByName(one("b_source", "a_source")).withColumn("rank", rank)
    telling = shares.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    return ranked.unionByName(telling.withColumn("rank", rank).filter(F.col("rank") <= terms))
