"""Line deduplication by distinct-site spread.

A line's spread is the number of sites (sources) that have it. HyperLogLog sketches of sites per line hash are merged by
aggregation, so a line costs one small sketch a task however often it occurs. Lines whose estimate is near the
threshold get an exact distinct count; lines clearly over it are boilerplate as they are. A boilerplate line stays where
it comes first (smallest doc_id, then place) and goes everywhere else.

Only built-in functions are used. Line hashes have 128 bits; texts are split, never shuffled as lines. A line's rows
are combined before they are dealt by it: exact counts are over different (line, site), and lines with many rows meet
their place by broadcast, so that no task gets all rows of a line. Taking lines out of a text takes time in proportion.

Defined results: lines are parts between newlines, without spaces, tabs and returns at their ends; lines of fewer than
``WORDS`` words are too short to tell and stay; a null source is a site of its own; null texts stay null and have no
lines; rows that are equal in doc_id and text are treated alike; null doc_ids come last in the order of places; an
empty table gives an empty result. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import BROADCAST_ROWS, WORD, cut, packed, unpacked

SITES = 2
WORDS = 3
#: Estimates within this share of the threshold are counted exactly; sketches of 2 ** LG buckets err by about 2 %.
NEAR = 0.25
LG = 11
#: A line with more rows is a hot one: there is at most one in so many rows.
HOT = 1000
#: Where hot lines are too many for a broadcast, the rows of each go to so many tasks.
SALTS = 16


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def row_key(doc_id: Column, text: Column) -> Column:
    return F.struct(doc_id.alias("id"), F.xxhash64(text).alias("h"))


def _lines(docs: DataFrame, words: int) -> DataFrame:
    """key, site, pos, a, b (hash) of each line that is long enough."""
    row, at = packed(docs)
    # the key hashes the whole text: below the explode, once a text
    texts = row.select(row_key(at["doc_id"], at["text"]).alias("key"), F.coalesce(F.concat(F.lit("s"), at["source"]), F.lit("none")).alias("site"), at["text"].alias("text"))
    own = texts.select("key", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = own.select("key", "site", "pos", trimmed(F.col("line")).alias("line"))
    return line.filter(F.col("line").rlike(rf"(?:{WORD}[\x20\x09-\x0D]+){{{words - 1}}}{WORD}")).select("key", "site", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def _first() -> Column:
    return F.min(F.struct(F.col("key.id").isNull().alias("none"), F.col("key"), F.col("pos"))).alias("first")


def boilerplate(docs: DataFrame, sites: int = SITES, words: int = WORDS, near: float = NEAR) -> DataFrame:
    """(a, b, n, first): hashes of lines on at least ``sites`` sites, how often they occur, and where they come first."""
    lines = _lines(docs, words)
    spread = lines.groupBy("a", "b").agg(F.hll_sketch_agg("site", F.lit(LG)).alias("s"), F.count("*").alias("n"), _first()).filter("n > 1").select("a", "b", "n", "first", F.hll_sketch_estimate("s").alias("est"))
    told = cut(spread.filter(F.col("est") >= sites * (1 - near)))
    clear = told.filter(F.col("est") > sites * (1 + near)).select("a", "b", "n", "first")
    close = told.filter(F.col("est") <= sites * (1 + near)).select(F.col("a").alias("a2"), F.col("b").alias("b2"), "n", "first")
    same = (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2"))
    few = close.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    keys, on = close.select("a2", "b2"), lines.select("a", "b", "site")
    pairs = on.join(F.broadcast(keys), same, "left_semi").distinct() if few else on.distinct().join(keys, same, "left_semi")
    exact = pairs.groupBy("a", "b").agg(F.count("*").alias("exact")).filter(F.col("exact") >= sites)
    return cut(clear.unionByName(exact.join(close, same).select("a", "b", "n", "first")))


def dropped_lines(docs: DataFrame, sites: int = SITES, words: int = WORDS) -> DataFrame:
    """(key, drop): the places of the lines that go, for documents that have any."""
    found = boilerplate(docs, sites, words)
    at = lambda d, i, name: d.select(F.col("a").alias(f"a{i}"), F.col("b").alias(f"b{i}"), F.col("first").alias(name))
    lines = _lines(docs, words).select("key", "pos", "a", "b")
    hot = cut(at(found.filter(F.col("n") > HOT), 3, "hot"))
    same = (F.col("a") == F.col("a3")) & (F.col("b") == F.col("b3"))
    if many := hot.limit(BROADCAST_ROWS + 1).count():
        if many <= BROADCAST_ROWS:
            met = lines.join(F.broadcast(hot), same, "left")
        else:  # each of too many hot lines in SALTS tasks
            salted = hot.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            met = lines.withColumn("salt", F.pmod(F.xxhash64("key", "pos"), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("salt") == F.col("s")), "left")
        lines = met.select("key", "pos", "a", "b", "hot")
        # a hot line has its place already: it meets nothing, and is dealt by its own place
        free = F.col("hot").isNull()
        lines = lines.withColumn("a", F.when(free, F.col("a")).otherwise(F.xxhash64("key", "pos")))
        rest = at(found.filter(F.col("n") <= HOT), 2, "first")
        hits = lines.join(rest, (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")) & free, "left").withColumn("first", F.coalesce("hot", "first")).filter(F.col("first").isNotNull())
    else:
        hits = lines.join(at(found, 2, "first"), (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")))
    later = hits.filter(~(F.col("key").eqNullSafe(F.col("first.key")) & (F.col("pos") == F.col("first.pos"))))
    return later.groupBy("key").agg(F.collect_set("pos").alias("drop"))


def without(text: Column, drop: Column) -> Column:
    """A text less the lines at some places. Lines and places are bound once: a lambda would split the text for each line."""
    lines = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    both = F.array(F.struct(lines.alias("lines"), left.alias("left")))
    return F.element_at(F.transform(both, lambda x: F.array_join(F.transform(x["left"], lambda i: F.get(x["lines"], i)), "\n")), 1)


def _with_drops(docs: DataFrame, sites: int, words: int) -> tuple[DataFrame, Column, Column]:
    row, at = packed(docs)
    # the key's own columns, null-safe: ids may be null
    drops = dropped_lines(docs, sites, words).select(F.col("key.id").alias("id2"), F.col("key.h").alias("h2"), "drop")
    both = row.join(drops, at["doc_id"].eqNullSafe(F.col("id2")) & (F.xxhash64(at["text"]) == F.col("h2")), "left")
    return both, at["text"], F.when(F.col("drop").isNull(), at["text"]).otherwise(without(at["text"], F.col("drop")))


def dedup_lines(docs: DataFrame, sites: int = SITES, words: int = WORDS) -> DataFrame:
    """``docs`` with cross-site boilerplate lines taken out of ``text`` (and ``n_chars``, if there is one, brought up to date)."""
    both, _, text = _with_drops(docs, sites, words)
    more = {"n_chars": F.when(F.col("drop").isNull(), F.col(f"row.c{docs.columns.index('n_chars')}")).otherwise(F.length(text)).cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in docs.columns else {}
    return unpacked(both, docs.columns, text=text, **more)


def line_report(docs: DataFrame, sites: int = SITES, words: int = WORDS) -> DataFrame:
    """doc_id, n_lines, n_dropped, text_sha256 (of the text that is left; null for null) of every row."""
    both, was, text = _with_drops(docs, sites, words)
    at = docs.columns.index("doc_id")
    return both.select(F.col(f"row.c{at}").alias("doc_id"), F.when(was.isNull(), 0).otherwise(F.size(F.split(was, "\n"))).cast("long").alias("n_lines"), F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"), F.sha2(text, 256).alias("text_sha256"))
