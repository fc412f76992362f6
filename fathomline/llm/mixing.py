"""Mixing sources to target weights by Pareto order sampling.

A source's target is a number of words. Each of its documents is due ``rate`` copies on average: in proportion to its
importance, up to the cap, such that all of them make up the target. A document's importance is the number of binary
digits of its size, so that longer ones are likelier, but not by their length; any column may be given instead. The whole
part of the rate is taken for certain, and of the rest a sample of a fixed size in words is drawn, with unequal
probabilities: documents are ranked by their random odds divided by their inclusion odds, and taken in that order until
the source's words are used up; one last document, the one whose size is nearest to the words that are left, closes the
gap.

No source is ever gathered in one task. Ranks are cut in equal slices per source; the slices' words are summed, the
slice that holds the cut is found from those sums, and only that slice's documents (about the square root of the
table) are ordered.

Defined results: a null text has size 0; a null source is a source of its own, last in the order of weights; documents
of size 0 take part and take 0 words; importances that are null count as 1, those under 0 as 0; rows that are equal in id (or, with null ids, in text) are drawn together;
an empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.llm.common import WORD, cut, packed, small_or_not, unpacked

SEED = "fathomline-mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_key(doc_id: Column, text: Column, seed: str) -> Column:
    """32 hex digits that depend on nothing but the seed and the row's id (its text, if it has no id)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text|"), F.md5(F.coalesce(text, F.lit("")))))))


def uniform(key: Column) -> Column:
    """Strictly between 0 and 1, from the first 52 bits."""
    return (F.conv(F.substring(key, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """source, source_size, target from (source, source_size): shares by weight; what exceeds cap x size is shared anew.

    The water level rises until nothing is above its cap: a source gets its weight times the level, or its cap."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = cut(sizes.withColumn("n", F.row_number().over(order) - 1).select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")).alias("w"),
        (F.col("source_size") * F.lit(float(cap))).alias("most")))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("most") <= F.col("w") * F.lit(level)
        used, free = s.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if not free or (level is not None and (total - used) / free <= level):
            break
        level = (total - used) / free
    share = F.col("most") if level is None else F.least(F.col("most"), F.col("w") * F.lit(level))
    return s.select("source", "source_size", share.alias("target"))


def size_class(size: Column) -> Column:
    """The number of binary digits of a size."""
    return F.length(F.bin(size)).cast("double")


def document_rates(light: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """source -> k such that documents due min(cap, k x importance) copies make up the source's target.

    k rises from 0; each step shares what documents at the cap leave of the target. Sums are taken once for each source
    and importance."""
    mass = cut(light.groupBy(F.col("source").alias("s"), "importance").agg(F.sum("size").alias("size")))
    full = F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-12))
    k = cut(targets.select("source", "target", "source_size", F.lit(0.0).alias("k")))
    while True:
        at_cap = F.col("importance") * F.col("k") >= cap
        parts = mass.join(small_or_not(k), F.col("s").eqNullSafe(F.col("source"))).groupBy("source", "target", "source_size").agg(
            F.sum(F.when(at_cap, F.col("size") * cap).otherwise(0.0)).alias("used"), F.sum(F.when(at_cap, 0.0).otherwise(F.col("size") * F.col("importance"))).alias("free"), F.max("k").alias("was"))
        new = cut(parts.select("source", "target", "source_size", "was", F.when(F.col("free") > 0, F.greatest(F.col("was"), (F.col("target") - F.col("used")) / F.col("free"))).otherwise(F.col("was")).alias("k")))
        k = new.drop("was")
        if not new.filter(F.col("k") > F.col("was") * (1 + 1e-12)).limit(1).count():
            # a source that is wanted to the cap takes all its documents so often, whatever their importance
            return k.select("source", F.when(full & (F.col("source_size") > 0), F.lit(float("inf"))).otherwise(F.col("k")).alias("k"))


def weight_of(size: Column, given: Column | None) -> Column:
    """Importance: by size, or as given."""
    return size_class(size) if given is None else F.greatest(F.lit(0.0), F.coalesce(given.cast("double"), F.lit(1.0)))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: str = SEED, importance: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(light rows: id, source, size, key, importance; per source: source_size, target, k, cut, odd one).

    Sizes and keys come from one pass over the texts; all else reads those light rows."""
    row, at = packed(docs)
    sized = row.select(at["doc_id"].alias("doc_id"), at["source"].alias("source"), word_count(at["text"]).alias("size"), draw_key(at["doc_id"], at["text"], seed).alias("key"), *([] if importance is None else [at[importance].alias("given")]))
    light = cut(sized.select("doc_id", "source", "size", "key", weight_of(F.col("size"), None if importance is None else F.col("given")).alias("importance")))
    targets = cut(source_targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap))
    k = cut(document_rates(light, targets, cap))
    base = cut(targets.join(k.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select("source", "source_size", "target", "k"))
    slices = int(max(16, light.count() ** 0.5))
    ranked = light.join(small_or_not(base.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))).select("source", "size", "key", "target", *due(cap))
    whole = ranked.withColumn("slice", F.floor(F.col("rank") / (1 + F.col("rank")) * slices))
    sums = cut(whole.groupBy("source", "slice").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"), F.sum(F.when(F.col("part") > 0, F.col("size")).otherwise(0)).alias("words"), F.max("target").alias("target")))
    of = W.partitionBy("source")
    left = sums.withColumn("left", F.col("target") - F.sum("sure").over(of)).withColumn("upto", F.sum("words").over(of.orderBy("slice").rowsBetween(W.unboundedPreceding, 0)))
    cross = cut(left.filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left"))).groupBy("source").agg(F.min("slice").alias("slice"), F.min("left").alias("left"), F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("before"))).alias("b")).select(F.col("source").alias("s"), F.col("slice").alias("at"), "left", F.col("b.before").alias("before")))
    mark = F.struct(F.col("rank"), F.col("key"))
    near = whole.filter(F.col("part") > 0).join(small_or_not(cross), F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("at")))
    # equal marks are peers of a RANGE frame: they are taken together or not at all
    run = near.select("s", "left", (F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("rank", "key"))).alias("upto"), mark.alias("mark"))
    last = cut(cross.join(run.filter(F.col("upto") <= F.col("left")).groupBy(F.col("s").alias("r")).agg(F.max("mark").alias("mark"), F.max("upto").alias("upto")), F.col("s").eqNullSafe(F.col("r")), "left").select("s", "at", "mark", (F.col("left") - F.coalesce(F.col("upto"), F.col("before"))).alias("gap")))
    past = (F.col("slice") > F.col("at")) | (F.col("slice") == F.col("at")) & (F.col("mark").isNull() | (mark > F.col("mark")))
    fits = whole.filter(F.col("part") > 0).join(small_or_not(last), F.col("source").eqNullSafe(F.col("s"))).filter(past & (F.col("size") > 0) & (F.abs(F.col("gap") - F.col("size")) < F.col("gap")))
    odd = cut(fits.groupBy(F.col("s").alias("o")).agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), mark.alias("mark"))).alias("odd")).select("o", "odd.mark.key"))
    cuts = last.join(odd, F.col("s").eqNullSafe(F.col("o")), "left").select("s", F.col("at"), F.col("mark").alias("cut"), F.col("key").alias("odd"))
    per_source = base.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "k", F.col("at").alias("cut_slice"), "cut", "odd", F.lit(slices).alias("slices"))
    return light, cut(per_source)


def due(cap: float) -> list[Column]:
    """whole: certain copies; part: what is left of the copies that are due; rank: random odds over inclusion odds."""
    rate = F.when(F.col("importance") > 0, F.least(F.lit(float(cap)), F.col("k") * F.col("importance"))).otherwise(0.0)
    part = rate - F.floor(rate)
    odds = uniform(F.col("key")) / (1 - uniform(F.col("key")))
    return [F.floor(rate).cast("long").alias("whole"), part.alias("part"), F.when(part > 0, odds / (part / (1 - part))).otherwise(F.lit(0.0)).alias("rank")]


def copies(cap: float = 3.0) -> Column:
    """A row's copies, from its key, importance and its source's row of ``plan_mix``; decided where the row is."""
    whole, part, rank = due(cap)
    slice_ = F.floor(rank / (1 + rank) * F.col("slices"))
    mark = F.struct(rank.alias("rank"), F.col("key").alias("key"))
    drawn = F.col("cut_slice").isNull() | (slice_ < F.col("cut_slice")) | ((slice_ == F.col("cut_slice")) & F.coalesce(mark <= F.col("cut"), F.lit(False))) | F.coalesce(F.col("key") == F.col("odd"), F.lit(False))
    return whole + F.when((part > 0) & drawn, 1).otherwise(0)


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: str = SEED, importance: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    light, per_source = plan_mix(docs, weights, cap, seed, importance)
    both = light.join(small_or_not(per_source.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s")))
    return both.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (copies(cap) * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: str = SEED, importance: str | None = None) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, with the columns of ``docs``. Texts aren't shuffled."""
    _, per_source = plan_mix(docs, weights, cap, seed, importance)
    row, at = packed(docs)
    keyed = row.select("row", at["source"].alias("source"), draw_key(at["doc_id"], at["text"], seed).alias("key"), weight_of(word_count(at["text"]), None if importance is None else at[importance]).alias("importance"))
    both = keyed.join(small_or_not(per_source.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s")))
    taken = both.select("row", copies(cap).cast("int").alias("n")).filter("n > 0")
    return unpacked(taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("n"))).alias("again")), docs.columns)
