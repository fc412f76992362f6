"""Interpolating as-of joins.

All variants are one idea: queries and samples are brought together by one exchange on the group (a dive), and window
functions look back in ascending and in descending time; no frame looks ahead to the end of a partition, which Spark
would recompute per row. A dive is an ordered sequence, so its rows share a task; parallelism comes from dives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def linear(x: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Value at x of the line through two points (also outside them); y0 where the points share x."""
    return F.when(x1 == x0, y0).otherwise((y1 - y0) / (x1 - x0) * (x - x0) + y0)


def brackets(queries: DataFrame, samples: DataFrame, by: Sequence[str], t: str, cols: Sequence[str], extrapolate: bool = True, strict_low: bool = False) -> DataFrame:
    """``queries`` with structs lo and hi (t and ``cols`` of samples) around each row's time.

    lo is the last sample at or before (``strict_low``: before) the row, hi the first at or after it. With ``extrapolate``,
    rows before the first or after the last sample get the two nearest samples; else the missing side is null."""
    # both sides in one number of partitions, which adaptive execution leaves alone: a union keeps its inputs' partitioning (Spark
    # 4.1), so that the windows need no other exchange, but takes partitions side by side
    n = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    queries, samples = queries.repartition(n, *by), samples.repartition(n, *by)
    qcols = [c for c in queries.columns if c not in by and c != t]
    s = F.struct(F.col(t).alias("t"), *[F.col(c).alias(c) for c in cols])
    # each sample also carries its neighbours, for rows outside the samples
    w = W.partitionBy(*by).orderBy(t)
    near = samples.select(*by, t, s.alias("s")).select(*by, t, F.struct("s", F.lag("s").over(w).alias("before"), F.lead("s").over(w).alias("after")).alias("s"), F.lit(None).alias("q"))
    asked = queries.select(*by, t, F.struct(*[F.col(c) for c in qcols] or [F.lit(1).alias("_")]).alias("q"))
    u = asked.select(*by, t, F.lit(None).cast(near.schema["s"].dataType).alias("s"), "q", F.lit(1).alias("is_q")).unionByName(near.select(*by, t, "s", F.lit(None).cast(asked.schema["q"].dataType).alias("q"), F.lit(0).alias("is_q")))
    back = W.partitionBy(*by).orderBy(F.col(t), F.col("is_q").desc() if strict_low else F.col("is_q")).rowsBetween(W.unboundedPreceding, -1)
    ahead = W.partitionBy(*by).orderBy(F.col(t).desc(), F.col("is_q")).rowsBetween(W.unboundedPreceding, -1)
    found = u.withColumn("lo", F.last("s", ignorenulls=True).over(back)).withColumn("hi", F.last("s", ignorenulls=True).over(ahead)).filter("is_q = 1")
    if extrapolate:
        lo = F.coalesce(F.when(F.col("lo").isNotNull() & F.col("hi").isNull() & F.col("lo.before").isNotNull(), F.col("lo.before")), F.col("lo.s"), F.col("hi.s"))
        hi = F.coalesce(F.when(F.col("hi").isNotNull() & F.col("lo").isNull() & F.col("hi.after").isNotNull(), F.col("hi.after")), F.col("hi.s"), F.col("lo.s"))
    else:
        lo, hi = F.col("lo.s"), F.col("hi.s")
    return found.select(*by, t, *[F.col(f"q.{c}").alias(c) for c in qcols], lo.alias("lo"), hi.alias("hi"))


def interpolated(queries: DataFrame, samples: DataFrame, by: Sequence[str], t: str, cols: Sequence[str], yaw: Sequence[str] = (), extrapolate: bool = True) -> DataFrame:
    """``queries`` with ``cols`` of samples at their times; columns in ``yaw`` go the short way round."""
    from fathomline.functions.frames import yaw_between

    b = brackets(queries, samples, by, t, cols, extrapolate)
    at = lambda c: (F.col(t), F.col("lo.t"), F.col("hi.t"), F.col(f"lo.{c}"), F.col(f"hi.{c}"))
    inside = F.col("lo").isNotNull() & F.col("hi").isNotNull()
    out = [F.when(inside, (yaw_between if c in yaw else linear)(*at(c))).alias(c) for c in cols]
    return b.select(*[c for c in queries.columns if c not in cols], *out)


def forward_interpolated(queries: DataFrame, samples: DataFrame, by: Sequence[str], t: str, cols: Sequence[str]) -> DataFrame:
    """As ``interpolated``, but only for rows with a sample strictly before them and one at or after them."""
    b = brackets(queries, samples, by, t, cols, extrapolate=False, strict_low=True).filter(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    out = [linear(F.col(t), F.col("lo.t"), F.col("hi.t"), F.col(f"lo.{c}"), F.col(f"hi.{c}")).alias(c) for c in cols]
    return b.select(*[c for c in queries.columns if c not in cols], *out)


def next_observation(queries: DataFrame, samples: DataFrame, by: Sequence[str], t: str, cols: Sequence[str], clamp: bool = True) -> DataFrame:
    """``queries`` with ``cols`` of the first sample at or after each row; past the last one, the last (or null)."""
    b = brackets(queries, samples, by, t, cols, extrapolate=False)
    side = F.coalesce(F.col("hi"), F.col("lo")) if clamp else F.col("hi")
    return b.withColumn("s", side).select(*[c for c in queries.columns if c not in cols], F.col("s.t").alias("sample_t"), *[F.col(f"s.{c}").alias(c) for c in cols])


def last_observation(queries: DataFrame, samples: DataFrame, by: Sequence[str], t: str, cols: Sequence[str]) -> DataFrame:
    """``queries`` with ``cols`` of the last sample at or before each row."""
    b = brackets(queries, samples, by, t, cols, extrapolate=False)
    return b.select(*[c for c in queries.columns if c not in cols], F.col("lo.t").alias("sample_t"), *[F.col(f"lo.{c}").alias(c) for c in cols])


def piecewise_clock(queries: DataFrame, knots: DataFrame, by: Sequence[str], t: str) -> DataFrame:
    """Times on another clock: from the last knot (t, other, slope) at or before each row, else from the first."""
    b = brackets(queries, knots, by, t, ["other", "slope"], extrapolate=False).withColumn("k", F.coalesce("lo", "hi"))
    return b.select(*queries.columns, (F.col("k.other") + F.col("k.slope") * (F.col(t) - F.col("k.t"))).alias("corrected"))


def blended_covariance(x: Column, lo: Column, hi: Column) -> Column:
    """Elementwise convex blend of two structs' arrays ``covariance`` at x."""
    f = F.when(hi["t"] == lo["t"], 0.0).otherwise((x - lo["t"]) / (hi["t"] - lo["t"]))
    return F.zip_with(lo["covariance"], hi["covariance"], lambda a, b: a * (1 - f) + b * f)
