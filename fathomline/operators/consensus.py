"""Sample consensus and robust fits as aggregation.

Hypotheses are drawn first: from at most ``SAMPLE`` rows of each group (the least by a hash), so many for each group that a
row holds them. All rows are then scored against the hypotheses of their group, with sums that combine before the shuffle, and
robust fits repeat weighted sums; so a group may hold any share of the rows, and none is ever held by one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.shared import cut

SAMPLE = 256
XYZ = ("x", "y", "z")
PAIRS = [(p, q) for i, p in enumerate(XYZ) for q in XYZ[i:]]


def matched(rows: DataFrame, groups: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the columns of their group; null keys are a group of their own."""
    keys = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(by)])
    right = groups.select(keys.alias("_right"), *[c for c in groups.columns if c not in by])
    return rows.withColumn("_left", keys).join(right, F.col("_left").eqNullSafe(F.col("_right")), how).drop("_left", "_right")


def drawn(rows: DataFrame, by: Sequence[str], cols: Sequence[str], seed: int) -> DataFrame:
    """by..., sample: at most SAMPLE rows of each group as structs, in an order that their values alone decide."""
    order = [F.xxhash64(F.lit(seed), *cols), *cols]
    n = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    few = rows.select(*by, *cols).withColumn("_n", n).filter(F.col("_n") <= SAMPLE)
    return few.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_n", *cols))).alias("sample"))


# -- planes


def plane_of_sums(*sums: pd.Series) -> pd.DataFrame:
    """Unit normal and offset of the plane of least weighted squares: from the weight, three sums and six sums of products."""
    m = np.stack([s.to_numpy(float) for s in sums], axis=1)
    w = np.where(m[:, 0] > 0, m[:, 0], np.nan)
    mean = m[:, 1:4] / w[:, None]
    cov = np.empty((len(m), 3, 3))
    for n, (p, q) in enumerate(PAIRS):
        i, j = XYZ.index(p), XYZ.index(q)
        cov[:, i, j] = cov[:, j, i] = m[:, 4 + n] / w - mean[:, i] * mean[:, j]
    normal = np.full((len(m), 3), np.nan)
    ok = np.isfinite(cov).all(axis=(1, 2))
    normal[ok] = np.linalg.eigh(cov[ok])[1][:, :, 0]
    lead = np.argmax(np.abs(np.nan_to_num(normal)), axis=1)
    normal *= np.where(normal[np.arange(len(m)), lead] > 0, 1, -1)[:, None]
    return pd.DataFrame(np.column_stack([normal, -(normal * mean).sum(axis=1)]), columns=["a", "b", "c", "d"])


def robust_planes(points: DataFrame, by: Sequence[str], rounds: int = 50, enough: float = 1e-9) -> DataFrame:
    """by..., a, b, c, d: planes with a soft-L1 loss, by weighted sums that are repeated until no plane moves."""
    by, fitted = list(by), F.pandas_udf(plane_of_sums, "a double, b double, c double, d double")
    centre = cut(points.groupBy(*by).agg(*[F.avg(c).alias(f"m{c}") for c in XYZ]))
    local = cut(matched(points.select(*by, *XYZ), centre, by).select(*by, *[(F.col(c) - F.col(f"m{c}")).alias(c) for c in XYZ]))
    weight, planes = F.lit(1.0), None
    for _ in range(rounds):
        weighted = (local if planes is None else matched(local, planes, by)).withColumn("w", weight)
        sums = weighted.groupBy(*by).agg(F.sum("w").alias("s0"), *[F.sum(F.col("w") * F.col(c)).alias(f"s{c}") for c in XYZ], *[F.sum(F.col("w") * F.col(p) * F.col(q)).alias(f"s{p}{q}") for p, q in PAIRS])
        new = cut(sums.select(*by, fitted("s0", *[f"s{c}" for c in XYZ], *[f"s{p}{q}" for p, q in PAIRS]).alias("p")).select(*by, "p.*"))
        weight = 1 / F.sqrt(1 + (F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("c") * F.col("z") + F.col("d")) ** 2)
        if planes is not None:
            both = matched(new, planes.withColumnsRenamed({c: f"_{c}" for c in "abcd"}), by)
            if (both.agg(F.max(F.greatest(*[F.abs(F.col(c) - F.col(f"_{c}")) for c in "abcd"]))).first()[0] or 0.0) < enough:
                planes = new
                break
        planes = new
    shift = F.col("d") - F.col("a") * F.col("mx") - F.col("b") * F.col("my") - F.col("c") * F.col("mz")
    return matched(planes, centre, by).select(*by, "a", "b", "c", shift.alias("d"))


def off_plane(plane: str = "") -> Column:
    a, b, c, d = (F.col(f"{plane}{k}") for k in "abcd")
    return F.abs(a * F.col("x") + b * F.col("y") + c * F.col("z") + d)


def planes_with_inliers(points: DataFrame, by: Sequence[str], inlier: float) -> DataFrame:
    """by..., a, b, c, d, inliers: robust planes and how many points are within ``inlier`` of them."""
    by = list(by)
    return matched(points.select(*by, *XYZ), robust_planes(points, by), by).groupBy(*by, *"abcd").agg(F.count_if(off_plane() < inlier).alias("inliers"))


def planes_of_triples(sample: DataFrame, by: Sequence[str], rounds: int, seed: int) -> DataFrame:
    """by..., planes: unit normals and offsets of planes through random triples of each sample; triples on a line have none."""

    @F.pandas_udf("array<struct<a: double, b: double, c: double, d: double>>")
    def through(points: pd.Series) -> pd.Series:
        out = []
        for s in points:
            xyz = np.array([[p["x"], p["y"], p["z"]] for p in s])
            rng, found = np.random.default_rng(seed), []
            for _ in range(rounds if len(xyz) >= 3 else 0):
                p, q, r = xyz[rng.choice(len(xyz), 3, replace=False)]
                n = np.cross(q - p, r - p)
                if (size := np.linalg.norm(n)) > 1e-12:
                    n = n / size
                    found.append(dict(zip("abcd", [*n.tolist(), float(-n @ p)], strict=True)))
            out.append(found)
        return pd.Series(out)

    return sample.select(*by, through("sample").alias("planes"))


def consensus_planes(points: DataFrame, by: Sequence[str], inlier: float, rounds: int, seed: int = 0) -> DataFrame:
    """by..., a, b, c, d, inliers: the plane through a triple that most points are within ``inlier`` of, fitted again to these
    (to all points where no triple has three)."""
    by = list(by)
    points = points.select(*by, *[F.col(c).cast("double").alias(c) for c in XYZ])
    tried = cut(planes_of_triples(drawn(points, by, XYZ, seed), by, rounds, seed))
    scored = matched(points, tried, by).select(*by, *XYZ, F.posexplode("planes").alias("n", "p")).withColumns({c: F.col(f"p.{c}") for c in "abcd"})
    counts = scored.groupBy(*by, "n", *"abcd").agg(F.count_if(off_plane() < inlier).alias("near"))
    best = counts.groupBy(*by).agg(F.max_by(F.struct(*"abcd", "near"), F.struct("near", -F.col("n"))).alias("best"))
    every = cut(matched(points.select(*by).distinct(), best, by).select(*by, "best.*").unionByName(tried.filter(F.size("planes") == 0).select(*by, *[F.lit(None).cast("double").alias(c) for c in "abcd"], F.lit(0).cast("long").alias("near"))))
    chosen = matched(points, every, by).filter((F.col("near") < 3) | (off_plane() < inlier)).select(*by, *XYZ)
    return matched(robust_planes(chosen, by), every.select(*by, F.col("near").alias("inliers")), by)


# -- means


def consensus_means(rows: DataFrame, by: Sequence[str], value: str, threshold: float, rounds: int, size: int, seed: int, signed: bool) -> DataFrame:
    """by..., mean, std, n of the values near the best of ``rounds`` means of ``size`` drawn values; of all where none has one near.

    signed: the best has the least sum of residuals, sign and all; else the least mean distance."""
    by = list(by)
    rows = rows.select(*by, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))

    @F.pandas_udf("array<double>")
    def guesses(sample: pd.Series) -> pd.Series:
        out = []
        for s in sample:
            v = np.sort([x["v"] for x in s])
            out.append(np.unique(v[np.random.default_rng(seed).integers(0, len(v), (rounds, size))].mean(axis=1)))
        return pd.Series(out)

    tried = cut(drawn(rows, by, ["v"], seed).select(*by, guesses("sample").alias("_guess")))
    near = matched(rows, tried, by).select(*by, "v", F.explode("_guess").alias("_guess")).filter(F.abs(F.col("v") - F.col("_guess")) < threshold)
    miss = F.sum(F.col("v") - F.col("_guess")) if signed else F.avg(F.abs(F.col("v") - F.col("_guess")))
    best = cut(near.groupBy(*by, "_guess").agg(miss.alias("miss")).groupBy(*by).agg(F.min(F.struct("miss", "_guess")).alias("best")).select(*by, F.col("best._guess").alias("_guess")))
    chosen = matched(rows, best, by, "left").filter(F.col("_guess").isNull() | (F.abs(F.col("v") - F.col("_guess")) < threshold))
    return chosen.groupBy(*by).agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("*").alias("n"))


# -- triples far apart


def planes_of_far_triples(points: DataFrame, key: str, least: float, planes: int, min_sine: float, seed: int, batch: int, most: int) -> DataFrame:
    """a, b, c, d of ``planes`` planes through random triples of points whose places in y and z are ``least`` apart and whose
    angle there has a sine of ``min_sine`` or more.

    Points are dealt by a hash to as many places as there are triples; the first three of a place are a triple, so that every
    point of a cloud of any size may be drawn. Rounds of about ``batch`` dealt points go on until there are enough planes; after
    ``most`` triples without that, or when a cloud has hardly a triple that wasn't tried, it is an error."""
    cloud = cut(points.select(F.col(key).alias("k"), *[F.col(c).cast("double").alias(c) for c in XYZ]))
    n = cloud.count()
    every = n * (n - 1) * (n - 2) // 6
    found: list[DataFrame] = []
    have = tried = turn = 0
    while have < planes:
        if not every or tried > most or (not have and tried > 20 * every + 1000):
            raise ValueError(f"{have} of {planes} planes found in {tried} triples: the points are too close or too much in line")
        repeats = max(1, -(-min(batch, 4 * 3 * planes * 4 ** min(turn, 12)) // n))
        rows = cloud.withColumn("turn", F.explode(F.sequence(F.lit(turn * 1_000_000), F.lit(turn * 1_000_000 + repeats - 1))))
        hashed = F.xxhash64(F.lit(seed), "turn", "k")
        dealt = rows.withColumn("place", F.pmod(hashed, F.lit(max(1, n // 3)))).withColumn("h", F.xxhash64(hashed))
        at = lambda c, i: F.col(f"s.{c}")[i]
        # a place has three points on average: its list is short
        three = dealt.groupBy("turn", "place").agg(F.array_sort(F.collect_list(F.struct("h", "k", *XYZ))).alias("s")).filter(F.size("s") >= 3)
        y, z = ([at(c, i) for i in range(3)] for c in ("y", "z"))
        far = lambda i, j: F.hypot(y[j] - y[i], z[j] - z[i])
        sine = F.abs((y[1] - y[0]) * (z[2] - z[0]) - (z[1] - z[0]) * (y[2] - y[0]))
        good = three.filter((F.least(far(0, 1), far(0, 2), far(1, 2)) >= least) & (far(0, 1) > 0) & (far(0, 2) > 0) & (sine >= min_sine * far(0, 1) * far(0, 2)))
        marked = cut(three.agg(F.count("*").alias("n")))
        some = cut(good.select("turn", "place", F.slice("s", 1, 3).alias("s")).orderBy("turn", "place").limit(planes - have))
        tried += marked.first()[0]
        have += some.count()
        found.append(some)
        turn += 1
    u, v = ([at(c, i) - at(c, 0) for c in XYZ] for i in (1, 2))
    normal = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
    size = F.sqrt(normal[0] ** 2 + normal[1] ** 2 + normal[2] ** 2)
    unit = reduce(DataFrame.unionByName, found).select(*[(c / size).alias(k) for c, k in zip(normal, "abc", strict=True)], *[at(c, 0).alias(c) for c in XYZ])
    return unit.select(*"abc", (-(F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("c") * F.col("z"))).alias("d"))
