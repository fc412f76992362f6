"""Statistics over navigation and pixel tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from fathomline.operators import consensus
from fathomline.operators.interp import forward_interpolated
from fathomline.operators.windows import over, step_lengths


def mean_position(fixes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean fix and its distance from the origin; ``far`` beyond 10 km."""
    m = fixes.groupBy(*by).agg(F.avg("northings").alias("northings"), F.avg("eastings").alias("eastings"))
    d = F.sqrt(F.col("northings") ** 2 + F.col("eastings") ** 2)
    return m.withColumn("distance", d).withColumn("far", d > 10_000)


def mean_offset(track: DataFrame, fixes: DataFrame, by: Sequence[str], t: str, gap: float = 20.0) -> DataFrame:
    """Mean fix less mean track at the fixes' times, over fixes from the first whose track samples are no more than ``gap`` apart."""
    f = fixes.select(*by, t, F.col("northings").alias("fix_n"), F.col("eastings").alias("fix_e"))
    w = over(by, t)
    near = track.select(*by, t, "northings", "eastings", F.lead(t).over(w).alias("_next"))
    at = forward_interpolated(f, near.withColumn("_gap", F.coalesce(F.col("_next") - F.col(t), F.lit(0.0))).drop("_next"), by, t, ["northings", "eastings", "_gap"])
    start = at.filter(F.col("_gap") <= gap).groupBy(*by).agg(F.min(t).alias("_start"))
    used = at.join(start, list(by)).filter(F.col(t) >= F.col("_start"))
    return used.groupBy(*by).agg((F.avg("fix_n") - F.avg("northings")).alias("north_offset"), (F.avg("fix_e") - F.avg("eastings")).alias("east_offset"), F.count("*").alias("n"))


def pixel_stats(pixels: DataFrame, keys: Sequence[str], value: str = "value", ignore_zeroes: bool = False) -> DataFrame:
    """Mean and population deviation (floor 1e-6; null for a single image). Zeroes may be left out, as the running mean leaves them."""
    v = F.when(F.col(value) != 0, F.col(value)) if ignore_zeroes else F.col(value)
    dev = F.when(F.count("*") > 1, F.greatest(F.stddev_pop(v), F.lit(1e-6)))
    return pixels.groupBy(*keys).agg(F.avg(v).alias("mean"), dev.alias("std"), F.count("*").alias("n"))


def clipped_running_stats(pixels: DataFrame, keys: Sequence[str], order: str, value: str = "value", clip: float = 0.95) -> DataFrame:
    """Running mean and deviation in which a value over ``clip`` counts as the mean so far: an ordered fold per pixel.

    Pixels are dealt to tasks whole and pass in the order of ``order``, so that a step takes all pixels of an image side by
    side; a task holds three numbers for each of its pixels, whatever their histories."""
    keys = list(keys)
    schema = T.StructType([pixels.schema[k] for k in keys] + T._parse_datatype_string("mean double, std double, n long").fields)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place: dict[tuple, int] = {}
        n, mean, m2 = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        for pdf in batches:
            names = list(pdf[keys].itertuples(index=False, name=None))
            at = np.array([place.setdefault(k, len(place)) for k in names], np.int64)
            if len(place) > len(n):
                n, mean, m2 = (np.concatenate([a, np.zeros(max(len(place), 2 * len(a)) - len(a), a.dtype)]) for a in (n, mean, m2))
            v = pdf["_v"].to_numpy(float)
            turn = pd.Series(at).groupby(at).cumcount().to_numpy()  # rows of one pixel come in one after the other
            for k in range(int(turn.max()) + 1 if len(turn) else 0):
                rows = np.flatnonzero(turn == k)
                p, x = at[rows], v[rows]
                x = np.where(x > clip, mean[p], x)
                n[p] += 1
                old = mean[p]
                mean[p] = old + (x - old) / n[p]
                m2[p] += (x - old) * (x - mean[p])
        k = len(place)
        out = pd.DataFrame(list(place), columns=keys)
        out["mean"], out["n"] = mean[:k], n[:k]
        out["std"] = np.where(n[:k] > 1, np.maximum(np.sqrt(m2[:k] / np.maximum(n[:k], 1)), 1e-6), np.nan)
        out["std"] = out["std"].astype(object).where(n[:k] > 1, None)
        yield out[[*keys, "mean", "std", "n"]]

    rows = pixels.select(*keys, F.col(order).alias("_o"), F.col(value).cast("double").alias("_v"))
    return rows.repartition(*keys).sortWithinPartitions("_o", "_v", *keys).mapInPandas(fold, schema)


def trimmed_stats(rows: DataFrame, keys: Sequence[str], value: str, rate: float = 0.2) -> DataFrame:
    """Mean and population deviation of what is left when half of ``rate`` is cut from each end of the sorted values."""
    w = W.partitionBy(*keys)
    ranked = rows.select(*keys, value, (F.row_number().over(w.orderBy(value)) - 1).alias("_r"), F.count("*").over(w).alias("_n"))
    low, high = F.floor(F.col("_n") * rate / 2), F.floor(F.col("_n") * (1 - rate / 2))
    return ranked.filter((F.col("_r") >= low) & (F.col("_r") < high)).groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count("*").alias("n"))


def medians(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.median(value).alias("median"))


def ransac_mean(rows: DataFrame, keys: Sequence[str], value: str, threshold: float = 0.1, rounds: int = 1000, size: int = 2, seed: int = 0, signed: bool = True) -> DataFrame:
    """Mean of the inliers of the best of many means of a few samples. signed: the best has the least signed residual sum, as the reference takes it."""
    return consensus.consensus_means(rows, keys, value, threshold, rounds, size, seed, signed)


def altitude_bins(images: DataFrame, altitude: str, least: float, most: float, width: float = 0.1, enough: int = 10) -> DataFrame:
    """Bins (of ``width`` from ``least``) with at least ``enough`` images: their number and mean altitude."""
    kept = images.filter((F.col(altitude) > least) & (F.col(altitude) < most))
    return kept.groupBy(F.floor((F.col(altitude) - least) / width).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg(altitude).alias("distance")).filter(F.col("n") >= enough)


def smoothed_bins(pixels: DataFrame, method: str, keys: Sequence[str] = ("bin", "channel", "pixel"), value: str = "value") -> DataFrame:
    """One intensity per bin and pixel by ``mean``, ``mean_trimmed``, ``median`` or ``ransac_mean``; with the bin's mean distance."""
    distance = pixels.groupBy("bin").agg(F.avg("altitude").alias("distance"))
    if method == "median":
        v = medians(pixels, keys, value).withColumnRenamed("median", "intensity")
    else:
        f = {"mean": lambda: pixel_stats(pixels, keys, value), "mean_trimmed": lambda: trimmed_stats(pixels, keys, value), "ransac_mean": lambda: ransac_mean(pixels, list(keys), value)}[method]()
        v = f.select(*keys, F.col("mean").alias("intensity"))
    return v.join(distance, "bin")


def clock_regression(rows: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Line of y on x, its intercept lowered to the least residual (delays only make stamps later)."""
    line = rows.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("_c"))
    low = rows.join(line, list(by)).groupBy(*by).agg(F.first("slope").alias("slope"), F.min(F.col(y) - F.col("slope") * F.col(x)).alias("intercept"))
    return low


def clock_corrected(rows: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    return rows.join(clock_regression(rows, by, x, y), list(by)).withColumn("corrected", F.col("slope") * F.col(x) + F.col("intercept")).drop("slope", "intercept")


def acquisition_stats(rows: DataFrame, by: Sequence[str], t: str, coords: Sequence[str], altitude: str, least: float, most: float, fov_deg: float) -> DataFrame:
    """Images, those within an altitude range, mean altitude, time, distance and swath area of a survey."""
    s = step_lengths(rows, by, t, coords)
    ok = (F.col(altitude) > least) & (F.col(altitude) < most)
    area = F.col("step") * F.col(altitude) * F.tan(F.radians(F.lit(fov_deg / 2))) * 2
    return s.groupBy(*by).agg(F.count("*").alias("images"), F.count_if(ok).alias("between"), F.avg(altitude).alias("mean_altitude"), (F.max(t) - F.min(t)).alias("bottom_time"), F.sum("step").alias("distance"), F.sum(area).alias("area"))


def bounding_box(rows: DataFrame, by: Sequence[str], lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return rows.groupBy(*by).agg(F.min(lat).alias("south"), F.max(lat).alias("north"), F.min(lon).alias("west"), F.max(lon).alias("east"))


def brightness(pixels: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return pixels.groupBy(*keys).agg(F.avg(value).alias("mean"), F.max(value).alias("max"))


def accepted(measurements: DataFrame, by: Sequence[str]) -> DataFrame:
    """Measurements of each type and how many the gate let through."""
    return measurements.groupBy(*by, "type").agg(F.count("*").alias("total"), F.count_if(~F.col("valid")).alias("dropped"))


def tagged_counts(rows: DataFrame, by: Sequence[str], t: str, least: float = 0.002) -> DataFrame:
    """Records of each tag and their sample period: the first step of at least ``least`` seconds."""
    w = over(by, t)
    s = rows.select(*by, t, (F.lead(t).over(w) - F.col(t)).alias("_dt"))
    period = F.min_by("_dt", F.when(F.col("_dt") >= least, F.col(t)))
    return s.groupBy(*by).agg(F.count("*").alias("n"), period.alias("period"))


def epipolar_rms(points: DataFrame, by: Sequence[str], du: str, dv: str) -> DataFrame:
    return points.groupBy(*by).agg(F.sqrt(F.avg(F.least(F.abs(F.col(du)), F.abs(F.col(dv))) ** 2)).alias("rms"))


def distinct_times(*tables: DataFrame, by: Sequence[str], t: str) -> DataFrame:
    u = tables[0].select(*by, t)
    for x in tables[1:]:
        u = u.unionByName(x.select(*by, t))
    return u.distinct()


def cloud_stats(points: DataFrame, by: Sequence[str]) -> DataFrame:
    return points.groupBy(*by).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg("z").alias("z"), F.stddev_pop("y").alias("std_y"), F.stddev_pop("z").alias("std_z"))


def effective_size(weights: DataFrame, by: Sequence[str], w: str = "weight") -> DataFrame:
    """1 / sum of squared normalised weights."""
    return weights.groupBy(*by).agg((F.sum(w) ** 2 / F.sum(F.col(w) ** 2)).alias("neff"))
