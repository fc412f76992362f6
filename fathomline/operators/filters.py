"""Filters over the tagged union and its tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.operators.interp import interpolated

#: Columns that a record of each category must have.
REQUIRED = {
    "velocity_body": ["x_velocity", "y_velocity", "z_velocity", "x_velocity_std", "y_velocity_std", "z_velocity_std"],
    "velocity_inertial": ["north_velocity", "east_velocity", "down_velocity"],
    "orientation": ["roll", "pitch", "yaw"],
    "depth": ["depth"],
    "altitude": ["altitude"],
    "usbl": ["latitude", "longitude"],
    "tide": ["height"],
}


def time_range(rows: DataFrame, by: Sequence[str], t: str, start: float | None = None, finish: float | None = None) -> DataFrame:
    """Rows between two times, ends included; a missing end is that of the rows (origins, at time 0, aside)."""
    if start is None and finish is None:
        return rows.filter(F.col(t) > 0)
    ok = F.col(t) > 0
    if start is not None:
        ok &= F.col(t) >= start
    if finish is not None:
        ok &= F.col(t) <= finish
    return rows.filter(ok)


def tagged(rows: DataFrame, category: str, frame: str | None = None) -> DataFrame:
    """Rows whose category (and frame) contain a word."""
    ok = F.col("category").contains(category)
    return rows.filter(ok & F.col("frame").contains(frame) if frame else ok)


def sane_clock(rows: DataFrame, t: str, device_t: str, most: float = 1.0) -> DataFrame:
    """Rows whose two clocks agree, stamped with the device's."""
    return rows.filter(F.abs(F.col(t) - F.col(device_t)) < most).withColumn(t, F.col(device_t))


def valid(rows: DataFrame, category: str) -> DataFrame:
    ok = F.lit(True)
    for c in REQUIRED[category]:
        ok &= F.col(c).isNotNull()
    return rows.filter(ok)


def no_nans(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    ok = F.lit(True)
    for c in cols:
        ok &= F.col(c).isNotNull() & ~F.isnan(c)
    return rows.filter(ok)


def sentinel_to_null(c: Column, least: float = -32.0, most: float = 32.0, inclusive: bool = True) -> Column:
    """Null for values outside the range; the bounds themselves stay if ``inclusive``."""
    return F.when((c >= least) & (c <= most) if inclusive else (c > least) & (c < most), c)


def during(rows: DataFrame, others: DataFrame, by: Sequence[str], t: str, margin: float = 1.0) -> DataFrame:
    """Rows at least ``margin`` after the others begin and before they end. One small row a group is joined."""
    span = others.groupBy(*by).agg(F.min(t).alias("_from"), F.max(t).alias("_to"))
    return rows.join(span, list(by)).filter((F.col(t) >= F.col("_from") + margin) & (F.col(t) + margin <= F.col("_to"))).drop("_from", "_to")


def depth_gate(fixes: DataFrame, depths: DataFrame, by: Sequence[str], t: str, sigma: float) -> DataFrame:
    """Fixes whose depth agrees with the depth sensor's at their time, within sigma times both errors."""
    at = interpolated(fixes.withColumnsRenamed({"depth": "fix_depth", "depth_std": "fix_std"}), depths, by, t, ["depth", "depth_std"])
    ok = F.abs(F.col("fix_depth") - F.col("depth")) <= sigma * (F.abs(F.col("fix_std")) + F.abs(F.col("depth_std")))
    return at.filter(ok).drop("depth", "depth_std").withColumnsRenamed({"fix_depth": "depth", "fix_std": "depth_std"})


def between_marks(rows: DataFrame, by: Sequence[str], order: str, col: str, start: str, end: str) -> DataFrame:
    """Rows from the first that equals ``start`` to the first that equals ``end``, both included."""
    w = W.partitionBy(*by).orderBy(order)
    begun = F.max(F.when(F.col(col) == start, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))
    ended = F.coalesce(F.max(F.when(F.col(col) == end, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_in", (begun == 1) & (ended == 0)).filter("_in").drop("_in")


def altitude_range(rows: DataFrame, least: float, most: float, col: str = "altitude") -> DataFrame:
    """Strictly between; text ``None`` and null go."""
    v = F.col(col).try_cast("double")
    return rows.filter((v > least) & (v < most))


def brightness(rows: DataFrame, col: str, least: float, most: float) -> DataFrame:
    return rows.filter((F.col(col) < least) | (F.col(col) > most))


def fit_inputs(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Finite and positive pairs."""
    fine = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) & (F.col(c) > 0)
    return rows.filter(fine(x) & fine(y))


def std_model(value: Column, stored: Column, model: str, offset: float = 0.0, factor: float = 0.0, signed: bool = True) -> Column:
    """A standard deviation: as stored, or offset + factor x value (its size, if not ``signed``)."""
    return stored if model == "sensor" else F.lit(offset) + factor * (value if signed else F.abs(value))


def rejected_views(views: DataFrame, error: str, least: float = 0.25, rounds: int = 10) -> DataFrame:
    """Views whose error is at most max(mean + 2 deviations, ``least``), again until none goes."""
    for _ in range(rounds):
        mean, dev, n = views.agg(F.avg(error), F.stddev_pop(error), F.count("*")).first()
        if not n:
            break
        kept = views.filter(F.col(error) <= max(mean + 2 * dev, least))
        if kept.count() == n:
            break
        views = kept
    return views


def acquisition(rows: DataFrame, t: str, altitude: str, start: float | None = None, end: float | None = None, below: float | None = None) -> DataFrame:
    """Images between two times (both taken in) and under an altitude."""
    ok = F.lit(True)
    if start is not None:
        ok &= F.col(t) >= start
    if end is not None:
        ok &= F.col(t) <= end
    if below is not None:
        ok &= F.col(altitude) < below
    return rows.filter(ok)


def placed(rows: DataFrame, depth: str = "depth") -> DataFrame:
    """Rows whose depth is known: laser frames outside the filtered track have none."""
    return rows.filter(F.col(depth).isNotNull())
