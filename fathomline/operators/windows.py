"""Ordered computations within a dive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

from fathomline.functions.frames import wrap_180


def over(by: Sequence[str], *order: str | Column) -> WindowSpec:
    return W.partitionBy(*by).orderBy(*order)


def upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(W.unboundedPreceding, 0)


def dead_reckoned(rows: DataFrame, by: Sequence[str], t: str, speeds: dict[str, str], order: Sequence[str] | None = None) -> DataFrame:
    """Positions by the trapezoidal rule, from 0 at the first row. ``speeds``: velocity column -> position column."""
    w = over(by, *(order or [t]))
    steps = {p: F.coalesce((F.col(t) - F.lag(t).over(w)) * (F.col(v) + F.lag(v).over(w)) / 2, F.lit(0.0)) for v, p in speeds.items()}
    with_steps = rows.select("*", *[s.alias(f"_{p}") for p, s in steps.items()])
    return with_steps.select(*rows.columns, *[F.sum(f"_{p}").over(upto(w)).alias(p) for p in steps])


def angular_rates(rows: DataFrame, by: Sequence[str], t: str, angles: Sequence[str], yaw: Sequence[str] = ("yaw",)) -> DataFrame:
    """Degrees a second by central differences, one-sided at the ends; yaw differences go the short way. Adds ``<angle>_rate``."""
    w = over(by, t)
    side = lambda c: (F.coalesce(F.lag(c).over(w), F.col(c)), F.coalesce(F.lead(c).over(w), F.col(c)))
    t0, t1 = side(t)
    out = []
    for a in angles:
        a0, a1 = side(a)
        d = a1 - a0
        out.append(F.try_divide(wrap_180(d) if a in yaw else d, t1 - t0).alias(f"{a}_rate"))
    return rows.select("*", *out)


def continuous_fixes(fixes: DataFrame, by: Sequence[str], t: str, north: str, east: str, north_std: str, east_std: str, sigma: float, max_speed: float) -> DataFrame:
    """Fixes each of whose four neighbours (two on each side) is as near as their errors and a speed allow; ends go."""
    w = over(by, t)
    ok = None
    for k in (1, 2):
        for f in (F.lag, F.lead):
            n, e, ns, es, tt = (f(c, k).over(w) for c in (north, east, north_std, east_std, t))
            apart = F.sqrt((F.col(north) - n) ** 2 + (F.col(east) - e) ** 2)
            room = sigma * (F.sqrt(F.col(north_std) ** 2 + F.col(east_std) ** 2) + F.sqrt(ns**2 + es**2) + F.abs(F.col(t) - tt) * max_speed)
            test = F.coalesce(apart < room, F.lit(False))
            ok = test if ok is None else ok & test
    return fixes.withColumn("_ok", ok).filter("_ok").drop("_ok")


def forward_filled(rows: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    w = upto(over(by, *order))
    return rows.select(*[c for c in rows.columns if c not in cols], *[F.last(c, ignorenulls=True).over(w).alias(c) for c in cols])


def back_filled(rows: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The next value for nulls: a look back in descending order."""
    w = upto(over(by, *[F.col(c).desc() for c in order]))
    return rows.select(*[c for c in rows.columns if c not in cols], *[F.last(c, ignorenulls=True).over(w).alias(c) for c in cols])


def monotone(rows: DataFrame, by: Sequence[str], order: str, t: str) -> DataFrame:
    """A row that is not later than the one before replaces what was kept last: the last row of each such run stays.

    As the reference compares with the previous row, a run is a row that is later than its predecessor and all that follow until the next such."""
    w = over(by, order)
    runs = rows.withColumn("_later", F.when(F.coalesce(F.col(t) > F.lag(t).over(w), F.lit(True)), 1).otherwise(0)).withColumn("_run", F.sum("_later").over(upto(w)))
    last = W.partitionBy(*by, "_run").orderBy(F.col(order).desc())
    return runs.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_later", "_run", "_n")


def changed(rows: DataFrame, by: Sequence[str], order: str, col: str) -> DataFrame:
    """Rows whose value differs from the row before."""
    w = over(by, order)
    return rows.withColumn("_was", F.lag(col).over(w)).filter(F.col("_was").isNull() | (F.col(col) != F.col("_was"))).drop("_was")


def segments(rows: DataFrame, by: Sequence[str], order: str, starts: Column, name: str = "segment") -> DataFrame:
    """Numbers runs: each row that ``starts`` opens a new one."""
    return rows.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(upto(over(by, order))))


def repaired_zeros(rows: DataFrame, by: Sequence[str], t: str, cols: Sequence[str]) -> DataFrame:
    """A 0 becomes the value, at its time, of the line from the row before (as repaired) to the row after (as it is).

    In a run of zeros each goes on from the one before, so the value before the run is scaled down step by step: a running
    product, not a loop. The first and the last row of a group stay as they are."""
    w = over(by, t)
    inner = F.lag(t).over(w).isNotNull() & F.lead(t).over(w).isNotNull()
    part = F.when(F.lead(t).over(w) == F.lag(t).over(w), 0.0).otherwise((F.col(t) - F.lag(t).over(w)) / (F.lead(t).over(w) - F.lag(t).over(w)))
    out = rows
    for c in cols:
        zero = (F.col(c) == 0) & inner
        out = out.withColumns({"_zero": F.coalesce(zero, F.lit(False)), "_part": part, "_next": F.lead(c).over(w)})
        out = out.withColumn("_run", F.sum(F.when(F.col("_zero"), 0).otherwise(1)).over(upto(w)))
        run = upto(over([*by, "_run"], t))
        from_ = F.first(c).over(run) * F.product(F.when(F.col("_zero"), 1 - F.col("_part")).otherwise(1.0)).over(run)
        fixed = F.when(F.col("_zero"), from_ + F.col("_next") * F.col("_part")).otherwise(F.col(c))
        out = out.withColumn(c, fixed).drop("_zero", "_part", "_next", "_run")
    return out.select(*[c for c in rows.columns if c not in cols], *cols)


def step_lengths(rows: DataFrame, by: Sequence[str], t: str, coords: Sequence[str], name: str = "step") -> DataFrame:
    """Distance from the row before (0 at the first)."""
    w = over(by, t)
    return rows.withColumn(name, F.coalesce(F.sqrt(sum(((F.col(c) - F.lag(c).over(w)) ** 2 for c in coords), F.lit(0.0))), F.lit(0.0)))


def relative_poses(rows: DataFrame, by: Sequence[str], t: str, cols: Sequence[str], keep_next: Sequence[str] = ()) -> DataFrame:
    """Each pose less the next one, with the next one's ``keep_next``; the last pose has none."""
    w = over(by, t)
    out = rows.select(*by, t, F.lead(t).over(w).alias("next_t"), *[(F.col(c) - F.lead(c).over(w)).alias(f"d_{c}") for c in cols], *[F.lead(c).over(w).alias(f"next_{c}") for c in keep_next])
    return out.filter(F.col("next_t").isNotNull())


def slopes(rows: DataFrame, by: Sequence[str], t: str, other: str) -> DataFrame:
    """Knots (t, other, slope to the next knot); the last knot keeps the slope before it."""
    w = over(by, t)
    s = rows.select(*by, t, F.col(other).alias("other"), F.try_divide(F.lead(other).over(w) - F.col(other), F.lead(t).over(w) - F.col(t)).alias("slope"))
    return s.withColumn("slope", F.coalesce("slope", F.lag("slope").over(w), F.lit(1.0)))
