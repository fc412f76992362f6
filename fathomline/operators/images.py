"""Image corrections. Statistics and per-pixel arithmetic run on pixel tables (image_id, channel, pixel, value) as
expressions; operations that need neighbours (debayer, undistort, rescale) run on image rows in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from fathomline.operators.filters import fit_inputs
from fathomline.operators.folds import side_by_side
from fathomline.shared import cut, dealt

IMAGE = "image_id string, height int, width int, channels int, data array<float>"
#: The same without rounding to single precision.
IMAGE_DOUBLE = IMAGE.replace("float", "double")


# -- pixel tables


def exp_curve(distance: Column, a: Column, b: Column, c: Column) -> Column:
    return a * F.exp(b * distance) + c


def attenuation_corrected(pixels: DataFrame, params: DataFrame) -> DataFrame:
    """value x gain / (a e^(b altitude) + c), parameters by channel and pixel."""
    fit = exp_curve(F.col("altitude"), F.col("a"), F.col("b"), F.col("c"))
    return pixels.join(params, ["channel", "pixel"]).withColumn("value", F.try_divide(F.col("gain"), fit) * F.col("value")).drop("a", "b", "c", "gain")


def with_gains(params: DataFrame, target: float | Column) -> DataFrame:
    """Gains: the fitted curve at the target distance."""
    d = target if isinstance(target, Column) else F.lit(float(target))
    return params.withColumn("gain", exp_curve(d, F.col("a"), F.col("b"), F.col("c")))


def matched_stats(value: Column, mean: Column, std: Column, target_mean: float, target_std: float) -> Column:
    """A value moved to a target mean and deviation (in percent), within 0 and 1."""
    moved = (value - mean) / std * (target_std / 100) + target_mean / 100
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved))


def gamma(pixels: DataFrame, keys: Sequence[str] = ("image_id",), value: str = "value") -> DataFrame:
    """Linear for images that are dark throughout, else a power; which is decided by the image's greatest value."""
    top = pixels.groupBy(*keys).agg(F.max(value).alias("_top"))
    curve = F.when(F.col("_top") < 0.0031308, 12.92 * F.col(value)).otherwise(1.055 * F.pow(F.col(value), 1 / 1.5) - 0.055)
    return pixels.join(top, list(keys)).withColumn(value, curve).drop("_top")


def balanced(value: Column, channel: Column, gains: Sequence[float], offsets: Sequence[float]) -> Column:
    """gain x (value - offset) by channel; past the last channel, the first."""
    pick = lambda xs: F.coalesce(F.get(F.array(*[F.lit(float(x)) for x in xs]), channel), F.lit(float(xs[0])))
    return pick(gains) * (value - pick(offsets))


def to_bytes(value: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(255), F.floor(value * 255))).cast("int")


#: Decays that are tried first, and how many between the best one's neighbours, in so many finer rounds.
DECAYS, CLOSER, FINER = (*(-np.geomspace(10, 1e-3, 40)).tolist(), 0.0), 60, 2
#: How often weights are found anew on the first grid, and on a finer one, which starts with those of the best.
REWEIGHTED, AGAIN = 5, 3
#: A key of more than HOT different samples is summed by so many tasks; others are fitted by one.
HOT, TASKS = 1_000_000, 16
#: Samples that are weighed with all decays of a grid at a time, and keys whose sums a task holds.
CHUNK, TOGETHER = 1024, 1024


class Curves:
    """Samples of whole keys side by side, in the order of keys and distances, and sums over them for a grid of decays of each key.

    Sums go through chunks, so that no more than CHUNK samples are held for each decay; a run of one distance has one exponential."""

    def __init__(self, key: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        self.keys = int(key[-1]) + 1
        self.top = np.minimum.reduceat(y, np.flatnonzero(np.diff(key, prepend=-1)))
        self.chunks = []
        for at in range(0, len(x), CHUNK):
            k, xs = key[at : at + CHUNK], x[at : at + CHUNK]
            new = np.diff(k, prepend=-1) != 0
            runs = np.flatnonzero(new | (np.diff(xs, prepend=np.nan) != 0))
            first, size = np.flatnonzero(new), np.diff(runs, append=len(xs))
            self.chunks.append((slice(k[0], k[-1] + 1), k[runs], xs[runs], runs, size, first, np.searchsorted(runs, first), y[at : at + CHUNK], n[at : at + CHUNK]))

    def solved(self, b: np.ndarray, a: np.ndarray | None, c: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """a, c (decay, key) of least squares with the weights that the last ones give; equal weights without these."""
        sums = np.zeros((5, len(b), self.keys))
        for own, k, x, runs, size, _, first, y, n in self.chunks:
            e = np.exp(b[:, k] * x)
            w = np.broadcast_to(n, (len(b), len(n))) if a is None else n / self.bend(e, a[:, k], c[:, k], size, y)
            s, sy = np.add.reduceat(w, runs, axis=1), np.add.reduceat(w * y, runs, axis=1)
            sums[:, :, own] += np.add.reduceat(np.stack([s, s * e, sy, s * e * e, sy * e]), first, axis=2)
        s, sx, sy, sxx, sxy = sums
        det = s * sxx - sx * sx
        flat = det <= 1e-12
        c = np.clip(np.where(flat, 0.0, (sxx * sy - sx * sxy) / np.where(flat, 1.0, det)), 0.0, self.top)
        return np.maximum((sxy - c * sx) / np.maximum(sxx, 1e-300), 1e-6), c

    @staticmethod
    def bend(e: np.ndarray, a: np.ndarray, c: np.ndarray, size: np.ndarray, y: np.ndarray) -> np.ndarray:
        miss = y - np.repeat(a * e + c, size, axis=1)
        miss *= miss
        miss += 1
        return np.sqrt(miss, out=miss)

    def cost(self, b: np.ndarray, a: np.ndarray, c: np.ndarray) -> np.ndarray:
        cost = np.zeros(b.shape)
        for own, k, x, _, size, first, _, y, n in self.chunks:
            cost[:, own] += np.add.reduceat(2 * n * (self.bend(np.exp(b[:, k] * x), a[:, k], c[:, k], size, y) - 1), first, axis=1)
        return cost

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """a, b, c of each key: the grids of ``fit_attenuation``."""
        every, a, c = np.arange(self.keys), None, None
        b = np.repeat(np.array(DECAYS)[:, None], self.keys, axis=1)
        for turns in (REWEIGHTED, *[AGAIN] * FINER):
            for _ in range(turns):
                a, c = self.solved(b, a, c)
            i = np.argmin(np.nan_to_num(self.cost(b, a, c), nan=np.inf), axis=0)
            lo, hi, found = b[np.maximum(i - 1, 0), every], b[np.minimum(i + 1, len(b) - 1), every], (a[i, every], b[i, every], c[i, every])
            b = lo + (hi - lo) * np.arange(CLOSER + 1)[:, None] / CLOSER
            a, c = (np.repeat(v[None], len(b), axis=0) for v in (found[0], found[2]))
        return found


def fitted_whole(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys..., b, a, c: keys of at most HOT different samples (_x, _y, _n) are dealt whole and fitted by one task each."""
    keys = list(keys)

    def fit(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        begin = np.flatnonzero(np.diff(part.groupby(keys, sort=False, dropna=False).ngroup().to_numpy(), prepend=-1))
        x, y, n = (part[v].to_numpy(float) for v in ("_x", "_y", "_n"))
        ends, found = np.append(begin, len(part)), []
        for i in range(0, len(begin), TOGETHER):
            own = ends[i : i + TOGETHER + 1]
            at = slice(own[0], own[-1])
            found.append(np.stack(Curves(np.repeat(np.arange(len(own) - 1), np.diff(own)), x[at], y[at], n[at]).best()))
        a, b, c = np.concatenate(found, axis=1)
        yield part.iloc[begin][keys].reset_index(drop=True).assign(b=b, a=a, c=c)

    schema = T.StructType([*[samples.schema[k] for k in keys], *[T.StructField(v, T.DoubleType()) for v in "bac"]])
    return dealt(samples.select(*keys, "_x", "_y", "_n"), keys).sortWithinPartitions(*keys, "_x", "_y").mapInPandas(side_by_side(fit, keys), schema)


def fit_attenuation(samples: DataFrame, keys: Sequence[str] = ("channel", "pixel"), x: str = "distance", y: str = "intensity") -> DataFrame:
    """a, b, c of a e^(b x) + c per key: a >= 1e-6, b <= 0, 0 <= c <= least intensity, with a soft-L1 loss; (1, 0, 0) without samples.

    For a given b the curve is linear in a and c, so each b of a grid is solved from five weighted sums, and the grid is refined
    around the best: bounded work per sample, no seeds to go wrong. A task sums and solves the keys that it was dealt, from end
    to end. The sums of a key of more than HOT different samples are built-in aggregates over samples that several tasks were
    dealt; weights come from joining the last fits, so that these are never held together. Rows without a key are left out; null, infinite and non-positive values take no part; equal samples count as often as they are there."""
    partitions = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(keys)
    named = samples.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    for k in keys:
        named = named.filter(F.col(k).isNotNull())
    good = cut(fit_inputs(named, "_x", "_y").groupBy(*keys, "_x", "_y").agg(F.count("*").alias("_n")))
    sizes = cut(good.groupBy(*keys).agg(F.min("_y").alias("_top"), F.when(F.count("*") > HOT, TASKS).otherwise(1).alias("_parts")))
    hot = sizes.filter(F.col("_parts") > 1)
    if not hot.limit(1).count():
        return with_defaults(named, cut(fitted_whole(good, keys)), keys)
    whole = cut(fitted_whole(good.join(hot.select(*keys), keys, "left_anti"), keys))
    sizes = cut(hot)
    part = F.pmod(F.xxhash64("_x", "_y"), F.col("_parts")).cast("int")
    parted = cut(good.join(sizes, keys).withColumn("_part", part).drop("_parts", "_top").repartition(partitions, *keys, "_part"))

    def summed(fits: DataFrame) -> DataFrame:
        """Fits with their cost and with the sums that their weights give."""
        spread = fits.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        met = parted.join(spread, [*keys, "_part"]).withColumn("_e", F.exp(F.col("b") * F.col("_x")))
        bend = F.sqrt(1 + F.pow(F.col("_y") - F.col("a") * F.col("_e") - F.col("c"), 2))
        w, e, v = (F.col(c) for c in ("_w", "_e", "_y"))
        met = met.withColumn("_cost", F.col("_n") * 2 * (bend - 1)).withColumn("_w", F.col("_n") * F.coalesce(1 / bend, F.lit(1.0)))
        sums = {"cost": F.col("_cost"), "s": w, "sx": w * e, "sy": w * v, "sxx": w * e * e, "sxy": w * e * v}
        return met.groupBy(*keys, "b").agg(*[F.first(c).alias(c) for c in ("lo", "hi", "_top", "_parts", "a", "c")], *[F.sum(f).alias(c) for c, f in sums.items()])

    def solved(fits: DataFrame) -> DataFrame:
        s = summed(fits)
        det = F.col("s") * F.col("sxx") - F.col("sx") * F.col("sx")
        c = F.when(det <= 1e-12, 0.0).otherwise(F.try_divide(F.col("sxx") * F.col("sy") - F.col("sx") * F.col("sxy"), det))
        s = s.withColumn("c", F.greatest(F.lit(0.0), F.least(F.col("_top"), c)))
        a = (F.col("sxy") - F.col("c") * F.col("sx")) / F.greatest(F.col("sxx"), F.lit(1e-300))
        return s.select(*keys, "b", "lo", "hi", "_top", "_parts", F.greatest(a, F.lit(1e-6)).alias("a"), "c")

    def best(fits: DataFrame, turns: int) -> DataFrame:
        for _ in range(turns):
            fits = solved(fits)
        least = summed(fits).groupBy(*keys).agg(F.min(F.struct("cost", "b", "a", "c", "lo", "hi", "_top", "_parts")).alias("m"))
        return cut(least.select(*keys, "m.b", "m.a", "m.c", "m.lo", "m.hi", "m._top", "m._parts"))

    grid = [F.struct(F.lit(b).alias("b"), F.lit(DECAYS[max(i - 1, 0)]).alias("lo"), F.lit(DECAYS[min(i + 1, len(DECAYS) - 1)]).alias("hi")) for i, b in enumerate(DECAYS)]
    nothing = F.lit(None).cast("double")
    found = best(sizes.select(*keys, F.inline(F.array(*grid)), "_top", "_parts", nothing.alias("a"), nothing.alias("c")), REWEIGHTED)
    for _ in range(FINER):
        at = lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / CLOSER
        steps = found.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(CLOSER))))
        i = F.col("_i")
        closer = steps.select(*keys, at(i).alias("b"), at(F.greatest(i - 1, F.lit(0))).alias("lo"), at(F.least(i + 1, F.lit(CLOSER))).alias("hi"), "_top", "_parts", "a", "c")
        found = best(closer, AGAIN)
    return with_defaults(named, found.select(*keys, "b", "a", "c").unionByName(whole), keys)


def with_defaults(rows: DataFrame, fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The fit of every key of ``rows``; (1, 0, 0) where there is none."""
    filled = [F.coalesce(c, F.lit(v)).alias(c) for c, v in (("a", 1.0), ("b", 0.0), ("c", 0.0))]
    return rows.select(*keys).distinct().join(fits, list(keys), "left").select(*keys, *filled)


def laser_line(pixels: DataFrame, k: int = 7, min_ratio: float = 0.01, keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """Row of the laser line in each column: the window of k rows with the greatest triangular-weighted sum, its centroid in sub-pixels.

    ``pixels``: keys, row, col, value. Columns whose best sum is under ``min_ratio`` of the image's greatest are left out."""
    w = W.partitionBy(*keys, "col").orderBy("row")
    half = (k - 1) / 2
    weight = [half + 1 - abs(i - half) for i in range(k)]
    ahead = [F.lead("value", i).over(w) for i in range(k)]
    total = sum((F.coalesce(v, F.lit(0.0)) * wi for v, wi in zip(ahead, weight, strict=True)), F.lit(0.0))
    mass = sum((F.coalesce(v, F.lit(0.0)) for v in ahead), F.lit(0.0))
    moment = sum((F.coalesce(v, F.lit(0.0)) * i for i, v in enumerate(ahead)), F.lit(0.0))
    s = pixels.select(*keys, "col", "row", total.alias("sum"), (F.col("row") + F.try_divide(moment, mass)).alias("centre"), ahead[-1].alias("_end")).filter(F.col("_end").isNotNull())
    best = s.groupBy(*keys, "col").agg(F.max_by("centre", F.struct("sum", (-F.col("row")).alias("r"))).alias("row"), F.max("sum").alias("sum"))
    top = best.groupBy(*keys).agg(F.max("sum").alias("_top"))
    return best.join(top, list(keys)).filter((F.col("sum") >= min_ratio * F.col("_top")) & (F.col("sum") > 0)).drop("_top")


# -- image rows


def exploded(images: DataFrame) -> DataFrame:
    """Pixel table of image rows (data in height, width, channels order)."""
    p = images.select(*[c for c in images.columns if c != "data"], F.posexplode("data").alias("_i", "value"))
    return p.withColumn("channel", (F.col("_i") % F.col("channels")).cast("int")).withColumn("pixel", F.floor(F.col("_i") / F.col("channels")).cast("int")).drop("_i")


def mapped(images: DataFrame, f, schema: str = IMAGE) -> DataFrame:
    """Each image (as a height x width x channels array) through ``f``."""
    kind = np.float64 if schema == IMAGE_DOUBLE else np.float32

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                out = np.asarray(f(np.asarray(r.data, kind).reshape(r.height, r.width, r.channels)), kind)
                out = out[:, :, None] if out.ndim == 2 else out
                rows.append((r.image_id, *out.shape, out.ravel()))
            yield pd.DataFrame(rows, columns=["image_id", "height", "width", "channels", "data"])

    return images.select("image_id", "height", "width", "channels", "data").mapInPandas(run, schema)


def neighbour_mean(raw: np.ndarray, have: np.ndarray) -> np.ndarray:
    """Weighted mean of the samples next to each pixel, those beside it twice as heavy as those across the corner."""
    h, w = raw.shape
    value, mass = np.zeros((h, w)), np.zeros((h, w))
    pv, pm = np.pad(raw * have, 1), np.pad(have, 1)
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            k = (2 - abs(dy)) * (2 - abs(dx)) / 4
            value += k * pv[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
            mass += k * pm[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
    return value / np.maximum(mass, 1e-9)


def debayer(image: np.ndarray, pattern: str = "rggb", edges: bool = True) -> np.ndarray:
    """RGB from a mosaic of any of the four patterns: means of the nearest samples of each colour.

    With ``edges``, green where it wasn't sampled goes along the edge: it is the mean of the two neighbours, side by side or
    above and below, that differ less. In the outermost rows and columns it is the mean of those that are there."""
    pattern = pattern.lower()
    if pattern not in ("rggb", "grbg", "bggr", "gbrg"):
        raise ValueError(f"{pattern} is no Bayer pattern")
    raw = image[:, :, 0].astype(float)
    h, w = raw.shape
    rows, cols = np.arange(h)[:, None] % 2, np.arange(w)[None, :] % 2
    out = np.zeros((h, w, 3))
    for c, name in enumerate("rgb"):
        have = np.zeros((h, w))
        for i, p in enumerate(pattern):
            if p == name:
                have = np.maximum(have, (rows == i // 2) & (cols == i % 2))
        mean = neighbour_mean(raw, have)
        if name == "g" and edges and h > 2 and w > 2:
            up, down, left, right = raw[:-2, 1:-1], raw[2:, 1:-1], raw[1:-1, :-2], raw[1:-1, 2:]
            mean[1:-1, 1:-1] = np.where(np.abs(left - right) > np.abs(up - down), up + down, left + right) / 2
        out[:, :, c] = np.where(have > 0, raw, mean)
    return out


def sampled(image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bilinear values at places; 0 outside."""
    h, w = image.shape[:2]
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    fx, fy = (x - x0)[..., None], (y - y0)[..., None]
    out = np.zeros((*x.shape, image.shape[2]))
    for dy, wy in ((0, 1 - fy), (1, fy)):
        for dx, wx in ((0, 1 - fx), (1, fx)):
            xi, yi = x0 + dx, y0 + dy
            ok = (xi >= 0) & (xi < w) & (yi >= 0) & (yi < h)
            out += np.where(ok[..., None], image[np.clip(yi, 0, h - 1), np.clip(xi, 0, w - 1)] * wx * wy, 0)
    return out


def undistort(image: np.ndarray, k: np.ndarray, d: Sequence[float]) -> np.ndarray:
    """Remap by a pinhole camera with radial (k1, k2, k3) and tangential (p1, p2) terms in the order k1 k2 p1 p2 k3."""
    k1, k2, p1, p2, k3 = (*d, 0, 0, 0, 0, 0)[:5]
    h, w = image.shape[:2]
    u, v = np.meshgrid(np.arange(w), np.arange(h))
    x, y = (u - k[0, 2]) / k[0, 0], (v - k[1, 2]) / k[1, 1]
    r2 = x * x + y * y
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    xd = x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)
    yd = y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y
    return sampled(image, xd * k[0, 0] + k[0, 2], yd * k[1, 1] + k[1, 2])


#: Half-widths of the resampling kernels.
SUPPORT = {"bilinear": 1.0, "bicubic": 2.0, "lanczos": 3.0}


def kernel(method: str, x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    if method == "bilinear":
        return np.maximum(1 - x, 0)
    if method == "bicubic":  # with a slope of -1/2 at 1
        return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0))
    return np.where(x < 3, np.sinc(x) * np.sinc(x / 3), 0)


@lru_cache(maxsize=64)
def taps(n: int, m: int, method: str) -> tuple[np.ndarray, np.ndarray]:
    """Which of n samples make each of m, and their weights (m x taps). Kernels are stretched where there are fewer samples after."""
    scale = n / m
    centre = (np.arange(m) + 0.5) * scale
    if method == "nearest_neighbour":
        return np.minimum(np.floor(centre).astype(int), n - 1)[:, None], np.ones((m, 1))
    wide = max(scale, 1.0)
    reach = SUPPORT[method] * wide
    first = np.maximum(np.floor(centre - reach + 0.5).astype(int), 0)
    last = np.minimum(np.floor(centre + reach + 0.5).astype(int), n)
    at = first[:, None] + np.arange(int((last - first).max()))[None, :]
    weight = np.where(at < last[:, None], kernel(method, (at + 0.5 - centre[:, None]) / wide), 0)
    return np.minimum(at, n - 1), weight / weight.sum(axis=1, keepdims=True)


def resized(image: np.ndarray, height: int, width: int, method: str = "bilinear") -> np.ndarray:
    """An image at another size by one kernel, first along its rows, then along its columns."""
    if method != "nearest_neighbour" and method not in SUPPORT:
        raise ValueError(f"{method} is no kernel; there are nearest_neighbour, {', '.join(SUPPORT)}")
    out = image.astype(float)
    for axis, m in ((1, width), (0, height)):
        at, weight = taps(out.shape[axis], m, method)
        shape = [1, 1, 1]
        shape[axis] = m
        out = sum(np.take(out, at[:, k], axis=axis) * weight[:, k].reshape(shape) for k in range(at.shape[1]))
    return out


def rescale(image: np.ndarray, altitude: float, f_x: float, f_y: float, target: float, maintain_pixels: bool = False, method: str = "bilinear") -> np.ndarray:
    """Resize so that a pixel covers ``target`` metres. With ``maintain_pixels`` at the old number of pixels: blurred by going
    there and back where pixels cover less now, else the middle of the image that fills it at that size."""
    h, w = image.shape[:2]
    down, across = altitude / f_y / target, altitude / f_x / target
    if not maintain_pixels:
        return resized(image, max(1, int(h * down)), max(1, int(w * across)), method)
    if down < 1 or across < 1:
        return resized(resized(image, max(1, int(h * down)), max(1, int(w * across)), method), h, w, method)
    top, left = int((h - int(h / down)) / 2), int((w - int(w / across)) / 2)
    return resized(image[top : h - top, left : w - left], h, w, method)
