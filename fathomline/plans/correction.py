"""The image job: attenuation parameters from image and altitude pairs, then corrected images. All on pixel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.config import ImageConfig
from fathomline.operators import aggregates, filters, images


def parameters(pixels: DataFrame, c: ImageConfig = ImageConfig()) -> tuple[DataFrame, DataFrame]:
    """(attenuation: channel, pixel, a, b, c, gain; statistics of corrected pixels: channel, pixel, mean, std).

    ``pixels``: image_id, channel, pixel, value, altitude."""
    kept = filters.altitude_range(pixels, c.altitude_min, c.altitude_max)
    heights = kept.select("image_id", "altitude").distinct()
    bins = aggregates.altitude_bins(heights, "altitude", c.altitude_min, c.altitude_max, c.bin_width).select("bin")
    binned = kept.withColumn("bin", F.floor((F.col("altitude") - c.altitude_min) / c.bin_width).cast("int")).join(bins, "bin", "left_semi")
    smooth = aggregates.smoothed_bins(binned, c.smoothing)
    target = heights.agg(F.avg("altitude").alias("m")).first()["m"] or 1.0
    fitted = images.with_gains(images.fit_attenuation(filters.fit_inputs(smooth, "distance", "intensity")), target)
    stats = aggregates.pixel_stats(images.attenuation_corrected(kept, fitted), ["channel", "pixel"]).select("channel", "pixel", "mean", "std")
    return fitted, stats


def correct(pixels: DataFrame, attenuation: DataFrame, stats: DataFrame, c: ImageConfig = ImageConfig()) -> DataFrame:
    """Corrected pixels as bytes."""
    even = images.attenuation_corrected(pixels, attenuation).join(stats, ["channel", "pixel"])
    level = even.withColumn("value", images.matched_stats(F.col("value"), F.col("mean"), F.col("std"), c.target_mean, c.target_std)).drop("mean", "std")
    lit = images.gamma(level) if c.gamma else level
    return lit.withColumn("value", images.to_bytes(F.col("value")))
