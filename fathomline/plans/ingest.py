"""The parse job: one table of all categories and dives, in time order, tides taken off depths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.config import Mission
from fathomline.operators import interp, sampling
from fathomline.sources import registry


def tide_corrected(depths: DataFrame, tides: DataFrame, by: list[str]) -> DataFrame:
    """Depths less the tide at their time; outside the tides' span, as they are."""
    at = interp.interpolated(depths, tides.select(*by, "t", "height"), by, "t", ["height"], extrapolate=False)
    return at.withColumn("depth", F.col("depth") - F.coalesce("height", F.lit(0.0))).drop("height")


def origin(spark: SparkSession, dive: str, m: Mission) -> DataFrame:
    return spark.createDataFrame([(dive, 0.0, "origin", m.latitude, m.longitude, m.crs, m.date)], "dive string, t double, category string, latitude double, longitude double, crs string, date string")


def dive_table(spark: SparkSession, dive: str, folder: str, m: Mission) -> DataFrame:
    """The tagged union of a dive's sensors."""
    tables = [origin(spark, dive, m)]
    read: dict[str, DataFrame] = {}
    for category, s in m.sensors.items():
        if s.format:
            path = f"{folder.rstrip('/')}/{s.filepath.strip('/')}/{s.filename}".rstrip("/")
            read[category] = registry.read(spark, category, s.format, path, **s.options).withColumn("dive", F.lit(dive)).withColumn("category", F.lit(category))
    if "tide" in read and "depth" in read:
        read["depth"] = tide_corrected(read["depth"], read["tide"], ["dive"])
    return sampling.union_all(*tables, *read.values())


def parse(spark: SparkSession, dives: dict[str, tuple[str, Mission]]) -> DataFrame:
    """All dives, which must share an origin, in time order."""
    return sampling.interlaced(sampling.merged_dives(*[dive_table(spark, d, f, m) for d, (f, m) in dives.items()]), "t", "seq", ["dive"])
