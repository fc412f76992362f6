"""The interchange table: a tagged union of measurements, as JSON or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DATA = "array<struct<x_velocity: double, x_velocity_std: double, y_velocity: double, y_velocity_std: double, z_velocity: double, z_velocity_std: double, north_velocity: double, north_velocity_std: double, east_velocity: double, east_velocity_std: double, down_velocity: double, down_velocity_std: double, heading: double, heading_std: double, roll: double, roll_std: double, pitch: double, pitch_std: double, depth: double, depth_std: double, altitude: double, altitude_std: double, sound_velocity: double, sound_velocity_correction: double, latitude: double, longitude: double, crs: string, date: string, height: double, height_std: double>>"
_TARGET = "array<struct<latitude: double, latitude_std: double, longitude: double, longitude_std: double, northings: double, northings_std: double, eastings: double, eastings_std: double, depth: double, depth_std: double, distance_to_ship: string, heading: double>>"
_IMAGE = "array<struct<epoch_timestamp: double, filename: string, serial: string, epoch_timestamp_cpu: double, epoch_timestamp_cam: double>>"
SCHEMA = f"epoch_timestamp double, class string, sensor string, frame string, category string, epoch_timestamp_dvl double, epoch_timestamp_depth double, data {_DATA}, data_ship {_TARGET}, data_target {_TARGET}, camera1 {_IMAGE}, camera2 {_IMAGE}, camera3 {_IMAGE}, filename string, serial string"

#: Where each category's columns stand: name -> (place in the array, field).
PLACES = {
    "velocity_body": {f"{k}_velocity{s}": (i, f"{k}_velocity{s}") for i, k in enumerate("xyz") for s in ("", "_std")},
    "velocity_inertial": {f"{k}_velocity{s}": (i, f"{k}_velocity{s}") for i, k in enumerate(("north", "east", "down")) for s in ("", "_std")},
    "orientation": {"yaw": (0, "heading"), "yaw_std": (0, "heading_std"), "roll": (1, "roll"), "roll_std": (1, "roll_std"), "pitch": (2, "pitch"), "pitch_std": (2, "pitch_std")},
    "depth": {"depth": (0, "depth"), "depth_std": (0, "depth_std")},
    "altitude": {"altitude": (0, "altitude"), "altitude_std": (0, "altitude_std"), "sound_velocity": (1, "sound_velocity"), "sound_velocity_correction": (1, "sound_velocity_correction")},
    "tide": {"height": (0, "height"), "height_std": (0, "height_std")},
    "origin": {"latitude": (0, "latitude"), "longitude": (0, "longitude"), "crs": (0, "crs"), "date": (0, "date")},
}


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON arrays at a path, with the file and their order."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path).select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("seq"))


def category(records: DataFrame, name: str) -> DataFrame:
    """The table of a category: file, seq, t and its columns."""
    kind, _, frame = name.partition("_")
    rows = records.filter(F.col("category").contains(kind))
    if frame:
        rows = rows.filter(F.col("frame").contains(frame))
    return rows.select("file", "seq", F.col("epoch_timestamp").alias("t"), F.col("epoch_timestamp_dvl").alias("t_dvl"), F.col("epoch_timestamp_depth").alias("t_depth"), *[F.get("data", F.lit(i))[f].alias(c) for c, (i, f) in PLACES[name].items()])


def usbl(records: DataFrame) -> DataFrame:
    at = lambda i, f: F.get("data_target", F.lit(i))[f]
    cols = [at(i, f"{n}{s}").alias(f"{n}{s}") for i, n in enumerate(("latitude", "longitude", "northings", "eastings", "depth")) for s in ("", "_std")]
    return records.filter(F.col("category").contains("usbl")).select("file", "seq", F.col("epoch_timestamp").alias("t"), *cols, at(5, "distance_to_ship").try_cast("double").alias("distance_to_ship"))


def cameras(records: DataFrame) -> DataFrame:
    """Images of all cameras: camera, t, filename."""
    rows = records.filter(F.col("category").contains("image") | F.col("category").contains("laser"))
    one = F.array(*[F.struct(F.lit(c).alias("camera"), F.get(c, F.lit(0))["epoch_timestamp"].alias("t"), F.get(c, F.lit(0))["filename"].alias("filename")) for c in ("camera1", "camera2", "camera3")],
                  F.struct(F.lit("laser").alias("camera"), F.col("epoch_timestamp").alias("t"), F.col("filename").alias("filename")))
    return rows.select("file", "seq", F.explode(one).alias("i")).select("file", "seq", "i.*").filter(F.col("filename").isNotNull())


def prefixed(records: DataFrame, prefix: str) -> DataFrame:
    """Image names under a dive's folder."""
    named = {c: F.transform(c, lambda x: x.withField("filename", F.concat(F.lit(prefix + "/"), x["filename"]))) for c in ("camera1", "camera2", "camera3")}
    return records.withColumns(named | {"filename": F.concat(F.lit(prefix + "/"), "filename")})
