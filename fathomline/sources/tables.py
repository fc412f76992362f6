"""CSV logs and pose files to measurement tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.functions import times
from fathomline.functions.frames import mount_yaw
from fathomline.operators.filters import between_marks, no_nans, sentinel_to_null
from fathomline.operators.windows import changed, monotone
from fathomline.sources.lines import name_of, read_lines


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Columns as text with the file and the order of rows: types are given by the readers below, nothing is inferred twice."""
    df = spark.read.option("header", True).option("sep", sep).option("nullValue", "None").csv(path)
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("seq"))


def _numbers(df: DataFrame, **cols: str) -> DataFrame:
    return df.select("file", "seq", *[c for c in ("t",) if c in df.columns], *[F.col(f"`{src}`").try_cast("double").alias(k) for k, src in cols.items()])


def std_of(df: DataFrame, cols: Sequence[str], factor: float, offset: float) -> DataFrame:
    return df.select("*", *[(F.abs(c) * factor + offset).alias(f"{c}_std") for c in cols])


# -- ALR


def alr(df: DataFrame, category: str) -> DataFrame:
    """Mission log of an autonomous long-range vehicle: bottom-locked velocities, angles in radians, GPS as fixes; later rows replace rows that are not later."""
    t = df.withColumn("t", F.col("epoch_timestamp").try_cast("double"))
    if category == "velocity":
        locked = t.filter(F.col("DVL_down_BT_is_good").try_cast("double") == 1) if "DVL_down_BT_is_good" in df.columns else t
        out = _numbers(locked, x_velocity="DVL_down_BT_x", y_velocity="DVL_down_BT_y", z_velocity="DVL_down_BT_z")
    elif category == "orientation":
        rad = _numbers(t, roll="AUV_roll", pitch="AUV_pitch", yaw="AUV_heading")
        out = rad.select("file", "seq", "t", *[F.degrees(c).alias(c) for c in ("roll", "pitch", "yaw")])
    elif category == "depth":
        out = _numbers(t, depth="AUV_depth")
    elif category == "altitude":
        out = _numbers(t, altitude="AUV_altitude")
    else:
        out = _numbers(t, latitude="GPS_latitude", longitude="GPS_longitude", depth="AUV_depth")
    values = [c for c in out.columns if c not in ("file", "seq", "t", "depth" if category == "usbl" else "")]
    return monotone(no_nans(out, values), ["file"], "seq", "t")


# -- ae2000


def ae2000(df: DataFrame, category: str, tz_hours: float = 0.0, offset_s: float = 0.0) -> DataFrame:
    """Logs with ``yyyy/mm/dd HH:MM:SS.fff`` in their second column; velocities in mm/s, only with bottom lock; depths over 0 that differ from the last."""
    second = df.columns[1]
    t = df.withColumn("t", times.string_to_epoch(F.col(f"`{second}`"), "yyyy/M/d H:m:s[.SSSSSS][.SSS]", tz_hours) + offset_s).filter(F.col("t").isNotNull())
    if category == "velocity":
        v = _numbers(t.filter(F.col("dvl_validBottom").try_cast("double") == 1), x_velocity="dvl_surgeVelBottom", y_velocity="dvl_swayVelBottom", z_velocity="dvl_heaveVelBottom")
        return v.select("file", "seq", "t", *[(F.col(f"{k}_velocity") / 1000).alias(f"{k}_velocity") for k in "xyz"])
    if category == "altitude":
        return _numbers(t.filter(F.col("dvl_validBottom").try_cast("double") == 1), altitude="dvl_rangeBottom")
    if category == "orientation":
        return _numbers(t, roll="roll", pitch="pitch", yaw="yaw")
    return changed(_numbers(t, depth="Depth").filter("depth > 0"), ["file"], "seq", "depth")


# -- koyo21


def koyo21(df: DataFrame, category: str) -> DataFrame:
    """Remote vehicle's log, raw (Date, Time) or filtered (timestamp), read as UTC."""
    stamp = times.string_to_epoch(F.col("timestamp"), "yyyy-MM-dd HH:mm:ss") if "timestamp" in df.columns else times.string_to_epoch(F.concat_ws(" ", "Date", "Time"), "yyyy/M/d H:m:s")
    t = df.withColumn("t", stamp)
    cols = {"orientation": {"roll": "Roll", "pitch": "Pich", "yaw": "Hedding"}, "depth": {"depth": "Depth(ROV)"}, "altitude": {"altitude": "Altitude"}, "velocity": {"x_velocity": "Surge", "z_velocity": "Heave"}, "usbl": {"latitude": "Latitude", "longitude": "Longitude"}}[category]
    out = no_nans(_numbers(t, **cols), list(cols))
    if category == "velocity":
        out = out.withColumn("y_velocity", F.lit(0.0))
    return monotone(out, ["file"], "seq", "t")


# -- NTNU DVL


def ntnu_dvl(df: DataFrame, category: str, heading_offset: float = 0.0, factor: float = 0.0) -> DataFrame:
    """Tab-separated; the day is in the file's name; velocities without bottom lock are out of range and become null."""
    n = name_of()
    day = times.epoch_from_parts(F.substring(n, 1, 4).try_cast("int"), F.substring(n, 5, 2).try_cast("int"), F.substring(n, 7, 2).try_cast("int"), 0, 0, 0)
    t = df.withColumn("t", times.clock_of_day(F.regexp_replace("time", ":", ""), day))
    if category == "altitude":
        a = _numbers(t, a1="dvl_alt1", a3="dvl_alt3").withColumn("altitude", (F.col("a1") + F.col("a3")) / 2)
        return a.select("file", "seq", "t", "altitude", (F.col("altitude") * factor).alias("altitude_std"))
    v = _numbers(t, u="u_dvl", v="v_dvl", w="z_dvl")
    xyz = mount_yaw((F.col("u"), F.col("v"), F.col("w")), heading_offset)
    return v.select("file", "seq", "t", *[sentinel_to_null(c).alias(f"{k}_velocity") for k, c in zip("xyz", xyz, strict=True)])


# -- payloads, poses


def payload(spark: SparkSession, path: str, offset_s: float = 0.0, schema: str | None = None) -> DataFrame:
    """Any CSV with ``corrected_timestamp``; other columns as they are. Without a ``schema`` the files are read once more to find one."""
    reader = spark.read.option("header", True)
    df = (reader.option("enforceSchema", False).schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return df.withColumn("t", F.col("corrected_timestamp").cast("double") + offset_s)


def acfr_poses(spark: SparkSession, path: str, stereo: bool = False) -> DataFrame:
    """Pose files: ``%`` comments, then 11 (vehicle) or 15 (stereo) numbers and names a line; angles come in radians."""
    lines = read_lines(spark, path).filter(~F.col("line").startswith("%") & ~F.col("line").startswith("ORIGIN_") & (F.trim("line") != ""))
    return acfr_fields(lines, stereo)


def acfr_fields(lines: DataFrame, stereo: bool = False) -> DataFrame:
    names = ["id", "t", "latitude", "longitude", "northings", "eastings", "depth", "roll", "pitch", "yaw"] + (["left", "right", "altitude", "radius", "crossover"] if stereo else ["altitude"])
    body = lines.filter(~F.col("line").startswith("%") & ~F.col("line").startswith("ORIGIN_"))
    p = F.split(F.trim("line"), r"\s+")
    at = lambda i, n: F.get(p, F.lit(i)) if n in ("left", "right") else F.get(p, F.lit(i)).try_cast("long" if n in ("id", "crossover") else "double")
    rows = body.filter(F.size(p) == len(names)).select("file", "seq", *[at(i, n).alias(n) for i, n in enumerate(names)])
    return rows.select("file", "seq", *[F.degrees(n).alias(n) if n in ("roll", "pitch", "yaw") else F.col(n) for n in names])


def track_of(file: str = "file") -> Column:
    """What a pose file and its covariance file share: the path without the suffix and without ``_cov``."""
    return F.regexp_replace(F.regexp_replace(F.col(file), r"\.[^./]*$", ""), "_cov$", "")


def states(poses: DataFrame, covariances: DataFrame, start: str | None = None, end: str | None = None, path: str = "relative_path") -> DataFrame:
    """Poses with their covariances by position in the pair of files ``x.csv`` and ``x_cov.csv``, between two images."""
    numbered = lambda d: d.withColumn("_track", track_of()).withColumn("_n", F.row_number().over(W.partitionBy("_track").orderBy("seq")))
    c = numbered(covariances)
    more = c.select("_track", "_n", *[x for x in covariances.columns if x not in poses.columns])
    both = numbered(poses).join(more, ["_track", "_n"]).drop("_track", "_n")
    return between_marks(both, ["file"], "seq", path, start, end) if start and end else both


def camera_times(df: DataFrame, columns: dict[str, str], tz_hours: float = 0.0) -> DataFrame:
    """Image index and time from a CSV whose columns have stamp formats: {"date": "YYYYMMDD", "time": "hhmmss", "ms": "fff", "index": "iiiiiii"}."""
    index = [c for c, f in columns.items() if "i" in f]
    text = F.concat(*[F.lpad(F.col(c).cast("string"), len(f), "0") for c, f in columns.items() if "i" not in f])
    fmt = "".join(f for c, f in columns.items() if "i" not in f)
    return df.select(*[F.col(c).try_cast("long").alias("index") for c in index], times.epoch_from_stamp(text, fmt, tz_hours).alias("t"))


def ply(spark: SparkSession, path: str) -> DataFrame:
    """file, seq, x, y, z of point clouds in text form: rows after the header's end, as many as it says."""
    lines = read_lines(spark, path)
    head = lines.groupBy("file").agg(F.min(F.when(F.col("line") == "end_header", F.col("seq"))).alias("end"), F.max(F.regexp_extract("line", r"^element vertex (\d+)", 1).try_cast("long")).alias("n"))
    at = lambda i: F.get(F.split(F.trim("line"), r"\s+"), F.lit(i)).try_cast("double")
    return lines.join(head, "file").filter((F.col("seq") > F.col("end")) & (F.col("seq") <= F.col("end") + F.col("n"))).select("file", (F.col("seq") - F.col("end")).alias("seq"), *[at(i).alias(c) for i, c in enumerate("xyz")])
