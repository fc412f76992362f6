"""Remote vehicles whose logs become camera poses at once: position, attitude and image times in, poses out.

Images meet the logs by bracket joins on (dive, time). Each table has ``dive`` and ``t``; readers of single files take the
folder or file name as the dive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.config import Vehicle
from fathomline.functions import frames, geo, times
from fathomline.operators import folds, interp, windows

BY = ["dive"]
POSE = ["northings", "eastings", "depth", "roll", "pitch", "heading", "altitude"]


def _flat(spark: SparkSession, path: str, header: bool, encoding: str = "UTF-8") -> DataFrame:
    df = spark.read.option("header", header).option("encoding", encoding).option("escape", "\0").option("ignoreLeadingWhiteSpace", True).csv(path)
    names = [c.strip() for c in df.columns]
    return df.toDF(*names).select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("seq"))


def increasing(rows: DataFrame, by: list[str], order: str, t: str) -> DataFrame:
    """Rows later than all before them; the first of each group only sets the clock."""
    before = F.max(t).over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("_before", before).filter(F.col(t) > F.col("_before")).drop("_before")


# -- koyo20


def koyo20_positions(spark: SparkSession, path: str, dive: str = "", encoding: str = "ISO-8859-1") -> DataFrame:
    """dive, t, depth, altitude, latitude, longitude of ship logs without a header; zeros of depth and altitude are bridged.

    The logs' Japanese columns aren't used; read byte by byte they hold no separators."""
    raw = _flat(spark, path, header=False, encoding=encoding)
    c = lambda i: F.col(f"_c{i}")
    date, clock = F.lpad(c(2), 13, " "), c(3)
    n = lambda of, a, k: F.substring(of, a, k).try_cast("int")
    t = times.epoch_from_parts(2000 + n(date, 6, 2), n(date, 9, 2), n(date, 12, 2), n(clock, 1, 2), n(clock, 4, 2), n(clock, 7, 2))
    number = {"depth": 23, "altitude": 24, "latitude": 31, "longitude": 32}
    rows = raw.filter(F.length(c(2)) >= 8).select(F.lit(dive).alias("dive"), "file", "seq", t.alias("t"), *[F.trim(c(i)).try_cast("double").alias(k) for k, i in number.items()]).filter(F.col("t").isNotNull())
    return windows.repaired_zeros(increasing(rows, ["dive", "file"], "seq", "t"), BY, "t", ["depth", "altitude"])


def _stamped(date: Column, clock: Column, ms: Column) -> Column:
    d, h = date.try_cast("long").cast("string"), F.lpad(clock.try_cast("long").cast("string"), 6, "0")
    n = lambda of, a, k: F.substring(of, a, k).try_cast("int")
    return times.epoch_from_parts(n(d, 1, 4), n(d, 5, 2), n(d, 7, 2), n(h, 1, 2), n(h, 3, 2), n(h, 5, 2)) + ms.try_cast("double") / 1000


def koyo20_attitudes(spark: SparkSession, path: str, dive: str = "") -> DataFrame:
    """dive, t, roll, pitch, heading of a compass log; rows without an index don't count."""
    raw = _flat(spark, path, header=True).filter(F.col("index").try_cast("double").isNotNull())
    return raw.select(F.lit(dive).alias("dive"), _stamped(F.col("`date(YYYYMMDD)`"), F.col("`time(hhmmss)`"), F.col("`time_ms(iiii)`")).alias("t"), *[F.col(f"`{k}(degrees)`").try_cast("double").alias(k) for k in ("roll", "pitch", "heading")])


def koyo20_images(spark: SparkSession, path: str, dive: str = "") -> DataFrame:
    """dive, t, index of a camera's time file."""
    raw = _flat(spark, path, header=True).filter(F.col("index").try_cast("double").isNotNull())
    return raw.select(F.lit(dive).alias("dive"), _stamped(F.col("date"), F.col("time"), F.col("ms")).alias("t"), F.col("index").try_cast("long").alias("index"))


def koyo20_poses(images: DataFrame, positions: DataFrame, attitudes: DataFrame, vehicle: Vehicle, camera: str, latitude: float, longitude: float, most_speed: float = 20.0) -> DataFrame:
    """Poses at image times within both logs, at the camera's place. Depth starts from the depth sensor, all else from the DVL.

    Positions that would need more than ``most_speed`` metres a second are left out first."""
    sane = folds.speed_filtered(positions.select(*BY, "t", "depth", "altitude", "latitude", "longitude"), BY, "t", "latitude", "longitude", most_speed)
    at = interp.interpolated(images, sane, BY, "t", ["latitude", "longitude", "depth", "altitude"], extrapolate=False)
    turned = interp.interpolated(at, attitudes, BY, "t", ["heading", "pitch", "roll"], extrapolate=False)
    whole = turned.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("depth").isNotNull() & F.col("altitude").isNotNull() & F.col("heading").isNotNull() & F.col("pitch").isNotNull() & F.col("roll").isNotNull())
    n, e = geo.northings_eastings(F.col("_g"))
    placed = whole.withColumn("_g", geo.latlon_to_metres(F.col("latitude"), F.col("longitude"), latitude, longitude)).withColumns({"northings": n, "eastings": e}).drop("_g")
    arm = lambda sensor: frames.body_to_inertial("roll", "pitch", "heading", *[F.lit(float(a - b)) for a, b in zip(vehicle.arm(camera), vehicle.arm(sensor), strict=True)])
    (dn, de, dd), (_, _, deeper) = arm("dvl"), arm("depth")
    moved = placed.withColumns({"northings": F.col("northings") + dn, "eastings": F.col("eastings") + de, "altitude": F.col("altitude") - dd, "depth": F.col("depth") + deeper})
    return moved.withColumn("_p", geo.metres_to_latlon(latitude, longitude, F.col("eastings"), F.col("northings"))).select(*BY, "t", *[c for c in images.columns if c not in (*BY, "t")], *POSE, "_p.latitude", "_p.longitude")


# -- HyBIS


def hybis_positions(spark: SparkSession, path: str, dive: str = "") -> DataFrame:
    """dive, t, roll, pitch, heading, depth, altitude, latitude, longitude; zeros of depth and altitude are bridged."""
    raw = _flat(spark, path, header=True)
    d, h = F.trim("Date"), F.trim("Time")
    n = lambda of, a, k: F.substring(of, a, k).try_cast("int")
    t = times.epoch_from_parts(n(d, 7, 4), n(d, 4, 2), n(d, 1, 2), n(h, 1, 2), n(h, 4, 2), n(h, 7, 2))
    num = {"roll": "Roll", "pitch": "Pitch", "heading": "Heading", "depth": "Pressure", "altitude": "Altitude"}
    rows = raw.filter(F.length(F.trim("Hybis Long")) >= 11).select(F.lit(dive).alias("dive"), t.alias("t"), *[F.col(s).try_cast("double").alias(k) for k, s in num.items()], geo.degrees_from_minutes(F.col("Hybis Lat")).alias("latitude"), geo.degrees_from_minutes(F.col("Hybis Long")).alias("longitude"))
    return windows.repaired_zeros(rows.filter(F.col("t").isNotNull()), BY, "t", ["depth", "altitude"])


def hybis_poses(images: DataFrame, positions: DataFrame, latitude: float, longitude: float) -> DataFrame:
    """Poses at image times; before the first and after the last position, the line of the nearest two goes on."""
    cols = ["latitude", "longitude", "depth", "roll", "pitch", "heading", "altitude"]
    at = interp.interpolated(images, positions, BY, "t", cols)
    n, e = geo.northings_eastings(F.col("_g"))
    placed = at.withColumn("_g", geo.latlon_to_metres(F.col("latitude"), F.col("longitude"), latitude, longitude)).withColumns({"northings": n, "eastings": e})
    return placed.select(*BY, "t", *[c for c in images.columns if c not in (*BY, "t")], *POSE, "latitude", "longitude")
