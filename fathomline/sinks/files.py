"""Exports. Rows are put in order within a dive and written by Spark's own writers; a dive may be asked for as one file."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Headers of exported poses, by column.
POSE_HEADERS = {
    "t": "timestamp [s]", "northings": "northing [m]", "eastings": "easting [m]", "depth": "depth [m]", "roll": "roll [deg]", "pitch": "pitch [deg]", "yaw": "heading [deg]",
    "altitude": "altitude [m]", "latitude": "latitude [deg]", "longitude": "longitude [deg]",
    "x_velocity": "x_velocity [m/s]", "y_velocity": "y_velocity [m/s]", "z_velocity": "z_velocity [m/s]",
}


def write_interchange(records: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The tagged union, a folder per category, so that a reader of one category reads no other."""
    records.write.mode("overwrite").partitionBy("category").format(fmt).save(path)


def enough_rows(rows: DataFrame, by: Sequence[str], least: int = 2) -> DataFrame:
    """Rows of groups with at least ``least`` rows: shorter tables aren't exported."""
    n = rows.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).drop("_n")
    return rows.join(n, list(by), "left_semi")


def write_csv(rows: DataFrame, path: str, by: Sequence[str] = (), order: str = "t", headers: dict[str, str] = POSE_HEADERS) -> None:
    """A folder per group and rows in order; null is written ``None``. Only groups with two rows or more are written."""
    rows = enough_rows(rows, by) if by else rows
    named = rows.withColumnsRenamed({k: v for k, v in headers.items() if k in rows.columns})
    o = headers.get(order, order)
    w = (named.repartition(*by) if by else named.repartition(1)).sortWithinPartitions(*by, o).write.mode("overwrite").option("header", True).option("nullValue", "None")
    (w.partitionBy(*by) if by else w).csv(path)


def covariance_columns(rows: DataFrame, states: Sequence[str] = ("x", "y", "z", "roll", "pitch", "yaw"), size: int = 12) -> DataFrame:
    """The upper-left block of a covariance array as 36 columns cov_a_b."""
    n = len(states)
    return rows.select(*[c for c in rows.columns if c != "covariance"], *[F.get("covariance", F.lit(i * size + j)).alias(f"cov_{states[i]}_{states[j]}") for i in range(n) for j in range(n)])


def sidescan_lines(rows: DataFrame, date_format: str = "yyyy/MM/dd HH:mm:ss.SSS") -> Column:
    """Fixed decimals, tab-separated."""
    stamp = F.date_format(F.timestamp_micros((F.col("t") * 1e6).cast("long")), date_format)
    return F.concat(stamp, F.format_string("\t%.6f\t%.6f\t%.3f\t%.3f\t%.3f\t%.3f\t%.3f", *[F.col(c).cast("double") for c in ("latitude", "longitude", "roll", "pitch", "yaw", "depth", "altitude")]))


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def information(covariance: str = "covariance", size: int = 12, keep: int = 6) -> Column:
    """Inverse of the pose block of a covariance, row by row in batches."""

    @F.pandas_udf("array<double>")
    def inverse(c: pd.Series) -> pd.Series:
        return c.map(lambda a: np.linalg.pinv(np.asarray(a, float).reshape(size, size)[:keep, :keep]).ravel().tolist())

    return inverse(F.col(covariance))


def edges(relative: DataFrame, order: Sequence[int] = (0, 1, 2, 5, 4, 3)) -> Column:
    """``EDGE3 i j dx dy dz dyaw dpitch droll`` and the upper triangle of the information matrix in that order."""
    info = [F.get("information", F.lit(order[i] * 6 + order[j])) for i in range(6) for j in range(i, 6)]
    deltas = [F.col(c) for c in ("d_northings", "d_eastings", "d_depth", "d_yaw", "d_pitch", "d_roll")]
    return F.concat_ws(" ", F.lit("EDGE3"), F.col("i").cast("string"), (F.col("i") + 1).cast("string"), *[v.cast("string") for v in [*deltas, *info]])


def acfr_pose_lines(rows: DataFrame) -> Column:
    """Vehicle poses: id, time, place, position and angles (radians)."""
    angles = [F.radians(c) for c in ("roll", "pitch", "yaw")]
    return F.concat_ws(" ", F.col("id").cast("string"), *[F.format_string("%.9f", c.cast("double")) for c in [F.col("t"), F.col("latitude"), F.col("longitude"), F.col("northings"), F.col("eastings"), F.col("depth"), *angles, F.col("altitude")]])


def acfr_raw_lines(rows: DataFrame) -> Column:
    """Tagged lines of a combined raw log, from rows with ``kind`` and their values."""
    num = lambda c: F.col(c).cast("string")
    return (
        F.when(F.col("kind") == "depth", F.concat(F.lit("PAROSCI: "), num("t"), F.lit(" "), num("depth")))
        .when(F.col("kind") == "usbl", F.concat(F.lit("SSBL_FIX: "), num("t"), F.lit(" target_x: "), num("northings"), F.lit(" target_y: "), num("eastings"), F.lit(" target_z: "), num("depth")))
        .when(F.col("kind") == "image", F.concat(F.lit("VIS: "), num("t"), F.lit(" ["), num("t"), F.lit("] "), F.col("filename"), F.lit(" exp: 0")))
        .when(F.col("kind") == "velocity", F.concat(F.lit("RDI: "), num("t"), F.lit(" alt:"), num("altitude"), F.lit(" r1:0 r2:0 r3:0 r4:0 h:"), num("yaw"), F.lit(" p:"), num("pitch"), F.lit(" r:"), num("roll"), F.lit(" vx:"), num("x_velocity"), F.lit(" vy:"), num("y_velocity"), F.lit(" vz:"), num("z_velocity")))
    )


def record_json(rows: DataFrame, category: str) -> Column:
    """Rows of a category as interchange JSON."""
    from fathomline.sources.interchange import PLACES

    places: dict[int, list[Column]] = {}
    for c, (i, f) in PLACES[category].items():
        if c in rows.columns:
            places.setdefault(i, []).append(F.col(c).alias(f))
    kind, _, frame = category.partition("_")
    data = F.concat(F.lit("["), F.concat_ws(", ", *[F.to_json(F.struct(*v), {"ignoreNullFields": "false"}) for _, v in sorted(places.items())]), F.lit("]"))
    head = F.to_json(F.struct(F.col("t").alias("epoch_timestamp"), F.lit("measurement").alias("class"), F.lit(frame or "body").alias("frame"), F.lit(kind).alias("category")))
    return F.concat(F.regexp_replace(head, r"\}$", ', "data": '), data, F.lit("}"))


def write_filelist(nav: DataFrame, images: DataFrame, path: str) -> None:
    """Navigation of the images that were processed, as one CSV a camera."""
    from fathomline.operators.joins import by_stem

    by_stem(nav, images, "relative_path", "processed", "processed").repartition(1).write.mode("overwrite").option("header", True).csv(path)


def simplified(nav: DataFrame, columns: dict[str, str], order: str) -> DataFrame:
    """Navigation with the columns (and names) that another program asks for."""
    return nav.select(*[F.col(f"`{k}`").alias(v) for k, v in columns.items()]).orderBy(order)


def write_attenuation(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").partitionBy("channel").parquet(path)


def write_images(images: DataFrame, folder: str) -> DataFrame:
    """8-bit PNM files of image rows (0 to 1), written by executors into a folder they share; returns (image_id, file)."""
    from collections.abc import Iterator

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        for pdf in batches:
            names = []
            for r in pdf.itertuples(index=False):
                a = np.clip(np.floor(np.asarray(r.data, float) * 255), 0, 255).astype(np.uint8).reshape(r.height, r.width, r.channels)
                name = os.path.join(folder, str(r.image_id).rsplit("/", 1)[-1].rsplit(".", 1)[0] + (".ppm" if r.channels == 3 else ".pgm"))
                part = f"{name}.{os.getpid()}"
                with open(part, "wb") as f:
                    f.write(f"P{6 if r.channels == 3 else 5}\n{r.width} {r.height}\n255\n".encode() + a.tobytes())
                os.replace(part, name)  # a task that runs twice leaves one whole file
                names.append(name)
            yield pd.DataFrame({"image_id": pdf.image_id, "file": names})

    return images.mapInPandas(run, "image_id string, file string")


def ply_lines(points: DataFrame, order: str) -> DataFrame:
    """A point cloud in text form: place, line. The header has the number of points; nothing is collected but that."""
    n = points.count()
    head = ["ply", "format ascii 1.0", f"element vertex {n}", "property float x", "property float y", "property float z", "end_header"]
    top = points.sparkSession.createDataFrame([(-len(head) + i, line) for i, line in enumerate(head)], "place long, line string")
    return top.unionByName(points.select(F.col(order).cast("long").alias("place"), F.concat_ws(" ", *[F.format_string("%.6f", F.col(c).cast("double")) for c in "xyz"]).alias("line"))).orderBy("place")


#: Headings of pose lists of remote vehicles and the columns under them.
POSE_LIST = {"northing [m]": "northings", "easting [m]": "eastings", "depth [m]": "depth", "roll [deg]": "roll", "pitch [deg]": "pitch", "heading [deg]": "heading", "altitude [m]": "altitude", "timestamp": "t", "latitude [deg]": "latitude", "longitude [deg]": "longitude", "relative_path": "path"}


def pose_list(poses: DataFrame, number: str = "image_number") -> DataFrame:
    """Poses under the headings of a pose list, by time; images without a number of their own are counted by time within a dive."""
    from pyspark.sql.window import Window as W

    n = F.col(number) if number in poses.columns else F.row_number().over(W.partitionBy("dive").orderBy("t")) - 1
    return poses.select(n.alias("image_number"), *[F.col(c).alias(h) for h, c in POSE_LIST.items() if c in poses.columns])
