"""Image listings and image decoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions import times
from fathomline.operators import joins
from fathomline.operators.images import IMAGE
from fathomline.sources.tables import camera_times


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, modified of files; contents aren't read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return df.select("path", "length", F.col("modificationTime").alias("modified"))


def camera_listing(files: DataFrame, style: str, tz_hours: float = 0.0, offset_s: float = 0.0) -> DataFrame:
    """path, t: times by a camera's way of naming (``acfr``, ``biocam``, ``ntnu``), by a stamp format, or by file time (``mtime``)."""
    if style == "mtime":
        t = times.epoch_of(F.col("modified"))
    elif style in ("acfr", "biocam", "ntnu"):
        t = times.epoch_from_image_name(F.col("path"), style, tz_hours)
    else:
        t = times.epoch_from_stamp(F.regexp_extract("path", r"([^/]+)$", 1), style, tz_hours)
    return files.withColumn("t", t + offset_s)


def stereo_pairs(left: DataFrame, right: DataFrame, tolerance: float = 0.05, inclusive: bool = True) -> DataFrame:
    """Left images with the nearest right image; (path, t, matched_path, matched_t)."""
    one = lambda d: d.select(F.lit(0).alias("g"), "path", "t")
    return joins.nearest(one(left), one(right), ["g"], "t", tolerance, "path", "path", inclusive).drop("g")


def by_index(images: DataFrame, stamps: DataFrame, pattern: str = r"(\d{7})") -> DataFrame:
    """Images with the time of the same index in a camera's time file."""
    return images.withColumn("index", F.regexp_extract("path", pattern, 1).try_cast("long")).join(stamps, "index")


def seaxerocks(files: DataFrame, stamps: DataFrame, tz_hours: float = 0.0, offset_s: float = 0.0, pattern: str = r"(\d{7})") -> DataFrame:
    """path, t, index of images whose times stand in the camera's time file (index, date, time, ms); images without a line there are left out."""
    t = camera_times(stamps, {"index": "iiiiiii", "date": "YYYYMMDD", "time": "hhmmss", "ms": "fff"}, tz_hours)
    return by_index(files, t, pattern).select("path", (F.col("t") + offset_s).alias("t"), "index")


def gopro_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """t, file_left, file_right of a list of stereo pairs (epoch, file_left, file_right) whose files are both there."""
    there = lambda files, name: files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias(name)).distinct()
    rows = pairs.select(F.col("epoch").try_cast("double").alias("t"), F.trim("file_left").alias("file_left"), F.trim("file_right").alias("file_right"))
    return rows.join(there(left, "file_left"), "file_left", "left_semi").join(there(right, "file_right"), "file_right", "left_semi").select("t", "file_left", "file_right")


def voyis(files: DataFrame, pps: str, system: str, tz_hours: float = 0.0, offset_s: float = 0.0) -> DataFrame:
    """path, t: names that say PPS from their 16th character on have one stamp format, all others the system's."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    t = F.when(F.substring(name, 16, 3) == "PPS", times.epoch_from_stamp(name, pps, tz_hours)).otherwise(times.epoch_from_stamp(name, system, tz_hours))
    return files.withColumn("t", t - offset_s).filter(F.col("t").isNotNull())


def decoded(files: DataFrame, kind: str, height: int = 0, width: int = 0, channels: int = 1, bits: int = 8) -> DataFrame:
    """image_id, height, width, channels, data (0 to 1) of binary files: ``raw`` (8 or 16 bits), ``packed18`` (18-bit Bayer values, four in 12 bytes), ``npy``, ``pnm``.

    One file is in memory at a time."""
    import io

    def pixels(content: bytes) -> np.ndarray:
        if kind == "npy":
            return np.load(io.BytesIO(content), allow_pickle=False).astype(np.float32)
        if kind == "pnm":
            head, rest, fields = content[:2], content[2:], []
            while len(fields) < 3:
                word, _, rest = rest.lstrip().partition(b"\n" if rest.lstrip().startswith(b"#") else b" ") if b" " in rest[:20] and rest.lstrip().find(b" ") < rest.lstrip().find(b"\n") else rest.lstrip().partition(b"\n")
                if not word.startswith(b"#"):
                    fields += [int(x) for x in word.split()]
            w, h, top = fields[:3]
            a = np.frombuffer(rest, ">u2" if top > 255 else "u1")[: w * h * (3 if head == b"P6" else 1)]
            return (a.reshape(h, w, -1) / top).astype(np.float32)
        if kind == "packed18":
            # 32-bit words with their bytes turned round; then three bytes a pixel, highest first
            b = np.frombuffer(content[: len(content) // 12 * 12], "<u4").byteswap().view(np.uint8).reshape(-1, 3).astype(np.uint32)
            v = (b[:, 0] << 16 | b[:, 1] << 8 | b[:, 2]).astype(np.float32) * np.float32(2.0**-18)
            return v[: height * width].reshape(height, width)
        a = np.frombuffer(content, np.uint16 if bits > 8 else np.uint8)
        return (a[: height * width * channels].reshape(height, width, channels) * 2.0**-bits).astype(np.float32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf.path, pdf.content, strict=True):
                a = pixels(bytes(content))
                a = a[:, :, None] if a.ndim == 2 else a
                yield pd.DataFrame({"image_id": [path], "height": [a.shape[0]], "width": [a.shape[1]], "channels": [a.shape[2]], "data": [a.ravel()]})

    return files.select("path", "content").mapInPandas(run, IMAGE)
