"""MATLAB files (level 5) as tables: one row per element of each numeric array, named by its path through the structs.

Files are read by Spark and decoded where they are, one at a time. Cell arrays, objects and sparse matrices are skipped.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators.windows import monotone

# The format's type numbers.
NUMBERS = {1: "i1", 2: "u1", 3: "i2", 4: "u2", 5: "i4", 6: "u4", 7: "f4", 9: "f8", 12: "i8", 13: "u8"}
MATRIX, COMPRESSED = 14, 15
STRUCT, FIRST_NUMERIC = 2, 6


def elements(data: bytes, order: str) -> Iterator[tuple[int, bytes]]:
    """(type, content) of the data elements that follow each other; compressed ones are opened."""
    at = 0
    while at + 8 <= len(data):
        kind, size = struct.unpack_from(order + "II", data, at)
        if kind >> 16:  # a small element: size and type share a word, four bytes of content follow
            yield kind & 0xFFFF, data[at + 4 : at + 4 + (kind >> 16)]
            at += 8
            continue
        body = data[at + 8 : at + 8 + size]
        at += 8 + size
        if kind == COMPRESSED:
            yield from elements(zlib.decompress(body), order)
        else:
            yield kind, body
            at += -at % 8


def numbers(kind: int, body: bytes, order: str) -> np.ndarray:
    return np.frombuffer(body, order + NUMBERS[kind])


def arrays_of(body: bytes, order: str, above: str = "") -> Iterator[tuple[str, np.ndarray]]:
    """(path, values in column order) of the numeric arrays of a matrix element and of the structs in it."""
    parts = list(elements(body, order))
    if len(parts) < 3:
        return
    kind = int(numbers(*parts[0], order)[0]) & 0xFF
    name = parts[2][1].decode("ascii", "replace")
    path = ".".join(x for x in (above, name) if x)
    if kind == STRUCT:
        width = int(numbers(*parts[3], order)[0])
        names = [parts[4][1][i : i + width].split(b"\0")[0].decode("ascii", "replace") for i in range(0, len(parts[4][1]), width)]
        for i, (_, inner) in enumerate(parts[5:]):
            field = names[i % len(names)]
            yield from arrays_of(inner, order, f"{path}.{field}" if path else field)
    elif kind >= FIRST_NUMERIC and len(parts) > 3:
        yield path, numbers(*parts[3], order).astype(np.float64)


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, name, i, value"""

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, content in zip(pdf.path, pdf.content, strict=True):
                data = bytes(content)
                order = "<" if data[126:128] == b"IM" else ">"
                for kind, body in elements(data[128:], order):
                    if kind == MATRIX:
                        for name, values in arrays_of(body, order):
                            yield pd.DataFrame({"file": file, "name": name, "i": np.arange(len(values)), "value": values})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(decoded, "file string, name string, i long, value double")


#: Where each category's columns stand in a vehicle's mission file, and the factor that makes them metres or degrees.
DEGREES = 57.29577951308232
AUTOSUB = {
    "velocity": ("ADCPbin00", {"x_velocity": ("Vnorth0", -1e-3), "y_velocity": ("Veast0", -1e-3), "z_velocity": ("Vdown0", -1e-3), "x_velocity_std": ("Verr0", 1e-3), "y_velocity_std": ("Verr0", 1e-3), "z_velocity_std": ("Verr0", 1e-3)}),
    "orientation": ("INSAttitude", {"roll": ("Roll", DEGREES), "pitch": ("Pitch", DEGREES), "yaw": ("Heading", DEGREES)}),
    "depth": ("DepCtlNode", {"depth": ("DepCtldepth", 1.0)}),
    "altitude": ("ADCPLog_1", {"altitude": ("ADCPAvAlt", 1.0)}),
}


def autosub(arrays: DataFrame, category: str, factor: float = 0.0, root: str = "missionData") -> DataFrame:
    """file, seq, t and a category's columns; a row that isn't later than the one before replaces it."""
    node, columns = AUTOSUB[category]
    of = lambda field: F.max(F.when(F.col("name") == f"{root}.{node}.{field}", F.col("value")))
    rows = arrays.filter(F.col("name").startswith(f"{root}.{node}.")).groupBy("file", F.col("i").alias("seq")).agg(of("eTime").alias("t"), *[(of(f) * k).alias(c) for c, (f, k) in columns.items()]).filter(F.col("t").isNotNull())
    out = monotone(rows, ["file"], "seq", "t")
    if category in ("depth", "altitude"):
        out = out.withColumn(f"{category}_std", F.col(category) * factor)
    return out.withColumn("t_dvl", F.col("t")) if category == "velocity" else out
