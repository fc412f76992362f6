"""Text logs as ordered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def read_lines(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """file, seq (order within the file; gaps allowed), line. ``skip`` drops lines at the head of each file.

    The order is the place of the block in the file, then the order within the block: it holds however the file is split."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), F.regexp_replace("value", "\r$", "").alias("line"))
    w = W.partitionBy("file").orderBy("block", "n")
    numbered = raw.withColumn("seq", F.row_number().over(w).cast("long")).select("file", "seq", "line")
    return numbered.filter(F.col("seq") > skip) if skip else numbered


def lines_of(spark: SparkSession, texts: dict[str, list[str]]) -> DataFrame:
    """The same from memory, for tests and small inputs."""
    return spark.createDataFrame([(f, i + 1, x) for f, ls in texts.items() for i, x in enumerate(ls)], "file string, seq long, line string")


def part(line: Column | str, i: int, sep: str = ",") -> Column:
    """i-th field of a line; null past the end."""
    return F.get(F.split(F.col(line) if isinstance(line, str) else line, sep, -1), F.lit(i))


def num(line: Column | str, i: int, sep: str = ",") -> Column:
    return F.trim(part(line, i, sep)).try_cast("double")


def name_of(file: str = "file") -> Column:
    return F.regexp_extract(F.col(file), r"([^/]*)$", 1)
