"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most this many short rows (a few MB) may be broadcast; its rows are counted first.
BROADCAST_ROWS = 50_000

#: ASCII white space, as the contracts' [\x20\x09-\x0D].
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a temporary one, in local mode only."""
    sc = spark.sparkContext
    if (at := sc.getCheckpointDir()) is None:
        at = sc.getConf().get("spark.checkpoint.dir")
        if not at and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = at or tempfile.mkdtemp(prefix="fathomline-")
        sc.setCheckpointDir(at)
        at = sc.getCheckpointDir()
    return at


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(s.getPath().toString() for s in found or [])


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the one above the target is made if need be."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(target).getParent())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"{source} couldn't be moved to {target}")


def tidied(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``f`` for mapInArrow (or over a column's arrays); at the end of a task the worker gives back what it no longer needs. Workers wait for more tasks
    in the memory that an executor has for all of them, and allocators would keep their most ever."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """What this process no longer needs goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def cut(df: DataFrame) -> DataFrame:
    """Write a light table to the shared folder and go on from there: lost executors don't cost its lineage again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def swept(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and checkpoints that nothing refers to any more: it does so when the driver's garbage is
    collected. The driver's two processes give back what they have gathered, too."""
    give_back()
    spark._jvm.System.gc()


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Columns by exact name, renamed: picked(df, id="doc_id"). Other columns may clash with each other or with these."""
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{df.columns.index(n)}").alias(k) for k, n in names.items()])


def packed(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """All columns in one struct ``row``, safe from clashing names, and the way to each column by its (first) name."""
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    row = flat.select(F.struct(*[F.col(c) for c in flat.columns]).alias("row"))
    return row, {n: F.col(f"row.c{i}") for i, n in reversed(list(enumerate(df.columns)))}


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns that ``packed`` packed, under their names again, some of them replaced."""
    out = [changed.get(n, F.col(f"row.c{i}")) if columns.index(n) == i else F.col(f"row.c{i}") for i, n in enumerate(columns)]
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(out)]).toDF(*columns)


def small_or_not(df: DataFrame) -> DataFrame:
    """Marks a written table for broadcast if its counted rows are few; else Spark chooses the join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def free_name(columns: list[str], name: str) -> str:
    """The name, with underscores added while a column has it already."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
