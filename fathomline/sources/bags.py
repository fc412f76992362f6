"""Bag files (format 2.0) as a Python Data Source: one partition a chunk, planned from the files' own index.

``spark.dataSource.register(BagSource)`` and ``spark.read.format("bag").load(path)``, or ``read``. Topics and times are pushed down,
as options (``topics``, separated by commas; ``start``, ``end``) or, with the option ``pushdown`` where the session sets
spark.sql.python.filterPushdown.enabled, from filters: chunks without such a topic or outside the times are never read. Files are opened through pyarrow's file systems, so a
path may be a local one or name a store that these know; a folder or a pattern in the last part of a path stands for its bags.

Rows: file, chunk (its place), topic, type, t (seconds), data (the message as it is), message (as JSON, by the definition that
the bag holds; bytes as base64, numbers that aren't finite as null). Chunks may be plain or bz2.
"""

from __future__ import annotations

import base64
import bz2
import fnmatch
import json
import math
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from fathomline.functions.frames import euler_from_quaternion
from fathomline.functions.geo import depth_of_pressure

SCHEMA = "file string, chunk long, topic string, type string, t double, data binary, message string"

#: Fixed values of the format.
MAGIC = b"#ROSBAG V2.0\n"
MESSAGE, HEADER, CHUNK, CHUNK_INFO, CONNECTION = 2, 3, 5, 6, 7
PRIMITIVES = {"bool": "?", "int8": "b", "uint8": "B", "byte": "b", "char": "B", "int16": "h", "uint16": "H", "int32": "i", "uint32": "I", "int64": "q", "uint64": "Q", "float32": "f", "float64": "d"}


def fields_of(raw: bytes) -> dict[str, bytes]:
    out, at = {}, 0
    while at < len(raw):
        (n,) = struct.unpack_from("<I", raw, at)
        name, _, value = raw[at + 4 : at + 4 + n].partition(b"=")
        out[name.decode()] = value
        at += 4 + n
    return out


def record(read) -> tuple[dict[str, bytes], bytes] | None:
    """The next record's header and data from ``read(n)``; None at the end."""
    size = read(4)
    if len(size) < 4:
        return None
    head = fields_of(read(struct.unpack("<I", size)[0]))
    return head, read(struct.unpack("<I", read(4))[0])


def seconds(raw: bytes) -> float:
    s, ns = struct.unpack("<II", raw)
    return s + ns / 1e9


def number(raw: bytes) -> int:
    return int.from_bytes(raw, "little")


@dataclass(frozen=True)
class Connection:
    topic: str
    type: str
    definition: str


@dataclass
class Chunk(InputPartition):
    file: str
    place: int
    connections: dict[int, Connection]

    def __post_init__(self) -> None:
        super().__init__(None)


class Layout:
    """Message types by the definitions that a bag holds, and what reads them."""

    def __init__(self, name: str, definition: str) -> None:
        parts = definition.split("\n" + "=" * 80 + "\n")
        self.name, self.types = name, {name: self.parsed(parts[0])}
        for p in parts[1:]:
            head, _, rest = p.partition("\n")
            self.types[head.removeprefix("MSG:").strip()] = self.parsed(rest)

    @staticmethod
    def parsed(text: str) -> list[tuple[str, str]]:
        lines = (x.split("#")[0].split() for x in text.splitlines())
        return [(x[0], x[1]) for x in lines if len(x) == 2 and "=" not in x[1]]

    def whole(self, kind: str, within: str) -> str:
        if kind == "Header":
            return "std_msgs/Header"
        return kind if "/" in kind else f"{within.split('/')[0]}/{kind}"

    def value(self, kind: str, raw: bytes, at: int, within: str):
        if kind.endswith("]"):
            base, _, count = kind[:-1].partition("[")
            n, at = (int(count), at) if count else (struct.unpack_from("<I", raw, at)[0], at + 4)
            if base in ("uint8", "char"):
                return base64.b64encode(raw[at : at + n]).decode(), at + n
            if base in PRIMITIVES:
                found = struct.unpack_from(f"<{n}{PRIMITIVES[base]}", raw, at)
                return [self.plain(v) for v in found], at + n * struct.calcsize(PRIMITIVES[base])
            out = []
            for _ in range(n):
                v, at = self.value(base, raw, at, within)
                out.append(v)
            return out, at
        if kind in PRIMITIVES:
            return self.plain(struct.unpack_from("<" + PRIMITIVES[kind], raw, at)[0]), at + struct.calcsize(PRIMITIVES[kind])
        if kind == "string":
            (n,) = struct.unpack_from("<I", raw, at)
            return raw[at + 4 : at + 4 + n].decode("utf-8", "replace"), at + 4 + n
        if kind in ("time", "duration"):
            s, ns = struct.unpack_from("<II" if kind == "time" else "<ii", raw, at)
            return s + ns / 1e9, at + 8
        return self.read(self.whole(kind, within), raw, at)

    @staticmethod
    def plain(v):
        return None if isinstance(v, float) and not math.isfinite(v) else v

    def read(self, name: str, raw: bytes, at: int = 0):
        out = {}
        for kind, field in self.types[name]:
            out[field], at = self.value(kind, raw, at, name)
        return out, at

    def json(self, raw: bytes) -> str:
        return json.dumps(self.read(self.name, raw)[0])


def opened(path: str):
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store, inner


def files_of(path: str) -> list[str]:
    """The file itself, the .bag files of a folder, or what matches a pattern in the last part."""
    from pyarrow import fs

    store, inner = opened(path)
    folder, _, last = inner.rpartition("/")
    if any(c in last for c in "*?["):
        found = [f.path for f in store.get_file_info(fs.FileSelector(folder)) if fnmatch.fnmatch(f.base_name, last)]
    elif store.get_file_info(inner).type == fs.FileType.Directory:
        found = [f.path for f in store.get_file_info(fs.FileSelector(inner)) if f.base_name.endswith(".bag")]
    else:
        return [path]
    lead = path[: len(path) - len(inner)]
    return sorted(lead + f for f in found)


def chunks_of(path: str) -> list[tuple[int, float, float, dict[int, Connection]]]:
    """(place, first time, last time, connections) of each chunk, from the index at the end of a bag."""
    store, inner = opened(path)
    with store.open_input_file(inner) as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no bag of format 2.0")
        head, _ = record(f.read)
        place = number(head["index_pos"])
        if not place:
            raise ValueError(f"{path} has no index: it was not closed")
        f.seek(place)
        connections, chunks = {}, []
        while (found := record(f.read)) is not None:
            head, data = found
            if head["op"][0] == CONNECTION:
                told = fields_of(data)
                connections[number(head["conn"])] = Connection(head["topic"].decode(), told["type"].decode(), told["message_definition"].decode("utf-8", "replace"))
            elif head["op"][0] == CHUNK_INFO:
                own = [c for c, _ in struct.iter_unpack("<II", data)]
                chunks.append((number(head["chunk_pos"]), seconds(head["start_time"]), seconds(head["end_time"]), own))
    return [(at, a, b, {c: connections[c] for c in own}) for at, a, b, own in chunks]


class BagReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.topics = {t.strip() for t in options["topics"].split(",")} if options.get("topics") else None
        self.start, self.end = float(options.get("start", "-inf")), float(options.get("end", "inf"))

    def wanted(self, c: Connection) -> bool:
        return self.topics is None or c.topic in self.topics

    def taken(self, filters: list[Filter]) -> Iterable[Filter]:
        """Topics and times choose chunks and rows; what is left is given back."""
        for f in filters:
            of = tuple(getattr(f, "attribute", ()))
            if of == ("topic",) and isinstance(f, (EqualTo, In)):
                some = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.topics = some if self.topics is None else self.topics & some
            elif of == ("t",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.start = max(self.start, float(f.value))
                if isinstance(f, GreaterThan):
                    yield f
            elif of == ("t",) and isinstance(f, (LessThan, LessThanOrEqual)):
                self.end = min(self.end, float(f.value))
                if isinstance(f, LessThan):
                    yield f
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        out = []
        for file in files_of(self.path):
            for place, first, last, connections in chunks_of(file):
                own = {n: c for n, c in connections.items() if self.wanted(c)}
                if own and first <= self.end and last >= self.start:
                    out.append(Chunk(file, place, own))
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not isinstance(partition, Chunk):  # no chunk was chosen
            return
        store, inner = opened(partition.file)
        with store.open_input_file(inner) as f:
            f.seek(partition.place)
            head, data = record(f.read)
        packing = head["compression"].decode()
        if packing not in ("none", "bz2"):
            raise ValueError(f"chunks packed by {packing} can't be read")
        data = bz2.decompress(data) if packing == "bz2" else data
        layouts = {n: Layout(c.type, c.definition) for n, c in partition.connections.items()}
        at = 0

        def take(n: int) -> bytes:
            nonlocal at
            at += n
            return data[at - n : at]

        while (found := record(take)) is not None:
            head, raw = found
            if head["op"][0] == MESSAGE and (n := number(head["conn"])) in layouts and self.start <= (t := seconds(head["time"])) <= self.end:
                c = partition.connections[n]
                yield partition.file, partition.place, c.topic, c.type, t, raw, layouts[n].json(raw)


class PushingReader(BagReader):
    """Where the session lets filters through: without that, Spark refuses a reader that takes them."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return self.taken(filters)


class BagSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bag"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BagReader:
        return (PushingReader if self.options.get("pushdown") == "true" else BagReader)(dict(self.options))


def read(spark: SparkSession, path: str, topics: Iterable[str] = (), start: float | None = None, end: float | None = None) -> DataFrame:
    """Messages of bags, of some topics and times only if these are given."""
    spark.dataSource.register(BagSource)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    options = {"pushdown": pushdown} | {k: str(v) for k, v in (("topics", ",".join(topics)), ("start", start), ("end", end)) if v not in (None, "")}
    return spark.read.format("bag").options(**options).load(path)


def parsed(bag: DataFrame, schema: str) -> DataFrame:
    """t (the header's stamp, or else the bag's time) and the fields of ``schema`` from the messages' JSON."""
    m = bag.select("t", "topic", F.from_json("message", f"header struct<stamp: double, frame_id: string>, {schema}").alias("m"))
    stamp = F.col("m.header.stamp")
    return m.select(F.when(stamp > 0, stamp).otherwise(F.col("t")).alias("t"), "topic", "m.*").drop("header")


def attitudes(spark: SparkSession, path: str, topics: Iterable[str], **times) -> DataFrame:
    """t, roll, pitch, yaw in degrees from inertial units' quaternions."""
    m = parsed(read(spark, path, topics, **times), "orientation struct<x: double, y: double, z: double, w: double>")
    r, p, y = euler_from_quaternion(*[F.col(f"orientation.{c}") for c in "xyzw"])
    return m.select("t", F.degrees(r).alias("roll"), F.degrees(p).alias("pitch"), F.degrees(y).alias("yaw"))


def depths(spark: SparkSession, path: str, topics: Iterable[str], **times) -> DataFrame:
    """t, depth from pressures (Pa)."""
    m = parsed(read(spark, path, topics, **times), "fluid_pressure double, variance double")
    return m.select("t", depth_of_pressure(F.col("fluid_pressure")).alias("depth"))


def positions(spark: SparkSession, path: str, topics: Iterable[str], **times) -> DataFrame:
    """t, latitude, longitude, altitude from satellite fixes."""
    return parsed(read(spark, path, topics, **times), "latitude double, longitude double, altitude double").select("t", "latitude", "longitude", "altitude")


def nearest_messages(images: DataFrame, bag: DataFrame, by_time: str = "t", within: float = 0.005) -> DataFrame:
    """Images with the message of a bag that is nearest to their time and closer than ``within`` seconds."""
    from fathomline.operators.joins import nearest

    left = images.select(F.col(by_time).alias("t"), F.monotonically_increasing_id().alias("image"), F.lit(1).alias("one"))
    right = bag.select("t", F.struct("t", "topic", "chunk").alias("at"), F.lit(1).alias("one"))
    return nearest(left, right, ["one"], "t", within, "image", "at", inclusive=False).drop("one")
