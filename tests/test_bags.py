"""A bag that the test writes comes back; filters choose chunks."""

import bz2
import json
import struct

import pytest
from pyspark.sql import functions as F

from fathomline.sources import bags

IMU = "Header header\ngeometry_msgs/Quaternion orientation\nfloat64[9] covariance\n" + "=" * 80 + "\nMSG: std_msgs/Header\nuint32 seq\ntime stamp\nstring frame_id\n" + "=" * 80 + "\nMSG: geometry_msgs/Quaternion\nfloat64 x\nfloat64 y # of the axis\nfloat64 z\nfloat64 w\n"
NOTE = "uint8 LEVEL=3\nstring text\nuint8[] raw\nPoint[] points\nfloat32 odd\nduration d\n" + "=" * 80 + "\nMSG: my_msgs/Point\nint16 x\nbool on\n"


def record(head, data):
    raw = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k.encode() + b"=" + v for k, v in head.items())
    return struct.pack("<I", len(raw)) + raw + struct.pack("<I", len(data)) + data


def stamp(t):
    return struct.pack("<II", int(t), round((t - int(t)) * 1e9))


def imu(n, t, q):
    return struct.pack("<I", n) + stamp(t) + struct.pack("<I", 4) + b"base" + struct.pack("<4d", *q) + struct.pack("<9d", *([0.0] * 8), float("nan"))


def note(text, raw, points):
    return struct.pack("<I", len(text.encode())) + text.encode() + struct.pack("<I", len(raw)) + raw + struct.pack("<I", len(points)) + b"".join(struct.pack("<h?", *p) for p in points) + struct.pack("<f", 0.5) + struct.pack("<ii", -2, 500_000_000)


def write_bag(path, chunks, packing="none"):
    """chunks: lists of (connection, time, message)"""
    kinds = {0: ("/imu", "sensor_msgs/Imu", IMU), 1: ("/note", "my_msgs/Note", NOTE)}
    connection = lambda c: record({"op": b"\x07", "conn": struct.pack("<I", c), "topic": kinds[c][0].encode()}, b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k + b"=" + v for k, v in ((b"topic", kinds[c][0].encode()), (b"type", kinds[c][1].encode()), (b"md5sum", b"0" * 32), (b"message_definition", kinds[c][2].encode()))))
    body, infos = b"", b""
    start = len(bags.MAGIC) + 4096
    for messages in chunks:
        data = b"".join(connection(c) for c in sorted({m[0] for m in messages})) + b"".join(record({"op": b"\x02", "conn": struct.pack("<I", c), "time": stamp(t)}, m) for c, t, m in messages)
        infos += record({"op": b"\x06", "ver": struct.pack("<I", 1), "chunk_pos": struct.pack("<Q", start + len(body)), "start_time": stamp(min(m[1] for m in messages)), "end_time": stamp(max(m[1] for m in messages)), "count": struct.pack("<I", 1)}, b"".join(struct.pack("<II", c, sum(m[0] == c for m in messages)) for c in sorted({m[0] for m in messages})))
        body += record({"op": b"\x05", "compression": packing.encode(), "size": struct.pack("<I", len(data))}, bz2.compress(data) if packing == "bz2" else data)
        body += record({"op": b"\x04", "ver": struct.pack("<I", 1), "conn": struct.pack("<I", 0), "count": struct.pack("<I", 0)}, b"")
    fixed = {"op": b"\x03", "index_pos": struct.pack("<Q", start + len(body)), "conn_count": struct.pack("<I", 2), "chunk_count": struct.pack("<I", len(chunks))}
    bare = len(record(fixed, b""))
    path.write_bytes(bags.MAGIC + record(fixed, b" " * (4096 - bare)) + body + connection(0) + connection(1) + infos)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("bags")
    half = 0.5**0.5
    chunks = [[(0, 100.0 + 10 * k + i, imu(i, 100.25 + 10 * k + i, (0, 0, half, half))) for i in range(5)] + ([(1, 103.0 + 10 * k, note(f"höhe {k}", b"\x01\xff", [(3, True), (-4, False)]))] if k % 2 else []) for k in range(6)]
    write_bag(d / "a.bag", chunks)
    write_bag(d / "b.bag", [[(1, 500.0, note("", b"", []))]], "bz2")
    (d / "other.txt").write_text("no bag")
    return d


def test_messages_come_back_by_topic(spark, folder):
    got = bags.read(spark, str(folder)).collect()
    assert len(got) == 30 + 3 + 1 and {r["topic"] for r in got} == {"/imu", "/note"}
    notes = sorted((r["t"], json.loads(r["message"])) for r in got if r["topic"] == "/note")
    assert notes[0] == (113.0, {"text": "höhe 1", "raw": "Af8=", "points": [{"x": 3, "on": True}, {"x": -4, "on": False}], "odd": 0.5, "d": -1.5})
    assert notes[-1] == (500.0, {"text": "", "raw": "", "points": [], "odd": 0.5, "d": -1.5})
    first = json.loads(min(r["message"] for r in got if r["topic"] == "/imu" and r["t"] == 100.0))
    assert first["header"] == {"seq": 0, "stamp": 100.25, "frame_id": "base"} and first["covariance"][7:] == [0.0, None]
    turned = bags.attitudes(spark, str(folder / "a.bag"), ["/imu"]).orderBy("t").collect()
    assert len(turned) == 30 and turned[0]["t"] == 100.25 and abs(turned[0]["yaw"] - 90) < 1e-9 and abs(turned[0]["roll"]) < 1e-9
    assert bags.read(spark, str(folder / "*.bag"), ["/note"]).count() == 4


def test_topics_and_times_choose_chunks(spark, folder):
    path = str(folder / "a.bag")
    reader = lambda **o: bags.BagReader({"path": path, **o})
    assert len(reader().partitions()) == 6 and len(reader(topics="/note").partitions()) == 3 and len(reader(start="121", end="133").partitions()) == 2
    whole = reader()
    left = list(whole.taken([bags.GreaterThan(("t",), 120.0), bags.LessThanOrEqual(("t",), 124.0), bags.EqualTo(("topic",), "/imu"), bags.EqualTo(("type",), "x")]))
    assert len(whole.partitions()) == 1 and [type(f).__name__ for f in left] == ["GreaterThan", "EqualTo"]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = bags.read(spark, path).filter((F.col("t") > 120.0) & (F.col("t") <= 124.0) & (F.col("topic") == "/imu"))
        assert sorted(r["t"] for r in some.collect()) == [121.0, 122.0, 123.0, 124.0] and some.rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert bags.read(spark, path, ["/none"]).count() == 0


def test_images_meet_the_nearest_message(spark, folder):
    images = spark.createDataFrame([(100.002,), (101.0049,), (102.2,)], "t double")
    got = bags.nearest_messages(images, bags.read(spark, str(folder / "a.bag"), ["/imu"])).collect()
    assert sorted(r["matched_at"]["t"] for r in got) == [100.0, 101.0]


def test_files_that_are_no_bags(spark, folder, tmp_path):
    (tmp_path / "x.bag").write_bytes(b"#ROSBAG V1.2\n")
    with pytest.raises(ValueError, match="no bag"):
        bags.chunks_of(str(tmp_path / "x.bag"))
    fixed = record({"op": b"\x03", "index_pos": struct.pack("<Q", 0)}, b"")
    (tmp_path / "y.bag").write_bytes(bags.MAGIC + fixed)
    with pytest.raises(ValueError, match="no index"):
        bags.chunks_of(str(tmp_path / "y.bag"))
