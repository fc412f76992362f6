import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from fathomline.llm import archives as ar

PAGES = [
    (1, "http://a.example/x y", "hi\r\n\r\nWARC/1.0\r\n\n\nfiledesc://x 1 2 3 4\n"), (2, None, None), (3, "http://é.example/", "x" * 1000), (4, "http://b.example/", "x" * 1000), (5, "u", "s" * 99), (6, "u", "s" * 99), (7, "u", "s" * 100), (8, "u", "s" * 100),
    (9, "u", "é" * 60), (0, "u", "é" * 60), (None, "u", "x" * 1000), (10, "u", "\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n" * 20), (11, "u", ""), (12, "u", "z" * 300_000),
]


def brute(pages):
    body = lambda h: (h or "").encode()
    first = {}
    for i, _, h in pages:
        if len(body(h)) >= 100:
            k = body(h)
            first[k] = i if k not in first or first[k] is None or (i is not None and i < first[k]) else first[k]
    out = []
    for i, _, h in pages:
        k = body(h)
        f = first.get(k, i)
        out.append((i, len(k), hashlib.sha256(k).hexdigest(), "response" if f == i else "revisit", None if f == i else f))
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("size", [1, 7, 10**6])
def test_arc_records_are_cut_by_declared_lengths(version, size):
    out = bytearray(ar.version_block("x.arc", version))
    for i, u, h in PAGES[:9]:
        out += ar.arc_record(u, i, h, version, "x.arc", len(out))
    rows = list(ar.converted("x.arc", [bytes(out[k : k + size]) for k in range(0, len(out), size)]))
    assert rows[0][1] == "warcinfo" and [r[8] for r in rows[1:]] == [(h or "").encode() for _, _, h in PAGES[:9]]
    assert len({r[0] for r in rows}) == len(rows) and all(uuid.UUID(r[0][10:-1]) for r in rows)
    assert [r[6] for r in rows[1:]] == [i for i, _, _ in PAGES[:9]]
    cut = list(ar.converted("x.arc", [bytes(out[:-20])]))  # truncated: the last record goes
    assert len(cut) == len(rows) - 1


def test_dates_and_types():
    assert ar.warc_date("20010203040506") == "2001-02-03T04:05:06Z" and ar.warc_date("2001") == "2001-01-01T00:00:00Z" and ar.warc_date("x") == "2000-01-01T00:00:00Z"
    rec = lambda u, b: ar.ArcRecord({"url": u}, 1, 0, b)
    assert [ar.warc_type(rec(*x)) for x in (("filedesc://a", b""), ("http://a", b"x"), ("dns:a", b"x"), ("ftp://a", b"HTTP/1.0 200\n\nx"))] == ["warcinfo", "response", "resource", "response"]


def test_pages_through_archives(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).select("*", F.lit(1).alias("digest"), F.lit("b").alias("type"))
    out = ar.convert_pages(spark, df, str(tmp_path / "w"))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(PAGES)
    back = ar.read_warc(spark, str(tmp_path / "w"))
    assert back.filter("not block_ok").count() == 0
    again = {r["record_id"] for r in back.collect()}
    assert len(again) == back.count()


def test_repeated_rows_and_empty_table(spark, tmp_path):
    twice = [(1, "u", "a" * 200), (1, "u", "a" * 200), (2, "u", "b")]
    df = spark.createDataFrame(twice, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in ar.convert_pages(spark, df.repartition(2), str(tmp_path / "a")).filter("page_id = 1").collect())
    assert [g[1] for g in got] == ["response", "revisit"]
    assert ar.convert_pages(spark, df.filter("page_id > 5"), str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("gz", [False, True])
def test_arc_files(spark, tmp_path, gz):
    import gzip

    out = bytearray(ar.version_block("x.arc", 2))
    for i, u, h in PAGES[:9]:
        out += ar.arc_record(u, i, h, 2, "x.arc", len(out))
    p = tmp_path / ("x.arc.gz" if gz else "x.arc")
    p.write_bytes(gzip.compress(bytes(out)) if gz else bytes(out))
    rows = ar.read_arc_files(spark, str(p)).orderBy("place").collect()
    assert [bytes(r["body"]) for r in rows[1:]] == [(h or "").encode() for _, _, h in PAGES[:9]]
