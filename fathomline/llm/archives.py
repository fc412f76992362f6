"""Legacy archive converter: ARC version 1 and 2 to WARC 1.0, and a WARC reader.

An ARC file starts with a version block (``filedesc://``), whose second line names the version. Each record is a header
line (URL, IP, date, type, length in version 1; five more fields before the length in version 2) and as many bytes as
it declares. Records are cut by those declared lengths only, never by what a payload looks like. From each, a WARC
record is made with a record id that depends on nothing but the archive's name, the record's place in it and its
header (so a task that is run again writes the same), the date in WARC's form, the type from the ARC type and status,
and block and payload digests.

Archives are read as a stream of lines, each file by one task, with one record in memory at a time; they are written
through Spark's text writer with WARC's record end as the line separator, so lost executors leave no half-written
archive behind.

Defined results: a null html is an empty payload; a null URL is written as ``urn:none``; white space and non-ASCII in
URLs are percent-encoded; a null page_id stays null and loses every tie for the smallest; equal payloads of at least
``LEAST`` bytes are one response and revisits of it; an empty table gives an empty result; rows repeated with one
page_id are one response and revisits of the same page_id; a truncated last record is dropped, a header line that isn't
one is skipped. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import cut, picked, tidied

LEAST = 100
IP, DATE, AGENT = "0.0.0.0", "20000101000000", "fathomline"
#: Rows of one ARC archive in memory.
ARCHIVED = 256
END = "\r\n\r\n"
#: What parts WARC records when a file is read as lines; parts are joined again by the declared lengths.
MARK = END + "WARC/1.0\r\n"

# Fixed formats: fields of a header line by ARC version.
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}


# -- ARC


@dataclass
class ArcRecord:
    head: dict[str, str]
    version: int
    offset: int
    block: bytes


def version_block(name: str, version: int, date: str = DATE) -> bytes:
    """The first record of an ARC file."""
    fields = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}[version]
    body = f"{version} 0 {AGENT}\n{fields}\n".encode()
    tail = f"{len(body)}" if version == 1 else f"200 - - 0 {name} {len(body)}"
    return f"filedesc://{name} {IP} {date} text/plain {tail}\n".encode() + body + b"\n"


def arc_url(url: str | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "urn:none"


def arc_record(url: str | None, page_id: int | None, html: str | None, version: int, name: str, offset: int) -> bytes:
    """A page as an ARC record: an HTTP response with the html as its body."""
    body = (html or "").encode("utf-8", "surrogatepass")
    about = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{about}Content-Length: {len(body)}\r\n\r\n".encode() + body
    tail = f"{len(block)}" if version == 1 else f"200 {hashlib.md5(block).hexdigest()} - {offset} {name} {len(block)}"
    return f"{arc_url(url)} {IP} {DATE} text/html {tail}\n".encode() + block + b"\n"


def read_arc(chunks: Iterable[bytes]) -> Iterator[ArcRecord]:
    """Records of one archive from its bytes, in pieces of any size. The version block sets the form of the headers."""
    held, source, at = bytearray(), iter(chunks), 0
    version = 1

    def more() -> bool:
        if (c := next(source, None)) is None:
            return False
        held.extend(c)
        return True

    while True:
        while (end := held.find(b"\n")) < 0:
            if not more():
                return
        line, start = bytes(held[:end]), at
        del held[: end + 1]
        at += end + 1
        parts = line.rstrip(b"\r").decode("utf-8", "replace").split(" ")
        # the version block's own header tells its version by its number of fields
        names = FIELDS[2 if parts[0].startswith("filedesc://") and len(parts) == len(FIELDS[2]) else 1 if parts[0].startswith("filedesc://") else version]
        if len(parts) < len(names) or not parts[-1].isdigit():
            continue  # the line between records, or damage: go on to the next that is a header
        head = dict(zip(names, [" ".join(parts[: len(parts) - len(names) + 1]), *parts[len(parts) - len(names) + 1 :]], strict=True))
        length = int(head["length"])
        while len(held) < length:
            if not more():
                return  # truncated
        block = bytes(held[:length])
        del held[:length]
        at += length
        if head["url"].startswith("filedesc://"):
            version = 2 if block.split(b" ", 1)[0] == b"2" else 1
        yield ArcRecord(head, version, start, block)


# -- ARC to WARC


def warc_date(date: str) -> str:
    """14 digits (fewer: padded with the earliest) to ISO 8601."""
    d = (date if date.isdigit() else DATE)[:14]
    d += "00000101000000"[len(d) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its blank line, and body; no header: all is body."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(i, n) for i, n in ((block.find(b"\r\n\r\n"), 4), (block.find(b"\n\n"), 2)) if i >= 0]
    if not ends:
        return block, b""
    i, n = min(ends)
    return block[: i + n], block[i + n :]


def http_field(header: bytes, name: str) -> str | None:
    for line in header.split(b"\n")[1:]:
        k, _, v = line.partition(b":")
        if k.strip().lower() == name.lower().encode():
            return v.strip().decode("latin-1")
    return None


def record_id(archive: str, r: ArcRecord) -> str:
    said = hashlib.sha256(f"{archive} {r.offset} {r.head['url']} {r.head['date']} {r.head['length']}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=said[:16], version=5)}>"


def warc_type(r: ArcRecord) -> str:
    url = r.head["url"]
    return "warcinfo" if url.startswith("filedesc://") else "response" if r.block.startswith(b"HTTP/") or url.startswith("http") else "resource"


#: What ``converted`` gives for each record of an archive. header, body: of the HTTP message.
CONVERTED = "record_id string, type string, url string, ip string, date string, mime string, page_id long, header binary, body binary, digest string, place long"


def converted(archive: str, chunks: Iterable[bytes]) -> Iterator[tuple]:
    for r in read_arc(chunks):
        header, body = http_parts(r.block)
        page = http_field(header, "X-Page-Id")
        yield (record_id(archive, r), warc_type(r), r.head["url"], r.head["ip"], warc_date(r.head["date"]), r.head["type"], int(page) if page else None, header, body, hashlib.sha256(body).hexdigest(), r.offset)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _in_batches(rows: Iterator[tuple], ddl: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    schema, held, size = _schema(ddl), [], 0
    for r in rows:
        held.append(r)
        size += sum(len(v) for v in r if isinstance(v, bytes | str))
        if size > most or len(held) >= 2048:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def pages_to_archives(pages: DataFrame) -> DataFrame:
    """(name, arc): pages as ARC archives of a few hundred records, of versions 1 and 2 in turn."""
    rows = picked(pages, page_id="page_id", url="url", html="html")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for whole in batches:
            for k in range(0, whole.num_rows, ARCHIVED):
                b = whole.slice(k, ARCHIVED).to_pylist()
                seen = hashlib.sha256("|".join(f"{r['page_id']} {r['url']}" for r in b).encode("utf-8", "surrogatepass")).hexdigest()[:16]
                version, name = 1 + int(seen, 16) % 2, f"pages-{part}-{made}-{seen}.arc"
                made += 1
                out = bytearray(version_block(name, version))
                for r in b:
                    out += arc_record(r["url"], r["page_id"], r["html"], version, name, len(out))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([bytes(out)], pa.binary())], names=["name", "arc"])

    return rows.mapInArrow(tidied(archive), "name string, arc binary")


def convert_archives(archives: DataFrame) -> DataFrame:
    """Records (``CONVERTED``) of ARC archives (name, arc), version blocks included."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for name, arc in zip(b.column(0), b.column(1), strict=True) for r in converted(name.as_py(), [arc.as_py()]))
        yield from _in_batches(rows, CONVERTED)

    return archives.mapInArrow(tidied(convert), CONVERTED)


def read_arc_files(spark: SparkSession, path: str) -> DataFrame:
    """Records (``CONVERTED``) of ARC files (.gz or plain) at a path, each read as a stream of lines."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.input_file_name().alias("name"), F.col("value").cast("binary").alias("line"))
    # a plain file may be split between tasks: bring its lines together, in order
    whole = lines if path.endswith(".gz") else lines.withColumn("n", F.monotonically_increasing_id()).repartition("name").sortWithinPartitions("name", "n").drop("n")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def files() -> Iterator[tuple]:
            pairs = ((n.as_py(), v.as_py()) for b in batches for n, v in zip(b.column(0), b.column(1), strict=True))
            held = next(pairs, None)
            while held is not None:
                name = held[0].rsplit("/", 1)[-1]

                def one(first: tuple = held) -> Iterator[bytes]:
                    nonlocal held
                    at = first
                    while at is not None and at[0] == first[0]:
                        yield at[1] + b"\n"
                        at = next(pairs, None)
                    held = at

                chunks = one()
                yield from converted(name, chunks)
                for _ in chunks:  # what a damaged file has left
                    pass

        yield from _in_batches(files(), CONVERTED)

    return whole.mapInArrow(tidied(convert), CONVERTED)


# -- WARC


def dated_types(records: DataFrame, least: int = LEAST) -> DataFrame:
    """Records with refers_to and refers_id: the smallest page_id of those with an equal payload, where that's another record.

    Only digests and ids are shuffled to find them; payloads move once, to their record's row."""
    light = cut(records.filter("type <> 'warcinfo'").select("record_id", "page_id", "digest", F.length("body").cast("long").alias("size")))
    sized = light.filter(F.col("size") >= least)
    first = cut(sized.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")).alias("f")).filter("n > 1").select(F.col("digest").alias("d"), "f.page_id", "f.record_id").toDF("d", "refers_to", "refers_id"))
    revisits = cut(sized.join(first, F.col("digest") == F.col("d")).filter("record_id <> refers_id").select(F.col("record_id").alias("r"), "refers_to", "refers_id"))
    return records.join(revisits, F.col("record_id") == F.col("r"), "left").drop("r")


def warc_text(records: DataFrame) -> Column:
    """A WARC record, without the record end: version and named fields, a blank line, the block (bytes, kept as a string)."""
    revisit = F.col("refers_id").isNotNull()
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    header, body = F.col("header").cast("string"), F.col("body").cast("string")
    block = F.when(revisit, header).otherwise(F.concat(header, body))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.col("type"))
    return F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.when(F.col("type") != "warcinfo", F.col("url"))), line("WARC-IP-Address", F.when(F.col("type") != "warcinfo", F.col("ip"))),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        line("WARC-Refers-To", F.col("refers_id")), line("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(F.when(revisit, F.col("header")).otherwise(F.concat("header", "body")), 256))),
        line("Content-Type", F.when(F.col("header") == F.lit(b""), F.col("mime")).otherwise(F.lit("application/http; msgtype=response"))),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_warc(records: DataFrame, path: str) -> None:
    """Records of ``dated_types`` as gzipped WARC files."""
    records.select(warc_text(records).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


READ = "record_id string, type string, url string, date string, page_id long, payload_bytes long, payload_digest string, refers_id string, refers_to long, block_ok boolean"


def read_warc_records(parts: Iterable[bytes]) -> Iterator[tuple]:
    """Rows (``READ``) from what stands between ``MARK``s; parts are joined until a record has its declared length."""
    held: bytes | None = None
    for part in parts:
        held = part.removeprefix(b"WARC/1.0\r\n") if held is None else held + MARK.encode() + part
        head, blank, rest = held.partition(b"\r\n\r\n")
        if not blank:
            continue
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))}
        length = int(fields.get(b"content-length", b"0"))
        if len(rest) < length:
            continue  # the mark was part of the block
        block, held = rest[:length], None
        say = lambda n, f=fields: f[n].decode() if n in f else None
        header, body = http_parts(block)
        kind, page = say(b"warc-type"), http_field(header, "X-Page-Id")
        digest = (say(b"warc-payload-digest") or "").removeprefix("sha256:")
        size = int(http_field(header, "Content-Length") or 0) if kind == "revisit" else len(body)
        ok = hashlib.sha256(block).hexdigest() == (say(b"warc-block-digest") or "").removeprefix("sha256:")
        if kind != "revisit":
            digest = hashlib.sha256(body).hexdigest()
        to = say(b"warc-refers-to-page")
        yield (say(b"warc-record-id"), kind, say(b"warc-target-uri"), say(b"warc-date"), int(page) if page else None, size, digest, say(b"warc-refers-to"), int(to) if to else None, ok)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows (``READ``) of the gzipped WARC files at a path: each file is one task's, as gzip can't be split."""
    parts = spark.read.option("lineSep", MARK).text(path).select(F.input_file_name().alias("name"), F.col("value").cast("binary").alias("part"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            pairs = ((n.as_py(), v.as_py()) for b in batches for n, v in zip(b.column(0), b.column(1), strict=True))
            held = next(pairs, None)
            while held is not None:

                def one(first: tuple = held) -> Iterator[bytes]:
                    nonlocal held
                    at = first
                    while at is not None and at[0] == first[0]:
                        yield at[1]
                        at = next(pairs, None)
                    held = at

                yield from read_warc_records(one())

        yield from _in_batches(rows(), READ)

    return parts.mapInArrow(tidied(read), READ)


def convert_pages(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Pages through ARC archives into WARC files at ``path``, and what those files hold of them."""
    write_warc(dated_types(convert_archives(pages_to_archives(pages))), path)
    back = read_warc(spark, path)
    return back.filter("type <> 'warcinfo'").select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")
