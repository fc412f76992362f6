"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified Hamming distances, components.

A fingerprint's 64 bits are split into five blocks. Two fingerprints that differ in at most two bits agree in three
whole blocks at least, so each fingerprint is filed under its ten triples of blocks (38 bits or more each), pairs are
joined on a triple, and their distance is verified. Equal fingerprints are one class from the start; copies are never
paired. A triple that files more than ``PAIRED`` fingerprints isn't paired: there each fingerprint is filed again under
itself and its single-bit flips outside the triple. Two of them within two bits share such a point, and all that share
one are within two bits of each other, at most 27 of them; so links stay exact, without caps, and rows stay linear.

Defined results: null and empty texts have fingerprint zero and link like any other; A-Z only is lower-cased; repeated
rows are copies; a null doc_id takes part, but is never a component_id unless a whole component has none; an empty
table gives an empty result. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import cut, packed, tidied
from fathomline.llm.components import components

WIDTHS = (13, 13, 13, 13, 12)
PAIRED = 32
#: Hashes are summed this many at a time: memory stays bounded for a text of any length.
PIECE = 1 << 15


def _masks() -> list[int]:
    at, blocks = 0, []
    for w in WIDTHS:
        blocks.append(((1 << w) - 1) << at)
        at += w
    return [sum(c) for c in combinations(blocks, 3)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, width: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
    starts = [0, *[e + 1 for e in ends]][: len(words) - width + 1]
    stops = [*ends[width - 1 :], len(line)]
    digest, votes = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for k in range(0, len(starts), PIECE):
        joined = b"".join([digest(line[a:b], 42) for a, b in zip(starts[k : k + PIECE], stops[k : k + PIECE], strict=True)])
        votes += np.unpackbits(np.frombuffer(joined, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * votes > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): fp as a signed long."""
    row, at = packed(docs)
    kind = dict(docs.dtypes)["doc_id"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t.as_py(), width)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return row.select(at["doc_id"].alias("doc_id"), at["text"].alias("text")).mapInArrow(tidied(hashed), f"doc_id {kind}, fp long")


def links(fps: DataFrame, most: int = 2) -> DataFrame:
    """(a, b): links between different fingerprints at ``most`` (2) or fewer bits that join all that such pairs join."""
    if most > 2:
        raise ValueError("five blocks in triples find up to two differing bits")
    masks = _masks()
    filed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("c", "k"))
    shared = cut(filed.groupBy("c", "k").agg(F.count("*").alias("n")).filter("n > 1")).withColumnsRenamed({"c": "c2", "k": "k2"})
    hits = cut(filed.join(shared, (F.col("c") == F.col("c2")) & (F.col("k") == F.col("k2"))).select("c", "k", "n", "fp"))
    few = hits.filter(F.col("n") <= PAIRED)
    other = few.select(F.col("c").alias("c2"), F.col("k").alias("k2"), F.col("fp").alias("b"))
    pairs = few.join(other, (F.col("c") == F.col("c2")) & (F.col("k") == F.col("k2")) & (F.col("fp") < F.col("b"))).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= most).select(F.col("fp").alias("a"), "b")
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1]) for m in masks])
    points = hits.filter(F.col("n") > PAIRED).select("c", "fp", F.explode(F.element_at(flips, F.col("c") + 1)).alias("flip")).select("c", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    balls = points.groupBy("c", "point").agg(F.collect_set("fp").alias("near"))  # at most 27
    stars = balls.filter(F.size("near") > 1).select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a <> b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the least doc_id that links reach."""
    light = cut(fingerprints(docs))
    classes = cut(light.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = cut(components(links(classes.select("fp"))))
    rooted = cut(classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = cut(rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id")))
    by_fp = cut(rooted.join(named, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id"))
    return light.join(by_fp, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, root) of every row, mark a hash of its text: rows are near copies if their roots are one."""
    row, at = packed(docs)
    fps = cut(fingerprints(row.select(F.struct(at["doc_id"].alias("id"), F.xxhash64(at["text"]).alias("mark")).alias("doc_id"), at["text"].alias("text"))))
    roots = cut(components(links(fps.select("fp").distinct())))
    return fps.join(roots, F.col("fp") == F.col("node"), "left").select(F.col("doc_id.id").alias("doc_id"), F.col("doc_id.mark").alias("mark"), F.coalesce("root", "fp").alias("root"))


def first_of_each(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One row of each group of near-duplicates, with all columns: the one with the smallest doc_id (null last), of rows that
    share it the one whose text has the least hash, of the same text twice the least row as JSON.

    ``groups``: doc_id, mark (``xxhash64`` of the text) and root of every row, by fingerprints unless given."""
    groups = grouped(docs) if groups is None else groups
    firsts = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first"))
    rows = groups.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).withColumnsRenamed({"doc_id": "id", "mark": "m"})
    # a text has one group, so that a row's id and mark stand for no other group's first
    kept = cut(firsts.join(rows, F.col("first.doc_id").eqNullSafe(F.col("id")) & (F.col("first.mark") == F.col("m"))).select("id", "m", "n"))
    row, at = packed(docs)
    found = row.join(kept, at["doc_id"].eqNullSafe(F.col("id")) & (F.xxhash64(at["text"]) == F.col("m")))
    if kept.filter("n > 1").limit(1).count():
        again = found.filter("n > 1").groupBy("id", "m").agg(F.min_by("row", F.to_json("row")).alias("row"))
        found = found.filter("n = 1").select("row").unionByName(again.select("row"))
    return found.select("row.*").toDF(*docs.columns)
