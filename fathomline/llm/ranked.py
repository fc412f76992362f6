"""Ranked lexical search: document-sharded postings with integer impacts, scored a term at a time.

Texts are read once. Each task packs its documents in shards of a bounded size, in compressed rows (CSR): for each term the
positions of the documents that hold it and how often. Counts over all shards (documents with a term, all terms, documents
of each term) give the weights; then each shard computes the impact of every posting once and scores one item after the
other: the impacts of a term are added into a dense array over the shard's documents, the k best are taken by a partition
that keeps ties by doc_id, and the shards' bests are merged by one top-k. Only terms that items hold are kept in shards.

Items are dealt in blocks of a bounded number of bytes; each block is one pass over the documents and its vocabulary is
broadcast. So nothing that grows with the documents leaves the tasks but k rows a shard and item.

Defined results: null and empty texts have no terms and find nothing; a document counts once a row, whatever its id;
documents without a doc_id count and rank after others of their score; repeated rows of an item (same item_id and text) are
one, and texts that share an item_id are one query together; items without an item_id are left out; texts of any length are
read whole; an empty table gives an empty result. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.llm.common import cut, picked, remove, scratch, tidied

#: A shard ends at so many documents or postings.
DOCUMENTS, POSTINGS = 1 << 15, 1 << 20
#: Texts are read in pieces of about so many bytes; a word is never cut.
PIECE = 1 << 20
#: Bytes of items in a block.
ITEM_BYTES = 16 << 20

#: Fixed values of the formula: scale of weights, of parts, and the parts of a thousand that a length counts.
WEIGHT, PART, FREE, LENGTH = 1000, 1_000_000_000, 25, 75

#: Bytes that end a term (ASCII other than digits and letters) as spaces, A-Z as a-z; all bytes of other characters stay.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def pieces(raw: bytes) -> Iterator[bytes]:
    """A translated text in parts that end between words."""
    at = 0
    while len(raw) - at > PIECE:
        end = raw.find(b" ", at + PIECE)
        if end < 0:
            break
        yield raw[at:end]
        at = end
    yield raw[at:] if at else raw


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, a list a piece."""
    if text:
        for piece in pieces(text.encode("utf-8", "surrogatepass").translate(TERM_BYTES)):
            yield piece.split()


class Shard:
    """Documents and postings that are being gathered."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.found: list[tuple[list[int], list[int]]] = []
        self.postings = 0

    def add(self, doc_id: int | None, text: str | None, known: dict[bytes, int]) -> None:
        size, held = 0, Counter()
        for words in terms(text):
            size += len(words)
            held.update(map(known.get, words))
        held.pop(None, None)
        if size:
            self.ids.append(doc_id)
            self.sizes.append(size)
            self.found.append((list(held), list(held.values())))
            self.postings += len(held)

    def full(self) -> bool:
        return len(self.ids) >= DOCUMENTS or self.postings >= POSTINGS

    def packed(self) -> pa.RecordBatch:
        """One row: the documents in order of doc_id (none last), then terms, starts, places and times of the postings by term."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        term = np.array([t for ts, _ in self.found for t in ts], np.int64)
        times = np.array([n for _, ns in self.found for n in ns], np.int64)
        at = np.repeat(place, [len(ts) for ts, _ in self.found])
        by = np.lexsort((at, term))
        names, starts = np.unique(term[by], return_index=True)
        none = sum(i is None for i in self.ids)
        ids = np.array([self.ids[i] for i in order[: len(order) - none]], np.int64)
        cells = (ids, np.array(self.sizes, np.int64)[order], names, np.append(starts, len(by)).astype(np.int64), at[by].astype(np.int32), times[by])
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["ids", "sizes", "terms", "starts", "places", "times"])


SHARD = "ids binary, sizes binary, terms binary, starts binary, places binary, times binary"
KINDS = (np.int64, np.int64, np.int64, np.int64, np.int32, np.int64)


def shards(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """Packed shards of the documents with at least one term; ``known`` numbers the terms that are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(known)  # terms of at most ITEM_BYTES

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, shard = shared.value, Shard()
        for b in batches:
            for i, text in zip(b.column(0), b.column(1), strict=True):
                shard.add(i.as_py(), text.as_py(), numbers)
                if shard.full():
                    yield shard.packed()
                    shard = Shard()
        if shard.ids:
            yield shard.packed()

    return picked(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(index), SHARD)


def statistics(written: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all terms, and the documents of each kept term."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                sizes, names, starts = (np.frombuffer(b.column(c)[r].as_py(), np.int64) for c in range(3))
                term = np.concatenate([[-2, -1], names])
                n = np.concatenate([[len(sizes), int(sizes.sum())], np.diff(starts)])
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n.astype(np.int64))], names=["term", "n"])

    rows = written.select("sizes", "terms", "starts").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row a term of the block
    found = {r["term"]: r["n"] for r in rows}
    return found.pop(-2, 0), found.pop(-1, 0), found


def weight(n: int, df: int) -> int:
    return math.floor(WEIGHT * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(sizes: np.ndarray, starts: np.ndarray, places: np.ndarray, times: np.ndarray, weights: np.ndarray, n: int, total: int) -> np.ndarray:
    """The impact of each posting; whole numbers without rounding, also where a product needs more than 64 bits."""
    longest = LENGTH * int(sizes.max(initial=0)) * n
    m = FREE + (LENGTH * sizes * n // total if longest < 1 << 63 else np.array([LENGTH * int(s) * n // total for s in sizes], np.int64))
    if PART * int(times.max(initial=0)) < 1 << 63:
        part = PART * times // (WEIGHT * times + 8 * m[places])
    else:
        part = np.array([PART * int(t) // (WEIGHT * int(t) + 8 * int(m[p])) for t, p in zip(times, places, strict=True)], np.int64)
    return np.repeat(weights, np.diff(starts)) * part


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores above 0, greatest first; of equal ones the first places."""
    live = np.flatnonzero(scores > 0)
    if len(live) > k:
        least = np.partition(scores[live], len(live) - k)[len(live) - k]
        over = live[scores[live] > least]
        live = np.concatenate([over, live[scores[live] == least][: k - len(over)]])
    return live[np.lexsort((live, -scores[live]))]


def found_in(written: DataFrame, items: list[tuple[int, list[tuple[int, int]]]], stats: tuple[int, int, dict[int, int]], k: int) -> DataFrame:
    """item_id, doc_id, score: the k best of each shard for each item (terms by number, with their repeats)."""
    n, total, df = stats
    weights = {t: weight(n, d) for t, d in df.items()}
    shared = written.sparkSession.sparkContext.broadcast((items, weights))  # items of at most ITEM_BYTES

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by_term = shared.value
        for b in batches:
            for r in range(b.num_rows):
                ids, sizes, names, starts, places, times = (np.frombuffer(b.column(c)[r].as_py(), kind) for c, kind in enumerate(KINDS))
                here = np.array([by_term[t] for t in names.tolist()], np.int64)
                impact = impacts(sizes, starts, places, times, here, n, total)
                row = {t: i for i, t in enumerate(names.tolist())}
                out: list[tuple[np.ndarray, ...]] = []
                for item, held in asked:
                    scores = np.zeros(len(sizes), np.int64)
                    for t, repeats in held:
                        if (i := row.get(t)) is not None:
                            a, z = starts[i], starts[i + 1]
                            scores[places[a:z]] += repeats * impact[a:z]
                    at = best(scores, k)
                    out.append((np.full(len(at), item, np.int64), at, scores[at]))
                item_id, at, score_ = (np.concatenate(c) for c in zip(*out, strict=True))
                none = at >= len(ids)
                doc = np.append(ids, 0)[np.minimum(at, len(ids))]
                yield pa.RecordBatch.from_arrays([pa.array(item_id), pa.array(doc, mask=none), pa.array(score_)], names=["item_id", "doc_id", "score"])

    return written.mapInArrow(tidied(score), "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the k documents with the highest scores above 0; ties by doc_id."""
    spark = docs.sparkSession
    asked = cut(picked(items, item_id="item_id", text="text").select(F.col("item_id").cast("long"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct())
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    found: list[DataFrame] = []
    for block in range(blocks):
        known: dict[bytes, int] = {}
        queries: dict[int, Counter] = {}
        for row in asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():  # about ITEM_BYTES
            held = queries.setdefault(row["item_id"], Counter())
            for words in terms(row["text"]):
                held.update(known.setdefault(w, len(known)) for w in words)
        path = scratch(spark, "shards")
        shards(docs, known).write.parquet(path)
        written = spark.read.parquet(path)
        found.append(cut(_ranked(found_in(written, [(i, list(h.items())) for i, h in sorted(queries.items())], statistics(written), k), k)))
        remove(spark, path)
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
