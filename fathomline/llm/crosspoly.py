"""Approximate nearest neighbours by cosine: cross-polytope hashing with multiprobe tables and exact reranking.

Unit vectors, padded to a power of two, go through pseudo-rotations: three rounds of random signs and a fast Hadamard
transform. The nearest signed axis is a hash of one function; the code of a table joins the values of as many functions as
the counted rows ask for, so that buckets hold about ``BUCKET`` rows at every size (the last function looks at fewer axes).
A query probes, in each of ``TABLES`` tables, every bucket whose penalty (sum over functions of the squared gap between its
greatest coordinate and that of the bucket's axis) is within a radius. The radius is fitted: at most ``SAMPLE`` queries are
compared with all rows, and it is the least that finds ``RECALL`` of their neighbours. So structureless vectors are probed
widely and clustered ones narrowly, without a bound on probes or candidates.

Buckets are dealt to shards of about a block of rows by a hash of table and code. Shards with more rows (a hot bucket) are
salted into blocks by the counted rows, and so are the queries that probe a shard; a block of queries meets a block of
candidates in one join row, bucket by bucket. Only the k best of a meeting go on; they are merged, once for each pair, by a
second top-k. Equal vectors are one candidate with a list of the k + 1 least ids, so copies neither fill a bucket nor a task.

Defined results: vectors that are null, zero or hold a null, NaN or infinite component take no part, nor do rows without a
vec_id; vectors of different lengths meet as if the shorter went on with zeros; repeated query ids are searched once, with
the least of their vectors; a vec_id that several vectors share is a candidate with each, but never of a query with that
id; repeated rows count once; equal scores go to the smaller vec_id; an empty table gives an empty result. Other columns
don't matter, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.llm.common import cut, picked, small_or_not, tidied
from fathomline.llm.topk import usable

TABLES = 4
BUCKET = 32
#: Rounds of signs and transforms in a pseudo-rotation.
ROUNDS = 3
#: The bounded sample that the radius is fitted on: so many queries, the least by a hash of their ids.
SAMPLE, RECALL = 128, 0.95
#: Rows of a block of candidates and of queries.
CANDIDATES, QUERIES = 8192, 256
SEED = 20


def units(vectors: pa.ListArray, wide: int) -> np.ndarray:
    """Vectors as rows of so many columns, each times a power of two (so that no square overflows), not yet of unit length."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    m = np.zeros((len(vectors), wide))
    m[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = vectors.flatten().to_numpy(zero_copy_only=False)
    _, power = np.frexp(np.abs(m).max(axis=1, initial=0))
    return np.ldexp(m, -power[:, None])


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows, in double."""
    return (q * x).sum(axis=1) / np.sqrt((q * q).sum(axis=1) * (x * x).sum(axis=1))


def hadamard(y: np.ndarray) -> np.ndarray:
    """The transform of each row, orthonormal; as many columns as a power of two."""
    rows, wide = y.shape
    step = 1
    while step < wide:
        halves = y.reshape(rows, -1, 2, step)
        y = np.concatenate([halves[:, :, :1] + halves[:, :, 1:], halves[:, :, :1] - halves[:, :, 1:]], axis=2).reshape(rows, wide)
        step *= 2
    return y / math.sqrt(wide)


class Hash:
    """The functions of all tables: axes that each looks at, and its signs."""

    def __init__(self, wide: int, rows: int) -> None:
        self.wide = 1 << max(0, wide - 1).bit_length()
        bits, most = max(1, math.ceil(math.log2(max(2, rows / BUCKET)))), self.wide.bit_length()
        self.axes = [self.wide] * (bits // most) + ([1 << (bits % most - 1)] if bits % most else [])
        self.signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (TABLES, len(self.axes), ROUNDS, self.wide))

    def coordinates(self, unit: np.ndarray, table: int) -> list[np.ndarray]:
        """For each function the coordinates on its signed axes."""
        out = []
        for axes, signs in zip(self.axes, self.signs[table], strict=True):
            y = np.pad(unit, ((0, 0), (0, self.wide - unit.shape[1])))
            for s in signs:
                y = hadamard(y * s)
            out.append(np.concatenate([y[:, :axes], -y[:, :axes]], axis=1))
        return out

    def codes(self, unit: np.ndarray, table: int) -> np.ndarray:
        code = np.zeros(len(unit), np.int64)
        for z in self.coordinates(unit, table):
            code = code * z.shape[1] + z.argmax(axis=1)
        return code

    def penalty(self, q: np.ndarray, x: np.ndarray, table: int) -> np.ndarray:
        """Of pairs of rows: what probing the bucket of ``x`` costs ``q``."""
        total = np.zeros(len(q))
        for z, own in zip(self.coordinates(q, table), self.coordinates(x, table), strict=True):
            total += (z.max(axis=1) - z[np.arange(len(z)), own.argmax(axis=1)]) ** 2
        return total

    def probes(self, unit: np.ndarray, table: int, radius: float) -> list[np.ndarray]:
        """For each row the codes of all buckets within the radius."""
        gaps = [(z.max(axis=1, keepdims=True) - z) ** 2 for z in self.coordinates(unit, table)]
        out = []
        for r in range(len(unit)):
            code, cost = np.zeros(1, np.int64), np.zeros(1)
            for g in gaps:
                sums = cost[:, None] + g[r][None, :]
                i, j = np.nonzero(sums <= radius)
                code, cost = code[i] * g.shape[1] + j, sums[i, j]
            out.append(code)
        return out


def normed(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of at most k greatest scores, ties by the smaller id, and of what is as near to the last as rounding may be."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        over = np.flatnonzero(scores >= least - 1e-12)
    else:
        over = np.arange(len(scores))
    return over[np.lexsort((ids[over], -scores[over]))]


def exact_neighbours(classes: DataFrame, sample: list[tuple[int, list]], wide: int, k: int) -> list[tuple[int, list]]:
    """(query, vector) of the k nearest different vectors of each sampled query, compared with all rows."""
    q_id, q = np.array([i for i, _ in sample], np.int64), normed(units(pa.array([v for _, v in sample]), wide))
    shared = classes.sparkSession.sparkContext.broadcast((q_id, q))  # at most SAMPLE vectors

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, mine = shared.value
        for b in batches:
            cid = b.column(0).to_numpy()
            s = mine @ normed(units(b.column(1), wide)).T
            s[cid[None, :] == ids[:, None]] = -np.inf
            kept = [t[np.isfinite(r[t])][:k] for r in s for t in [top(r, cid, k)]]
            at = np.concatenate(kept)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, [len(t) for t in kept])), pa.array(np.concatenate([r[t] for r, t in zip(s, kept, strict=True)])), b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at))], names=["q", "score", "cid", "v"])

    kind = dict(classes.dtypes)["v"]
    rows = classes.select("cid", "v").mapInArrow(tidied(compare), f"q long, score double, cid long, v {kind}")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.col("score").desc(), "cid"))
    return [(r["q"], r["v"]) for r in rows.withColumn("n", rank).filter(F.col("n") <= k).select("q", "v").collect()]  # SAMPLE * k rows


def radius(classes: DataFrame, queries: DataFrame, hashes: Hash, wide: int, k: int) -> float:
    """The least radius that finds RECALL of the sampled queries' neighbours in any table."""
    sample = [(r["qid"], r["v"]) for r in queries.orderBy(F.xxhash64("qid"), "qid").limit(SAMPLE).collect()]
    if not (near := exact_neighbours(classes, sample, wide, k)):
        return 0.0
    of = dict(sample)
    q, x = (normed(units(pa.array(part), wide)) for part in ([of[i] for i, _ in near], [v for _, v in near]))
    cost = np.sort(np.min([hashes.penalty(q, x, t) for t in range(TABLES)], axis=0))
    return float(cost[math.ceil(RECALL * len(cost)) - 1]) + 1e-9


def shard_of(code: np.ndarray, table: int, shards: int) -> np.ndarray:
    mixed = (code.astype(np.uint64) + np.uint64(table << 56)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)


def dealt(rows: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """Rows with the number of their block, by a hash of ``key``: about ``size`` rows of a (tab, shard) each."""
    counts = cut(rows.groupBy("tab", "shard").agg(F.count("*").alias("n"))).select(F.col("tab").alias("ct"), F.col("shard").alias("cs"), F.ceil(F.col("n") / size).cast("int").alias("blocks"))
    return rows.join(small_or_not(counts), (F.col("tab") == F.col("ct")) & (F.col("shard") == F.col("cs"))).withColumn(name, F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")).drop("ct", "cs", "blocks")


def meeting(b: pa.RecordBatch, r: int, wide: int, k: int) -> tuple[np.ndarray, ...] | None:
    """(query, candidate's key and least id, cosine) of the k best candidates of each query within a block, of those whose buckets it probes."""
    xs, qs = b.column(0)[r].values, b.column(1)[r].values
    code, key, cid, many = (xs.field(c).to_numpy(zero_copy_only=False) for c in ("code", "key", "cid", "many"))
    qid, asked = qs.field("qid").to_numpy(), qs.field("codes")
    x, q = (units(s.field("v"), wide) for s in (xs, qs))
    names, bucket = np.unique(code, return_inverse=True)
    by = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[by], np.arange(len(names) + 1))
    whose = np.repeat(np.arange(len(qid)), asked.value_lengths().to_numpy())
    probed = asked.flatten().to_numpy()
    at = np.minimum(np.searchsorted(names, probed), len(names) - 1)
    hit = names[at] == probed
    whose, at = whose[hit], at[hit]
    if not len(at):
        return None
    x_unit, q_unit = normed(x), normed(q)
    scores = np.full((len(qid), len(cid)), -np.inf)
    order = np.argsort(at, kind="stable")
    starts = np.flatnonzero(np.diff(at[order], prepend=-1))
    for group in np.split(order, starts[1:]):
        mine, theirs = whose[group], by[ends[at[group[0]]] : ends[at[group[0]] + 1]]
        scores[np.ix_(mine, theirs)] = q_unit[mine] @ x_unit[theirs].T
    # a row of the query's own id is no candidate, unless other rows have the same vector
    scores[(cid[None, :] == qid[:, None]) & ~many[None, :]] = -np.inf
    rows: list[np.ndarray] = []
    cols: list[np.ndarray] = []
    for i, s in enumerate(scores):
        live = np.flatnonzero(np.isfinite(s))
        kept = live[top(s[live], cid[live], k)]
        rows.append(np.full(len(kept), i))
        cols.append(kept)
    i, j = np.concatenate(rows), np.concatenate(cols)
    return qid[i], key[j], cid[j], cosines(q[i], x[j])


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` (of vec_id) marks, the k nearest found of all other rows."""
    spark: SparkSession = vectors.sparkSession
    item = vectors.schema[vectors.columns.index("embedding")].dataType.elementType.simpleString()
    v = F.col("embedding") if item in ("float", "double") else F.col("embedding").cast("array<double>")
    rows = picked(vectors, vec_id="vec_id", embedding="embedding").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")) & F.coalesce(F.exists("v", lambda c: c != 0), F.lit(False)))
    classes = cut(rows.groupBy("v").agg(F.min("vec_id").alias("cid"), F.max("vec_id").alias("last")).select(F.monotonically_increasing_id().alias("key"), "cid", (F.col("cid") < F.col("last")).alias("many"), "v"))
    queries = cut(rows.filter(is_query).groupBy(F.col("vec_id").alias("qid")).agg(F.min("v").alias("v")))
    n, wide = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n or not queries.limit(1).count():
        return empty
    hashes = Hash(wide, n)
    within = radius(classes, queries, hashes, wide, k)
    shards = max(1, round(n / CANDIDATES))
    kind = dict(rows.dtypes)["v"]

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit = normed(units(b.column(3), wide))
            for t in range(TABLES):
                code = hashes.codes(unit, t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), t, np.int32)), pa.array(shard_of(code, t, shards)), pa.array(code), *b.columns], names=["tab", "shard", "code", "key", "cid", "many", "v"])

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and shard that has buckets which it probes."""
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                b = whole.slice(at, QUERIES)
                unit = normed(units(b.column(1), wide))
                for t in range(TABLES):
                    codes = hashes.probes(unit, t, within)
                    row, code = np.repeat(np.arange(len(codes)), [len(c) for c in codes]), np.concatenate(codes)
                    shard = shard_of(code, t, shards)
                    by = np.lexsort((code, shard, row))
                    row, code, shard = row[by], code[by], shard[by]
                    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(shard, prepend=-1) != 0))
                    asked = pa.ListArray.from_arrays(pa.array(np.append(first, len(code)).astype(np.int32)), pa.array(code))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), t, np.int32)), pa.array(shard[first]), b.column(0).take(pa.array(row[first])), asked, b.column(1).take(pa.array(row[first]))], names=["tab", "shard", "qid", "codes", "v"])

    x = dealt(classes.mapInArrow(tidied(filed), f"tab int, shard long, code long, key long, cid long, many boolean, v {kind}"), "key", CANDIDATES, "x_block")
    x = x.groupBy("tab", "shard", "x_block").agg(F.collect_list(F.struct("code", "key", "cid", "many", "v")).alias("xs"))
    q = dealt(queries.mapInArrow(tidied(probed), f"tab int, shard long, qid long, codes array<long>, v {kind}"), "qid", QUERIES, "q_block")
    q = q.groupBy("tab", "shard", "q_block").agg(F.collect_list(F.struct("qid", "codes", "v")).alias("qs")).withColumnsRenamed({"tab": "qt", "shard": "qh"})
    met = x.join(q, (F.col("tab") == F.col("qt")) & (F.col("shard") == F.col("qh"))).select("xs", "qs")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                if (found := meeting(b, r, wide, k)) is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "key", "cid", "score"])

    # the same pair may have been met in several tables
    pairs = met.mapInArrow(tidied(meet), "query_id long, key long, cid long, score double").groupBy("query_id", "key", "cid").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "cid"))
    near = cut(pairs.withColumn("rank", rank).filter(F.col("rank") <= k))
    twins = cut(classes.filter("many").select(F.col("key").alias("c"), F.col("v").alias("cv")))
    if not twins.limit(1).count():
        return near.select("query_id", "rank", F.col("cid").alias("vec_id"), "score")
    # of equal vectors the k + 1 least ids are enough: one may be the query's own
    least = F.row_number().over(W.partitionBy("c").orderBy("vec_id"))
    members = rows.join(small_or_not(twins), F.col("v") == F.col("cv")).select("c", "vec_id").distinct().withColumn("n", least).filter(F.col("n") <= k + 1).select("c", "vec_id")
    each = near.join(members, F.col("key") == F.col("c"), "left").select("query_id", F.coalesce("vec_id", "cid").alias("vec_id"), "score").filter("query_id <> vec_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
