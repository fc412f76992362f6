"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments of equal length, at lengths halved from the whole vector down to 2; of each segment its mean
and deviation are kept. For two vectors the squared distance is at least the sum over segments of l((m-m')^2 + (s-s')^2),
and with their norms that bounds their inner product from above by the sum of l(mm' + ss'). Bounds are taken coarse to
fine, each only for pairs that all coarser ones have left; what survives the finest level is multiplied exactly.

A pair falls out when its bound is under the query's threshold: a product that k candidates are known to reach. It
starts from ``SEEDS`` candidates (those with the greatest norms; any would do, they only save work), rises within a block
of candidates by exact products of those that the bounds put first, and goes on from block to block of a task. Blocks of
candidates whose greatest norm rules them out are skipped whole.

Queries and candidates are packed in blocks of a bounded size. Blocks of queries go to all tasks by broadcast if their
counted bytes are few (``BROADCAST_BYTES``), else they meet blocks of candidates through an equality join on a shard
number, chosen so that each partition gets one shard. A meeting gives at most k rows a query; these are merged by a second
top-k. No row of vectors is collected.

Defined results: a component x counts as floor(1024 * x) in double, held within 1e300; vectors that are null, or hold a
null, NaN or infinite component, take no part, as neither do rows without a vec_id; vectors of different lengths meet as
if the shorter went on with zeros; repeated query ids are searched once, with the least of their vectors; repeated
candidates each count; products beyond a long saturate; ties go to the smaller vec_id; an empty table gives an empty
result. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.llm.common import cut, picked, tidied

SCALE = 1024
QUERIES, CANDIDATES = 256, 8192
#: Candidates that first thresholds come from; fewer where vectors are so long that these have more than SEED_CELLS components.
SEEDS, SEED_CELLS = 1024, 1 << 20
#: For each of the k, so many candidates of a block are tried first, to raise the threshold.
TRIED = 16
#: Query blocks of so many bytes at most are broadcast.
BROADCAST_BYTES = 32 << 20
#: Query blocks whose thresholds a task remembers.
REMEMBERED = 4096
LONG = 2**63 - 1


def _levels(width: int) -> list[int]:
    """Segment lengths, coarse to fine."""
    out, n = [], width
    while n > 1:
        out.append(n)
        n = -(-n // 2)
    return out


def _stats(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of segments, each times the root of the length: products of these are sums over segments."""
    rows, width = x.shape
    parts = -(-width // length)
    if parts * length > width:
        x = np.concatenate([x, np.zeros((rows, parts * length - width))], axis=1)
    cut = x.reshape(rows, parts, length)
    mean = cut.mean(axis=2)
    dev = np.sqrt(np.maximum((cut * cut).mean(axis=2) - mean * mean, 0))
    return mean * np.sqrt(length), dev * np.sqrt(length)


def exact(q: np.ndarray, x: np.ndarray, safe: bool) -> np.ndarray:
    """Products of pairs of rows as whole numbers; where doubles can't hold them, row by row."""
    if safe:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    return np.array([max(-LONG - 1, min(LONG, sum(int(a) * int(b) for a, b in zip(v, w, strict=True)))) for v, w in zip(q, x, strict=True)], np.int64)


def kth_best(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def survivors(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int, least: np.ndarray, safe: bool) -> np.ndarray:
    """Which pairs may be among the k best of their query. ``least`` (thresholds) rises in place."""
    live = x_id[None, :] != q_id[:, None]
    q_norm, x_norm = (np.sqrt((v * v).sum(axis=1)) for v in (q, x))
    if not (np.isfinite(q_norm).all() and np.isfinite(x_norm).all()):
        return live
    slack = 1e-9 * q_norm[:, None].max(initial=0) * x_norm.max(initial=0) + 1e-6
    live &= q_norm[:, None] * x_norm[None, :] + slack >= least[:, None]
    for length in _levels(q.shape[1]):
        rows, cols = np.flatnonzero(live.any(axis=1)), np.flatnonzero(live.any(axis=0))
        if not len(rows):
            break
        (qm, qd), (xm, xd) = _stats(q[rows], length), _stats(x[cols], length)
        guess = qm @ xm.T
        bound = guess + qd @ xd.T
        mine = live[np.ix_(rows, cols)]
        mine &= bound + slack >= least[rows, None]
        if length <= 4 and TRIED * k < len(cols):
            # the exact products of the likeliest raise the threshold
            guess[~mine] = -np.inf
            top = np.argpartition(-guess, TRIED * k - 1, axis=1)[:, : TRIED * k]
            for r, i in enumerate(rows):
                at = top[r][mine[r, top[r]]]
                if len(at) >= k:
                    least[i] = max(least[i], kth_best(exact(np.broadcast_to(q[i], (len(at), q.shape[1])), x[cols[at]], safe).astype(float), k))
            mine &= bound + slack >= least[rows, None]
        live[np.ix_(rows, cols)] = mine
    return live


def best_of_block(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, candidate, product) of at most k greatest products of each query with rows of another id within a block, and how many pairs were multiplied.

    All products that are among a query's k best of all blocks are there. ``least``: what k candidates of each query are
    known to reach; it rises in place."""
    least = np.full(len(q), -np.inf) if least is None else least
    safe = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < 2**52
    live = survivors(q, q_id, x, x_id, k, least, safe)
    reached = int(live.sum())
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in np.flatnonzero(live.any(axis=1)):
        at = np.flatnonzero(live[i])
        scores = (x[at] @ q[i]).astype(np.int64) if safe else exact(np.broadcast_to(q[i], (len(at), q.shape[1])), x[at], safe)
        if len(at) > k:
            worst = np.partition(scores, len(scores) - k)[len(scores) - k]
            at, scores = at[scores >= worst], scores[scores >= worst]
        by = np.lexsort((x_id[at], -scores.astype(object) if not safe else -scores))[:k]
        if len(by) == k:
            least[i] = max(least[i], float(scores[by[-1]]))
        found.append((np.full(len(by), q_id[i]), x_id[at[by]], scores[by]))
    parts = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
    return parts[0], parts[1], parts[2], reached


def usable(v: Column) -> Column:
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return v.isNotNull() & ~F.coalesce(F.exists(v, bad), F.lit(True))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows: ids, width and components as bytes, from partitions as they are."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                b = whole.slice(at, size)
                ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                vectors = b.column(1).to_pylist()
                width = max(map(len, vectors))
                m = np.zeros((len(vectors), width))
                for i, v in enumerate(vectors):
                    m[i, : len(v)] = v
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([width], pa.int32()), pa.array([np.clip(np.floor(SCALE * m), -1e300, 1e300).tobytes()], pa.binary())], names=["ids", "width", "m"])

    return rows.mapInArrow(tidied(pack), "ids binary, width int, m binary")


def _unpacked(b: pa.RecordBatch, r: int, at: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and components of a packed block whose columns (ids, width, m) start at ``at``, widened with zeros."""
    ids, w, raw = (b.column(at + c)[r].as_py() for c in range(3))
    ids = np.frombuffer(ids, np.int64)
    m = np.frombuffer(raw).reshape(len(ids), w)
    return ids, np.pad(m, ((0, 0), (0, wide - w))) if w < wide else m


def _spread(spark: SparkSession, shards: int) -> list[int]:
    """For each of so many partitions a number that is dealt to it."""
    n = spark.range(shards * 32).select("id", F.pmod(F.hash("id"), F.lit(shards)).alias("p"))
    found = dict(n.groupBy("p").agg(F.min("id").alias("id")).collect())  # one row a partition
    return [int(found.get(p, p)) for p in range(shards)]


def search(vectors: DataFrame, is_query: Column, k: int = 10, seeds: int = SEEDS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` (of vec_id) marks, the k best of all other rows."""
    spark = vectors.sparkSession
    rows = picked(vectors, vec_id="vec_id", embedding="embedding").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    n, wide = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    wide = max(1, wide or 0, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    chosen = rows.orderBy(norm.desc(), "vec_id").limit(max(1, min(seeds, SEED_CELLS // wide)))
    seed = F.broadcast(_packed(chosen.coalesce(1), SEEDS).limit(1).toDF("s_ids", "s_width", "s"))  # at most SEED_CELLS numbers
    q_blocks = _packed(queries, QUERIES).toDF("q_ids", "q_width", "q")

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Query blocks with a threshold for each query, from the seeds."""
        for b in batches:
            for r in range(b.num_rows):
                full = max(b.column(1)[r].as_py(), b.column(4)[r].as_py() or 0)
                q_id, q = _unpacked(b, r, 0, full)
                least = np.full(len(q_id), -np.inf)
                if b.column(3)[r].as_py() is not None:
                    x_id, x = _unpacked(b, r, 3, full)
                    best_of_block(q, q_id, x, x_id, k, least)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(r, 1), b.column(1).slice(r, 1), b.column(2).slice(r, 1), pa.array([least.tobytes()], pa.binary())], names=["q_ids", "q_width", "q", "least"])

    # one row of seeds; none in an empty table
    with_seeds = q_blocks.withColumn("one", F.lit(1)).join(seed.withColumn("one", F.lit(1)), "one", "left").select("q_ids", "q_width", "q", "s_ids", "s_width", "s")
    q = cut(with_seeds.mapInArrow(tidied(started), "q_ids binary, q_width int, q binary, least binary"))
    x = _packed(rows, CANDIDATES)
    columns = ["ids", "width", "m", "q_ids", "q_width", "q", "least"]
    if n * wide * 8 <= BROADCAST_BYTES:
        met = x.withColumn("one", F.lit(1)).join(F.broadcast(q.withColumn("one", F.lit(1))), "one").select(*columns)
    else:
        shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        numbers = F.array(*[F.lit(v).cast("long") for v in _spread(spark, shards)])
        dealt = x.withColumn("at", F.element_at(numbers, (F.pmod(F.xxhash64("ids"), F.lit(shards)) + 1).cast("int")))
        met = dealt.join(q.withColumn("shard", F.explode(numbers)), F.col("at") == F.col("shard")).select(*columns)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        for b in batches:
            for r in range(b.num_rows):
                full = max(b.column(1)[r].as_py(), b.column(4)[r].as_py())
                (x_id, x), (q_id, q) = _unpacked(b, r, 0, full), _unpacked(b, r, 3, full)
                name = b.column(3)[r].as_py()
                if name not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[name] = np.frombuffer(b.column(6)[r].as_py()).copy()
                a, c, s, _ = best_of_block(q, q_id, x, x_id, k, known[name])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "vec_id", "score"])

    some = met.mapInArrow(tidied(meet), "query_id long, vec_id long, score long")
    # the k best of a query: each task first keeps the k best of what it has met
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return some.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
