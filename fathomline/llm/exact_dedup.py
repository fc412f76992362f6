"""Exact deduplication as a stateful stream.

Documents are written once to the shared folder as waves of (doc_id, normalised text, digest, length) and stream from
there, one micro-batch a wave. Keyed state, held on disk by RocksDB under the streaming checkpoint and never expired,
keeps for each digest the stable identifier (doc_id) and the content locator (file and row) of the row that stays, with
the number of rows seen. Rows are combined before the shuffle, so a text that holds a third of the rows sends one row a
task. A hit is not trusted: in the batch that makes it, the full bytes of all rows with its digest are compared with
those of the digest's first row, whose locator the state has, too: of earlier waves only the files that hold such rows are
read. Texts that merely share a digest are split by their bytes.

With ``state_dir`` all this is kept there, and a later call goes on from the state: with a new ``run`` its documents meet
those of earlier runs; with the same ``run`` again it goes on where that one was stopped, and adds nothing twice.
Otherwise the files go when the result is written.

Defined results: null texts count as empty; equal texts are those equal without ASCII white space; of equals the
longest original stays, then the smallest doc_id (null last), then the first locator, so repeated rows leave one; doc_id
may have any type that has an order; an empty table gives an empty result. Other columns are never read, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.llm.common import BROADCAST_ROWS, SPACE, cut, exists, move, packed, remove, scratch

#: State on disk. Changes are checkpointed, not whole files, and no space is allocated ahead: with many partitions of
#: little state, each would otherwise hold megabytes of nothing.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: A call has at least so many waves, and more where Spark's estimate of the documents is over so many bytes a wave.
WAVES, WAVE_BYTES = 2, 256 << 30
#: Where Spark doesn't know a size, its estimate is beyond this.
UNKNOWN = 1 << 60
#: A digest with more rows is joined by broadcast, so that no task gets all of them.
HOT = 1000
#: Rows of a digest go to so many tasks where hits are too many for a broadcast.
SALTS = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def waves_for(docs: DataFrame) -> int:
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(WAVES, -(-size // WAVE_BYTES)) if size < UNKNOWN else WAVES


class Store:
    """The files of a state: staged waves, streamed waves, the stream's checkpoint, keepers by batch, digests that lied."""

    def __init__(self, spark: SparkSession, at: str, kind: T.DataType) -> None:
        self.spark, self.at = spark, at
        self.staged, self.waves, self.stream, self.keepers, self.false = (f"{at}/{x}" for x in ("staged", "waves", "stream", "keepers", "false"))
        self.row = T.StructType([T.StructField("id", kind), T.StructField("points", T.LongType()), T.StructField("sha", T.StringType()), T.StructField("key", T.StringType()), T.StructField("norm", T.StringType()), T.StructField("wave", T.LongType())])
        self.best = T.StructType([T.StructField("less", T.LongType()), T.StructField("none", T.BooleanType()), T.StructField("id", kind), T.StructField("place", T.StringType())])
        self.keeper = T.StructType([T.StructField("key", T.StringType()), T.StructField("best", self.best), T.StructField("first", T.StructType([T.StructField("wave", T.LongType()), T.StructField("place", T.StringType())])), T.StructField("n", T.LongType()), T.StructField("batch", T.LongType())])

    def rows(self, reader, *files: str) -> DataFrame:
        """Streamed waves (or some of their files) with the locator of each row."""
        place = F.concat_ws("#", F.regexp_extract("_metadata.file_path", r"(wave=[^/]*/[^/]*)$", 1), F.lpad(F.col("_metadata.row_index").cast("string"), 20, "0"))
        found = reader.schema(self.row).option("basePath", self.waves).parquet(*[f"{self.waves}/{f}" for f in files]) if files else reader.schema(self.row).parquet(self.waves)
        return found.select("id", "points", "sha", "key", "norm", "wave", place.alias("place"))

    def latest(self) -> DataFrame:
        """key, best, n as of the last batch that changed each digest."""
        found = self.spark.read.schema(self.keeper).parquet(self.keepers)
        return found.groupBy("key").agg(F.max_by(F.struct("best", "n"), "batch").alias("s")).select("key", "s.best", "s.n")


def stage(docs: DataFrame, store: Store, run: str, first: int, waves: int, digest) -> None:
    """Write the documents as waves ``first`` and following of a run; a mark says that the run is whole."""
    row, at = packed(docs)
    norm = row.select(at["doc_id"].alias("id"), F.length(F.coalesce(at["text"], F.lit(""))).cast("long").alias("points"), normalised(at["text"]).alias("norm"))
    rows = norm.select("id", "points", F.sha2("norm", 256).alias("sha"), "norm").select("id", "points", "sha", digest(F.col("sha")).alias("key"), "norm", (first + F.pmod(F.xxhash64("id"), F.lit(waves))).alias("wave"))
    rows.write.mode("overwrite").partitionBy("wave").parquet(f"{store.staged}/run={run}")


def hit_rows(rows: DataFrame, keys: DataFrame, few: bool) -> DataFrame:
    """key, norm of the rows with one of ``keys`` (k, different)."""
    if few:
        return rows.join(F.broadcast(keys), F.col("key") == F.col("k"), "left_semi").select("key", "norm")
    salted = keys.select("k", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    return rows.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int")).join(salted, (F.col("key") == F.col("k")) & (F.col("salt") == F.col("s")), "left_semi").select("key", "norm")


def settle(store: Store, batch: int, wave: int) -> None:
    """Compare the bytes of a batch's hits; write the digests that stand for more than one text."""
    spark = store.spark
    hits = spark.read.schema(store.keeper).parquet(f"{store.keepers}/batch={batch}").filter("n > 1")
    few = hits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = store.rows(spark.read)
    keys = hits.select(F.col("key").alias("k"))
    same = hit_rows(rows.filter(F.col("wave") == wave), keys, few)
    # earlier rows are known to be equal to the first one
    stayed = cut(hits.filter(F.col("first.wave") < wave).select(F.col("key").alias("k"), F.col("first.place").alias("p")))
    files = [r[0] for r in stayed.select(F.substring_index("p", "#", 1)).distinct().collect()]  # names of files
    if files:
        before = store.rows(spark.read, *sorted(files)).select("key", "norm", "place")
        same = same.unionByName(before.join(F.broadcast(stayed) if few else stayed, (F.col("key") == F.col("k")) & (F.col("place") == F.col("p")), "left_semi").select("key", "norm"))
    # the least and the greatest text of a digest are one and the same, or the digest lied; combined before the shuffle
    lied = same.groupBy("key").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).filter("a <> b").select("key")
    lied.write.mode("overwrite").parquet(f"{store.false}/batch={batch}")


def stream_wave(store: Store, wave: int) -> None:
    """One more micro-batch: all files of the wave that has just been put in place (and of one that a stopped run left)."""
    rows = store.rows(store.spark.readStream)
    state = rows.groupBy("key").agg(F.min(F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("none"), "id", "place")).alias("best"), F.min(F.struct("wave", "place")).alias("first"), F.count("*").alias("n"))

    def upsert(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{store.keepers}/batch={batch}")
        settle(store, batch, wave)

    query = state.writeStream.outputMode("update").option("checkpointLocation", store.stream).foreachBatch(upsert).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest(docs: DataFrame, store: Store, run: str = "0", waves: int | None = None, digest=lambda sha: sha) -> None:
    """Stage the documents, unless their run has been staged, and stream all waves that haven't been."""
    spark = store.spark
    number = lambda paths: [int(p.rsplit("=", 1)[1]) for p in paths]
    was = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        done = number(exists(spark, f"{store.waves}/wave=*"))
        if done:  # a stopped run may have left its last wave in the middle
            stream_wave(store, max(done))

        def rest() -> None:
            whole = [p.rsplit("/", 1)[0] for p in exists(spark, f"{store.staged}/run=*/_SUCCESS")]
            for wave, path in sorted((n, p) for r in whole for p in exists(spark, f"{r}/wave=*") for n in number([p])):
                move(spark, path, f"{store.waves}/wave={wave}")
                stream_wave(store, wave)

        rest()
        if not exists(spark, f"{store.staged}/run={run}/_SUCCESS"):
            first = max(number(exists(spark, f"{store.waves}/wave=*")), default=-1) + 1
            stage(docs, store, run, first, waves or waves_for(docs), digest)
            rest()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def groups(store: Store) -> DataFrame:
    """id, keep_id, n, kept, sha of every row that has been streamed."""
    spark = store.spark
    rows = store.rows(spark.read)
    shape = lambda d: d.select("id", "keep_id", "n", (F.col("place") == F.col("keep_place")).alias("kept"), "sha")
    keeper = lambda d, *keys: d.select(*keys, F.col("best.place").alias("keep_place"), F.col("best.id").alias("keep_id"), "n")
    state = cut(store.latest())
    false = cut(spark.read.schema("key string, batch long").parquet(store.false).select("key").distinct())
    lied = bool(false.limit(1).count())
    bad = F.broadcast(false) if lied and false.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else false
    light, held = rows.select("id", "key", "place", "sha"), state
    if lied:
        light, held = light.join(bad, "key", "left_anti"), state.join(bad, "key", "left_anti")
    # digests with many rows meet them by broadcast or, where there are too many of them, each in SALTS tasks
    hot = cut(keeper(held.filter(F.col("n") > HOT), F.col("key").alias("k")))
    many = hot.limit(BROADCAST_ROWS + 1).count()
    rest = keeper(held.filter(F.col("n") <= HOT), F.col("key").alias("k"))
    on = F.col("key") == F.col("k")
    if not many:
        found = shape(light.join(rest, on))
    elif many <= BROADCAST_ROWS:
        found = shape(light.join(F.broadcast(hot), on)).unionByName(shape(light.join(F.broadcast(hot.select("k")), on, "left_anti").join(rest, on)))
    else:
        dealt = light.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int"))
        salted = hot.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        mine = on & (F.col("salt") == F.col("s"))
        found = shape(dealt.join(salted, mine)).unionByName(shape(dealt.join(salted.select("k", "s"), mine, "left_anti").join(rest, on)))
    if lied:
        theirs = rows.join(bad, "key", "left_semi").select("id", "points", "key", "norm", "place", "sha")
        best = F.min(F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("none"), "id", "place")).alias("best")
        split = keeper(cut(theirs.groupBy("key", "norm").agg(best, F.count("*").alias("n"))), F.col("key").alias("k"), F.col("norm").alias("m"))
        found = found.unionByName(shape(theirs.join(split, on & (F.col("norm") == F.col("m")))))
    return found


def exact_duplicates(docs: DataFrame, state_dir: str | None = None, run: str = "0", waves: int | None = None, digest=lambda sha: sha) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` and of earlier runs in ``state_dir``.

    ``digest`` maps the SHA-256 to the state's key; tests pass a weak one to make different texts collide."""
    spark = docs.sparkSession
    kind = docs.schema[docs.columns.index("doc_id")].dataType
    store = Store(spark, state_dir or scratch(spark, "dedup"), kind)
    ingest(docs, store, run, waves, digest)
    if exists(spark, f"{store.waves}/wave=*"):
        found = cut(groups(store))
    else:
        found = spark.createDataFrame([], T.StructType([T.StructField("id", kind), T.StructField("keep_id", kind), T.StructField("n", T.LongType()), T.StructField("kept", T.BooleanType()), T.StructField("sha", T.StringType())]))
    if state_dir is None:
        remove(spark, store.at)
    return found.select(F.col("id").alias("doc_id"), "keep_id", F.col("n").cast("long").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))
