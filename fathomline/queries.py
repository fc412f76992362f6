"""One query per operator on the driver's tables, and the same in DuckDB SQL where SQL can say it.

The tables hold no dives; they stand in for them: ``events`` is a tagged sensor stream (user = dive, event_type =
category, value = measurement), ``lineitem`` and ``orders`` are large measurement tables, ``embeddings`` are images of 64
pixels, ``documents`` and ``pages`` are log text. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fathomline.functions import frames, geo, text, times
from fathomline.operators import aggregates, calibration, filters, folds, geometry, graphs, images, interp, joins, sampling, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Seconds at the start of the events' month: times are kept small, so that doubles hold microseconds.
START = 1704067200.0

_EV = "ev AS (SELECT user_id AS dive, epoch_us(ts) / 1e6::DOUBLE - 1704067200.0::DOUBLE AS t, event_id AS seq, event_type AS kind, value FROM events)"
_LI = "li AS (SELECT l_orderkey AS dive, l_linenumber AS seq, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_partkey, l_suppkey, l_shipdate FROM lineitem)"
_PX = "px AS (SELECT vec_id AS image_id, label AS channel, unnest(range(len(embedding)))::INTEGER AS pixel, unnest(embedding)::DOUBLE AS value FROM embeddings WHERE embedding IS NOT NULL)"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """dive, t, seq, kind, value"""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("dive"), (times.epoch_of(F.col("ts")) - START).alias("t"), F.col("event_id").alias("seq"), F.col("event_type").alias("kind"), "value")
    return e.filter(F.col("kind").isin(*kinds)) if kinds else e


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, channel (the label), pixel, value"""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("image_id"), F.col("label").alias("channel"), F.posexplode(F.col("embedding").cast("array<double>")).alias("pixel", "value"))


def _r(c: Column | str, name: str, digits: int = 6) -> Column:
    return (F.round(F.col(c) if isinstance(c, str) else c, digits) + 0.0).alias(name)  # no negative zero


# -- scans, filters


@query(f"""WITH {_EV} SELECT dive, seq, kind, value FROM ev WHERE (kind LIKE '%ew%' OR kind LIKE '%click%') AND t BETWEEN 86400 AND 864000""")
def scan_filter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = filters.time_range(stream(spark, sf_dir), ["dive"], "t", 86400, 864000).withColumnRenamed("kind", "category")
    return filters.tagged(e, "ew").unionByName(filters.tagged(e, "click")).select("dive", "seq", F.col("category").alias("kind"), "value")


@query(f"""WITH {_EV} SELECT dive, seq, round(t - value / 50, 6) AS t FROM ev WHERE abs(t - (t - value / 50)) < 1.0""")
def clock_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).withColumn("device_t", F.col("t") - F.col("value") / 50)
    return filters.sane_clock(e, "t", "device_t").select("dive", "seq", _r("t", "t"))


@query("""SELECT event_id AS seq, (json_extract(props, '$.k'))::BIGINT AS k, CASE WHEN value > 0 AND value < 32 THEN value END AS value FROM events WHERE (json_extract(props, '$.k'))::BIGINT > 10""")
def nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return e.filter(F.col("k") > 10).select(F.col("event_id").alias("seq"), "k", filters.sentinel_to_null(F.col("value"), 0.0, 32.0, inclusive=False).alias("value"))


@query(f"""WITH {_EV}, span AS (SELECT dive, min(t) AS a, max(t) AS b FROM ev WHERE kind = 'click' GROUP BY dive)
SELECT ev.dive, seq FROM ev JOIN span USING (dive) WHERE kind = 'purchase' AND t >= a + 1 AND t + 1 <= b""")
def during_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.during(stream(spark, sf_dir, "purchase"), stream(spark, sf_dir, "click"), ["dive"], "t").select("dive", "seq")


_BRACKET = """u AS (
  SELECT dive, t, seq, NULL::DOUBLE AS st, NULL::DOUBLE AS sv, NULL::DOUBLE AS pt, NULL::DOUBLE AS pv, NULL::DOUBLE AS nt, NULL::DOUBLE AS nv, 1 AS is_q FROM ev WHERE kind = '{q}'
  UNION ALL SELECT dive, t, NULL, t, value, lag(t) OVER w, lag(value) OVER w, lead(t) OVER w, lead(value) OVER w, 0 FROM ev WHERE kind = '{s}' WINDOW w AS (PARTITION BY dive ORDER BY t)),
b AS (SELECT *,
  last_value(st IGNORE NULLS) OVER up AS lt, last_value(sv IGNORE NULLS) OVER up AS lv, first_value(st IGNORE NULLS) OVER dn AS ht, first_value(sv IGNORE NULLS) OVER dn AS hv
  FROM u WINDOW up AS (PARTITION BY dive ORDER BY t, is_q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), dn AS (PARTITION BY dive ORDER BY t, is_q DESC ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""
_LINE = "round(CASE WHEN ht = lt THEN lv ELSE (hv - lv) / (ht - lt) * (t - lt) + lv END, 6)"


@query(f"WITH {_EV}, {_BRACKET.format(q='error', s='purchase')} SELECT dive, seq, {_LINE} AS value FROM b WHERE is_q = 1 AND lt IS NOT NULL AND ht IS NOT NULL")
def bracket_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = interp.interpolated(stream(spark, sf_dir, "error").drop("value"), stream(spark, sf_dir, "purchase"), ["dive"], "t", ["value"], extrapolate=False)
    return i.filter(F.col("value").isNotNull()).select("dive", "seq", _r("value", "value"))


@query(f"""WITH {_EV}, {_BRACKET.format(q='error', s='purchase')},
f AS (SELECT dive, max(a) AS a, max(av) AS av, max(a2) AS a2, max(av2) AS av2, max(z) AS z, max(zv) AS zv, max(z2) AS z2, max(zv2) AS zv2 FROM (
  SELECT dive, CASE WHEN i = 1 THEN t END a, CASE WHEN i = 1 THEN value END av, CASE WHEN i = 2 THEN t END a2, CASE WHEN i = 2 THEN value END av2,
         CASE WHEN j = 1 THEN t END z, CASE WHEN j = 1 THEN value END zv, CASE WHEN j = 2 THEN t END z2, CASE WHEN j = 2 THEN value END zv2
  FROM (SELECT *, row_number() OVER (PARTITION BY dive ORDER BY t) AS i, row_number() OVER (PARTITION BY dive ORDER BY t DESC) AS j FROM ev WHERE kind = 'purchase')) GROUP BY dive),
e AS (SELECT b.dive, seq, t,
  CASE WHEN lt IS NULL THEN a WHEN ht IS NULL THEN coalesce(z2, z) ELSE lt END AS lt, CASE WHEN lt IS NULL THEN av WHEN ht IS NULL THEN coalesce(zv2, zv) ELSE lv END AS lv,
  CASE WHEN lt IS NULL THEN coalesce(a2, a) WHEN ht IS NULL THEN z ELSE ht END AS ht, CASE WHEN lt IS NULL THEN coalesce(av2, av) WHEN ht IS NULL THEN zv ELSE hv END AS hv
  FROM b JOIN f USING (dive) WHERE is_q = 1)
SELECT dive, seq, {_LINE} AS value FROM e""")
def bracket_extrapolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = interp.interpolated(stream(spark, sf_dir, "error").drop("value"), stream(spark, sf_dir, "purchase"), ["dive"], "t", ["value"])
    return i.filter(F.col("value").isNotNull()).select("dive", "seq", _r("value", "value"))


@query(f"""WITH {_EV}, q AS (SELECT * FROM ev WHERE kind = 'view'), s AS (SELECT * FROM ev WHERE kind = 'click'),
lo AS (SELECT q.dive, q.seq, q.t, s.t AS lt, s.value AS lv FROM q ASOF JOIN s ON q.dive = s.dive AND q.t > s.t),
hi AS (SELECT q.seq, s.t AS ht, s.value AS hv FROM q ASOF JOIN s ON q.dive = s.dive AND q.t <= s.t)
SELECT dive, seq, {_LINE} AS value FROM lo JOIN hi USING (seq)""")
def forward_bracket_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = interp.forward_interpolated(stream(spark, sf_dir, "view").drop("value"), stream(spark, sf_dir, "click"), ["dive"], "t", ["value"])
    return i.select("dive", "seq", _r("value", "value"))


@query(f"""WITH {_EV}, q AS (SELECT * FROM ev WHERE kind = 'view'), s AS (SELECT * FROM ev WHERE kind = 'click'),
l AS (SELECT dive, max(t) AS t FROM s GROUP BY dive), lv AS (SELECT s.dive, s.seq AS last_seq FROM s JOIN l USING (dive, t)),
hi AS (SELECT q.seq, s.seq AS next_seq FROM q ASOF JOIN s ON q.dive = s.dive AND q.t <= s.t)
SELECT q.dive, q.seq, coalesce(next_seq, last_seq) AS next_seq FROM q JOIN lv USING (dive) LEFT JOIN hi ON q.seq = hi.seq""")
def forward_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir, "click").withColumnRenamed("seq", "next_seq")
    return interp.next_observation(stream(spark, sf_dir, "view"), s, ["dive"], "t", ["next_seq"]).filter(F.col("next_seq").isNotNull()).select("dive", "seq", "next_seq")


@query(f"""WITH {_EV}, q AS (SELECT * FROM ev WHERE kind = 'view'), s AS (SELECT * FROM ev WHERE kind = 'click')
SELECT q.dive, q.seq, s.seq AS last_seq FROM q ASOF JOIN s ON q.dive = s.dive AND q.t >= s.t""")
def backward_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stream(spark, sf_dir, "click").withColumnRenamed("seq", "last_seq")
    return interp.last_observation(stream(spark, sf_dir, "view"), s, ["dive"], "t", ["last_seq"]).filter(F.col("last_seq").isNotNull()).select("dive", "seq", "last_seq")


@query(f"""WITH {_EV}, k AS (SELECT dive, t, t * 1.001 + value AS o FROM ev WHERE kind = 'click'),
s AS (SELECT dive, t, o, (lead(o) OVER w - o) / (lead(t) OVER w - t) AS slope, lag(t) OVER w AS pt, lag(o) OVER w AS po FROM k WINDOW w AS (PARTITION BY dive ORDER BY t)),
c AS (SELECT dive, t, o, coalesce(slope, (o - po) / (t - pt), 1.0) AS slope FROM s), f AS (SELECT dive, arg_min(t, t) AS t, arg_min(o, t) AS o, arg_min(slope, t) AS slope FROM c GROUP BY dive),
q AS (SELECT * FROM ev WHERE kind = 'view'), m AS (SELECT q.seq, c.t AS kt, c.o, c.slope FROM q ASOF JOIN c ON q.dive = c.dive AND q.t >= c.t)
SELECT q.dive, q.seq, round(coalesce(m.o, f.o) + coalesce(m.slope, f.slope) * (q.t - coalesce(m.kt, f.t)), 6) AS corrected FROM q JOIN f USING (dive) LEFT JOIN m ON q.seq = m.seq""")
def piecewise_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    knots = windows.slopes(stream(spark, sf_dir, "click").withColumn("o", F.col("t") * 1.001 + F.col("value")), ["dive"], "t", "o")
    q = interp.piecewise_clock(stream(spark, sf_dir, "view"), knots, ["dive"], "t")
    return q.filter(F.col("corrected").isNotNull()).select("dive", "seq", _r("corrected", "corrected"))


@query(f"""WITH {_EV}, p AS (SELECT l.seq, l.dive, r.seq AS matched_seq, abs(l.t - r.t) AS gap, row_number() OVER (PARTITION BY l.seq ORDER BY abs(l.t - r.t), r.seq) AS n
FROM (SELECT * FROM ev WHERE kind = 'view') l JOIN (SELECT * FROM ev WHERE kind = 'click') r ON l.dive = r.dive AND abs(l.t - r.t) <= 7200)
SELECT dive, seq, matched_seq, round(gap, 6) AS gap FROM p WHERE n = 1""")
def nearest_within_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = joins.nearest(stream(spark, sf_dir, "view"), stream(spark, sf_dir, "click"), ["dive"], "t", 7200, "seq", "seq")
    return n.select("dive", "seq", "matched_seq", _r("gap", "gap"))


@query(f"""WITH {_EV}, l AS (SELECT dive, floor(t / 86400)::BIGINT AS d, seq, row_number() OVER (PARTITION BY dive, floor(t / 86400) ORDER BY seq) AS n FROM ev WHERE kind = 'view'),
r AS (SELECT dive, floor(t / 86400)::BIGINT AS d, seq AS other, row_number() OVER (PARTITION BY dive, floor(t / 86400) ORDER BY seq) AS n FROM ev WHERE kind = 'click')
SELECT dive, d, seq, other FROM l JOIN r USING (dive, d, n)""")
def exact_merge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda k: stream(spark, sf_dir, k).select("dive", F.floor(F.col("t") / 86400).cast("long").alias("d"), "seq")
    r = day("click").withColumn("other", F.col("seq"))
    return joins.one_to_one(day("view"), r, ["dive", "d"], "seq").select("dive", "d", "seq", "other")


_STEM = "regexp_replace(regexp_extract({}, '([^/]*)$', 1), '\\.[^.]*$', '')"


@query(f"""WITH p AS (SELECT page_id, url, {_STEM.format('url')} AS stem FROM pages), f AS (SELECT stem, arg_min(url, page_id) AS first_url FROM p GROUP BY stem)
SELECT page_id, first_url FROM p JOIN f USING (stem)""")
def stem_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return joins.by_stem(p.select("page_id", "url"), p.select(F.col("url").alias("first_url"), F.col("page_id").alias("n")), "url", "first_url", "n").select("page_id", "first_url")


@query(f"""SELECT page_id FROM pages WHERE {_STEM.format('url')} IN (SELECT {_STEM.format("regexp_replace(url, '[?#].*$', '')")} FROM pages WHERE regexp_matches(url, '[?#]'))""")
def semi_join_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    names = p.filter(F.col("url").rlike("[?#]")).select(F.regexp_replace("url", "[?#].*$", "").alias("name"))
    return joins.listed(p, names, "url", "name").select("page_id")


@query(f"""SELECT page_id FROM pages WHERE {_STEM.format('url')} NOT IN (SELECT {_STEM.format("regexp_replace(url, '[?#].*$', '')")} FROM pages WHERE regexp_matches(url, '[?#]'))""")
def anti_join_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    names = p.filter(F.col("url").rlike("[?#]")).select(F.regexp_replace("url", "[?#].*$", "").alias("name"))
    return joins.listed(p, names, "url", "name", missing=True).select("page_id")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return sampling.without(table(spark, sf_dir, "orders").select("o_orderkey"), big, ["o_orderkey"])


@query("""WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part) SELECT p_partkey, word FROM part JOIN w ON contains(p_name, word)""")
def containment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    words = p.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return joins.containing(p, words, "p_name", "word", ["p_partkey"]).select("p_partkey", "word")


@query(f"""WITH {_EV}, p AS (SELECT l.dive, l.seq, r.seq AS peak, row_number() OVER (PARTITION BY l.dive, l.seq ORDER BY r.t, r.seq) AS n FROM (SELECT * FROM ev WHERE kind = 'view') l JOIN (SELECT * FROM ev WHERE kind = 'click') r
ON l.dive = r.dive AND r.t >= l.t AND r.t < l.t + 3600) SELECT dive, seq, peak FROM p WHERE n = 1""")
def band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = stream(spark, sf_dir, "click").select("dive", F.col("t").alias("rt"), F.col("seq").alias("peak"))
    return joins.band(stream(spark, sf_dir, "view").drop("value", "kind"), r, ["dive"], "t", "rt", 3600, ["seq"], ["peak"]).select("dive", "seq", "peak")


# -- windows


@query(f"""WITH {_EV}, s AS (SELECT dive, seq, t, coalesce((t - lag(t) OVER w) * (value + lag(value) OVER w) / 2, 0) AS step FROM ev WINDOW w AS (PARTITION BY dive ORDER BY t, seq))
SELECT dive, seq, round(sum(step) OVER (PARTITION BY dive ORDER BY t, seq ROWS UNBOUNDED PRECEDING), 3) AS northings FROM s""")
def dead_reckoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = windows.dead_reckoned(stream(spark, sf_dir), ["dive"], "t", {"value": "northings"}, ["t", "seq"])
    return d.select("dive", "seq", _r("northings", "northings", 3))


@query(f"""WITH {_EV}, y AS (SELECT dive, seq, t, fmod(value * 7, 360) AS yaw FROM ev),
n AS (SELECT dive, seq, coalesce(lag(t) OVER w, t) AS t0, coalesce(lead(t) OVER w, t) AS t1, coalesce(lead(yaw) OVER w, yaw) - coalesce(lag(yaw) OVER w, yaw) AS d FROM y WINDOW w AS (PARTITION BY dive ORDER BY t))
SELECT dive, seq, round(CASE WHEN d > 180 THEN d - 360 WHEN d < -180 THEN d + 360 ELSE d END / (t1 - t0), 9) AS yaw_rate FROM n WHERE t1 > t0""")
def angular_rate_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).withColumn("yaw", (F.col("value") * 7) % 360)
    return windows.angular_rates(e, ["dive"], "t", ["yaw"]).filter(F.col("yaw_rate").isNotNull()).select("dive", "seq", _r("yaw_rate", "yaw_rate", 9))


_NEAR = " AND ".join(f"coalesce(sqrt((value - {f}(value, {k}) OVER w) ** 2 + (value / 3 - {f}(value / 3, {k}) OVER w) ** 2) < 3 * (sqrt(2.0) * value / 10 + sqrt(2.0) * {f}(value, {k}) OVER w / 10 + abs(t - {f}(t, {k}) OVER w) * 0.001), false)" for k in (1, 2) for f in ("lag", "lead"))


@query(f"WITH {_EV}, f AS (SELECT dive, seq, {_NEAR} AS ok FROM ev WINDOW w AS (PARTITION BY dive ORDER BY t)) SELECT dive, seq FROM f WHERE ok")
def continuity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).select("dive", "seq", "t", F.col("value").alias("n"), (F.col("value") / 3).alias("e"), (F.col("value") / 10).alias("ns"), (F.col("value") / 10).alias("es"))
    return windows.continuous_fixes(e, ["dive"], "t", "n", "e", "ns", "es", 3.0, 0.001).select("dive", "seq")


@query(f"WITH {_EV}, {_BRACKET.format(q='error', s='purchase')} SELECT b.dive, b.seq FROM b JOIN ev ON b.seq = ev.seq WHERE is_q = 1 AND lt IS NOT NULL AND ht IS NOT NULL AND abs(ev.value - (CASE WHEN ht = lt THEN lv ELSE (hv - lv) / (ht - lt) * (b.t - lt) + lv END)) <= 2 * (1.0 + 5.0)")
def depth_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = stream(spark, sf_dir, "error").select("dive", "seq", "t", F.col("value").alias("depth"), F.lit(1.0).alias("depth_std"))
    depths = stream(spark, sf_dir, "purchase").select("dive", "t", F.col("value").alias("depth"), F.lit(5.0).alias("depth_std"))
    span = depths.groupBy("dive").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    inside = fixes.join(span, "dive").filter(F.col("t").between(F.col("a"), F.col("b"))).drop("a", "b")
    return filters.depth_gate(inside, depths, ["dive"], "t", 2.0).select("dive", "seq")


@query(f"""WITH {_EV} SELECT dive, seq, last_value(CASE WHEN kind = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY dive ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS value FROM ev""")
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).withColumn("value", F.when(F.col("kind") == "click", F.col("value")))
    return windows.forward_filled(e, ["dive"], ["t", "seq"], ["value"]).select("dive", "seq", "value")


@query(f"""WITH {_EV} SELECT dive, seq, first_value(CASE WHEN kind = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY dive ORDER BY t, seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM ev""")
def back_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).withColumn("value", F.when(F.col("kind") == "click", F.col("value")))
    return windows.back_filled(e, ["dive"], ["t", "seq"], ["value"]).select("dive", "seq", "value")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS t, lag(epoch_us(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders),
r AS (SELECT *, sum(CASE WHEN p IS NULL OR t > p THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM r GROUP BY o_custkey, run""")
def monotone_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("t"))
    return windows.monotone(o, ["o_custkey"], "o_orderkey", "t").select("o_custkey", "o_orderkey")


@query(f"""WITH {_EV}, p AS (SELECT dive, seq, value, lag(value) OVER (PARTITION BY dive ORDER BY t) AS was FROM (SELECT dive, seq, t, round(value / 20) AS value FROM ev)) SELECT dive, seq FROM p WHERE was IS NULL OR was <> value""")
def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.changed(stream(spark, sf_dir).withColumn("value", F.round(F.col("value") / 20)), ["dive"], "t", "value").select("dive", "seq")


@query(f"""WITH {_EV} SELECT dive, seq, sum(CASE WHEN kind = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY dive ORDER BY t, seq ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM ev""")
def ensembles(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.segments(stream(spark, sf_dir), ["dive"], "t", F.col("kind") == "signup")
    return w.select("dive", "seq", F.col("segment").cast("long").alias("segment"))


@query(f"""WITH {_EV}, z AS (SELECT dive, seq, t, CASE WHEN value < 5 THEN 0 ELSE value END AS value FROM ev),
n AS (SELECT *, lag(t) OVER w AS t0, lead(t) OVER w AS t1, lead(value) OVER w AS v1 FROM z WINDOW w AS (PARTITION BY dive ORDER BY t)),
p AS (SELECT *, value = 0 AND t0 IS NOT NULL AND t1 IS NOT NULL AS zero, CASE WHEN t1 = t0 THEN 0 ELSE (t - t0) / (t1 - t0) END AS part FROM n),
r AS (SELECT *, sum(CASE WHEN zero THEN 0 ELSE 1 END) OVER (PARTITION BY dive ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM p)
SELECT dive, seq, round(CASE WHEN zero THEN first_value(value) OVER w * product(CASE WHEN zero THEN 1 - part ELSE 1 END) OVER w + v1 * part ELSE value END, 6) AS value FROM r WINDOW w AS (PARTITION BY dive, run ORDER BY t ROWS UNBOUNDED PRECEDING)""")
def zero_gap_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = stream(spark, sf_dir).withColumn("value", F.when(F.col("value") < 5, 0.0).otherwise(F.col("value")))
    return windows.repaired_zeros(z, ["dive"], "t", ["value"]).select("dive", "seq", _r("value", "value"))


@query(f"""WITH {_EV}, p AS (SELECT dive, t, value - lead(value) OVER w AS d_value, lead(seq) OVER w AS next_seq FROM ev WINDOW w AS (PARTITION BY dive ORDER BY t)) SELECT dive, next_seq, round(d_value, 6) AS d_value FROM p WHERE next_seq IS NOT NULL""")
def relative_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.relative_poses(stream(spark, sf_dir), ["dive"], "t", ["value"], ["seq"]).select("dive", "next_seq", _r("d_value", "d_value"))


@query(f"""WITH {_EV}, f AS (SELECT dive, seq, max(CASE WHEN kind = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY dive ORDER BY t ROWS UNBOUNDED PRECEDING) AS b, coalesce(max(CASE WHEN kind = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY dive ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e FROM ev)
SELECT dive, seq FROM f WHERE b = 1 AND e = 0""")
def range_by_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.between_marks(stream(spark, sf_dir), ["dive"], "t", "kind", "signup", "purchase").select("dive", "seq")


# -- expressions


_B2I = {
    "north": "cos(y)*cos(p)*a + (cos(y)*sin(p)*sin(r) - sin(y)*cos(r))*b + (sin(y)*sin(r) + cos(y)*cos(r)*sin(p))*c",
    "east": "sin(y)*cos(p)*a + (cos(y)*cos(r) + sin(r)*sin(p)*sin(y))*b + (sin(p)*sin(y)*cos(r) - cos(y)*sin(r))*c",
    "down": "-sin(p)*a + cos(p)*sin(r)*b + cos(p)*cos(r)*c",
}


@query(f"""WITH {_LI}, a AS (SELECT dive, seq, radians(l_quantity) AS r, radians(l_discount * 100) AS p, radians(l_tax * 1000) AS y, 1.0 AS a, l_quantity / 10 AS b, l_tax AS c FROM li)
SELECT dive, seq, {", ".join(f"round({v}, 6) AS {k}" for k, v in _B2I.items())} FROM a""")
def body_to_inertial(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, e, d = frames.body_to_inertial(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 1000, F.lit(1.0), F.col("l_quantity") / 10, F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dive"), F.col("l_linenumber").alias("seq"), _r(n, "north"), _r(e, "east"), _r(d, "down"))


@query(f"WITH {_LI} SELECT dive, seq, round(l_quantity + l_tax * 0.3 - l_discount * 0.2, 9) AS x, round(l_discount + l_discount * 0.1 - 0.5 * 0.3, 9) AS y, round(l_tax + 0.5 * 0.2 - l_tax * 0.1, 9) AS z FROM li")
def lever_arm(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y, z = frames.lever_arm((F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")), (F.lit(0.5), F.col("l_tax"), F.col("l_discount")), (0.1, 0.2, 0.3))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dive"), F.col("l_linenumber").alias("seq"), _r(x, "x", 9), _r(y, "y", 9), _r(z, "z", 9))


@query("""SELECT event_id AS seq, strftime(ts, '%Y%m%d%H%M%S') AS stamp, round(epoch_us(date_trunc('second', ts)) / 1e6 + 9 * 3600 - 9 * 3600, 3) AS t FROM events""")
def format_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), times.epoch_to_text(times.epoch_of(F.col("ts"))).alias("stamp"))
    local = times.epoch_from_stamp(F.concat(F.lit("img_"), F.col("stamp")), "xxxxYYYYMMDDhhmmss", 9.0) + 9 * 3600
    return e.select("seq", "stamp", _r(local, "t", 3))


_LINES = "l AS (SELECT doc_id, generate_subscripts(ls, 1)::INTEGER - 1 AS n, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))"


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, line of all lines of all texts"""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.lines_of(F.col("text"))).alias("n", "line"))


@query(f"""WITH {_LINES} SELECT doc_id, n, lpad(upper(to_hex(list_reduce(list_prepend(0, list_transform(regexp_extract_all(line, '(?s).'), lambda c: unicode(c))), lambda a, b: xor(a, b)))), 2, '0') AS checksum FROM l""")
def log_parse_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(spark, sf_dir).select("doc_id", "n", text.xor_checksum(F.col("line")).alias("checksum"))


@query(f"""WITH {_LINES} SELECT doc_id, n, trim(substr(line, 1, 10)) AS a, trim(substr(line, 11, 8)) AS b,
CASE WHEN regexp_full_match(trim(substr(line, 19, 6)), '[+-]?[0-9]+(\\.[0-9]*)?') THEN trim(substr(line, 19, 6))::DOUBLE END AS c FROM l""")
def fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda start, width: text.fixed(F.col("line"), start, width)
    return text_lines(spark, sf_dir).select("doc_id", "n", at(1, 10).alias("a"), at(11, 8).alias("b"), text.plain_number(at(19, 6)).alias("c"))


# -- aggregates


@query(f"""WITH {_EV}, q AS (SELECT * FROM ev WHERE kind = 'view'), s AS (SELECT * FROM ev WHERE kind = 'click'),
lo AS (SELECT q.dive, q.seq, q.t, q.value, s.t AS lt, s.value AS lv FROM q ASOF JOIN s ON q.dive = s.dive AND q.t > s.t), hi AS (SELECT q.seq, s.t AS ht, s.value AS hv FROM q ASOF JOIN s ON q.dive = s.dive AND q.t <= s.t)
SELECT dive, count(*) AS n, round(avg(value) - avg((hv - lv) / (ht - lt) * (t - lt) + lv), 6) AS north_offset FROM lo JOIN hi USING (seq) GROUP BY dive""")
def mean_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    track = stream(spark, sf_dir, "click").select("dive", "t", F.col("value").alias("northings"), F.lit(0.0).alias("eastings"))
    fixes = stream(spark, sf_dir, "view").select("dive", "t", F.col("value").alias("northings"), F.lit(0.0).alias("eastings"))
    return aggregates.mean_offset(track, fixes, ["dive"], "t", gap=1e12).select("dive", "n", _r("north_offset", "north_offset"))


@query("""SELECT floor((p_retailprice - 900) / 0.7)::INTEGER AS bin, count(*) AS n, round(avg(p_retailprice), 6) AS distance FROM part WHERE p_retailprice > 900 AND p_retailprice < 990 GROUP BY 1 HAVING count(*) >= 10""")
def altitude_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.altitude_bins(table(spark, sf_dir, "part"), "p_retailprice", 900, 990, 0.7, 10).select("bin", "n", _r("distance", "distance"))


@query("""WITH r AS (SELECT l_returnflag, l_linestatus, l_suppkey, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_suppkey ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag, l_linestatus, l_suppkey) AS n FROM lineitem)
SELECT l_returnflag, l_linestatus, l_suppkey, round(avg(v), 6) AS mean, round(stddev_pop(v), 4) AS std, count(*) AS n FROM r WHERE i >= floor(n * 0.2 / 2) AND i < floor(n * (1 - 0.2 / 2)) GROUP BY ALL""")
def trimmed_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus", "l_suppkey"]
    return aggregates.trimmed_stats(table(spark, sf_dir, "lineitem"), keys, "l_extendedprice").select(*keys, _r("mean", "mean"), _r("std", "std", 4), "n")


@query("SELECT l_suppkey, round(median(l_extendedprice), 6) AS median FROM lineitem GROUP BY l_suppkey")
def median_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.medians(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice").select("l_suppkey", _r("median", "median"))


@query(f"WITH {_PX} SELECT pixel, round(avg(value), 6) AS mean, round(CASE WHEN count(*) > 1 THEN greatest(stddev_pop(value), 1e-6) END, 6) AS std, count(*) AS n FROM px GROUP BY pixel")
def welford(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.pixel_stats(pixels(spark, sf_dir), ["pixel"]).select("pixel", _r("mean", "mean"), _r("std", "std"), "n")


@query(f"""WITH RECURSIVE {_PX}, o AS (SELECT pixel, value, row_number() OVER (PARTITION BY pixel ORDER BY image_id, value) AS i FROM px),
f AS (
  SELECT pixel, 0::BIGINT AS i, 0.0::DOUBLE AS mean, 0.0::DOUBLE AS m2 FROM o WHERE i = 1
  UNION ALL
  SELECT pixel, i, mean + (x - mean) / i, m2 + (x - mean) * (x - (mean + (x - mean) / i)) FROM (
    SELECT f.pixel, o.i, f.mean, f.m2, CASE WHEN o.value > 0.1 THEN f.mean ELSE o.value END AS x FROM f JOIN o ON o.pixel = f.pixel AND o.i = f.i + 1)),
z AS (SELECT *, row_number() OVER (PARTITION BY pixel ORDER BY i DESC) AS back FROM f)
SELECT pixel, round(mean, 6) AS mean, round(CASE WHEN i > 1 THEN greatest(sqrt(m2 / i), 1e-6) END, 6) AS std, i::INTEGER AS n FROM z WHERE back = 1""")
def clipped_running_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = aggregates.clipped_running_stats(pixels(spark, sf_dir), ["pixel"], "image_id", clip=0.1)
    return c.select("pixel", _r("mean", "mean"), _r("std", "std"), "n")


@query(f"""WITH {_EV}, l AS (SELECT dive, regr_slope(t + value, t) AS slope FROM ev GROUP BY dive) SELECT dive, round(any_value(slope), 9) AS slope, round(min(t + value - slope * t), 4) AS intercept FROM ev JOIN l USING (dive) GROUP BY dive""")
def clock_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).withColumn("y", F.col("t") + F.col("value"))
    return aggregates.clock_regression(e, ["dive"], "t", "y").select("dive", _r("slope", "slope", 9), _r("intercept", "intercept", 4))


@query(f"""WITH {_EV}, s AS (SELECT dive, t, value AS alt, coalesce(sqrt((value / 10 - lag(value / 10) OVER w) ** 2 + (t / 1000 - lag(t / 1000) OVER w) ** 2), 0) AS step FROM ev WINDOW w AS (PARTITION BY dive ORDER BY t))
SELECT dive, count(*) AS images, count(*) FILTER (WHERE alt > 5 AND alt < 40) AS "between", round(avg(alt), 6) AS mean_altitude, round(max(t) - min(t), 3) AS bottom_time, round(sum(step), 4) AS distance, round(sum(step * alt * tan(radians(30.0)) * 2), 3) AS area FROM s GROUP BY dive""")
def swath_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).select("dive", "t", F.col("value").alias("alt"), (F.col("value") / 10).alias("n"), (F.col("t") / 1000).alias("e"))
    s = aggregates.acquisition_stats(e, ["dive"], "t", ["n", "e"], "alt", 5, 40, 60.0)
    return s.select("dive", "images", "between", _r("mean_altitude", "mean_altitude"), _r("bottom_time", "bottom_time", 3), _r("distance", "distance", 4), _r("area", "area", 3))


@query(f"""WITH {_EV}, s AS (SELECT dive, kind, t, lead(t) OVER (PARTITION BY dive, kind ORDER BY t) - t AS dt FROM ev) SELECT dive, kind, count(*) AS n, round(arg_min(dt, CASE WHEN dt >= 0.002 THEN t END), 6) AS period FROM s GROUP BY dive, kind""")
def tagged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.tagged_counts(stream(spark, sf_dir), ["dive", "kind"], "t").select("dive", "kind", "n", _r("period", "period"))


@query("""SELECT c_nationkey, round(min(c_acctbal), 6) AS south, round(max(c_acctbal), 6) AS north, min(c_custkey) AS west, max(c_custkey) AS east FROM customer GROUP BY c_nationkey""")
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.bounding_box(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", "c_custkey").select("c_nationkey", _r("south", "south"), _r("north", "north"), "west", "east")


@query(f"WITH {_EV} SELECT dive, round(sum(value) ** 2 / sum(value ** 2), 6) AS neff FROM ev GROUP BY dive")
def effective_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.effective_size(stream(spark, sf_dir), ["dive"], "value").select("dive", _r("neff", "neff"))


@query(f"WITH {_EV} SELECT DISTINCT dive, round(t) AS t FROM ev")
def distinct_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).withColumn("t", F.round("t"))
    return aggregates.distinct_times(e.filter("kind = 'click'"), e.filter("kind <> 'click'"), by=["dive"], t="t")


@query(f"WITH {_EV} SELECT dive, seq, kind FROM ev WHERE kind IN ('click', 'view') UNION ALL SELECT dive, seq, kind FROM ev WHERE kind = 'error'")
def union_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.union_all(stream(spark, sf_dir, "click", "view").drop("value"), stream(spark, sf_dir, "error")).select("dive", "seq", "kind")


@query(f"WITH {_EV}, r AS (SELECT dive, seq, (row_number() OVER (PARTITION BY dive ORDER BY t, seq))::INTEGER AS n FROM ev) SELECT * FROM r")
def interlace(spark: SparkSession, sf_dir: str) -> DataFrame:
    inline = sampling.interlaced(stream(spark, sf_dir), "t", "seq").withColumn("place", F.monotonically_increasing_id())
    return inline.withColumn("n", F.row_number().over(W.partitionBy("dive").orderBy("place"))).select("dive", "seq", "n")


@query(f"""WITH {_EV}, c AS (SELECT dive, seq, sum(value) OVER w / sum(value) OVER (PARTITION BY dive) AS hi, coalesce((sum(value) OVER w - value) / sum(value) OVER (PARTITION BY dive), 0) AS lo FROM ev WINDOW w AS (PARTITION BY dive ORDER BY seq ROWS UNBOUNDED PRECEDING))
SELECT dive, count(*) AS drawn FROM (SELECT dive, unnest(range(greatest(0, ceil(lo * 16 - 0.5)::BIGINT), least(16, ceil(hi * 16 - 0.5)::BIGINT))) AS draw FROM c) GROUP BY dive""")
def systematic_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.systematic_resample(stream(spark, sf_dir), ["dive"], "seq", "value", 16).groupBy("dive").agg(F.count("*").alias("drawn"))


@query()
def zstrat_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.z_stratified(stream(spark, sf_dir), ["dive"], "value", "seq", bins=10, most=3)


# -- images


@query(f"WITH {_PX}, s AS (SELECT pixel, avg(value) AS m, greatest(stddev_pop(value), 1e-6) AS d FROM px GROUP BY pixel) SELECT image_id, pixel, round(greatest(0.0, least(1.0, (value - m) / d * (25.0 / 100) + 30.0 / 100)), 6) AS value FROM px JOIN s USING (pixel)")
def pixel_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir)
    s = aggregates.pixel_stats(p, ["pixel"])
    return p.join(s, "pixel").select("image_id", "pixel", _r(images.matched_stats(F.col("value"), F.col("mean"), F.col("std"), 30.0, 25.0), "value"))


@query(f"""WITH {_PX}, g AS (SELECT pixel, 0.5 + pixel / 100 AS a, -0.1 - pixel / 1000 AS b, 0.05 AS c FROM (SELECT DISTINCT pixel FROM px))
SELECT image_id, pixel, round((a * exp(b * 2.0) + c) / (a * exp(b * (1 + image_id % 5)) + c) * value, 6) AS value FROM px JOIN g USING (pixel)""")
def attenuation_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir).withColumn("channel", F.lit(0)).withColumn("altitude", 1.0 + F.col("image_id") % 5)
    params = p.select("channel", "pixel").distinct().select("channel", "pixel", (0.5 + F.col("pixel") / 100).alias("a"), (-0.1 - F.col("pixel") / 1000).alias("b"), F.lit(0.05).alias("c"))
    return images.attenuation_corrected(p, images.with_gains(params, 2.0)).select("image_id", "pixel", _r("value", "value"))


@query(f"WITH {_PX}, m AS (SELECT image_id, max(abs(value)) AS top FROM px GROUP BY image_id) SELECT image_id, pixel, round(CASE WHEN top < 0.0031308 THEN 12.92 * abs(value) ELSE 1.055 * pow(abs(value), 1 / 1.5) - 0.055 END, 6) AS value FROM px JOIN m USING (image_id)")
def gamma_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir).withColumn("value", F.abs("value"))
    return images.gamma(p).select("image_id", "pixel", _r("value", "value"))


@query(f"WITH {_PX} SELECT image_id, pixel, round((CASE pixel % 3 WHEN 0 THEN 1.5 WHEN 1 THEN 2.0 ELSE 0.5 END) * (value - CASE pixel % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 0.0 ELSE -0.2 END), 6) AS value FROM px")
def manual_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir)
    return p.select("image_id", "pixel", _r(images.balanced(F.col("value"), (F.col("pixel") % 3).cast("int"), [1.5, 2.0, 0.5], [0.1, 0.0, -0.2]), "value"))


@query()
def exp_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir).select(F.col("channel"), "pixel", (1.0 + F.col("image_id") % 7).alias("distance"), F.abs("value").alias("intensity"))
    return images.fit_attenuation(p)


@query(f"""WITH {_PX}, a AS (SELECT image_id, pixel // 8 AS r, pixel % 8 AS col, abs(value) AS v0 FROM px),
w AS (SELECT *, lead(v0, 1) OVER w AS v1, lead(v0, 2) OVER w AS v2 FROM a WINDOW w AS (PARTITION BY image_id, col ORDER BY r)),
s AS (SELECT image_id, col, r, v0 + v1 * 2 + v2 AS total, r + (v1 + 2 * v2) / nullif(v0 + v1 + v2, 0) AS centre FROM w WHERE v2 IS NOT NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY image_id, col ORDER BY total DESC, r) AS n, max(total) OVER (PARTITION BY image_id) AS top FROM s)
SELECT image_id, col, round(centre, 6) AS row, round(total, 6) AS sum FROM b WHERE n = 1 AND total >= 0.01 * top AND total > 0""")
def laser_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir).select("image_id", F.floor(F.col("pixel") / 8).cast("int").alias("row"), (F.col("pixel") % 8).alias("col"), F.abs("value").alias("value"))
    return images.laser_line(p, k=3).select("image_id", "col", _r("row", "row"), _r("sum", "sum"))


def mosaics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an image of one channel, eight pixels wide."""
    e = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL")
    return e.select(F.col("vec_id").cast("string").alias("image_id"), F.floor(F.size("embedding") / 8).cast("int").alias("height"), F.lit(8).alias("width"), F.lit(1).alias("channels"), F.transform(F.col("embedding"), F.abs).alias("data"))


@query(f"""WITH {_PX}, a AS (SELECT image_id, pixel // 8 AS r, pixel % 8 AS c, abs(value)::DOUBLE AS v, CASE WHEN (pixel // 8) % 2 = 0 AND pixel % 2 = 0 THEN 0 WHEN (pixel // 8) % 2 = 1 AND pixel % 2 = 1 THEN 2 ELSE 1 END AS own FROM px),
n AS (SELECT a.image_id, a.r, a.c, a.own, b.own AS channel, a.v, sum(b.v * (2 - abs(a.r - b.r)) * (2 - abs(a.c - b.c))) / sum((2 - abs(a.r - b.r)) * (2 - abs(a.c - b.c))) AS mean,
  max(CASE WHEN b.r = a.r - 1 AND b.c = a.c THEN b.v END) AS up, max(CASE WHEN b.r = a.r + 1 AND b.c = a.c THEN b.v END) AS down, max(CASE WHEN b.r = a.r AND b.c = a.c - 1 THEN b.v END) AS "left", max(CASE WHEN b.r = a.r AND b.c = a.c + 1 THEN b.v END) AS "right"
  FROM a JOIN a b ON a.image_id = b.image_id AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY ALL)
SELECT image_id::VARCHAR AS image_id, (r * 8 + c)::INTEGER AS pixel, channel::INTEGER AS channel, round(CASE WHEN own = channel THEN v WHEN channel = 1 AND up + down + "left" + "right" IS NOT NULL THEN CASE WHEN abs("left" - "right") > abs(up - down) THEN (up + down) / 2 ELSE ("left" + "right") / 2 END ELSE mean END, 5) AS value FROM n""")
def debayer_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = images.exploded(images.mapped(mosaics(spark, sf_dir), images.debayer, images.IMAGE_DOUBLE))
    return out.select("image_id", "pixel", "channel", _r(F.col("value").cast("double"), "value", 5))


_KERNEL_SQL = """CASE m WHEN 'bilinear' THEN greatest(1 - abs(x), 0) WHEN 'bicubic' THEN CASE WHEN abs(x) < 1 THEN 1.5 * abs(x) ** 3 - 2.5 * x * x + 1 WHEN abs(x) < 2 THEN -0.5 * abs(x) ** 3 + 2.5 * x * x - 4 * abs(x) + 2 ELSE 0 END
ELSE CASE WHEN x = 0 THEN 1 WHEN abs(x) < 3 THEN 3 * sin(pi() * x) * sin(pi() * x / 3) / (pi() * x) ** 2 ELSE 0 END END"""


@query(f"""WITH {_PX}, k AS (SELECT * FROM (VALUES ('bilinear', 1), ('bicubic', 2), ('lanczos', 3)) AS t(m, reach)),
p AS (SELECT m, i, j, (j + 0.5::DOUBLE - (i + 0.5::DOUBLE) * 1.6) / 1.6 AS x FROM k, range(5) AS o(i), range(8) AS n(j) WHERE j >= floor(greatest((i + 0.5::DOUBLE) * 1.6 - reach * 1.6 + 0.5, 0)) AND j < floor((i + 0.5::DOUBLE) * 1.6 + reach * 1.6 + 0.5)),
w AS (SELECT m, i, j, w / sum(w) OVER (PARTITION BY m, i) AS w FROM (SELECT *, {_KERNEL_SQL} AS w FROM p) UNION ALL SELECT 'nearest_neighbour', i, floor((i + 0.5::DOUBLE) * 1.6)::BIGINT, 1 FROM range(5) AS o(i)),
a AS (SELECT image_id, pixel // 8 AS r, pixel % 8 AS c, abs(value)::DOUBLE AS v FROM px)
SELECT image_id::VARCHAR AS image_id, y.m AS method, (y.i * 5 + x.i)::INTEGER AS pixel, round(sum(v * y.w * x.w), 5) AS value FROM a JOIN w y ON a.r = y.j JOIN w x ON a.c = x.j AND x.m = y.m GROUP BY image_id, y.m, y.i, x.i""")
def rescale_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = []
    for m in ("nearest_neighbour", "bilinear", "bicubic", "lanczos"):
        small = images.exploded(images.mapped(mosaics(spark, sf_dir), lambda image, m=m: images.rescale(image, 1.0, 8.0, 8.0, 0.2, method=m), images.IMAGE_DOUBLE))
        made.append(small.select("image_id", F.lit(m).alias("method"), "pixel", _r(F.col("value").cast("double"), "value", 5)))
    return made[0].unionByName(made[1]).unionByName(made[2]).unionByName(made[3])


# -- frames, places, deviations: one expression a row


_I2B = {
    "x": "cos(y)*cos(p)*n + sin(y)*cos(p)*e - sin(p)*d",
    "y": "(cos(y)*sin(p)*sin(r) - sin(y)*cos(r))*n + (cos(y)*cos(r) + sin(r)*sin(p)*sin(y))*e + cos(p)*sin(r)*d",
    "z": "(sin(y)*sin(r) + cos(y)*cos(r)*sin(p))*n + (sin(p)*sin(y)*cos(r) - cos(y)*sin(r))*e + cos(p)*cos(r)*d",
}


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_orderkey": "dive", "l_linenumber": "seq"})


@query(f"""WITH {_LI}, a AS (SELECT dive, seq, radians(l_quantity) AS r, radians(l_discount * 100) AS p, radians(l_tax * 1000) AS y, 1.0 AS n, l_quantity / 10 AS e, l_tax AS d FROM li)
SELECT dive, seq, {", ".join(f"round({v}, 6) AS {k}" for k, v in _I2B.items())} FROM a""")
def inertial_to_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y, z = frames.inertial_to_body(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 1000, F.lit(1.0), F.col("l_quantity") / 10, F.col("l_tax"))
    return line_items(spark, sf_dir).select("dive", "seq", _r(x, "x"), _r(y, "y"), _r(z, "z"))


@query(f"""WITH {_LI}, a AS (SELECT dive, seq, l_extendedprice / 100 - 300 AS v, l_extendedprice / 1000 - 40 AS w FROM li)
SELECT dive, seq, round(CASE WHEN v < 0 THEN v + 360 WHEN v > 360 THEN v - 360 ELSE v END, 6) AS to_360, round(CASE WHEN v > 180 THEN v - 360 WHEN v < -180 THEN v + 360 ELSE v END, 6) AS to_180,
round(CASE WHEN w BETWEEN -pi() AND pi() THEN w ELSE (w + pi()) - 2 * pi() * floor((w + pi()) / (2 * pi())) - pi() END, 6) AS to_pi FROM a""")
def wrapped_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, w = F.col("l_extendedprice") / 100 - 300, F.col("l_extendedprice") / 1000 - 40
    return line_items(spark, sf_dir).select("dive", "seq", _r(frames.wrap_360(v), "to_360"), _r(frames.wrap_180(v), "to_180"), _r(frames.clamp_pi(w), "to_pi"))


@query(f"""WITH {_LI}, a AS (SELECT dive, seq, radians(l_quantity) AS r, radians(l_discount * 100) AS p, radians(l_tax * 1000) AS y FROM li)
SELECT dive, seq, round(10 + cos(y)*cos(p)*1.2 + (cos(y)*sin(p)*sin(r) - sin(y)*cos(r))*-0.4 + (sin(y)*sin(r) + cos(y)*cos(r)*sin(p))*0.5, 6) AS northings,
round(20 + sin(y)*cos(p)*1.2 + (cos(y)*cos(r) + sin(r)*sin(p)*sin(y))*-0.4 + (sin(p)*sin(y)*cos(r) - cos(y)*sin(r))*0.5, 6) AS eastings, round(30 - sin(p)*1.2 + cos(p)*sin(r)*-0.4 + cos(p)*cos(r)*0.5, 6) AS depth FROM a""")
def sensor_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, e, d = frames.offset_position(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 1000, F.lit(10.0), F.lit(20.0), F.lit(30.0), (0.1, 0.2, -0.3), (1.3, -0.2, 0.2))
    return line_items(spark, sf_dir).select("dive", "seq", _r(n, "northings"), _r(e, "eastings"), _r(d, "depth"))


@query(f"WITH {_LI} SELECT dive, seq, round(l_quantity * cos(l_tax) - l_discount * sin(l_tax), 6) AS north, round(l_quantity * sin(l_tax) + l_discount * cos(l_tax), 6) AS east FROM li")
def declination(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, e = frames.declined(F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"))
    return line_items(spark, sf_dir).select("dive", "seq", _r(n, "north"), _r(e, "east"))


@query(f"""WITH {_LI}, q AS (SELECT dive, seq, l_discount / n AS x, l_tax / n AS y, 0.3 / n AS z, 1.0 / n AS w FROM (SELECT *, sqrt(l_discount ** 2 + l_tax ** 2 + 0.09 + 1.0) AS n FROM li))
SELECT dive, seq, round(atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)), 6) AS roll, round(asin(2 * (w * y - z * x)), 6) + 0.0 AS pitch, round(atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)), 6) AS yaw FROM q""")
def quaternion_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.sqrt(F.col("l_discount") ** 2 + F.col("l_tax") ** 2 + 0.09 + 1.0)
    r, p, y = frames.euler_from_quaternion(F.col("l_discount") / n, F.col("l_tax") / n, F.lit(0.3) / n, F.lit(1.0) / n)
    return line_items(spark, sf_dir).select("dive", "seq", _r(r, "roll"), _r(p, "pitch"), _r(y, "yaw"))


@query(f"WITH {_LI} SELECT dive, seq, round(exp(-((l_quantity - 25) ** 2) / (1 + l_tax) ** 2 / 2) / sqrt(2 * pi() * (1 + l_tax) ** 2), 9) AS density FROM li")
def gaussian_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_items(spark, sf_dir).select("dive", "seq", _r(frames.gaussian_pdf(F.col("l_quantity"), 1 + F.col("l_tax"), F.lit(25.0)), "density", 9))


@query("""WITH c AS (SELECT c_custkey, abs(c_acctbal) AS far, fmod(abs(c_acctbal), 60) AS lat FROM customer)
SELECT c_custkey, round(far * 0.01 + 2, 6) AS northings_std, round(far * 0.01 + 2, 6) AS depth_std, round(far / 111111.0, 9) AS latitude_std, round(far / 111111.0 * cos(radians(lat)), 9) AS longitude_std FROM c""")
def sentence_stds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = geo.nmea_stds(F.abs("c_acctbal"), 2.0, 0.01, F.abs("c_acctbal") % 60)
    return table(spark, sf_dir, "customer").select("c_custkey", _r(s["northings_std"], "northings_std"), _r(s["depth_std"], "depth_std"), _r(s["latitude_std"], "latitude_std", 9), _r(s["longitude_std"], "longitude_std", 9))


@query("SELECT c_custkey, round(c_acctbal * 100 / (1030 * 9.80665), 6) AS depth FROM customer")
def pressure_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", _r(geo.depth_of_pressure(F.col("c_acctbal") * 100), "depth"))


@query("""WITH c AS (SELECT c_custkey, (c_custkey % 90)::INTEGER AS deg, (c_custkey % 60) + 0.25 AS m, CASE WHEN c_custkey % 2 = 0 THEN 'N' ELSE 'S' END AS h FROM customer)
SELECT c_custkey, round(CASE h WHEN 'S' THEN -1 ELSE 1 END * (deg + m / 60), 9) AS latitude FROM c""")
def sentence_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    said = F.format_string("%02d%02d.25%s", F.col("c_custkey") % 90, F.col("c_custkey") % 60, F.when(F.col("c_custkey") % 2 == 0, "N").otherwise("S"))
    return c.select("c_custkey", _r(geo.degrees_from_minutes(said), "latitude", 9))


# -- small aggregates and joins


@query(f"WITH {_PX} SELECT image_id, round(avg(value), 6) AS mean, round(max(value), 6) AS max FROM px GROUP BY image_id")
def image_brightness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.brightness(pixels(spark, sf_dir), ["image_id"]).select("image_id", _r("mean", "mean"), _r("max", "max"))


@query("SELECT l_suppkey, round(avg(l_quantity), 6) AS x, round(avg(l_discount), 6) AS y, round(avg(l_tax), 6) AS z, round(stddev_pop(l_discount), 6) AS std_y, round(stddev_pop(l_tax), 6) AS std_z FROM lineitem GROUP BY l_suppkey")
def cloud_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"), F.col("l_tax").alias("z"))
    return aggregates.cloud_stats(points, ["l_suppkey"]).select("l_suppkey", *[_r(c, c) for c in ("x", "y", "z", "std_y", "std_z")])


@query(f"""WITH {_EV}, m AS (SELECT dive, avg(value * 200) AS n, avg(t / 1000) AS e FROM ev GROUP BY dive) SELECT dive, round(n, 4) AS northings, round(e, 4) AS eastings, round(sqrt(n ** 2 + e ** 2), 4) AS distance, sqrt(n ** 2 + e ** 2) > 10000 AS far FROM m""")
def mean_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = stream(spark, sf_dir).select("dive", (F.col("value") * 200).alias("northings"), (F.col("t") / 1000).alias("eastings"))
    return aggregates.mean_position(fixes, ["dive"]).select("dive", _r("northings", "northings", 4), _r("eastings", "eastings", 4), _r("distance", "distance", 4), "far")


@query("SELECT l_returnflag, round(sqrt(avg(least(abs(l_discount - 0.05), abs(l_tax - 0.04)) ** 2)), 9) AS rms FROM lineitem GROUP BY l_returnflag")
def epipolar_rms(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_discount") - 0.05).alias("du"), (F.col("l_tax") - 0.04).alias("dv"))
    return aggregates.epipolar_rms(points, ["l_returnflag"], "du", "dv").select("l_returnflag", _r("rms", "rms", 9))


@query(f"WITH {_EV} SELECT l.seq, r.seq AS other FROM (SELECT * FROM ev WHERE kind = 'purchase') l JOIN (SELECT * FROM ev WHERE kind = 'error') r ON abs(l.t - r.t) <= 1800 AND abs(l.t - r.t) < 600")
def within_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = stream(spark, sf_dir, "error").select(F.col("t").alias("rt"), F.col("seq").alias("other"))
    return joins.within(stream(spark, sf_dir, "purchase").select("t", "seq"), right, "t", "rt", 1800, 600).select("seq", "other")


@query(f"WITH {_EV} SELECT dive, seq FROM ev WHERE t >= 86400 AND t <= 1864000 AND value < 60")
def acquisition_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.acquisition(stream(spark, sf_dir), "t", "value", 86400, 1864000, 60).select("dive", "seq")


@query(f"WITH {_EV}, p AS (SELECT dive, seq, CASE WHEN kind = 'click' THEN value END AS depth FROM ev) SELECT dive, seq, depth FROM p WHERE depth IS NOT NULL")
def placed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.placed(stream(spark, sf_dir).withColumn("depth", F.when(F.col("kind") == "click", F.col("value")))).select("dive", "seq", "depth")


@query(f"""WITH {_EV}, a AS (SELECT dive, seq, row_number() OVER (PARTITION BY dive ORDER BY seq) AS n FROM ev WHERE kind = 'view'), b AS (SELECT dive, value, row_number() OVER (PARTITION BY dive ORDER BY t) AS n FROM ev WHERE kind = 'click')
SELECT dive, seq, value FROM a JOIN b USING (dive, n)""")
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = joins.zip_rows(stream(spark, sf_dir, "view").select("dive", "seq"), stream(spark, sf_dir, "click").select("dive", "t", "value"), ["dive"], "seq", "t")
    return z.select("dive", "seq", "value")


@query(f"""WITH s AS (SELECT page_id, url, {_STEM.format('url')} AS stem FROM pages) SELECT a.stem, a.url AS "left", b.url AS "right" FROM s a JOIN s b USING (stem)""")
def stereo_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return joins.stereo_by_stem(p, p)


# -- geometry, folds


@query(f"WITH {_LI} SELECT dive, seq, round(abs(0.6 * l_quantity + 0.8 * l_tax - 2 * l_discount + 0.5) / sqrt(0.36 + 0.64 + 4), 6) AS distance FROM li")
def point_plane_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = geometry.point_plane(0.6, 0.8, -2.0, 0.5, "l_quantity", "l_tax", "l_discount")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dive"), F.col("l_linenumber").alias("seq"), _r(d, "distance"))


@query("""WITH RECURSIVE e0 AS (SELECT DISTINCT 'c' || o_custkey AS a, 's' || l_suppkey AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity >= 50),
e AS (SELECT a, b FROM e0 UNION SELECT b, a FROM e0), s AS (SELECT 's' || min(s_suppkey) AS node FROM supplier),
h(node, hops) AS (SELECT node, 0 FROM s UNION SELECT e.b, hops + 1 FROM h JOIN e ON h.node = e.a WHERE hops < 4)
SELECT node, min(hops)::INTEGER AS hops FROM h GROUP BY node""")
def graph_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "lineitem").filter("l_quantity >= 50")
    e = table(spark, sf_dir, "orders").join(big, F.col("o_orderkey") == F.col("l_orderkey")).select(F.concat(F.lit("c"), "o_custkey").alias("a"), F.concat(F.lit("s"), "l_suppkey").alias("b"))
    start = table(spark, sf_dir, "supplier").agg(F.concat(F.lit("s"), F.min("s_suppkey")).alias("node"))
    return graphs.hops(e, start, most=4).select("node", "hops")


@query(f"""WITH {_LI}, r AS (SELECT dive, seq, l_discount * 10 - 0.5 AS x, l_tax * 10 - 0.4 AS y, 1.0::DOUBLE AS z, 0.28 AS ax, 0.96 AS az, cos(1.2) ** 2 AS c2 FROM li),
q AS (SELECT *, ax * x + az * z AS dn, 0.3 * ax + 0.5 * az AS an, 0.3 * x - 0.1 * y + 0.5 * z AS da FROM r),
k AS (SELECT *, dn * dn - c2 * (x * x + y * y + z * z) AS a, -2 * (dn * an - c2 * da) AS b, an * an - c2 * (0.09 + 0.01 + 0.25) AS c FROM q),
t AS (SELECT *, (-b - sqrt(CASE WHEN b * b - 4 * a * c >= 0 THEN b * b - 4 * a * c END)) / (2 * a) AS t1, (-b + sqrt(CASE WHEN b * b - 4 * a * c >= 0 THEN b * b - 4 * a * c END)) / (2 * a) AS t2 FROM k)
SELECT dive, seq, round(least(CASE WHEN t1 > 0 AND t1 * dn - an >= 0 THEN t1 END, CASE WHEN t2 > 0 AND t2 * dn - an >= 0 THEN t2 END), 6) AS along FROM t""")
def rays_on_cone(spark: SparkSession, sf_dir: str) -> DataFrame:
    ray = (F.col("l_discount") * 10 - 0.5, F.col("l_tax") * 10 - 0.4, F.lit(1.0))
    return line_items(spark, sf_dir).select("dive", "seq", _r(geometry.on_cone(ray, (0.3, -0.1, 0.5), (0.28, 0.0, 0.96), 1.2), "along"))


@query()
def plane_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = stream(spark, sf_dir).select("dive", (F.col("t") / 1e6).alias("x"), (F.col("value") / 100).alias("y"), (F.col("t") / 2e6 + F.col("value") / 300).alias("z"))
    return geometry.fit_planes(points, ["dive"])


@query()
def geodesic(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") % 60).alias("lat"), (F.col("c_custkey") % 180).cast("double").alias("lon"))
    g = c.withColumn("g", geo.latlon_to_metres(F.col("lat"), F.col("lon"), 50.936501, -1.404266))
    n, e = geo.northings_eastings(F.col("g"))
    back = g.withColumn("n", n).withColumn("e", e).withColumn("p", geo.metres_to_latlon(50.936501, -1.404266, F.col("e"), F.col("n")))
    return back.select("c_custkey", "g.distance", "g.azimuth", "p.latitude", "p.longitude")


#: A made-up camera: fx, fy, cx, cy, k1, k2, p1, p2, k3.
_CAMERA = {"fx": 1400.0, "fy": 1390.0, "cx": 655.0, "cy": 500.0, "k1": -0.21, "k2": 0.12, "p1": 0.0012, "p2": -0.0007, "k3": -0.03}


def board_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """view, x, y, z, u, v: each supplier is a photograph of a board of 9 x 7 corners, at a pose that its columns tell; where
    s_acctbal is below zero the corners are up to 20 pixels off."""
    s = table(spark, sf_dir, "supplier")
    k, step = F.col("s_suppkey"), F.col("corner")
    board = s.withColumn("corner", F.explode(F.sequence(F.lit(0), F.lit(62)))).withColumn("x", (step % 9) * 0.04).withColumn("y", F.floor(step / 9) * 0.04)
    turned = frames.body_to_inertial(((k * 37) % 61 - 30).cast("double"), ((k * 53) % 71 - 35).cast("double"), (F.col("s_nationkey") * 14 - 168).cast("double"), F.col("x"), F.col("y"), F.lit(0.0))
    px, py, pz = turned[0] + ((k * 17) % 23 - 15) / 100, turned[1] + ((k * 29) % 19 - 12) / 100, turned[2] + 0.8 + (F.col("s_acctbal") + 1000) / 14000
    placed = board.select("s_suppkey", "s_acctbal", "corner", "x", "y", (px / pz).alias("a"), (py / pz).alias("b"))
    a, b = geometry.distorted(F.col("a"), F.col("b"), [_CAMERA[c] for c in ("k1", "k2", "p1", "p2", "k3")])
    off = lambda seed: F.when(F.col("s_acctbal") < 0, F.pmod(F.xxhash64("s_suppkey", "corner", F.lit(seed)), F.lit(41)) - 20.0).otherwise(0.0)
    return placed.select(F.col("s_suppkey").alias("view"), "x", "y", F.lit(0.0).alias("z"), (_CAMERA["fx"] * a + _CAMERA["cx"] + off(1)).alias("u"), (_CAMERA["fy"] * b + _CAMERA["cy"] + off(2)).alias("v"))


@query(f"""SELECT * FROM (VALUES {", ".join(f"('{k}', {v}::DOUBLE)" for k, v in _CAMERA.items())}) AS c(name, value) UNION ALL SELECT 'views', count(*)::DOUBLE FROM supplier WHERE s_acctbal >= 0""")
def camera_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = calibration.calibrated(board_corners(spark, sf_dir), (1280, 1024))
    rows = [(n, round(v, 4)) for n, v in zip(calibration.CAMERA, found.cameras[0], strict=True)]
    return spark.createDataFrame([*rows, ("views", float(found.views.count()))], "name string, value double")


@query()
def relative_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = measurements(spark, sf_dir)
    return folds.relative_ekf(m, ["dive"], m.filter(F.col("kind") == "query").select("dive", "t"), folds.EkfConfig(mahalanobis=100.0))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as measurements of dives, for the folds."""
    kind = F.when(F.col("kind") == "click", "orientation").when(F.col("kind") == "view", "velocity").when(F.col("kind") == "purchase", "depth").when(F.col("kind") == "signup", "usbl").otherwise("query")
    v = F.col("value")
    return stream(spark, sf_dir).select("dive", (F.col("t") / 1e5).alias("t"), kind.alias("kind"), (v / 100).alias("a"), (v / 200).alias("b"), (v / 300).alias("c"), F.lit(1.0).alias("a_std"), F.lit(1.0).alias("b_std"), F.lit(1.0).alias("c_std"))


@query()
def ekf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.ekf(measurements(spark, sf_dir), ["dive"], folds.EkfConfig(smooth=False, mahalanobis=100.0), covariance=False)


@query()
def rts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.ekf(measurements(spark, sf_dir), ["dive"], folds.EkfConfig(mahalanobis=100.0), covariance=False)


@query()
def ekf_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.accepted(folds.ekf_report(measurements(spark, sf_dir), ["dive"]), ["dive"])


@query()
def particle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.particle_filter(measurements(spark, sf_dir), ["dive"])


@query(f"""WITH RECURSIVE {_EV}, o AS (SELECT dive, seq, t, value / 100 AS lat, value / 200 AS lon, row_number() OVER (PARTITION BY dive ORDER BY t, seq) AS i FROM ev),
f AS (
  SELECT dive, seq, i, t, lat, lon, true AS keep FROM o WHERE i = 1
  UNION ALL
  SELECT dive, seq, i, CASE WHEN ok THEN nt ELSE t END, CASE WHEN ok THEN nlat ELSE lat END, CASE WHEN ok THEN nlon ELSE lon END, ok FROM (
    SELECT o.dive, o.seq, o.i, f.t, f.lat, f.lon, o.t AS nt, o.lat AS nlat, o.lon AS nlon, 111139 * sqrt((o.lat - f.lat) ** 2 + (o.lon - f.lon) ** 2) <= 20.0 * (o.t - f.t) AS ok
    FROM f JOIN o ON o.dive = f.dive AND o.i = f.i + 1))
SELECT f.dive, f.seq, o.t, o.lat, o.lon FROM f JOIN o ON f.dive = o.dive AND f.i = o.i WHERE keep""")
def speed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream(spark, sf_dir).select("dive", "seq", "t", (F.col("value") / 100).alias("lat"), (F.col("value") / 200).alias("lon"))
    return folds.speed_filtered(e, ["dive"], "t", "lat", "lon")
