"""Registered queries on awkward shapes of the data: bursts at one instant,
rows without a time, very long and very short ranges, deep chains, and streams
compared with their batch answers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import evidence as ev
from ..operators import filters as fl
from ..operators import joins as jn
from ..operators import rollups as ru
from ..operators import windows as wn
from ..session import scratch_path
from ..sources import ingest as ig
from ..streaming import streams as st
from .registry import register, rounded, table

FMT_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# ------------------------------------------- bursts
# A third of the events at one instant, a third without a time.
_BURST = """SELECT event_id, user_id, event_type, value,
  CASE event_id % 3 WHEN 0 THEN TIMESTAMP '2024-01-10 12:00:00' WHEN 1 THEN NULL ELSE ts END AS ts FROM events"""


def _burst(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    third = F.col("event_id") % 3
    ts = F.when(third == 0, F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")).when(third == 2, F.col("ts"))
    return e.select("event_id", "user_id", "event_type", "value", ts.alias("ts"))


@register("w4_running_count_burst", sql=f"""
SELECT event_id, count(*) OVER (ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "count"
FROM ({_BURST})
""")
def w4_running_count_burst(spark, sf_dir):
    """One running count over everything: no key, one busy instant."""
    return wn.running_count(_burst(spark, sf_dir), "ts", [], ["event_id"]).select("event_id", "count")


@register("w7_concurrency_burst", sql=f"""
WITH inv AS (SELECT event_id, ts AS s, CASE WHEN value > 20 THEN ts + INTERVAL 1 HOUR END AS e FROM ({_BURST})),
ev AS (SELECT event_id, s AS t, 1 AS d, 1 AS is_start FROM inv WHERE s IS NOT NULL
  UNION ALL SELECT event_id, e, -1, 0 FROM inv WHERE e IS NOT NULL)
SELECT event_id, CAST(running AS BIGINT) AS concurrent FROM (
  SELECT event_id, is_start, sum(d) OVER (ORDER BY t, is_start, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM ev) WHERE is_start = 1
UNION ALL SELECT event_id, NULL FROM inv WHERE s IS NULL
""")
def w7_concurrency_burst(spark, sf_dir):
    inv = _burst(spark, sf_dir).select("event_id", F.col("ts").alias("s"),
                                       F.when(F.col("value") > 20, F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("e"))
    return wn.concurrency(inv, "s", "e", tiebreak=["event_id"]).select("event_id", "concurrent")


@register("w7_cadence_burst", sql=f"""
WITH g AS (SELECT event_type, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY event_type ORDER BY ts NULLS FIRST) AS gap FROM ({_BURST}))
SELECT event_type, count(*) AS invocations, round(min(gap), 3) AS min_gap, round(avg(gap), 3) AS avg_gap, round(max(gap), 3) AS max_gap
FROM g GROUP BY event_type
""")
def w7_cadence_burst(spark, sf_dir):
    return rounded(wn.cadence(_burst(spark, sf_dir), "event_type", "ts"), 3)


@register("w8_state_runs_burst", sql=f"""
WITH x AS (
  SELECT event_type, value > 30 AS high, row_number() OVER (PARTITION BY event_type ORDER BY ts NULLS FIRST, event_id)
    - row_number() OVER (PARTITION BY event_type, value > 30 ORDER BY ts NULLS FIRST, event_id) AS run FROM ({_BURST}))
SELECT event_type, high, length, count(*) AS runs FROM (
  SELECT event_type, high, run, count(*) AS length FROM x GROUP BY ALL) GROUP BY ALL
""")
def w8_state_runs_burst(spark, sf_dir):
    b = _burst(spark, sf_dir).withColumn("high", F.col("value") > 30)
    r = wn.state_runs(b, "event_type", "ts", "high", tiebreak=["event_id"])
    return r.groupBy("event_type", "high", "length").agg(F.count(F.lit(1)).alias("runs"))


@register("j16_as_of_burst", sql=f"""
WITH g AS ({_BURST}),
v AS (SELECT ts AS t, max(event_id) AS vid FROM g WHERE event_type = 'view' AND ts IS NOT NULL GROUP BY ALL),
p AS (SELECT event_id, ts AS t FROM g WHERE event_type <> 'view')
SELECT p.event_id, CAST(v.vid AS VARCHAR) AS obs_event_id FROM p ASOF LEFT JOIN v ON p.t >= v.t
""")
def j16_as_of_burst(spark, sf_dir):
    """Every event and the newest view so far, whoever saw it; at the busy
    instant the view with the greatest id counts."""
    g = _burst(spark, sf_dir).withColumn("all", F.lit("all"))
    out = jn.as_of(g.filter(F.col("event_type") != "view").select("event_id", "all", "ts"),
                   g.filter(F.col("event_type") == "view").select("all", "ts", F.col("event_id").alias("vid")),
                   "all", "ts", ["vid"])
    return out.select("event_id", F.col("obs_vid").cast("string").alias("obs_event_id"))


@register("w3_series_lag_all", sql="""
WITH b AS (SELECT date_trunc('hour', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1)
SELECT strftime(bucket, '%Y-%m-%d %H') AS bucket, round(v, 6) AS v, round(lag(v) OVER (ORDER BY bucket), 6) AS prev,
       round(v - lag(v) OVER (ORDER BY bucket), 6) AS delta
FROM b
""")
def w3_series_lag_all(spark, sf_dir):
    """One series without a key: the previous hour's value by a blocked lag."""
    out = wn.series_lag(table(spark, sf_dir, "events"), "ts", "value", (), "1 hour")
    return rounded(out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH")))


# ------------------------------------------------------------------ W5, X5
# A progress log from the orders: every third order belongs to job 0, the
# others to their customers' jobs; 60 events are one search.
_LOG = """SELECT job, n, n * 3 AS sec,
  CASE WHEN n % 60 < 20 THEN 'search' WHEN n % 60 < 45 THEN 'fetch' ELSE 'write' END AS phase,
  CASE WHEN n % 180 = 70 THEN 'PAUSED' ELSE 'RUNNING' END AS state,
  least(n % 60 * 4, 100) AS percent, CASE WHEN n % 60 < 22 THEN 0 ELSE least((n % 60 - 22) * 50, 1000) END AS fetched,
  CASE WHEN n % 60 < 47 THEN 0 ELSE least((n % 60 - 47) * 100, 1000) END AS written, 1000 AS total
FROM (SELECT job, row_number() OVER (PARTITION BY job ORDER BY o_orderkey) - 1 AS n
      FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS job FROM orders))"""
_THINNED = f"""
WITH RECURSIVE p AS MATERIALIZED ({_LOG}),
k AS (
  SELECT job, n, sec, phase, state, percent, fetched, written, true AS kept FROM p WHERE n = 0
  UNION ALL
  SELECT job, n, CASE WHEN keep THEN sec ELSE l_sec END, CASE WHEN keep THEN phase ELSE l_phase END,
    CASE WHEN keep THEN state ELSE l_state END, CASE WHEN keep THEN percent ELSE l_percent END,
    CASE WHEN keep THEN fetched ELSE l_fetched END, CASE WHEN keep THEN written ELSE l_written END, keep
  FROM (
    SELECT p.*, k.sec AS l_sec, k.phase AS l_phase, k.state AS l_state, k.percent AS l_percent, k.fetched AS l_fetched,
      k.written AS l_written,
      p.phase <> k.phase OR p.state <> k.state OR p.percent >= 100 AND k.percent < 100 OR p.percent - k.percent >= 10
      OR p.phase = 'fetch' AND p.total > 0 AND p.fetched <> k.fetched AND (p.fetched = 0 OR p.fetched >= p.total)
      OR p.phase = 'write' AND p.total > 0 AND p.written <> k.written AND (p.written = 0 OR p.written >= p.total)
      OR p.sec - k.sec >= 10 AS keep
    FROM k JOIN p ON p.job = k.job AND p.n = k.n + 1))
SELECT job, n FROM k WHERE kept
"""


def _log(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(
        F.col("o_custkey")).cast("long").alias("job"))
    x = wn.running_count(o, "o_orderkey", ["job"], out="n").withColumn("n", F.col("n") - 1)
    k = F.col("n") % 60
    return x.select(
        "job", "n", F.timestamp_seconds(F.col("n") * 3).alias("ts"),
        F.when(k < 20, "search").when(k < 45, "fetch").otherwise("write").alias("phase"),
        F.when(F.col("n") % 180 == 70, "PAUSED").otherwise("RUNNING").alias("state"),
        F.least(k * 4, F.lit(100)).alias("percent"),
        F.when(k < 22, 0).otherwise(F.least((k - 22) * 50, F.lit(1000))).alias("fetched"),
        F.when(k < 47, 0).otherwise(F.least((k - 47) * 100, F.lit(1000))).alias("written"), F.lit(1000).alias("total"))


@register("w5_thin_hot_job", sql=_THINNED)
def w5_thin_hot_job(spark, sf_dir):
    """One job holds a third of the log; its segments are thinned apart."""
    return wn.thin_progress(_log(spark, sf_dir)).select("job", "n")


@register("x5_thin_stream", sql=_THINNED)
def x5_thin_stream(spark, sf_dir):
    """The same log as a stream of files, the last kept event in state."""
    src = scratch_path(spark, "progress-log")
    _log(spark, sf_dir).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    return st.drain(st.stream_thin_progress(stream), "thinned").select("job", "n")


# ------------------------------------------------------------- X1, X4, X7
@register("x1_envelope_stream", sql="""
SELECT event_id, event_type AS event, 'web' AS host, CAST(user_id AS VARCHAR) AS user_field, 'main' AS "index"
FROM events WHERE event_id % 10 <> 0
""")
def x1_envelope_stream(spark, sf_dir):
    """Envelope files as a stream of events; every tenth has no event and is
    dropped."""
    e = table(spark, sf_dir, "events")
    body = F.to_json(F.struct(
        F.when(F.col("event_id") % 10 != 0, F.col("event_type")).alias("event"), F.lit("web").alias("host"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        F.struct(F.col("user_id").cast("string").alias("user"), F.col("event_id").cast("string").alias("id")).alias("fields")))
    src = scratch_path(spark, "envelopes")
    e.select(body.alias("value")).write.text(src)
    out = st.drain(st.stream_envelopes(spark, src), "envelope-events")
    return out.select(F.col("fields")["id"].cast("long").alias("event_id"), "event", "host",
                      F.col("fields")["user"].alias("user_field"), "index")


def _deadline_sql(hours: int, extra: str) -> str:
    return f"""
WITH e AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events),
w AS (SELECT max(ts) - INTERVAL 1 HOUR AS until FROM events)
SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS last_seen{extra}
FROM e, w WHERE next > ts + INTERVAL {hours} HOUR OR next IS NULL AND ts + INTERVAL {hours} HOUR < until
"""


@register("x4_overdue_stream", sql=_deadline_sql(48, ""))
def x4_overdue_stream(spark, sf_dir):
    """Users as clients phoning home daily: every silence of more than two
    days, from event-time timers on a stream of the events table."""
    s = st.table_stream(spark, sf_dir, "events")
    out = st.drain(st.stream_overdue_clients(s, "user_id", "ts", 86400, 2, "1 hour"), "overdue")
    return out.select("user_id", F.date_format("last_seen", FMT_US).alias("last_seen"))


@register("x4_overdue_events", sql=_deadline_sql(48, ""))
def x4_overdue_events(spark, sf_dir):
    """The batch answer of x4_overdue_stream."""
    e = table(spark, sf_dir, "events")
    until = e.agg(F.max(F.col("ts").cast("timestamp")) - F.expr("INTERVAL 1 HOUR")).first()[0]
    out = st.overdue_events(e, "user_id", "ts", 86400, 2, F.lit(until))
    return out.select("user_id", F.date_format("last_seen", FMT_US).alias("last_seen"))


@register("x7_expirations_stream", sql=_deadline_sql(24, ", strftime(ts + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS expired_at"))
def x7_expirations_stream(spark, sf_dir):
    """Users' results live for a day after they were last written; their
    state goes when they expire."""
    s = st.table_stream(spark, sf_dir, "events")
    out = st.drain(st.stream_expirations(s, "user_id", "ts", "24 hours", "1 hour"), "expired")
    return out.select("user_id", F.date_format("last_seen", FMT_US).alias("last_seen"),
                      F.date_format("expired_at", FMT_US).alias("expired_at"))


# ----------------------------------------------------------------- A10
@register("a10_rollup_holes", sql="""
SELECT event_type, count(*) AS n, round(sum(value), 4) AS sum_value, round(min(value), 6) AS min_value,
       round(max(value), 6) AS max_value
FROM events GROUP BY event_type
""")
def a10_rollup_holes(spark, sf_dir):
    """The summaries cover January but for three holes, one of them cut
    inside an hour; overlapping and touching intervals; the holes are
    answered from the raw rows."""
    e = table(spark, sf_dir, "events")
    ranges = [("2024-01-01 00:00:00", "2024-01-05 00:00:00"), ("2024-01-04 12:00:00", "2024-01-08 07:30:00"),
              ("2024-01-09 00:00:00", "2024-01-12 00:00:00"), ("2024-01-12 00:00:00", "2024-01-15 03:00:00"),
              ("2024-01-15 09:00:00", "2024-01-31 23:00:00")]
    coverage = spark.createDataFrame(ranges, "start string, end string").select(
        F.col("start").cast("timestamp").alias("start"), F.col("end").cast("timestamp").alias("end"))
    at = F.col("ts").cast("timestamp")
    inside = F.lit(False)
    for a, b in ranges:
        inside = inside | ((at >= F.lit(a).cast("timestamp")) & (at < F.lit(b).cast("timestamp")))
    # the summary job also saw the first half of the cut hour: that bucket is partial and must not be used
    roll = ru.build_rollup(e.filter(inside), "ts", ["event_type"], ["value"])
    out = ru.query_rollup(roll, e, "ts", ["event_type"], ["value"], coverage=coverage, summaries_only=False)
    return out.select("event_type", "n", F.round("sum_value", 4).alias("sum_value"),
                      F.round("min_value", 6).alias("min_value"), F.round("max_value", 6).alias("max_value"))


# ------------------------------------------------------- J4, J8, J12, J18
@register("j4_range_join_blocks", sql="""
WITH bands AS (SELECT p_size AS band, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY p_size
  UNION ALL SELECT -1, -1e9, 1e9 UNION ALL SELECT -2, 1000.0, 1000.0)
SELECT b.band, count(*) AS lines
FROM (SELECT CASE WHEN l_linenumber = 1 THEN 1000.0 ELSE l_extendedprice / l_quantity END AS unit FROM lineitem) l
JOIN bands b ON l.unit BETWEEN b.lo AND b.hi GROUP BY b.band
""")
def j4_range_join_blocks(spark, sf_dir):
    """Price bands over equi-depth blocks: first lines all cost 1000, one
    band holds everything and one a single price."""
    bands = (table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("band"))
             .agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
             .unionByName(spark.createDataFrame([(-1, -1e9, 1e9), (-2, 1000.0, 1000.0)], "band int, lo double, hi double")))
    unit = F.when(F.col("l_linenumber") == 1, F.lit(1000.0)).otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", unit.alias("unit"))
    return jn.range_join(li, "unit", bands, "lo", "hi").groupBy("band").agg(F.count(F.lit(1)).alias("lines"))


@register("j8_role_chains", sql="""
WITH RECURSIVE up(role, ancestor) AS (
  SELECT s_suppkey, s_suppkey FROM supplier
  UNION
  SELECT u.role, u.ancestor - 1 FROM up u WHERE u.ancestor % 50 <> 0)
SELECT role, count(*) AS ancestors, min(ancestor) AS top FROM up GROUP BY role
""")
def j8_role_chains(spark, sf_dir):
    """Suppliers as roles in chains of 50, closed by path doubling."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("role"), F.when(
        F.col("s_suppkey") % 50 != 0, F.col("s_suppkey") - 1).alias("inherits"))
    return (jn.role_closure(s).groupBy("role")
            .agg(F.count(F.lit(1)).alias("ancestors"), F.min("ancestor").alias("top")))


@register("j12_burst_conflicts", sql="""
WITH changes AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1996-06-01' ELSE o_orderdate END AS "start",
         CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1996-06-01 01:00:00' ELSE o_orderdate + INTERVAL 2 DAY END AS "end" FROM orders),
windows AS (
  SELECT DISTINCT date_trunc('month', o_orderdate) + INTERVAL 14 DAY AS "start",
                  date_trunc('month', o_orderdate) + INTERVAL 16 DAY AS "end" FROM orders
  UNION ALL SELECT TIMESTAMP '1990-01-01', TIMESTAMP '2000-01-01'
  UNION ALL SELECT TIMESTAMP '1996-06-01 00:30:00', TIMESTAMP '1996-06-01 00:45:00')
SELECT strftime(w."start", '%Y-%m-%d %H:%M') AS b_start, count(*) AS conflicts, min(c.id) AS first_change
FROM changes c JOIN windows w ON c."start" < w."end" AND w."start" < c."end" GROUP BY 1
""")
def j12_burst_conflicts(spark, sf_dir):
    """A third of the changes start at one instant; one freeze lasts ten
    years, one a quarter of an hour."""
    o = table(spark, sf_dir, "orders")
    third = F.col("o_orderkey") % 3 == 0
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    changes = o.select(F.col("o_orderkey").alias("id"),
                       F.when(third, at("1996-06-01 00:00:00")).otherwise(F.col("o_orderdate")).alias("start"),
                       F.when(third, at("1996-06-01 01:00:00")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 2 DAY")).alias("end"))
    m = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    windows = o.select((m + F.expr("INTERVAL 14 DAY")).alias("start"), (m + F.expr("INTERVAL 16 DAY")).alias("end")).distinct()
    extra = spark.createDataFrame([("1990-01-01 00:00:00", "2000-01-01 00:00:00"),
                                   ("1996-06-01 00:30:00", "1996-06-01 00:45:00")], "start string, end string")
    windows = windows.unionByName(extra.select(F.col("start").cast("timestamp_ntz").alias("start"),
                                               F.col("end").cast("timestamp_ntz").alias("end")))
    j = jn.interval_conflicts(changes, windows)
    return j.groupBy(F.date_format("b_start", "yyyy-MM-dd HH:mm").alias("b_start")).agg(
        F.count(F.lit(1)).alias("conflicts"), F.min("a_id").alias("first_change"))


# Networks of every length from /0 to /32 that hold some of the customers' addresses.
_NETS = """
t AS (SELECT c_custkey, '10.' || CAST(c_nationkey AS VARCHAR) || '.' || CAST((c_custkey // 256) % 256 AS VARCHAR)
        || '.' || CAST(c_custkey % 256 AS VARCHAR) AS ip,
        10 * 16777216 + c_nationkey * 65536 + ((c_custkey // 256) % 256) * 256 + c_custkey % 256 AS n FROM customer),
c AS (SELECT DISTINCT bits, (n >> (32 - bits)) << (32 - bits) AS lo FROM t, range(33) r(bits) WHERE t.c_custkey % 33 = bits)"""


def _traffic(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    ip = F.concat_ws(".", F.lit("10"), F.col("c_nationkey").cast("string"),
                     F.pmod(F.floor(F.col("c_custkey") / 256), F.lit(256)).cast("string"),
                     F.pmod(F.col("c_custkey"), F.lit(256)).cast("string"))
    return c.select("c_custkey", ip.alias("ip"))


def _networks(spark, sf_dir):
    t = _traffic(spark, sf_dir)
    return t.select(F.concat("ip", F.lit("/"), (F.col("c_custkey") % 33).cast("string")).alias("cidr"))


@register("j18_prefix_join", sql=f"""
WITH {_NETS}
SELECT t.c_custkey, count(*) AS networks, CAST(sum(c.bits) AS BIGINT) AS bits, CAST(max(c.bits) AS INTEGER) AS longest
FROM t JOIN c ON (t.n >> (32 - c.bits)) << (32 - c.bits) = c.lo GROUP BY t.c_custkey
""")
def j18_prefix_join(spark, sf_dir):
    """Prefix lengths 0 to 32: an address has one key per length."""
    bits = F.split("cidr", "/")[1].cast("int")
    nets = _networks(spark, sf_dir).withColumn("bits", bits).withColumn("r", jn.cidr_bounds(F.col("cidr")))
    nets = nets.groupBy("bits", F.col("r.lo").alias("lo")).agg(F.min("cidr").alias("cidr")).select("cidr")
    m = jn.cidr_match(_traffic(spark, sf_dir), "ip", nets)
    return m.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("networks"), F.sum(bits).alias("bits"), F.max(bits).alias("longest"))


@register("j18_longest_prefix", sql=f"""
WITH {_NETS}
SELECT t.c_custkey, CAST(max(c.bits) AS INTEGER) AS bits FROM t JOIN c ON (t.n >> (32 - c.bits)) << (32 - c.bits) = c.lo GROUP BY t.c_custkey
""")
def j18_longest_prefix(spark, sf_dir):
    out = jn.longest_prefix(_traffic(spark, sf_dir), "ip", _networks(spark, sf_dir))
    return out.select("c_custkey", F.split("network", "/")[1].cast("int").alias("bits"))


# ------------------------------------------------------------- S3, S4, S5
@register("s4_page_index", sql="""
SELECT page, o_orderkey FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS n, (SELECT count(*) FROM orders) AS total FROM orders),
  (SELECT 'first' AS page, 0 AS lo, 25 AS hi UNION ALL SELECT 'second', 25, 50 UNION ALL SELECT 'deep', 1000, 1100
   UNION ALL SELECT 'end', 1490, 100000000)
WHERE n >= lo AND n < hi
""")
def s4_page_index(spark, sf_dir):
    """Four pages of one order, each read from the parts it lies in."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    index = fl.build_page_index(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], scratch_path(spark, "orders-pages"))
    out = None
    for name, limit, offset in (("first", 25, 0), ("second", 25, 25), ("deep", 100, 1000), ("end", 0, 1490)):
        page = index.page(limit, offset).select(F.lit(name).alias("page"), "o_orderkey")
        out = page if out is None else out.unionByName(page)
    return out


@register("s3_stringify_nested", sql="""
SELECT event_id, '{"k":' || json_extract(props, '$.k') || ',"user":' || user_id || '}' AS doc,
       '["' || event_type || '","x"]' AS tags, value
FROM events
""")
def s3_stringify_nested(spark, sf_dir):
    """Struct and array columns become JSON text, numbers stay."""
    e = table(spark, sf_dir, "events")
    nested = e.select("event_id", F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"),
                                           F.col("user_id").alias("user")).alias("doc"),
                      F.array("event_type", F.lit("x")).alias("tags"), "value")
    return ig.stringify_nested(nested)


@register("s5_saved_result", sql="""
SELECT 'latest' AS table_name, o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus
""")
def s5_saved_result(spark, sf_dir):
    """A result saved twice under one name: the second write replaces the
    first, rows and manifest alike."""
    from ..sources import manifest as mf
    root = scratch_path(spark, "saved")
    o = table(spark, sf_dir, "orders")
    ig.save_result(o.limit(3), root, "latest", f"{root}-manifest")
    ig.save_result(o, root, "latest", f"{root}-manifest")
    names = mf.list_results(spark.read.parquet(f"{root}-manifest"), limit=10).select("table_name")
    saved = spark.read.parquet(f"{root}/latest").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return names.crossJoin(F.broadcast(saved))


# ------------------------------------------------------- J7, J10, J11, G6-G8
_ACL = """SELECT l_orderkey AS object_id, CASE WHEN l_linenumber = 7 THEN '*' ELSE 'role' || CAST(l_suppkey % 5 AS VARCHAR) END AS role,
  true AS can_read, l_returnflag = 'R' AS can_write FROM lineitem"""


def _acl(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    role = F.when(F.col("l_linenumber") == 7, "*").otherwise(F.concat(F.lit("role"), (F.col("l_suppkey") % 5).cast("string")))
    return li.select(F.col("l_orderkey").alias("object_id"), role.alias("role"), F.lit(True).alias("can_read"),
                     (F.col("l_returnflag") == "R").alias("can_write"))


@register("j7_acl_exposure", sql=f"""
WITH acl AS ({_ACL}),
per AS (SELECT object_id, count(DISTINCT role) FILTER (WHERE can_write) AS n_write, count(DISTINCT role) AS n_read,
        bool_or(can_write AND role IN ('*', 'user')) AS broad FROM acl GROUP BY 1)
SELECT o.o_orderkey AS object_id, n_write AS n_write_roles, n_read AS n_read_roles,
  CASE WHEN o.o_orderstatus = 'P' OR p.object_id IS NULL THEN 'unknown' WHEN broad THEN 'broad_write'
       WHEN n_write > 0 THEN 'restricted_write' ELSE 'read_only' END AS exposure
FROM orders o LEFT JOIN per p ON p.object_id = o.o_orderkey
""")
def j7_acl_exposure(spark, sf_dir):
    """Orders as objects, their lines as ACL rows; sharing of pending orders
    is not known."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("object_id"), F.when(
        F.col("o_orderstatus") != "P", F.lit("app")).alias("sharing"))
    out = jn.acl_exposure(o, _acl(spark, sf_dir))
    return out.select("object_id", "n_write_roles", "n_read_roles", "exposure")


@register("j7_acl_roles", sql=f"SELECT object_id, role, bool_or(can_read) AS can_read, bool_or(can_write) AS can_write FROM ({_ACL}) GROUP BY 1, 2")
def j7_acl_roles(spark, sf_dir):
    """Long form: one row per object and role."""
    return jn.acl_roles(_acl(spark, sf_dir))


@register("j10_compatibility", sql="""
SELECT p.p_partkey AS id, CASE WHEN p.p_size % 4 = 0 THEN 'Compatible' WHEN p.p_size % 4 = 1 THEN 'Update available'
  WHEN p.p_size % 4 = 2 THEN 'Incompatible' ELSE 'Needs review' END AS label
FROM part p
""")
def j10_compatibility(spark, sf_dir):
    """Parts as installed apps (component = brand, version = size); the
    matrix knows three of four versions for the target."""
    p = table(spark, sf_dir, "part")
    installed = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("component"),
                         F.col("p_size").cast("string").alias("version"))
    turn = F.col("p_size") % 4
    matrix = (p.select("p_brand", "p_size").distinct().where(turn < 3)
              .select(F.col("p_brand").alias("component"), F.col("p_size").cast("string").alias("version"),
                      F.explode(F.array(F.lit("10.0"), F.lit("9.4"))).alias("target"),
                      F.when(turn == 0, "compatible").when(turn == 1, "update_required").otherwise("incompatible").alias("verdict"),
                      F.lit(True).alias("applicable"), F.lit(False).alias("stale"),
                      F.when(turn == 1, F.lit("11")).alias("alternative_version"), F.lit(None).cast("string").alias("migration_path")))
    out = jn.join_compatibility(installed, matrix, "10.0")
    return out.select("id", F.col("compatibility").alias("label"))


@register("j11_findings", sql="""
SELECT l.l_orderkey AS finding, l.l_linenumber AS line,
  CASE WHEN s.s_acctbal IS NULL THEN 'Unknown'
       WHEN EXISTS (SELECT 1 FROM lineitem r WHERE r.l_orderkey = l.l_orderkey AND r.l_suppkey = l.l_suppkey
                    AND r.l_linenumber = l.l_linenumber AND r.l_linestatus = 'F' AND r.l_returnflag = 'A') THEN 'Remediated'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'Excepted'
       WHEN s.s_acctbal > 0 THEN 'Exposed' ELSE 'Not exposed' END AS exposure_status
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_nationkey <> 3
""")
def j11_findings(spark, sf_dir):
    """Lines as findings at (component, path, asset), suppliers as inventory
    (one nation's is missing), finished accepted lines as remediation, urgent
    orders as accepted exceptions."""
    li, o, s = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "supplier"))
    findings = li.select(F.col("l_orderkey").alias("finding"), F.col("l_suppkey").alias("component"),
                         F.col("l_linenumber").alias("path"), F.lit("a").alias("asset"))
    paths = spark.range(1, 8).select(F.col("id").cast("int").alias("path"))
    known = s.where("s_nationkey <> 3").select(F.col("s_suppkey").alias("component"), (F.col("s_acctbal") > 0).alias("affected"))
    inventory = known.withColumn("path", F.explode(F.sequence(F.lit(1), F.lit(7)))).withColumn("asset", F.lit("a"))
    inventory = inventory.withColumn("matched", F.lit(True)).join(paths, "path")
    done = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")
    remediation = li.where(done).select(F.col("l_orderkey").alias("finding"), F.col("l_suppkey").alias("component"),
                                        F.col("l_linenumber").alias("path"), F.lit("a").alias("asset"),
                                        F.lit(True).alias("remediation_verified"),
                                        F.lit(True).alias("previously_affected")).distinct()
    exceptions = o.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("finding"), F.lit("accepted").alias("status"), F.lit(True).alias("exception_in_scope"),
        F.lit("2999-01-01").alias("exception_expiry"))
    out = jn.join_findings(findings, inventory, remediation, exceptions)
    out = out.withColumn("exposure_status", F.when(F.col("matched").isNull(), "Unknown").otherwise(F.col("exposure_status")))
    return out.select("finding", F.col("path").alias("line"), "exposure_status")


def _facts(spark, sf_dir):
    """A ledger of the suppliers: balance (observed), nation (documented) and
    a guess, each unknown for some."""
    s = table(spark, sf_dir, "supplier")
    wide = s.select("s_suppkey", F.when(F.col("s_acctbal") > 0, F.col("s_acctbal").cast("string")).alias("balance"),
                    F.when(F.col("s_nationkey") % 5 != 0, F.col("s_nationkey").cast("string")).alias("nation"),
                    F.lit("yes").alias("guess"))
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.lit(k).alias("source"))
                       for f, k in (("balance", "scan"), ("nation", "Documentation"), ("guess", "rumour"))])
    return wide.select(F.col("s_suppkey").cast("string").alias("object_id"), F.explode(fields).alias("x")).select("object_id", "x.*")


_FACTS = """
facts AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS object_id, 'balance' AS field, CASE WHEN s_acctbal > 0 THEN 'x' END AS value, 'observed' AS label FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'nation', CASE WHEN s_nationkey % 5 <> 0 THEN 'x' END, 'documented' FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'guess', 'yes', 'inferred' FROM supplier)"""


@register("g6_evidence_labels", sql=f"""
WITH {_FACTS}
SELECT object_id, field, CASE WHEN value IS NULL THEN 'missing' ELSE label END AS evidence_label FROM facts
""")
def g6_evidence_labels(spark, sf_dir):
    return ev.label_evidence(_facts(spark, sf_dir)).select("object_id", "field", "evidence_label")


@register("g7_report_rows", sql=f"""
WITH {_FACTS},
per AS (SELECT object_id, count(value) AS n_facts, count(*) FILTER (WHERE value IS NULL) AS n_unknown,
        min(field) FILTER (WHERE value IS NULL) AS first_unknown FROM facts GROUP BY 1)
SELECT object_id, n_facts, n_unknown, CASE WHEN n_unknown > 0 THEN 'collect ' || first_unknown
  WHEN CAST(object_id AS BIGINT) % 2 = 0 THEN 'retire' ELSE 'keep' END AS next_step FROM per
""")
def g7_report_rows(spark, sf_dir):
    """Report rows of the suppliers: the next step is to collect what is
    unknown, else what the decision says."""
    led = _facts(spark, sf_dir)
    missing = ev.missing_evidence(led.where("value IS NOT NULL"), {"retirement": ["balance", "nation"]}, objects=led.select("object_id").distinct())
    decisions = led.select("object_id").distinct().withColumn("next_step", F.when(
        F.col("object_id").cast("long") % 2 == 0, "retire").otherwise("keep"))
    out = ev.report_rows(led, decisions, missing)
    return out.select("object_id", "n_facts", F.size("unknowns").cast("long").alias("n_unknown"), "next_step")


@register("g8_health_lanes", sql="""
SELECT event_type, count(*) AS checks, lane FROM (
  SELECT event_type, CASE event_type WHEN 'view' THEN 'search' WHEN 'click' THEN 'disk' WHEN 'error' THEN 'queues'
    WHEN 'purchase' THEN 'license' ELSE 'unmapped' END AS lane FROM events) GROUP BY ALL
""")
def g8_health_lanes(spark, sf_dir):
    """Event types named after checks, by the caller's own patterns."""
    patterns = (("(?i)^view", "search"), ("(?i)click", "disk"), ("error$", "queues"), ("PURCHASE|purchase", "license"))
    out = ev.health_lanes(table(spark, sf_dir, "events").select("event_type"), "event_type", patterns=patterns)
    return out.groupBy("event_type", "lane").agg(F.count(F.lit(1)).alias("checks"))


@register("f_misc", sql="""
SELECT event_id, round(CASE WHEN value = 0 THEN 0 ELSE round(value * p) / p END, 9) AS sig,
       value AS exact, true AS random_ok, true AS now_ok
FROM (SELECT *, pow(10.0, 2 - floor(log10(abs(value)))) AS p FROM events)
""")
def f_misc(spark, sf_dir):
    """sigfig, exact, seeded random and now."""
    from ..functions import evalfns as fn
    r, again = fn.random(7), fn.random(7)
    e = table(spark, sf_dir, "events").select(
        "event_id", F.round(fn.sigfig("value", 3), 9).alias("sig"), fn.exact("value").alias("exact"),
        ((r >= 0) & (r < 1) & (r == again)).alias("random_ok"),
        (F.abs(fn.now() - F.unix_timestamp(F.current_timestamp())) <= 1).alias("now_ok"))
    return e
