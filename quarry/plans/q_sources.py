"""Registered queries: sources (S), streaming operators run on the batch
tables (X; the same functions serve streams), and progress thinning (W5)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import windows as wn
from ..sources import ingest as ig
from ..streaming import streams as st
from .registry import register, rounded, table

FMT = "yyyy-MM-dd HH:mm:ss"
FMT_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@register("s1_ingest_json", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def s1_ingest_json(spark, sf_dir):
    """The props JSON of every event ingested as a result table (union of
    keys, typed columns)."""
    e = table(spark, sf_dir, "events").select("event_id", "props")
    return ig.ingest_rows(e, "props", keep=["event_id"]).drop("_json")


# One text per event: scalars, arrays, odd key names, keys that differ by case
# or type, broken JSON.
_MIXED = """CASE event_id % 6 WHEN 0 THEN '5' WHEN 1 THEN '[1,2]' WHEN 2 THEN '{"bad'
  WHEN 3 THEN '{"n": ' || event_id || ', "a,b": "x", "Mix": 1, "nest": {"t": "' || event_type || '"}}'
  WHEN 4 THEN '{"N": ' || event_id || '.5, "mix": "t", "q: r": true, "nest": null}'
  ELSE '{"a,b": "' || event_type || '", "mix": [1]}' END"""


@register("s1_ingest_mixed", sql="""
SELECT event_id, CASE event_id % 6 WHEN 3 THEN '1' WHEN 4 THEN 't' WHEN 5 THEN '[1]' END AS "Mix",
  CASE event_id % 6 WHEN 3 THEN CAST(event_id AS DOUBLE) WHEN 4 THEN event_id + 0.5 END AS "N",
  CASE event_id % 6 WHEN 3 THEN 'x' WHEN 5 THEN event_type END AS "a,b",
  CASE event_id % 6 WHEN 3 THEN '{"t":"' || event_type || '"}' END AS nest,
  CASE event_id % 6 WHEN 4 THEN true END AS "q: r"
FROM events
""")
def s1_ingest_mixed(spark, sf_dir):
    """Rows of every shape become one table."""
    e = table(spark, sf_dir, "events").select("event_id", F.expr(_MIXED).alias("line"))
    return ig.ingest_rows(e, "line", keep=["event_id"]).drop("_json")


_BODY = """'{"event":"' || event_type || '}{x","fields":{"v":"' || event_id || '"}}' ||
  CASE event_id % 3 WHEN 0 THEN '{"event":"second"}' WHEN 1 THEN chr(10) || '{broken}' || chr(10) || '{"event":"third"}' ELSE ' ' END"""


@register("s8_split_envelopes", sql="""
SELECT event_id, 0 AS part, event_type || '}{x' AS event, CAST(event_id AS VARCHAR) AS v, false AS bad FROM events
UNION ALL SELECT event_id, 1, 'second', NULL, false FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 1, NULL, NULL, true FROM events WHERE event_id % 3 = 1
UNION ALL SELECT event_id, 2, 'third', NULL, false FROM events WHERE event_id % 3 = 1
""")
def s8_split_envelopes(spark, sf_dir):
    """Bodies of several envelopes, braces inside strings and broken pieces."""
    e = table(spark, sf_dir, "events").select("event_id", F.expr(_BODY).alias("value"))
    parts = ig.split_envelopes(e)
    p = F.from_json("value", ig.ENVELOPE_SCHEMA)
    bad = F.col("error").isNotNull()
    return parts.select("event_id", "part", F.when(~bad, p["event"]).alias("event"),
                        F.when(~bad, p["fields"]["v"]).alias("v"), bad.alias("bad"))


@register("o6_offset_to_end", sql="""
SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 700
""")
def o6_offset_to_end(spark, sf_dir):
    """Everything after the 700 dearest orders (by ordinal, no single task)."""
    from ..operators import summary as sm
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sm.head(o, 0, 700, [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_orderkey")


@register("s10_jsonl", sql="""
SELECT '{"type":"result","event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS value
FROM events
""")
def s10_jsonl(spark, sf_dir):
    """Events as tagged JSON lines."""
    return ig.to_jsonl(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), "result")


@register("a7_json_group_by", sql="""
SELECT json_extract_string(props, '$.k') AS k, count(DISTINCT event_type) AS kinds, count(*) AS n, max(value) AS top
FROM events GROUP BY 1 HAVING count(*) > 60
""")
def a7_json_group_by(spark, sf_dir):
    """Caller SQL that groups by a JSON path, with DISTINCT and HAVING."""
    from ..operators import filters as fl
    return fl.query_results(spark, table(spark, sf_dir, "events"), """
        SELECT get_json_object(props, '$.k') AS k, count(DISTINCT event_type) AS kinds, count(*) AS n, max(value) AS top
        FROM results GROUP BY 1 HAVING count(*) > 60""", limit=None)


def event_envelopes(spark, sf_dir):
    """Events re-encoded as delivery envelopes (one JSON document each)."""
    e = table(spark, sf_dir, "events")
    env = F.to_json(F.struct(
        F.col("event_type").alias("event"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("host"),
        F.create_map(F.lit("value"), F.col("value").cast("string")).alias("fields")))
    return e.select("event_id", env.alias("value"))


@register("s6_envelopes", sql="""
SELECT event_id, event_type AS event, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS _time,
       'user-' || CAST(user_id AS VARCHAR) AS host, 'api' AS source, 'events' AS sourcetype, 'main' AS "index",
       CAST(value AS VARCHAR) AS value
FROM events
""")
def s6_envelopes(spark, sf_dir):
    env = event_envelopes(spark, sf_dir)
    out = ig.read_envelopes(env, "value", defaults={"source": "api", "sourcetype": "events"})
    return out.select("event_id", "event", F.date_format("_time", FMT).alias("_time"), "host", "source",
                      "sourcetype", "index", F.col("fields")["value"].alias("value"))


@register("s7_raw_lines", sql=r"""
SELECT doc_id, count(*) AS lines FROM (
  SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM documents)
WHERE trim(line) <> '' GROUP BY doc_id
""")
def s7_raw_lines(spark, sf_dir):
    """Every document body as a raw payload: one event per non-blank line."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    ev = ig.read_raw(d, "text", defaults={"sourcetype": "documents"})
    return ev.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))


@register("x2_windowed_summary", sql=r"""
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, count(*) AS "rows", round(avg(value), 6) AS avg_value, round(max(value), 6) AS max_value,
       CAST(sum(CASE WHEN value >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS gte_50,
       CAST(sum(CASE WHEN value >= 200 THEN 1 ELSE 0 END) AS BIGINT) AS gte_200,
       CAST(sum(CASE WHEN value > 400 THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       round(CAST(sum(CASE WHEN value > 400 THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS error_rate
FROM events GROUP BY 1, 2, 3
""")
def x2_windowed_summary(spark, sf_dir):
    """The windowed stream summary evaluated on the events table (batch)."""
    e = table(spark, sf_dir, "events")
    out = st.stream_summary(e, "ts", "1 day", "1 hour", ["event_type"], metric="value", thresholds=(50, 200),
                            error_where="value > 400")
    out = out.withColumn("window_start", F.date_format("window_start", FMT)) \
             .withColumn("window_end", F.date_format("window_end", FMT))
    return rounded(out)


@register("x4_overdue_clients", sql="""
SELECT user_id, round(epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(max(ts)), 3) AS silent_seconds,
       epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(max(ts)) > 10800 AS overdue
FROM events GROUP BY user_id
""")
def x4_overdue_clients(spark, sf_dir):
    """Users as clients phoning home hourly; overdue after 3 missed hours."""
    e = table(spark, sf_dir, "events")
    out = st.overdue_clients(e, "user_id", "ts", 3600, 3, "2024-01-31 00:00:00")
    return rounded(out.select("user_id", "silent_seconds", "overdue"), 3)


@register("x6_activity_sessions", sql="""
WITH g AS (
  SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new_s
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       strftime(max(ts) + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS events
FROM s GROUP BY user_id, sid
""")
def x6_activity_sessions(spark, sf_dir):
    """Per user, sessions of activity with a 12 hour gap."""
    e = table(spark, sf_dir, "events")
    out = st.activity_sessions(e, "user_id", "ts", "12 hours")
    return out.select("user_id", F.date_format("session_start", FMT_US).alias("session_start"),
                      F.date_format("session_end", FMT_US).alias("session_end"), "events")


# A progress log per supplier: its lines in order are one event every 3 s; 60
# events are one search (fetching from the 20th, writing from the 45th).
_PROGRESS = """SELECT l_suppkey AS job, n, n * 3 AS sec,
  CASE WHEN n % 60 < 20 THEN 'search' WHEN n % 60 < 45 THEN 'fetch' ELSE 'write' END AS phase,
  CASE WHEN n % 180 = 70 THEN 'PAUSED' ELSE 'RUNNING' END AS state,
  least(n % 60 * 4, 100) AS percent, CASE WHEN n % 60 < 22 THEN 0 ELSE least((n % 60 - 22) * 50, 1000) END AS fetched,
  CASE WHEN n % 60 < 47 THEN 0 ELSE least((n % 60 - 47) * 100, 1000) END AS written, 1000 AS total
FROM (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1 AS n FROM lineitem)"""


@register("w5_thin_progress", sql=f"""
WITH RECURSIVE p AS MATERIALIZED ({_PROGRESS}),
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
""")
def w5_thin_progress(spark, sf_dir):
    """Kept events of a progress log made from the lines of each supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    w = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber")
    x = li.withColumn("n", F.row_number().over(w) - 1)
    k = F.col("n") % 60
    prog = x.select(
        F.col("l_suppkey").alias("job"), "n", F.timestamp_seconds(F.col("n") * 3).alias("ts"),
        F.when(k < 20, "search").when(k < 45, "fetch").otherwise("write").alias("phase"),
        F.when(F.col("n") % 180 == 70, "PAUSED").otherwise("RUNNING").alias("state"),
        F.least(k * 4, F.lit(100)).alias("percent"),
        F.when(k < 22, 0).otherwise(F.least((k - 22) * 50, F.lit(1000))).alias("fetched"),
        F.when(k < 47, 0).otherwise(F.least((k - 47) * 100, F.lit(1000))).alias("written"), F.lit(1000).alias("total"))
    return wn.thin_progress(prog).select("job", "n")


@register("s9_job_status", sql="""
WITH j AS (
  SELECT l_orderkey, count(*) AS n, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS done,
         sum(l_quantity) AS qty, max(l_linenumber) AS results
  FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey,
       CASE WHEN done = n THEN 'DONE' ELSE 'RUNNING' END AS state,
       round(least(greatest(CAST(done AS DOUBLE) / n, 0.0), 1.0), 6) AS done_progress,
       CAST(n AS BIGINT) AS scan_count, CAST(floor(qty) AS BIGINT) AS event_count, CAST(results AS BIGINT) AS result_count,
       done = n AS done
FROM j
""")
def s9_job_status(spark, sf_dir):
    """Each order becomes a search job whose status payload (the remote
    job-status JSON shape, with numbers partly sent as text) is built from
    its line items and parsed back leniently."""
    li = table(spark, sf_dir, "lineitem")
    j = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("done"),
        F.sum("l_quantity").alias("qty"), F.max("l_linenumber").alias("results"))
    content = F.struct(
        F.when(F.col("done") == F.col("n"), F.lit("done")).otherwise(F.lit("running")).alias("dispatchState"),
        (F.col("done") == F.col("n")).cast("string").alias("isDone"),
        (F.col("done") / F.col("n")).alias("doneProgress"),
        F.col("n").cast("string").alias("scanCount"), F.col("qty").alias("eventCount"),
        F.col("results").alias("resultCount"))
    payload = F.to_json(F.struct(F.array(F.struct(content.alias("content"))).alias("entry")))
    out = ig.parse_job_status(j.select("l_orderkey", payload.alias("value")))
    return rounded(out.select("l_orderkey", "state", "done_progress", "scan_count", "event_count", "result_count", "done"))


def order_manifest(spark, sf_dir):
    """A manifest of saved results derived from the data: every order is a
    saved result (rows = units ordered x 100, created at its order date);
    each line becomes a warning (code from the return flag, accepted once
    the line is finished)."""
    from ..sources import manifest as mf
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    code = (F.when(F.col("l_returnflag") == "R", F.lit("Returned-Line"))
            .when(F.col("l_returnflag") == "A", F.lit("accepted-line")).otherwise(F.lit("")))
    w = li.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(code.alias("code"),
                                F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("message"),
                                (F.col("l_linestatus") == "F").alias("accepted"),
                                F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("accepted_at"))).alias("warnings"),
        (F.sum("l_quantity") * 100).cast("long").alias("result_count"))
    m = o.join(w, o.o_orderkey == w.l_orderkey).select(
        F.concat(F.lit("result_"), F.col("o_orderkey").cast("string")).alias("table_name"),
        "result_count", F.col("result_count").alias("rows"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("created_at"),
        F.col("warnings").cast(mf.WARNING_TYPE).alias("warnings"))
    return m


_SQL_MANIFEST = """
m AS (
  SELECT 'result_' || CAST(o.o_orderkey AS VARCHAR) AS table_name, CAST(sum(l.l_quantity) * 100 AS BIGINT) AS result_count,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS created_at,
         count(*) FILTER (WHERE l.l_linestatus <> 'F') AS warning_count,
         count(*) FILTER (WHERE l.l_linestatus = 'F') AS accepted_warning_count,
         count(*) FILTER (WHERE l.l_returnflag = 'R') AS returned_codes
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderdate)"""


@register("m1_list_results", sql=f"""
WITH {_SQL_MANIFEST}
SELECT table_name, strftime(to_timestamp(created_at), '%Y-%m-%dT%H:%M:%SZ') AS created_at_utc,
       CAST(warning_count AS INTEGER) AS warning_count, CAST(accepted_warning_count AS INTEGER) AS accepted_warning_count,
       (SELECT count(*) FROM m) > 100 AS truncated
FROM m ORDER BY created_at DESC, table_name LIMIT 100
""")
def m1_list_results(spark, sf_dir):
    """The newest 100 saved results with warning counts (M1, M5 normalisation)."""
    from ..sources import manifest as mf
    out = mf.list_results(order_manifest(spark, sf_dir), limit=100)
    return out.select("table_name", "created_at_utc", "warning_count", "accepted_warning_count", "truncated")


@register("m4_m6_retention_and_broad_fetch", sql=f"""
WITH {_SQL_MANIFEST}
SELECT table_name, created_at < CAST(epoch(TIMESTAMP '2001-08-01') AS BIGINT) - 86400 AS expired,
       result_count > 10000 AS full_fetch
FROM m
""")
def m4_m6_retention_and_broad_fetch(spark, sf_dir):
    """Per saved result: expired at 2001-08-01 under the 24 hour retention
    (M4) and whether the broad-fetch warning applies (M6)."""
    from ..sources import manifest as mf
    m = order_manifest(spark, sf_dir)
    anchor = int(__import__("datetime").datetime(2001, 8, 1, tzinfo=__import__("datetime").timezone.utc).timestamp())
    expired = mf.expired_results(m, anchor).select("table_name", F.lit(True).alias("expired"))
    bf = mf.broad_fetch_warning(m).select(
        "table_name", F.exists("warnings", lambda x: x["code"] == mf.WARNING_FULL_FETCH).alias("full_fetch"))
    return (bf.join(expired, "table_name", "left")
            .select("table_name", F.coalesce("expired", F.lit(False)).alias("expired"), "full_fetch"))


@register("x3_unacked", sql="""
SELECT p.event_id FROM events p
WHERE p.event_type = 'purchase' AND NOT EXISTS (
  SELECT 1 FROM events v WHERE v.event_type = 'view' AND v.user_id = p.user_id
    AND v.ts >= p.ts AND v.ts <= p.ts + INTERVAL 1 HOUR)
""")
def x3_unacked(spark, sf_dir):
    """The bounded-wait acknowledgement join run on the batch tables: a
    purchase counts as acknowledged when the same user views within one
    hour; the rest are retry candidates.  The same function joins two
    streams with watermarks."""
    e = table(spark, sf_dir, "events")
    subs = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    acks = e.filter(F.col("event_type") == "view").select("user_id", "ts")
    return st.stream_unacked(subs, acks, ["user_id"], "ts", "ts", "1 hour").select("event_id")
