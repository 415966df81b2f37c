"""Registered queries: summaries, event selection, bounded SQL, slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import filters as fl
from ..operators import summary as sm
from ..session import spread
from .registry import register, rounded, table

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"      # Spark pattern
TS_FMT_SQL = "%Y-%m-%d %H:%M:%S.%f"        # the same in strftime


def event_results(spark, sf_dir):
    """The events table seen as a saved result table: ``_row``, ``_time``
    (text, as received) and the reference's well-known column names."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("_row"),
        F.date_format("ts", TS_FMT).alias("_time"),
        F.col("ts"),
        F.col("user_id"),
        F.col("event_type").alias("service"),
        F.col("value").alias("duration_ms"),
        F.col("props").alias("_raw"),
    )


# ----------------------------------------------------------------------- A5
@register("a5_summary", bench=True, sql="""
SELECT user_id, count(*) AS "rows", round(avg(value), 6) AS avg_value, round(max(value), 6) AS max_value,
       CAST(sum(CASE WHEN value >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS gte_50,
       CAST(sum(CASE WHEN value >= 200 THEN 1 ELSE 0 END) AS BIGINT) AS gte_200,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       round(CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS error_rate
FROM events
WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-28 00:00:00'
GROUP BY user_id
ORDER BY gte_50 DESC, user_id ASC
LIMIT 50
""")
def a5_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    out = sm.summary(e, group_by="user_id", metric="value", thresholds=(50, 200),
                     error_where="event_type = 'error'", preset="latency",
                     time_col="ts", time_from="2024-01-03 00:00:00", time_to="2024-01-28 00:00:00",
                     limit=50)
    return rounded(out)


@register("a1_group_count", sql="""
SELECT event_type, count(*) AS "rows" FROM events GROUP BY event_type
""")
def a1_group_count(spark, sf_dir):
    return sm.summary(table(spark, sf_dir, "events"), ["event_type", "event_type"], limit=None)


@register("a2_a4_metric_summary", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS "rows",
       round(avg(l_quantity), 6) AS avg_l_quantity, round(max(l_quantity), 6) AS max_l_quantity,
       CAST(sum(CASE WHEN l_quantity >= 10 THEN 1 ELSE 0 END) AS BIGINT) AS gte_10,
       CAST(sum(CASE WHEN l_quantity >= 25.5 THEN 1 ELSE 0 END) AS BIGINT) AS gte_25_5,
       CAST(sum(CASE WHEN l_quantity >= -1 THEN 1 ELSE 0 END) AS BIGINT) AS gte_neg_1,
       CAST(sum(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       round(CAST(sum(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS error_rate
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def a2_a4_metric_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = sm.summary(li, ["l_returnflag", "l_linestatus"], metric="l_quantity",
                     thresholds=(10, 25.5, -1, 10), error_where="l_discount > 0.08", limit=None)
    return rounded(out)


@register("a6_latency_max", sql="""
SELECT o_orderpriority, count(*) AS "rows", round(avg(o_totalprice), 6) AS avg_o_totalprice,
       round(max(o_totalprice), 6) AS max_o_totalprice
FROM orders GROUP BY o_orderpriority ORDER BY max_o_totalprice DESC, o_orderpriority LIMIT 3
""")
def a6_latency_max(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return rounded(sm.summary(o, "o_orderpriority", metric="o_totalprice", thresholds=(),
                              preset="latency", limit=3))


@register("o2_order_rows_asc", sql="""
SELECT o_orderstatus, count(*) AS "rows" FROM orders GROUP BY o_orderstatus
ORDER BY "rows" ASC, o_orderstatus LIMIT 2
""")
def o2_order_rows_asc(spark, sf_dir):
    return sm.summary(table(spark, sf_dir, "orders"), "o_orderstatus", order_by="rows",
                      order="asc", limit=2)


@register("a9_stats_count", sql="""
SELECT c_mktsegment, c_nationkey, count(*) AS "count" FROM customer GROUP BY c_mktsegment, c_nationkey
""")
def a9_stats_count(spark, sf_dir):
    return sm.stats_count(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


@register("a8_timechart", sql="""
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS _time,
       count(*) AS "count", round(sum(value), 6) AS total_value
FROM events GROUP BY 1
""")
def a8_timechart(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    out = sm.timechart(e, "ts", "6 hours", [F.count(F.lit(1)).alias("count"),
                                            F.sum("value").alias("total_value")])
    return rounded(out.withColumn("_time", F.date_format("_time", "yyyy-MM-dd HH:mm:ss")))


@register("a8_timechart_by", sql="""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS _time,
       count(*) FILTER (WHERE event_type = 'click') AS click,
       count(*) FILTER (WHERE event_type = 'error') AS error,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       count(*) FILTER (WHERE event_type = 'signup') AS signup,
       count(*) FILTER (WHERE event_type = 'view') AS "view"
FROM events GROUP BY 1
""")
def a8_timechart_by(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    out = sm.timechart(e, "ts", "1 day", [F.count(F.lit(1))], by="event_type",
                       values=["click", "error", "purchase", "signup", "view"])
    out = out.na.fill(0, ["click", "error", "purchase", "signup", "view"])
    return out.withColumn("_time", F.date_format("_time", "yyyy-MM-dd HH:mm:ss"))


# ----------------------------------------------------------------- P2, P8
@register("p2_time_window", sql="""
SELECT event_id, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 06:00:00'
""")
def p2_time_window(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return sm.time_window(e, "ts", "2024-01-10 00:00:00", "2024-01-12 06:00:00") \
             .select("event_id", "user_id", "event_type")


@register("p2_text_time_window", sql=f"""
SELECT event_id FROM events
WHERE strftime(ts, '{TS_FMT_SQL}') >= '2024-01-20 00:00:00' AND strftime(ts, '{TS_FMT_SQL}') < '2024-01-21 12:30:00'
""")
def p2_text_time_window(spark, sf_dir):
    r = event_results(spark, sf_dir)
    return sm.time_window(r, "_time", "2024-01-20 00:00:00", "2024-01-21 12:30:00") \
             .select(F.col("_row").alias("event_id"))


@register("p8_where", sql="""
SELECT event_id, round(value, 6) AS value FROM events WHERE event_type = 'error' AND value > 100
""")
def p8_where(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return rounded(sm.where_expr(e, "event_type = 'error' AND value > 100").select("event_id", "value"))


# ------------------------------------------------------------- P3-P7, O4
@register("p3_match_field", sql="""
SELECT event_id, event_type FROM events WHERE CAST(user_id AS VARCHAR) = '8'
""")
def p3_match_field(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return ev.match_field(e, "user_id", "8").select("event_id", "event_type")


@register("p4_match_json", sql="""
SELECT event_id, props FROM events WHERE json_extract_string(props, '$.k') = '69'
""")
def p4_match_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return ev.match_json(e, "$.k", "69", raw="props").select("event_id", "props")


@register("p5_request_id", sql="""
SELECT event_id, user_id AS trace_id FROM events WHERE CAST(user_id AS VARCHAR) = '42'
""")
def p5_request_id(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "trace_id")
    return ev.match_request_id(e, "42").select("event_id", "trace_id")


@register("p5_request_id_json", sql="""
SELECT event_id FROM events WHERE json_extract_string(props, '$.k') = '7'
""")
def p5_request_id_json(spark, sf_dir):
    """No id column: the id paths are read from ``_raw`` (here the props JSON
    re-keyed so that ``requestId`` carries the k value)."""
    e = table(spark, sf_dir, "events")
    raw = F.regexp_replace("props", '"k"', '"requestId"')
    r = e.select("event_id", raw.alias("_raw"))
    return ev.match_request_id(r, "7").select("event_id")


@register("p7_event_sequence", bench=True, sql=f"""
SELECT CAST(user_id AS VARCHAR) AS matched_value, event_id AS _row, strftime(ts, '{TS_FMT_SQL}') AS _time,
       event_type AS service
FROM events WHERE CAST(user_id AS VARCHAR) = '17'
ORDER BY _time, _row LIMIT 100
""")
def p7_event_sequence(spark, sf_dir):
    r = event_results(spark, sf_dir).drop("ts")
    return ev.event_sequence(r, field="user_id", value="17", limit=100)


# ------------------------------------------------------------------ P1
@register("p1_bounded_sql", sql="""
SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_value FROM events GROUP BY event_type
""")
def p1_bounded_sql(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    out = fl.query_results(spark, {"results": e},
                           "SELECT event_type, count(*) AS n, avg(value) AS avg_value "
                           "FROM results GROUP BY event_type;", limit=100)
    return rounded(out)


@register("o1_limit_flagged", sql="""
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, (SELECT count(*) FROM orders) > 10 AS truncated
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def o1_limit_flagged(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    out = sm.limit_flagged(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return rounded(out)


# ------------------------------------------------------------ S2, S4, P10
@register("s2_row_number", sql="""
SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS _row FROM events
""")
def s2_row_number(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    return fl.with_row_number(e, ["event_id"])


@register("s4_slice", sql="""
SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders) AS total,
       100 + (SELECT count(*) FROM (SELECT 1 FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 100)) < (SELECT count(*) FROM orders) AS has_more
FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 100
""")
def s4_slice(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return fl.slice_rows(o, [F.col("o_orderkey")], limit=25, offset=100)


@register("p10_count_rows", sql='SELECT count(*) AS "rows" FROM lineitem')
def p10_count_rows(spark, sf_dir):
    return fl.count_rows(table(spark, sf_dir, "lineitem"))


@register("p10_row_at", sql="""
SELECT o_orderkey, o_orderstatus FROM (
  SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS _row FROM orders) WHERE _row = 77
""")
def p10_row_at(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return fl.row_at(fl.with_row_number(o, ["o_orderkey"]), 77).drop("_row")


@register("p13_select", sql="SELECT n_name FROM nation")
def p13_select(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_name")


@register("p9_relative_time", sql="""
SELECT user_id, strftime(date_trunc('hour', max(ts) - INTERVAL 24 HOUR), '%Y-%m-%d %H:%M:%S') AS earliest,
       strftime(max(ts) - INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS recent
FROM events GROUP BY user_id
""")
def p9_relative_time(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.groupBy("user_id").agg(F.max("ts").alias("anchor"))
    return last.select(
        "user_id",
        F.date_format(fl.relative_time(F.col("anchor"), "-24h@h"), "yyyy-MM-dd HH:mm:ss").alias("earliest"),
        F.date_format(fl.relative_time(F.col("anchor"), "-15m"), "yyyy-MM-dd HH:mm:ss").alias("recent"))


# ------------------------------------------------------------------ P11
SECRET_RE = 'token = "([0-9a-f]+)"'


@register("p11_secret_rows", sql=f"""
WITH secrets AS (
  SELECT DISTINCT regexp_extract(text, '{SECRET_RE}', 1) AS s FROM documents
  WHERE regexp_extract(text, '{SECRET_RE}', 1) <> '')
SELECT d.doc_id, EXISTS (SELECT 1 FROM secrets WHERE contains(d.text, secrets.s)) AS has_secret
FROM documents d
""")
def p11_secret_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    secrets = (docs.select(F.regexp_extract("text", SECRET_RE, 1).alias("secret"))
               .filter(F.col("secret") != ""))
    return fl.flag_secret_rows(docs, secrets).select("doc_id", "has_secret")
