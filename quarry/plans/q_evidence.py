"""Registered queries: evidence ledger (G) and the lifecycle decision."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decisions as dc
from ..operators import evidence as ev
from .registry import register, table


def orders_ledger(spark, sf_dir):
    """Orders as evidence about customers: every order observes the
    customer's status, priority and total at its order date."""
    o = table(spark, sf_dir, "orders")
    return ev.to_ledger(o, "o_custkey", source="inventory", observed_at="o_orderdate",
                        fields=["o_orderstatus", "o_orderpriority", "o_totalprice"])


@register("g1_to_ledger", sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS object_id, field, value, 'inventory' AS source,
       strftime(o_orderdate, '%Y-%m-%d') AS observed_at
FROM (SELECT o_orderkey, o_orderdate, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
             CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
             CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders)
UNPIVOT (value FOR field IN (o_custkey, o_orderstatus, o_orderpriority, o_totalprice))
""")
def g1_to_ledger(spark, sf_dir):
    """Wide orders -> ledger rows; the lowest priority is treated as not
    recorded (null), so it yields no row."""
    o = table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority")))
    led = ev.to_ledger(o, "o_orderkey", source="inventory", observed_at="o_orderdate",
                       fields=["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    return led.withColumn("observed_at", F.date_format("observed_at", "yyyy-MM-dd"))


@register("g2_from_ledger", sql="""
WITH led AS (
  SELECT CAST(o_custkey AS VARCHAR) AS object_id, field, value, o_orderdate AS observed_at
  FROM (SELECT o_custkey, o_orderdate, o_orderstatus, o_orderpriority, CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders)
  UNPIVOT (value FOR field IN (o_orderstatus, o_orderpriority, o_totalprice))),
latest AS (SELECT object_id, field, arg_max(value, (observed_at, value)) AS value FROM led GROUP BY ALL)
SELECT object_id,
       max(CASE WHEN field = 'o_orderpriority' THEN value END) AS o_orderpriority,
       max(CASE WHEN field = 'o_orderstatus' THEN value END) AS o_orderstatus,
       max(CASE WHEN field = 'o_totalprice' THEN value END) AS o_totalprice
FROM latest GROUP BY object_id
""")
def g2_from_ledger(spark, sf_dir):
    return ev.from_ledger(orders_ledger(spark, sf_dir), ["o_orderpriority", "o_orderstatus", "o_totalprice"])


@register("g3_missing_evidence", sql="""
WITH led AS (
  SELECT CAST(c_custkey AS VARCHAR) AS object_id, field
  FROM (SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) END AS c_acctbal,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer)
  UNPIVOT (value FOR field IN (c_name, c_nationkey, c_acctbal, c_mktsegment))),
obs AS (SELECT object_id, list(field) AS f FROM led GROUP BY object_id),
rules AS (SELECT * FROM (VALUES ('orphan', ['c_name', 'c_acctbal']), ('exposure', ['c_mktsegment', 'c_nationkey']),
                                ('collision', ['c_name'])) AS t(decision, fields))
SELECT object_id, decision,
       array_to_string(list_sort(list_filter(fields, lambda x: NOT list_contains(f, x))), ',') AS missing,
       len(list_filter(fields, lambda x: NOT list_contains(f, x))) > 0 AS blocked
FROM obs, rules
""")
def g3_missing_evidence(spark, sf_dir):
    """Customers as governed objects: a negative balance and the BUILDING
    segment count as unrecorded; three decisions need different fields."""
    c = table(spark, sf_dir, "customer")
    c = (c.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
          .withColumn("c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))))
    led = ev.to_ledger(c, "c_custkey", fields=["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    miss = ev.missing_evidence(led, {"orphan": ["c_name", "c_acctbal"], "exposure": ["c_mktsegment", "c_nationkey"],
                                     "collision": ["c_name"]})
    return miss.select("object_id", "decision", F.array_join("missing", ",").alias("missing"), "blocked")


@register("g4_conflicts", sql="""
SELECT CAST(l_orderkey AS VARCHAR) AS object_id, 'l_linestatus' AS field, count(DISTINCT l_linestatus) AS n_values,
       min(l_linestatus) AS first_value, max(l_linestatus) AS last_value
FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linestatus) > 1
""")
def g4_conflicts(spark, sf_dir):
    """Each line item is an observation of its order's status; orders whose
    lines disagree are conflicts."""
    li = table(spark, sf_dir, "lineitem")
    led = ev.to_ledger(li, "l_orderkey", fields=["l_linestatus"])
    c = ev.conflicts(led)
    return c.select("object_id", "field", "n_values", "first_value", "last_value")


@register("g5_staleness", sql="""
SELECT field, CAST(sum(CASE WHEN o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 365 DAY THEN 1 ELSE 0 END) AS BIGINT) AS stale_rows,
       CAST(sum(CASE WHEN o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 365 DAY THEN 1 ELSE 0 END) AS BIGINT) AS current_rows
FROM (SELECT o_orderdate, o_orderstatus, o_orderpriority, CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders)
UNPIVOT (value FOR field IN (o_orderstatus, o_orderpriority, o_totalprice))
GROUP BY field
""")
def g5_staleness(spark, sf_dir):
    led = ev.mark_stale(orders_ledger(spark, sf_dir), "2001-08-01 00:00:00", "365 days")
    return led.groupBy("field").agg(F.sum(F.col("stale").cast("long")).alias("stale_rows"),
                                    F.sum(F.col("current").cast("long")).alias("current_rows"))


@register("d8_lifecycle_candidates", sql="""
WITH u AS (SELECT l_partkey, max(l_shipdate) AS last_used FROM lineitem GROUP BY l_partkey),
d AS (SELECT l_partkey, count(*) AS dependents FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_partkey)
SELECT p.p_partkey AS object_id,
       CASE WHEN u.last_used >= TIMESTAMP '2001-11-04' - INTERVAL 365 DAY THEN 'active'
            WHEN coalesce(d.dependents, 0) > 0 THEN 'in use by dependents'
            ELSE 'stale candidate' END AS lifecycle
FROM part p LEFT JOIN u ON u.l_partkey = p.p_partkey LEFT JOIN d ON d.l_partkey = p.p_partkey
""")
def d8_lifecycle_candidates(spark, sf_dir):
    """Parts as knowledge objects: line items are usage (ship date = last
    use), open line items are dependents; a part unused for a year with no
    dependents is a stale candidate."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("object_id"))
    li = table(spark, sf_dir, "lineitem")
    usage = li.select(F.col("l_partkey").alias("object_id"), F.col("l_shipdate").alias("last_used"))
    deps = li.filter(F.col("l_linestatus") == "O").select(F.col("l_partkey").alias("object_id"),
                                                           F.lit(1).alias("dependents"))
    out = dc.lifecycle_candidates(p, usage, deps, anchor="2001-11-04 00:00:00", stale_after="365 days")
    return out.select("object_id", "lifecycle")
