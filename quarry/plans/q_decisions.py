"""Registered queries: decision tables (D) fed with evidence columns derived
from the TPC-H tables, each with the same rule restated in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decisions as dc
from ..operators import rollups as ru
from ..operators import windows as wn
from .registry import register, table


@register("d1_exposure_status", sql="""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' OR l_quantity = 50 OR l_partkey IS NULL OR l_quantity < 2 THEN 'Unknown'
       WHEN (l_returnflag = 'R' OR l_returnflag = 'A') AND l_linestatus = 'F' THEN 'Remediated'
       WHEN l_discount >= 0.09 AND l_tax > 0.02 AND CAST(l_shipdate + INTERVAL 365 DAY AS DATE) >= DATE '2000-06-01' THEN 'Excepted'
       WHEN l_returnflag = 'R' THEN 'Exposed'
       WHEN l_returnflag <> 'R' AND l_returnflag <> 'A' THEN 'Not exposed'
       ELSE 'Unknown' END AS exposure_status
FROM lineitem
""")
def d1_exposure_status(spark, sf_dir):
    """Line items as findings: returned = affected, 'A' = previously
    affected, finished = remediation verified, deep discounts = accepted
    exceptions (in scope when taxed, valid one year from shipping), lines
    shipped before 1996 stale, 50-unit lines conflicting, 1-unit lines a
    bare scanner signal."""
    li = table(spark, sf_dir, "lineitem")
    x = li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_partkey").isNotNull().alias("matched"),
        (F.col("l_returnflag") == "R").alias("affected"),
        (F.col("l_returnflag") == "A").alias("previously_affected"),
        (F.col("l_linestatus") == "F").alias("remediation_verified"),
        F.when(F.col("l_discount") >= 0.09, F.lit("Accepted")).alias("exception_status"),
        (F.col("l_tax") > 0.02).alias("exception_in_scope"),
        (F.col("l_shipdate") + F.expr("INTERVAL 365 DAY")).cast("date").alias("exception_expiry"),
        (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("stale"),
        (F.col("l_quantity") == 50).alias("conflict"),
        (F.col("l_quantity") < 2).alias("scanner_only"))
    return dc.exposure_status(x, anchor="2000-06-01").select("l_orderkey", "l_linenumber", "exposure_status")


@register("d2_compatibility_label", sql="""
SELECT p_partkey,
  CASE WHEN p_retailprice < 1500 AND p_brand <> 'Brand#1' AND p_type = 'ECONOMY' THEN 'Compatible'
       WHEN p_retailprice < 1500 AND p_brand <> 'Brand#1' AND p_type = 'SMALL' AND p_size > 25 THEN 'Update available'
       WHEN p_retailprice < 1500 AND p_brand <> 'Brand#1' AND p_type = 'LARGE' AND p_size <= 25 AND p_size >= 5 THEN 'Incompatible'
       ELSE 'Needs review' END AS compatibility
FROM part
""")
def d2_compatibility_label(spark, sf_dir):
    """Parts as installed add-ons: the type gives the compatibility record's
    verdict; only cheaper parts have applicable evidence; Brand#1 records
    are stale; sizes over 25 name a tested alternative version and sizes
    under 5 a migration path."""
    p = table(spark, sf_dir, "part")
    x = p.select(
        "p_partkey",
        F.when(F.col("p_type") == "ECONOMY", "compatible").when(F.col("p_type") == "SMALL", "update_required")
         .when(F.col("p_type") == "LARGE", "incompatible").alias("verdict"),
        (F.col("p_retailprice") < 1500).alias("applicable"),
        (F.col("p_brand") == "Brand#1").alias("stale"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("v"), F.col("p_size").cast("string"))).alias("alternative_version"),
        F.when(F.col("p_size") < 5, F.lit("migrate")).alias("migration_path"))
    return dc.compatibility_label(x).select("p_partkey", "compatibility")


@register("d3_control_readiness", sql="""
WITH e AS (
  SELECT l_orderkey, l_returnflag <> 'R' AND l_shipdate >= TIMESTAMP '1997-01-01' AS counts,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus = 'F' END AS ok FROM lineitem)
SELECT l_orderkey AS control,
  CASE WHEN NOT coalesce(bool_or(counts), false) THEN 'unknown'
       WHEN bool_or(counts AND ok IS NULL) AND NOT bool_or(counts AND ok IS NOT NULL AND NOT ok) THEN 'unknown'
       WHEN bool_or(counts AND coalesce(ok, false)) AND bool_or(counts AND NOT coalesce(ok, true)) THEN 'unknown'
       WHEN bool_or(counts AND NOT coalesce(ok, true)) THEN 'fail' ELSE 'pass' END AS readiness
FROM e GROUP BY l_orderkey
""")
def d3_control_readiness(spark, sf_dir):
    """Orders as controls, their lines as evidence: finished lines pass,
    open lines fail, seventh lines have no result; returned lines are not
    authoritative; lines shipped before 1997 are not current."""
    li = table(spark, sf_dir, "lineitem")
    ev = li.select(F.col("l_orderkey").alias("control"),
                   F.when(F.col("l_linenumber") == 7, None).when(F.col("l_linestatus") == "F", "pass")
                    .otherwise("fail").alias("result"),
                   (F.col("l_returnflag") != "R").alias("authoritative"),
                   (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).alias("current"))
    return dc.control_readiness(ev).select("control", "readiness")


@register("d4_go_no_go", sql="""
WITH c AS (
  SELECT o_custkey AS plan, o_orderpriority <> '4-NOT SPECIFIED' AS mandatory,
         CASE o_orderstatus WHEN 'F' THEN 'met' WHEN 'O' THEN 'blocker' END AS status,
         o_totalprice > 50000 AND NOT (o_orderpriority = '5-LOW') AS has_ev
  FROM orders)
SELECT plan,
  CASE WHEN sum(CASE WHEN status = 'blocker' AND has_ev THEN 1 ELSE 0 END) > 0 THEN 'no-go'
       WHEN sum(CASE WHEN mandatory AND NOT coalesce(status = 'met' AND has_ev, false) THEN 1 ELSE 0 END) > 0 THEN 'decision-blocked'
       ELSE 'go' END AS decision
FROM c GROUP BY plan
""")
def d4_go_no_go(spark, sf_dir):
    """Customers as upgrade plans, their orders as criteria: finished =
    met, open = blocker, pending = no status; orders above 50 000 carry
    evidence unless low priority (conflicting); unspecified priority is
    optional."""
    o = table(spark, sf_dir, "orders")
    crit = o.select(F.col("o_custkey").alias("plan"),
                    (F.col("o_orderpriority") != "4-NOT SPECIFIED").alias("mandatory"),
                    F.when(F.col("o_orderstatus") == "F", "met").when(F.col("o_orderstatus") == "O", "blocker").alias("status"),
                    F.when(F.col("o_totalprice") > 50000, F.lit("priced")).alias("evidence"),
                    (F.col("o_orderpriority") == "5-LOW").alias("conflict"))
    return dc.go_no_go(crit).select("plan", "decision")


@register("d5_d6_dependency_recovery", sql="""
SELECT p_partkey,
  CASE WHEN p_type = 'LARGE' THEN 'blocked' WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'compatible' ELSE 'unresolved' END AS result,
  CASE WHEN p_size <= 8 THEN 1 WHEN p_size <= 16 THEN 2 WHEN p_size <= 24 THEN 3 WHEN p_size <= 32 THEN 4
       WHEN p_size <= 40 THEN 5 ELSE 6 END AS group_order,
  CASE WHEN p_retailprice > 1500 THEN 'supported' WHEN p_retailprice < 1000 THEN 'not supported' ELSE 'unknown' END AS in_place_rollback,
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_size > 20 THEN 'recovery evidenced'
       ELSE 'recovery readiness unconfirmed' END AS recovery_summary
FROM part
""")
def d5_d6_dependency_recovery(spark, sf_dir):
    """Parts as dependencies (size band = dependency group) and as recovery
    scopes (price = rollback documentation, brands 1-3 = backups, large
    sizes = validated restores)."""
    p = table(spark, sf_dir, "part")
    groups = dc.DEPENDENCY_GROUPS
    band = (F.when(F.col("p_size") <= 8, groups[0]).when(F.col("p_size") <= 16, groups[1])
            .when(F.col("p_size") <= 24, groups[2]).when(F.col("p_size") <= 32, groups[3])
            .when(F.col("p_size") <= 40, groups[4]).otherwise(groups[5]))
    x = p.select("p_partkey", band.alias("group"),
                 F.when(F.col("p_type").isin("STANDARD", "ECONOMY"), F.lit(True)).alias("supported"),
                 F.when(F.col("p_type") == "LARGE", F.lit(True)).alias("ruled_out"),
                 F.when(F.col("p_retailprice") > 1500, F.lit(True)).when(F.col("p_retailprice") < 1000, F.lit(False))
                  .alias("rollback_documented"),
                 F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3").alias("backup_evidenced"),
                 (F.col("p_size") > 20).alias("restore_validated"))
    x = dc.recovery_status(dc.dependency_result(x))
    return x.select("p_partkey", "result", "group_order", "in_place_rollback", "recovery_summary")


@register("d7_governance_priority", sql="""
SELECT p_partkey,
  CASE WHEN (p_size > 45 AND p_type = 'PROMO') OR p_brand = 'Brand#3' THEN 'higher'
       WHEN p_name LIKE 'red%' OR p_retailprice > 1900 THEN 'medium' ELSE 'lower' END AS priority
FROM part
""")
def d7_governance_priority(spark, sf_dir):
    """Parts as knowledge objects: large parts are confirmed orphans, PROMO
    parts are scheduled, Brand#3 is broadly writable, red parts collide,
    expensive parts lack ownership continuity."""
    p = table(spark, sf_dir, "part")
    x = p.select("p_partkey",
                 F.when(F.col("p_size") > 45, F.lit("confirmed")).alias("orphan_status"),
                 (F.col("p_type") == "PROMO").alias("scheduled"),
                 F.when(F.col("p_brand") == "Brand#3", F.lit("broad_write")).alias("exposure"),
                 F.col("p_name").startswith("red").alias("collision"),
                 (F.col("p_retailprice") > 1900).alias("ownership_gap"))
    return dc.governance_priority(x).select("p_partkey", "priority")


@register("d9_change_readiness", sql="""
WITH r AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey,
  CASE WHEN r.returned > 0 OR o.o_orderpriority = '5-LOW' THEN 'blocked'
       WHEN o.o_orderstatus = 'P' THEN 'not-ready'
       WHEN r.returned IS NULL OR o.o_orderkey % 9 = 0 THEN 'blocked' ELSE 'ready' END AS readiness
FROM orders o LEFT JOIN r ON r.l_orderkey = o.o_orderkey
""")
def d9_change_readiness(spark, sf_dir):
    """Orders as planned changes: returned lines are conflicts (orders without
    lines have no such evidence), low priority lacks the approval, every
    ninth has no list of evidence, pending is a failed prerequisite."""
    o = table(spark, sf_dir, "orders")
    r = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
         .agg(F.sum((F.col("l_returnflag") == "R").cast("int")).alias("conflicts")))
    none = F.array().cast("array<string>")
    x = o.join(r, "o_orderkey", "left").select(
        "o_orderkey", "conflicts",
        F.when(F.col("o_orderpriority") == "5-LOW", F.array(F.lit("approval")))
         .when(F.col("o_orderkey") % 9 != 0, none).alias("missing"),
        (F.col("o_orderstatus") == "P").alias("prerequisite_failed"))
    return dc.change_readiness(x).select("o_orderkey", "readiness")


@register("d10_cost_owner", sql="""
WITH pp AS (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS s FROM lineitem GROUP BY 1, 2),
peer AS (SELECT l_orderkey, max(s) / avg(s) AS imbalance FROM pp GROUP BY 1),
job AS (SELECT l_orderkey, count(*) AS concurrent, sum(l_quantity) / sum(l_linenumber) AS scan_to_result
        FROM lineitem GROUP BY 1),
gaps AS (SELECT l_orderkey, min(gap) AS min_gap FROM (
  SELECT l_orderkey, epoch(l_shipdate) - lag(epoch(l_shipdate)) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS gap FROM lineitem) GROUP BY 1)
SELECT j.l_orderkey AS search_id,
  CASE WHEN p.imbalance > 1.8 THEN 'platform' WHEN j.concurrent > 6 THEN 'workload' WHEN g.min_gap < 172800 THEN 'invocation'
       WHEN j.scan_to_result > 8 THEN 'query' ELSE 'unknown' END AS cost_owner
FROM job j JOIN peer p ON p.l_orderkey = j.l_orderkey JOIN gaps g ON g.l_orderkey = j.l_orderkey
""")
def d10_cost_owner(spark, sf_dir):
    """Orders as searches: per-supplier quantities are peer timings (A12),
    line count is concurrency, shipping dates are invocations (W7), quantity
    per result is the scan ratio (A11)."""
    li = table(spark, sf_dir, "lineitem")
    skew = ru.peer_skew(li, "l_orderkey", "l_suppkey", "l_quantity").select("l_orderkey", "imbalance")
    job = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("concurrent"),
                                      (F.sum("l_quantity") / F.sum("l_linenumber")).alias("scan_to_result"))
    gaps = wn.cadence(li.select("l_orderkey", "l_shipdate"), "l_orderkey", "l_shipdate").select("l_orderkey", "min_gap")
    x = job.join(skew, "l_orderkey").join(gaps, "l_orderkey")
    out = dc.cost_owner(x, imbalance_limit=1.8, cadence_limit_s=172800.0, concurrency_limit=6, scan_ratio_limit=8.0)
    return out.select(F.col("l_orderkey").alias("search_id"), "cost_owner")


@register("d11_acceleration_fit", sql="""
WITH s AS (
  SELECT c.c_custkey, CASE WHEN count(o.o_orderkey) = 0 THEN NULL
                          ELSE CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / count(o.o_orderkey) END AS coverage,
         c.c_mktsegment <> 'AUTOMOBILE' AS pruning, count(o.o_orderkey) AS cardinality, c.c_acctbal > 0 AS qualified
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_mktsegment, c.c_acctbal)
SELECT c_custkey,
  CASE WHEN coverage IS NULL THEN 'missing coverage' WHEN coverage < 0.3 THEN 'fails coverage'
       WHEN NOT pruning THEN 'fails pruning' WHEN cardinality > 12 THEN 'fails cardinality'
       WHEN NOT qualified THEN 'fails qualification' ELSE 'fit' END AS acceleration_fit
FROM s
""")
def d11_acceleration_fit(spark, sf_dir):
    """Customers as accelerated searches: share of finished orders is summary
    coverage, non-automobile segments prune, order count is cardinality,
    positive balance qualifies."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    j = c.join(o, o.o_custkey == c.c_custkey, "left").groupBy("c_custkey", "c_mktsegment", "c_acctbal").agg(
        F.try_divide(F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("double"),
                     F.count("o_orderkey")).alias("coverage"),
        F.count("o_orderkey").alias("cardinality"))
    x = j.select("c_custkey", "coverage", (F.col("c_mktsegment") != "AUTOMOBILE").alias("pruning"), "cardinality",
                 (F.col("c_acctbal") > 0).alias("qualified"))
    return dc.acceleration_fit(x, min_coverage=0.3, max_cardinality=12).select("c_custkey", "acceleration_fit")


@register("d12_stage_gate", sql="""
WITH s AS (
  SELECT o_custkey AS plan, o_orderkey AS stage, o_orderstatus, o_orderpriority,
         o_totalprice > 30000 AS compatible, o_orderstatus = 'F' AS completed, o_totalprice > 100000 AS threshold_met,
         lag(o_orderstatus) OVER w AS ps, lag(o_orderpriority) OVER w AS pp, row_number() OVER w AS rn
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
r AS (
  SELECT plan, stage,
         (CASE WHEN ps IS NULL THEN 0 WHEN o_orderstatus IS DISTINCT FROM ps THEN 1 ELSE 0 END)
         + (CASE WHEN pp IS NULL THEN 0 WHEN o_orderpriority IS DISTINCT FROM pp THEN 1 ELSE 0 END) AS changed_dims,
         rn, compatible, completed, threshold_met FROM s),
k AS (SELECT *, (rn = 1 OR changed_dims = 1) AND compatible AND (NOT completed OR threshold_met) AS stage_ok FROM r)
SELECT plan, stage, CAST(changed_dims AS INTEGER) AS changed_dims, stage_ok,
       CASE WHEN bool_and(coalesce(stage_ok, false)) OVER (PARTITION BY plan) THEN 'ok' ELSE 'decision-blocked' END AS gate
FROM k
""")
def d12_stage_gate(spark, sf_dir):
    """Customers as staged rollouts, their orders (by key) as stages whose
    dependency dimensions are status and priority."""
    o = table(spark, sf_dir, "orders")
    st = o.select(F.col("o_custkey").alias("plan"), F.col("o_orderkey").alias("stage"), "o_orderstatus",
                  "o_orderpriority", (F.col("o_totalprice") > 30000).alias("compatible"),
                  (F.col("o_orderstatus") == "F").alias("completed"),
                  (F.col("o_totalprice") > 100000).alias("threshold_met"))
    out = dc.stage_gate(st, "plan", "stage", ["o_orderstatus", "o_orderpriority"])
    return out.select("plan", "stage", F.col("changed_dims").cast("int").alias("changed_dims"), "stage_ok", "gate")
