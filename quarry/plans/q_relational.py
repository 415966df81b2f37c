"""Registered queries: joins (J), set operations (U), windows (W) and the
remaining aggregations (A10-A14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as jn
from ..operators import rollups as ru
from ..operators import windows as wn
from .registry import register, rounded, table


# ------------------------------------------------------------- J1-J3
@register("j1_inner_join", bench=True, sql="""
SELECT c.c_mktsegment, count(*) AS orders, round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment
""")
def j1_inner_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = jn.inner_join(o, c.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"),
                                         F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@register("j2_outer_join", sql="""
SELECT c.c_custkey, count(o.o_orderkey) AS orders
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
GROUP BY c.c_custkey
""")
def j2_outer_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    c = table(spark, sf_dir, "customer").select("c_custkey")
    j = jn.outer_join(c, o.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    return j.groupBy("c_custkey").agg(F.count("o_orderkey").alias("orders"))


@register("j2_full_join", sql="""
SELECT coalesce(a.k, b.k) AS k, CAST(a.n_a AS DOUBLE) AS n_a, CAST(b.n_b AS DOUBLE) AS n_b FROM
  (SELECT o_orderpriority AS k, count(*) AS n_a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
  FULL JOIN (SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS k, count(*) AS n_b
             FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) b
  ON a.k = b.k
""")
def j2_full_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = o.filter(F.col("o_orderstatus") == "F").groupBy(F.col("o_orderpriority").alias("k")).agg(F.count(F.lit(1)).alias("n_a"))
    # urgent pending orders have an unknown key, which joins nothing
    known = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
    b = o.filter(F.col("o_orderstatus") == "P").groupBy(known.alias("k")).agg(F.count(F.lit(1)).alias("n_b"))
    j = jn.outer_join(a, b, "k", "full")
    # counts as doubles on both sides: an outer join's null count must not
    # turn an integer column into floats in one engine only
    return j.select("k", F.col("n_a").cast("double").alias("n_a"), F.col("n_b").cast("double").alias("n_b"))


@register("j3_semi_join", sql="""
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def j3_semi_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    big = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return jn.semi_join(c, big, "c_custkey")


@register("j3_anti_join", sql="""
SELECT p_partkey FROM part p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_quantity > 45)
""")
def j3_anti_join(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey")
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("p_partkey"))
    return jn.anti_join(p, li, "p_partkey")


# ------------------------------------------------------------- J4 range
@register("j4_range_join", sql="""
WITH bands AS (
  SELECT p_size AS band, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY p_size)
SELECT b.band, count(*) AS lines
FROM lineitem l JOIN bands b ON l.l_extendedprice / l.l_quantity BETWEEN b.lo AND b.hi
GROUP BY b.band
""")
def j4_range_join(spark, sf_dir):
    """Price bands (per part size: the retail-price range) joined to every
    line's unit price: a range join through a bucket equi-key."""
    p = table(spark, sf_dir, "part")
    bands = p.groupBy(F.col("p_size").alias("band")).agg(F.min("p_retailprice").alias("lo"),
                                                         F.max("p_retailprice").alias("hi"))
    li = table(spark, sf_dir, "lineitem").select((F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    j = jn.range_join(li, "unit", bands, "lo", "hi", width=100.0)
    return j.groupBy("band").agg(F.count(F.lit(1)).alias("lines"))


# ------------------------------------------------------------- J5 lookup
@register("j5_enrich", sql="""
SELECT c.c_custkey, coalesce(n.n_name, 'UNKNOWN') AS n_name, coalesce(r.r_name, 'UNKNOWN') AS r_name
FROM customer c LEFT JOIN nation n ON CASE WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_nationkey END = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def j5_enrich(spark, sf_dir):
    """One segment's customers have an unknown nation."""
    nation = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey"))
    c = table(spark, sf_dir, "customer").select("c_custkey", nation.alias("n_nationkey"))
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    x = jn.enrich(c, n, "n_nationkey", ["n_name", "n_regionkey"])
    x = jn.enrich(x, r, "n_regionkey", ["r_name"], default="UNKNOWN")
    return x.select("c_custkey", F.coalesce("n_name", F.lit("UNKNOWN")).alias("n_name"), "r_name")


# ------------------------------------------------------------- J6 orphans
@register("j6_orphans", sql="""
WITH users AS (SELECT c_custkey AS "user", c_acctbal > 0 AS active FROM customer),
owned AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN -1 - o_custkey ELSE o_custkey END AS owner FROM orders)
SELECT o.o_orderkey, CASE WHEN o.owner IS NULL THEN 'unconfirmed' WHEN u."user" IS NULL THEN 'confirmed'
                          WHEN u.active THEN 'not_orphaned' ELSE 'confirmed' END AS orphan_status
FROM owned o LEFT JOIN users u ON o.owner = u."user"
""")
def j6_orphans(spark, sf_dir):
    """Orders whose owner is absent (finished orders name an account that
    does not exist) or inactive (non-positive balance) are confirmed orphans;
    pending orders name none."""
    c = table(spark, sf_dir, "customer")
    users = c.select(F.col("c_custkey").alias("user"), (F.col("c_acctbal") > 0).alias("active"))
    owner = F.when(F.col("o_orderstatus") == "F", -1 - F.col("o_custkey")).when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", owner.alias("owner"))
    return jn.orphans(o, users).select("o_orderkey", "orphan_status")


# ------------------------------------------------------------- J8 closure
@register("j8_effective_capabilities", sql="""
WITH RECURSIVE closure(role, ancestor) AS (
  SELECT n_nationkey, n_nationkey FROM nation
  UNION
  SELECT c.role, CAST(floor(c.ancestor / 2) AS INTEGER) FROM closure c WHERE c.ancestor > 0
)
SELECT cu.c_custkey AS "user", count(DISTINCT 'cap_' || r.r_name) AS capabilities, count(DISTINCT cl.ancestor) AS roles
FROM customer cu JOIN closure cl ON cl.role = cu.c_nationkey
JOIN nation n ON n.n_nationkey = cl.ancestor JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY cu.c_custkey
""")
def j8_effective_capabilities(spark, sf_dir):
    """Users = customers, each in the group of its nation; group n holds role
    n; role n inherits role floor(n/2); role n grants ``cap_<its region>``."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    user_groups = c.select(F.col("c_custkey").alias("user"), F.col("c_nationkey").alias("group"))
    group_roles = n.select(F.col("n_nationkey").alias("group"), F.col("n_nationkey").alias("role"))
    inherits = n.filter(F.col("n_nationkey") > 0).select(
        F.col("n_nationkey").alias("role"), F.floor(F.col("n_nationkey") / 2).cast("int").alias("inherits"))
    caps = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("role"), F.concat(F.lit("cap_"), F.col("r_name")).alias("capability"))
    closure = jn.role_closure(inherits)
    eff = jn.effective_capabilities(user_groups, group_roles, inherits, caps, closure=closure)
    roles = closure.withColumnRenamed("role", "group")
    n_roles = (user_groups.join(roles, "group").groupBy("user")
               .agg(F.count_distinct("ancestor").alias("roles")))
    n_caps = eff.groupBy("user").agg(F.count_distinct("capability").alias("capabilities"))
    return n_caps.join(n_roles, "user")


# ------------------------------------------------------------- J9 classes
@register("j9_server_classes", sql="""
WITH rules AS (
  SELECT * FROM (VALUES
    ('global', NULL, NULL, 'deny', '*bolt*'),
    ('class', 'rings', NULL, 'allow', '*ring'),
    ('app', 'rings', 'ring_app', 'allow', 'small *'),
    ('app', 'rings', 'other_app', 'allow', '* ring'),
    ('class', 'plates', NULL, 'allow', '*plate*'),
    ('app', 'plates', 'plate_app', 'deny', 'hot *'),
    ('app', 'plates', 'plate_app', 'allow', '?????*')
  ) AS t(level, class, app, kind, pattern)),
targets AS (SELECT DISTINCT class, app FROM rules WHERE level = 'app'),
applied AS (
  SELECT t.class, t.app, r.level, r.kind, r.pattern FROM rules r JOIN targets t ON r.level = 'global'
  UNION ALL SELECT t.class, t.app, r.level, r.kind, r.pattern FROM rules r JOIN targets t ON r.level = 'class' AND r.class = t.class
  UNION ALL SELECT class, app, level, kind, pattern FROM rules WHERE level = 'app'),
app_rules AS (SELECT DISTINCT class, app FROM rules WHERE level = 'app' AND kind = 'allow'),
hits AS (
  SELECT p.p_partkey, a.class, a.app, a.level, a.kind FROM part p JOIN applied a
  ON regexp_full_match(p.p_name, replace(replace(a.pattern, '*', '.*'), '?', '.')))
SELECT h.p_partkey AS client, h.class, h.app FROM hits h
LEFT JOIN app_rules ar ON ar.class = h.class AND ar.app = h.app
GROUP BY 1, 2, 3, ar.class
HAVING bool_or(h.kind = 'allow' AND h.level <> 'app') AND NOT bool_or(h.kind = 'deny')
   AND (bool_or(h.kind = 'allow' AND h.level = 'app') OR ar.class IS NULL)
""")
def j9_server_classes(spark, sf_dir):
    """Parts act as clients (name = hostname); a fixed deployment rule set
    assigns them to classes/apps; deny wins at every level."""
    clients = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("client"),
                                                  F.col("p_name").alias("hostname"))
    rules = spark.createDataFrame([
        ("global", None, None, "deny", "*bolt*"),
        ("class", "rings", None, "allow", "*ring"),
        ("app", "rings", "ring_app", "allow", "small *"),
        ("app", "rings", "other_app", "allow", "* ring"),
        ("class", "plates", None, "allow", "*plate*"),
        ("app", "plates", "plate_app", "deny", "hot *"),
        ("app", "plates", "plate_app", "allow", "?????*"),
    ], "level string, class string, app string, kind string, pattern string")
    return jn.match_classes(clients, rules)


# ------------------------------------------------------------- J12
@register("j12_interval_conflicts", sql="""
WITH changes AS (
  SELECT l_orderkey AS change_id, min(l_shipdate) AS "start", max(l_shipdate) + INTERVAL 1 DAY AS "end"
  FROM lineitem GROUP BY l_orderkey),
windows AS (
  SELECT DISTINCT date_trunc('month', o_orderdate) + INTERVAL 14 DAY AS "start",
                  date_trunc('month', o_orderdate) + INTERVAL 16 DAY AS "end" FROM orders)
SELECT c.change_id AS a_change_id, strftime(w."start", '%Y-%m-%d') AS b_start
FROM changes c JOIN windows w ON c."start" < w."end" AND w."start" < c."end"
""")
def j12_interval_conflicts(spark, sf_dir):
    """Changes = each order's shipping interval; freeze windows = days 15-16
    of every month that has orders."""
    li = table(spark, sf_dir, "lineitem")
    changes = li.groupBy(F.col("l_orderkey").alias("change_id")).agg(
        F.min("l_shipdate").alias("start"), (F.max("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("end"))
    o = table(spark, sf_dir, "orders")
    m = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    windows = o.select((m + F.expr("INTERVAL 14 DAY")).alias("start"),
                       (m + F.expr("INTERVAL 16 DAY")).alias("end")).distinct()
    j = jn.interval_conflicts(changes, windows, width_seconds=7 * 86400.0)
    return j.select("a_change_id", F.date_format("b_start", "yyyy-MM-dd").alias("b_start"))


# ------------------------------------------------------------- J13
@register("j13_baseline_compare", sql="""
WITH b AS (SELECT o_orderpriority AS metric, avg(o_totalprice) AS baseline FROM orders
           WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01' GROUP BY 1),
a AS (SELECT replace(o_orderpriority, '5-LOW', '5-MINOR') AS metric, avg(o_totalprice) AS observed FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate < TIMESTAMP '1998-03-01' GROUP BY 1)
SELECT coalesce(b.metric, a.metric) AS metric, round(b.baseline, 6) AS baseline, round(a.observed, 6) AS observed,
       round(CASE WHEN b.baseline <> 0 THEN (a.observed - b.baseline) / abs(b.baseline) END, 6) AS change,
       CASE WHEN b.baseline IS NULL OR a.observed IS NULL THEN 'unresolved'
            WHEN (a.observed - b.baseline) / abs(b.baseline) > 0.05 THEN 'regressed' ELSE 'ok' END AS status
FROM b FULL JOIN a ON a.metric = b.metric
""")
def j13_baseline_compare(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    jan = (o.filter((F.col("o_orderdate") >= "1998-01-01") & (F.col("o_orderdate") < "1998-02-01"))
           .groupBy(F.col("o_orderpriority").alias("metric")).agg(F.avg("o_totalprice").alias("value")))
    # one priority has another name in February
    feb = (o.filter((F.col("o_orderdate") >= "1998-02-01") & (F.col("o_orderdate") < "1998-03-01"))
           .groupBy(F.replace("o_orderpriority", F.lit("5-LOW"), F.lit("5-MINOR")).alias("metric")).agg(F.avg("o_totalprice").alias("value")))
    return rounded(jn.compare_baseline(jan, feb, threshold=0.05))


# ------------------------------------------------------------- J14, J15
@register("j14_unacked", sql="""
SELECT event_id, user_id FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events a WHERE a.event_id = e.event_id AND a.value >= 5)
""")
def j14_unacked(spark, sf_dir):
    """Every event is a submission; an event with value >= 5 counts as
    acknowledged."""
    e = table(spark, sf_dir, "events")
    acks = e.filter(F.col("value") >= 5).select("event_id")
    return jn.unacked(e.select("event_id", "user_id"), acks, ["event_id"])


@register("j15_verify_markers", sql="""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN 'rejected'
            WHEN EXISTS (SELECT 1 FROM events o WHERE o.event_id = e.event_id AND o.value >= 10) THEN 'validated'
            ELSE 'not_observed' END AS delivery_status
FROM events e
""")
def j15_verify_markers(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    sub = e.select("event_id", (F.col("event_type") != "error").alias("response_ok"))
    observed = e.filter(F.col("value") >= 10).select("event_id")
    return jn.verify_markers(sub, observed, ["event_id"]).select("event_id", "delivery_status")


# ------------------------------------------------------------- J16 as-of
@register("j16_as_of", bench=True, sql="""
SELECT p.event_id, round(v.value, 6) AS obs_value, CAST(v.event_id AS VARCHAR) AS obs_event_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, value, event_id FROM events WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def j16_as_of(spark, sf_dir):
    """For every purchase, the same user's newest view at or before it."""
    e = table(spark, sf_dir, "events")
    purchases = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = e.filter(F.col("event_type") == "view").select("user_id", "ts", "value", F.col("event_id").alias("vid"))
    out = jn.as_of(purchases, views, "user_id", "ts", ["value", "vid"])
    return rounded(out.select("event_id", F.col("obs_value"), F.col("obs_vid").cast("string").alias("obs_event_id")))


# ------------------------------------------------------------- J17
@register("j17_compare_members", sql="""
WITH n AS (SELECT count(DISTINCT l_suppkey) AS n FROM lineitem)
SELECT l_partkey, count(DISTINCT l_suppkey) AS n_present, count(DISTINCT l_returnflag || '|' || l_linestatus) AS variants,
       n - count(DISTINCT l_suppkey) AS n_missing,
       count(DISTINCT l_returnflag || '|' || l_linestatus) <= 1 AND n = count(DISTINCT l_suppkey) AS consistent
FROM lineitem, n GROUP BY l_partkey, n
""")
def j17_compare_members(spark, sf_dir):
    """All suppliers act as members holding parts; a part's metadata is its
    return flag and line status."""
    li = table(spark, sf_dir, "lineitem")
    return jn.compare_members(li, "l_partkey", "l_suppkey", ["l_returnflag", "l_linestatus"])


@register("j17_missing_members", sql="""
WITH m AS (SELECT DISTINCT l_suppkey FROM lineitem),
p AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT a.l_partkey, m.l_suppkey FROM (VALUES (1), (2), (3), (5), (8)) AS a(l_partkey), m
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.l_partkey = a.l_partkey AND p.l_suppkey = m.l_suppkey)
""")
def j17_missing_members(spark, sf_dir):
    """Which suppliers lack the asked parts."""
    li = table(spark, sf_dir, "lineitem")
    return jn.missing_members(li, "l_partkey", "l_suppkey", [1, 2, 3, 5, 8])


# ------------------------------------------------------------- J19 chain
@register("j19_chain", sql="""
SELECT 'by_type' AS child, event_type AS k, count(*) AS n FROM events WHERE value > 50 GROUP BY event_type
UNION ALL
SELECT 'by_day', strftime(ts, '%Y-%m-%d'), count(*) FROM events WHERE value > 50 GROUP BY strftime(ts, '%Y-%m-%d')
""")
def j19_chain(spark, sf_dir):
    base = table(spark, sf_dir, "events").filter(F.col("value") > 50)
    a, b = jn.chain(base,
                    lambda d: d.groupBy(F.col("event_type").alias("k")).agg(F.count(F.lit(1)).alias("n")),
                    lambda d: d.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("k")).agg(F.count(F.lit(1)).alias("n")))
    return (a.select(F.lit("by_type").alias("child"), "k", "n")
            .unionByName(b.select(F.lit("by_day").alias("child"), "k", "n")))


# ------------------------------------------------------------- U1-U6
@register("u1_set_ops", sql="""
SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL SELECT 'intersect', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL SELECT 'except', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL SELECT 'except_all', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
""")
def u1_set_ops(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    f = o.filter(F.col("o_orderstatus") == "F").select("o_custkey")
    op = o.filter(F.col("o_orderstatus") == "O").select("o_custkey")
    parts = [("union", jn.union_all(f, op)), ("intersect", jn.intersect(f, op)),
             ("except", jn.except_(f, op)), ("except_all", jn.except_(f, op, all=True))]
    out = None
    for name, d in parts:
        x = d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
        out = x if out is None else out.unionByName(x)
    return out


@register("u2_result_equivalence", sql="""
WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 100000),
b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice >= 100000.5),
ca AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM a GROUP BY ALL),
cb AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM b GROUP BY ALL),
j AS (SELECT coalesce(ca.n, 0) AS na, coalesce(cb.n, 0) AS nb FROM ca FULL JOIN cb
      ON ca.o_custkey = cb.o_custkey AND ca.o_orderstatus = cb.o_orderstatus)
SELECT CAST(sum(greatest(na - nb, 0)) AS BIGINT) AS only_a, CAST(sum(greatest(nb - na, 0)) AS BIGINT) AS only_b,
       sum(greatest(na - nb, 0)) = 0 AND sum(greatest(nb - na, 0)) = 0 AS equivalent
FROM j
""")
def u2_result_equivalence(spark, sf_dir):
    """Two variants of one query (> vs >= with a shifted bound) compared as
    multisets of rows."""
    o = table(spark, sf_dir, "orders")
    a = o.filter(F.col("o_totalprice") > 100000).select("o_custkey", "o_orderstatus")
    b = o.filter(F.col("o_totalprice") >= 100000.5).select("o_custkey", "o_orderstatus")
    return jn.result_equivalence(a, b)


@register("u3_minimal_diff", sql="""
WITH cur AS (SELECT DISTINCT c_nationkey AS target, c_mktsegment AS entry FROM customer WHERE c_acctbal > 5000),
des AS (SELECT DISTINCT c_nationkey AS target, replace(c_mktsegment, 'AUTOMOBILE', 'MOBILITY') AS entry FROM customer WHERE c_acctbal > 2000)
SELECT coalesce(cur.target, des.target) AS target, coalesce(cur.entry, des.entry) AS entry,
       CASE WHEN cur.entry IS NULL THEN 'add' WHEN des.entry IS NULL THEN 'remove' ELSE 'noop' END AS action
FROM cur FULL JOIN des ON cur.target = des.target AND cur.entry = des.entry
""")
def u3_minimal_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cur = c.filter(F.col("c_acctbal") > 5000).select(F.col("c_nationkey").alias("target"), F.col("c_mktsegment").alias("entry"))
    des = c.filter(F.col("c_acctbal") > 2000).select(
        F.col("c_nationkey").alias("target"), F.replace("c_mktsegment", F.lit("AUTOMOBILE"), F.lit("MOBILITY")).alias("entry"))
    return jn.minimal_diff(cur, des, ["entry"], target="target")


@register("u6_dedupe_urls", sql=r"""
WITH u AS (
  SELECT url, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) || '://' ||
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)) ||
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)?', 1) AS canonical_url
  FROM pages
  WHERE NULLIF(trim(regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1)), '') IS NOT NULL)
SELECT canonical_url, min(url) AS url, count(*) AS copies FROM u GROUP BY canonical_url
""")
def u6_dedupe_urls(spark, sf_dir):
    from ..operators.extract import extract_xml
    p = extract_xml(table(spark, sf_dir, "pages"), "html", {"title": "title"})
    return jn.dedupe_urls(p, "url", "title")


# ------------------------------------------------------------- W1-W9
@register("w1_latest_usable", sql="""
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_custkey DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1
""")
def w1_latest_usable(spark, sf_dir):
    """Latest non-pending order per customer (ties: greatest order key)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    x = o.withColumn("updated_at", F.lit(None).cast("timestamp_ntz")).withColumn("created_at", F.col("o_orderdate"))
    out = wn.latest_usable(x, "o_custkey", ("updated_at", "created_at"), usable="o_orderstatus <> 'P'",
                           tiebreak="o_orderkey")
    return out.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


@register("w2_first_failing_phase", sql="""
WITH grid AS (SELECT o.l_orderkey, ph.ln FROM (SELECT DISTINCT l_orderkey FROM lineitem) o,
                                              (SELECT unnest(range(1, 8)) AS ln) ph),
st AS (SELECT l_orderkey, l_linenumber AS ln, bool_and(l_linestatus = 'F') AS ok, min(l_linestatus) FILTER (WHERE l_linestatus <> 'F') AS bad
       FROM lineitem GROUP BY 1, 2),
f AS (SELECT g.l_orderkey, min(g.ln) FILTER (WHERE st.ok IS NULL OR NOT st.ok) AS ln FROM grid g
      LEFT JOIN st ON st.l_orderkey = g.l_orderkey AND st.ln = g.ln GROUP BY g.l_orderkey)
SELECT f.l_orderkey, 'line' || CAST(f.ln AS VARCHAR) AS first_failing_phase,
       CASE WHEN f.ln IS NULL THEN NULL ELSE coalesce(st.bad, 'missing') END AS failing_status
FROM f LEFT JOIN st ON st.l_orderkey = f.l_orderkey AND st.ln = f.ln
""")
def w2_first_failing_phase(spark, sf_dir):
    """Phases = line numbers 1-7 of an order; a line passes when its status
    is F; a missing line is a gap."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("phase"), "l_linestatus")
    return wn.first_failing_phase(li, "l_orderkey", "phase", "l_linestatus",
                                  [f"line{i}" for i in range(1, 8)], pass_value="F")


@register("w3_series_trend", sql="""
WITH b AS (SELECT event_type, date_trunc('day', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1, 2),
s AS (SELECT event_type, list(v ORDER BY bucket) AS pts, max(bucket) AS last FROM b GROUP BY 1)
SELECT event_type, array_to_string(list_transform(pts, lambda v: CAST(CAST(round(v) AS BIGINT) AS VARCHAR)), ' ') AS sparkline,
  round(pts[-1], 3) AS latest, round(pts[-1] - pts[-2], 3) AS trend, strftime(last, '%Y-%m-%d') AS latest_bucket
FROM s
""")
def w3_series_trend(spark, sf_dir):
    """The operator's own sparkline, latest value and trend."""
    t = wn.series_trend(table(spark, sf_dir, "events"), "ts", "value", ["event_type"], "1 day")
    shown = F.array_join(F.transform("sparkline", lambda v: F.round(v).cast("long").cast("string")), " ")
    return t.select("event_type", shown.alias("sparkline"), F.round("latest", 3).alias("latest"),
                    F.round("trend", 3).alias("trend"), F.date_format("latest_bucket", "yyyy-MM-dd").alias("latest_bucket"))


@register("w3_series_lag", sql="""
WITH b AS (SELECT user_id, date_trunc('day', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1, 2)
SELECT user_id, strftime(bucket, '%Y-%m-%d') AS bucket, round(v, 6) AS v,
       round(lag(v) OVER (PARTITION BY user_id ORDER BY bucket), 6) AS prev,
       round(v - lag(v) OVER (PARTITION BY user_id ORDER BY bucket), 6) AS delta
FROM b
""")
def w3_series_lag(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    out = wn.series_lag(e, "ts", "value", ["user_id"], "1 day")
    return rounded(out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd")))


@register("w4_running_count", bench=True, sql="""
SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "count"
FROM events
""")
def w4_running_count(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return wn.running_count(e, "ts", ["user_id"], ["event_id"]).select("event_id", "count")


@register("w6_eta", sql="""
WITH j AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'running' ELSE 'fetch' END AS mode,
         l_discount * 10 AS done_fraction, l_quantity AS rows, l_quantity * 2 AS total_rows, l_tax * 100 AS elapsed_seconds
  FROM lineitem),
k AS (
  SELECT *, least(greatest(coalesce(done_fraction, 0), 0), 1) AS frac,
         CASE WHEN elapsed_seconds > 0 THEN rows / elapsed_seconds ELSE 0.0 END AS rate FROM j)
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN mode = 'running' THEN frac * 100 ELSE CASE WHEN total_rows > 0 THEN least(rows / total_rows, 1) * 100 ELSE 0 END END, 6) AS percent,
  round(rate, 6) AS rate,
  round(CASE WHEN mode = 'running' THEN CASE WHEN frac > 0 AND frac < 1 AND elapsed_seconds > 0 THEN elapsed_seconds * (1 - frac) / frac ELSE 0 END
        ELSE CASE WHEN rate > 0 AND total_rows > rows THEN (total_rows - rows) / rate ELSE 0 END END, 6) AS eta_seconds,
  round(CASE WHEN mode = 'running' THEN CASE WHEN frac > 0 THEN rows / frac ELSE 0 END ELSE greatest(total_rows, rows) END, 6) AS estimated_total
FROM k
""")
def w6_eta(spark, sf_dir):
    """Line items read as progress samples: open lines are running jobs."""
    li = table(spark, sf_dir, "lineitem")
    x = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_linestatus") == "O", "running").otherwise("fetch").alias("mode"),
                  (F.col("l_discount") * 10).alias("done_fraction"), F.col("l_quantity").alias("rows"),
                  (F.col("l_quantity") * 2).alias("total_rows"), (F.col("l_tax") * 100).alias("elapsed_seconds"))
    out = wn.with_eta(x)
    return rounded(out.select("l_orderkey", "l_linenumber", "percent", "rate", "eta_seconds", "estimated_total"))


@register("w7_concurrency", sql="""
WITH inv AS (SELECT o_orderkey, o_orderdate AS s, o_orderdate + INTERVAL 45 DAY AS e FROM orders),
ev AS (SELECT o_orderkey, s AS t, 1 AS d, 1 AS is_start FROM inv UNION ALL SELECT o_orderkey, e, -1, 0 FROM inv)
SELECT o_orderkey, CAST(running AS BIGINT) AS concurrent FROM (
  SELECT o_orderkey, is_start, sum(d) OVER (ORDER BY t, is_start, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM ev) WHERE is_start = 1
""")
def w7_concurrency(spark, sf_dir):
    """Each order is an invocation running 45 days from its order date."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("s"),
                                              (F.col("o_orderdate") + F.expr("INTERVAL 45 DAY")).alias("e"))
    out = wn.concurrency(o, "s", "e", tiebreak=["o_orderkey"])
    return out.select("o_orderkey", "concurrent")


@register("w7_cadence", sql="""
WITH g AS (SELECT user_id, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events)
SELECT user_id, count(*) AS invocations, round(min(gap), 3) AS min_gap, round(avg(gap), 3) AS avg_gap, round(max(gap), 3) AS max_gap
FROM g GROUP BY user_id
""")
def w7_cadence(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return rounded(wn.cadence(e, "user_id", "ts"), 3)


@register("w8_state_runs", sql="""
WITH x AS (
  SELECT user_id, event_type, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
         - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS run
  FROM events)
SELECT user_id, event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS "start",
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS "end", count(*) AS length
FROM x GROUP BY user_id, event_type, run HAVING count(*) >= 2
""")
def w8_state_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    r = wn.state_runs(e, "user_id", "ts", "event_type", tiebreak=["event_id"], min_length=2)
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return r.select("user_id", "event_type", F.date_format("start", fmt).alias("start"),
                    F.date_format("end", fmt).alias("end"), "length")


# Rows with gaps, made by rule from the events: every 7th user id, every 11th
# time and every 5th state is unknown.
_GAPS = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type, value FROM events"""


def _gaps(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    blank = lambda c, n: F.when(F.col("event_id") % n != 0, F.col(c)).alias(c)
    return e.select("event_id", blank("user_id", 7), blank("ts", 11), blank("event_type", 5), "value")


@register("w4_running_count_gaps", sql=f"""
SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "count" FROM ({_GAPS})
""")
def w4_running_count_gaps(spark, sf_dir):
    return wn.running_count(_gaps(spark, sf_dir), "ts", ["user_id"], ["event_id"]).select("event_id", "count")


@register("w7_concurrency_open", sql="""
WITH inv AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS s,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 45 DAY END AS e FROM orders),
ev AS (SELECT o_orderkey, s AS t, 1 AS d, 1 AS is_start FROM inv WHERE s IS NOT NULL
  UNION ALL SELECT o_orderkey, e, -1, 0 FROM inv WHERE s IS NOT NULL AND e IS NOT NULL)
SELECT o_orderkey, CAST(running AS BIGINT) AS concurrent FROM (
  SELECT o_orderkey, is_start, sum(d) OVER (ORDER BY t, is_start, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM ev) WHERE is_start = 1
UNION ALL SELECT o_orderkey, NULL FROM inv WHERE s IS NULL
""")
def w7_concurrency_open(spark, sf_dir):
    """Open orders never ended; every 13th has no known start."""
    o = table(spark, sf_dir, "orders")
    inv = o.select("o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderdate")).alias("s"),
                   F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 45 DAY")).alias("e"))
    return wn.concurrency(inv, "s", "e", tiebreak=["o_orderkey"]).select("o_orderkey", "concurrent")


@register("w7_cadence_gaps", sql=f"""
WITH g AS (SELECT user_id, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST) AS gap FROM ({_GAPS}))
SELECT user_id, count(*) AS invocations, round(min(gap), 3) AS min_gap, round(avg(gap), 3) AS avg_gap, round(max(gap), 3) AS max_gap
FROM g GROUP BY user_id
""")
def w7_cadence_gaps(spark, sf_dir):
    return rounded(wn.cadence(_gaps(spark, sf_dir), "user_id", "ts"), 3)


@register("w8_state_runs_gaps", sql=f"""
WITH x AS (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)
    - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts NULLS FIRST, event_id) AS run FROM ({_GAPS}))
SELECT user_id, event_type, length, count(*) AS runs FROM (
  SELECT user_id, event_type, run, count(*) AS length FROM x GROUP BY ALL) GROUP BY ALL
""")
def w8_state_runs_gaps(spark, sf_dir):
    """Unknown users and unknown states form runs of their own."""
    r = wn.state_runs(_gaps(spark, sf_dir), "user_id", "ts", "event_type", tiebreak=["event_id"])
    return r.groupBy("user_id", "event_type", "length").agg(F.count(F.lit(1)).alias("runs"))


@register("j16_as_of_gaps", sql=f"""
WITH g AS ({_GAPS}),
v AS (SELECT user_id, date_trunc('hour', ts) AS t, max(event_id) AS vid FROM g
      WHERE event_type = 'view' AND user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL),
p AS (SELECT event_id, user_id, date_trunc('hour', ts) AS t FROM g WHERE event_type = 'purchase')
SELECT p.event_id, CAST(v.vid AS VARCHAR) AS obs_event_id FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.t >= v.t
""")
def j16_as_of_gaps(spark, sf_dir):
    """Decisions without user or time stay; views of the same hour tie and
    the greatest id is taken."""
    g = _gaps(spark, sf_dir).withColumn("t", F.date_trunc("hour", "ts"))
    out = jn.as_of(g.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "t"),
                   g.filter(F.col("event_type") == "view").select("user_id", "t", F.col("event_id").alias("vid")),
                   "user_id", "t", ["vid"])
    return out.select("event_id", F.col("obs_vid").cast("string").alias("obs_event_id"))


@register("w9_rank_hits", sql="""
SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT l_orderkey AS query_id, l_partkey AS doc_id, round(l_extendedprice, 6) AS score,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey) AS rank
  FROM lineitem) WHERE rank <= 3
""")
def w9_rank_hits(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("query_id"),
                                                 F.col("l_partkey").alias("doc_id"),
                                                 F.col("l_extendedprice").alias("score"))
    return rounded(wn.rank_hits(li, 3))


# ------------------------------------------------------------- A10-A14
@register("a10_rollup", sql="""
SELECT event_type, count(*) AS n, round(sum(value), 4) AS sum_value, round(min(value), 6) AS min_value,
       round(max(value), 6) AS max_value
FROM events GROUP BY event_type
""")
def a10_rollup(spark, sf_dir):
    """Rollup built for the data before 2024-01-20; later data is read raw
    (summaries_only=False); the answer equals the direct aggregate."""
    e = table(spark, sf_dir, "events")
    cut = "2024-01-20 00:00:00"
    roll = ru.build_rollup(e.filter(F.col("ts") < F.lit(cut).cast("timestamp_ntz")), "ts", ["event_type"], ["value"])
    out = ru.query_rollup(roll, e, "ts", ["event_type"], ["value"], covered_until=cut, summaries_only=False)
    return out.select("event_type", "n", F.round("sum_value", 4).alias("sum_value"),
                      F.round("min_value", 6).alias("min_value"), F.round("max_value", 6).alias("max_value"))


@register("a11_job_cost", sql="""
WITH per AS (
  SELECT l_orderkey AS search_id, CAST(sum(l_quantity) AS DOUBLE) AS scan_count, CAST(count(*) AS BIGINT) AS event_count,
         CAST(sum(l_linenumber) AS BIGINT) AS result_count, round(sum(l_extendedprice) / 1000, 6) AS run_seconds,
         arg_max(l_linenumber, (l_extendedprice, l_linenumber)) AS high_cost_stage
  FROM lineitem GROUP BY l_orderkey)
SELECT *, round(scan_count / result_count, 6) AS scan_to_result FROM per
ORDER BY run_seconds DESC, scan_count DESC, search_id LIMIT 25
""")
def a11_job_cost(spark, sf_dir):
    """Line items as stage records of a search (= order): quantity scanned,
    one event per line, line number as results, price/1000 as seconds."""
    li = table(spark, sf_dir, "lineitem")
    jobs = li.select(F.col("l_orderkey").alias("search_id"), F.col("l_linenumber").alias("stage"),
                     F.col("l_quantity").alias("scan_count"), F.lit(1).cast("long").alias("event_count"),
                     F.col("l_linenumber").cast("long").alias("result_count"),
                     (F.col("l_extendedprice") / 1000).alias("run_seconds"))
    per = ru.rank_job_cost(jobs)
    return rounded(ru.top_costly(per, 25))


@register("a12_peer_skew", sql="""
WITH pp AS (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS s FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, count(*) AS peers, round(max(s), 6) AS max_seconds, round(avg(s), 6) AS avg_seconds,
       round(stddev_samp(s), 6) AS stddev_seconds, round(max(s) / avg(s), 6) AS imbalance
FROM pp GROUP BY l_orderkey
""")
def a12_peer_skew(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return rounded(ru.peer_skew(li, "l_orderkey", "l_suppkey", "l_quantity"))


@register("a13_group_findings", sql="""
SELECT p_brand, p_type, count(DISTINCT p_partkey) AS n_findings, min(CAST(p_partkey AS VARCHAR)) AS first_finding, count(*) AS rows
FROM (SELECT p_partkey, CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS p_brand, p_type FROM part)
WHERE p_brand IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT NULL, p_type, 1, CAST(p_partkey AS VARCHAR), 1 FROM part WHERE p_size > 45
""")
def a13_group_findings(spark, sf_dir):
    return ru.group_findings(_findings(spark, sf_dir), ["p_brand", "p_type"])


def _findings(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("finding"),
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"), "p_type")


@register("a13_grouped_findings", sql="""
SELECT CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS p_brand, p_type, CAST(p_partkey AS VARCHAR) AS finding FROM part
""")
def a13_grouped_findings(spark, sf_dir):
    return ru.grouped_findings(_findings(spark, sf_dir), ["p_brand", "p_type"])


@register("a14_name_collisions", sql="""
SELECT p_brand AS object_type, p_type AS context, lower(n) AS name_key, count(*) AS occurrences,
       count(DISTINCT n) AS n_spellings, min(n) AS first_spelling
FROM (SELECT p_brand, p_type, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS n FROM part)
GROUP BY 1, 2, 3 HAVING count(*) > 1
""")
def a14_name_collisions(spark, sf_dir):
    """Every second part name is written in capitals."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("object_type"), F.col("p_type").alias("context"),
                                            name.alias("name"))
    return ru.name_collisions(p)


@register("j18_cidr_match", sql="""
WITH t AS (SELECT c_custkey, '10.' || CAST(c_nationkey AS VARCHAR) || '.' || CAST((c_custkey // 256) % 256 AS VARCHAR)
                  || '.' || CAST(c_custkey % 256 AS VARCHAR) AS ip FROM customer),
c AS (SELECT '10.' || CAST(n_nationkey AS VARCHAR) || '.0.0/' || CASE WHEN n_regionkey = 0 THEN '16' ELSE '20' END AS cidr,
             (10 * 16777216 + n_nationkey * 65536) AS lo,
             (10 * 16777216 + n_nationkey * 65536) + CASE WHEN n_regionkey = 0 THEN 65536 ELSE 4096 END - 1 AS hi
      FROM nation
      UNION ALL SELECT '10.0.0.0/8', 10 * 16777216, 11 * 16777216 - 1),
tn AS (SELECT c_custkey, ip, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
              + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS n FROM t)
SELECT tn.c_custkey, tn.ip, c.cidr FROM tn JOIN c ON tn.n BETWEEN c.lo AND c.hi
""")
def j18_cidr_match(spark, sf_dir):
    """Customers get addresses 10.<nation>.<key bytes>; every nation owns
    10.<nation>.0.0/16 (region 0) or /20, and 10.0.0.0/8 covers all."""
    c = table(spark, sf_dir, "customer")
    ip = F.concat_ws(".", F.lit("10"), F.col("c_nationkey").cast("string"),
                     F.pmod(F.floor(F.col("c_custkey") / 256), F.lit(256)).cast("string"),
                     F.pmod(F.col("c_custkey"), F.lit(256)).cast("string"))
    traffic = c.select("c_custkey", ip.alias("ip"))
    n = table(spark, sf_dir, "nation")
    cidrs = n.select(F.concat(F.lit("10."), F.col("n_nationkey").cast("string"), F.lit(".0.0/"),
                              F.when(F.col("n_regionkey") == 0, F.lit("16")).otherwise(F.lit("20"))).alias("cidr"))
    cidrs = cidrs.unionByName(spark.createDataFrame([("10.0.0.0/8",)], "cidr string"))
    return jn.cidr_match(traffic, "ip", cidrs).select("c_custkey", "ip", "cidr")


@register("u5_dedupe_tokens", sql=r"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS toks FROM documents),
w AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM t),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(tok) ORDER BY i) AS n FROM w)
SELECT t.doc_id, count(f.tok) AS n_unique, md5(coalesce(string_agg(f.tok, ' ' ORDER BY f.i), '')) AS tokens
FROM t LEFT JOIN f ON f.doc_id = t.doc_id AND f.n = 1 GROUP BY t.doc_id
""")
def u5_dedupe_tokens(spark, sf_dir):
    """Case-insensitive first-seen dedupe of every document's words; the
    whole list is compared by its digest."""
    d = table(spark, sf_dir, "documents")
    toks = F.regexp_extract_all(F.col("text"), F.lit(r"[\p{L}\p{N}]+"), 0)
    u = d.select("doc_id", jn.dedupe_tokens(toks).alias("u"))
    return u.select("doc_id", F.size("u").cast("long").alias("n_unique"), F.md5(F.array_join("u", " ")).alias("tokens"))


@register("a16_status_rollup", sql="""
WITH s AS (
  SELECT CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 401 WHEN 'view' THEN 200
                         WHEN 'signup' THEN 429 ELSE 418 END AS status_code FROM events),
c AS (
  SELECT CASE status_code WHEN 400 THEN 'bad_request' WHEN 401 THEN 'unauthorized' WHEN 403 THEN 'forbidden'
                          WHEN 429 THEN 'throttled' WHEN 500 THEN 'server_error' WHEN 503 THEN 'unavailable'
              ELSE CASE WHEN status_code BETWEEN 200 AND 299 THEN 'ok' WHEN status_code BETWEEN 400 AND 499 THEN 'client_error'
                        WHEN status_code BETWEEN 500 AND 599 THEN 'server_error' ELSE 'other' END END AS status_class
  FROM s)
SELECT status_class, count(*) AS responses,
       CASE status_class WHEN 'bad_request' THEN 'check event format and required fields'
                         WHEN 'unauthorized' THEN 'check the token'
                         WHEN 'forbidden' THEN 'check that the token is enabled and allowed for the index'
                         WHEN 'throttled' THEN 'reduce the send rate or add capacity'
                         WHEN 'server_error' THEN 'check receiver health'
                         WHEN 'unavailable' THEN 'check receiver health and queue capacity' END AS next_check
FROM c GROUP BY status_class
""")
def a16_status_rollup(spark, sf_dir):
    """Events read as delivery responses (event type -> HTTP status)."""
    e = table(spark, sf_dir, "events")
    code = (F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "click", 401)
            .when(F.col("event_type") == "view", 200).when(F.col("event_type") == "signup", 429).otherwise(418))
    return ru.status_rollup(e.select(code.alias("status_code")))
