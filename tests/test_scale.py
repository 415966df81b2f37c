"""Awkward shapes: bursts, rows without a time, long ranges, deep chains, holes
in a rollup, deep pages, one job with most of the events."""

import random
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import blocks as bk
from quarry.operators import filters as fl
from quarry.operators import joins as jn
from quarry.operators import rollups as ru
from quarry.operators import windows as wn
from quarry.session import scratch_path
from quarry.streaming import streams as st


def bursts(spark, n=3000):
    """A third at one instant, a third without a time; one key holds half."""
    third = F.col("id") % 3
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.when(third == 0, F.lit(500.0)).when(third == 2, (F.col("id") * 37 % 1000).cast("double")).alias("t"),
        (F.col("id") % 5 < 2).alias("s"))


def test_blocks_are_even_and_in_order(spark):
    df = bursts(spark)
    for ties, flag in ((["id"], None), ([], None), (["id"], "f")):
        x = wn._with_block(df.withColumn("f", F.col("s").cast("int")), "t", 16, ties, flag)
        sizes = [r["count"] for r in x.groupBy("__blk").count().collect()]
        assert max(sizes) < 3 * 3000 / 16 and sum(sizes) == 3000
        order = ["t", *([flag] if flag else []), "__tie"]
        rows = x.orderBy(*[F.col(c).asc_nulls_first() for c in order]).select("__blk").collect()
        got = [r[0] for r in rows]
        assert got == sorted(got)


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_cuts_place_values_and_ends(spark, n):
    rng = random.Random(n)
    values = [rng.choice([None, 5.0, 5.0, float(rng.randint(-20, 20)), float("inf"), float("-inf")]) for _ in range(300)]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "v double, i double")
    cuts = bk.equi_depth(df, F.col("v"), F.col("i"), n)
    x = cuts.with_block(df, F.col("v"), F.col("i"), "b")
    x = cuts.with_block(x, F.col("v"), None, "lo")
    x = cuts.with_last_below(x, F.col("v"), "below")
    x = cuts.with_last_below(x, F.col("v"), "upto", inclusive=True)
    rows = [(float("-inf") if r["v"] is None else r["v"], r["i"], r["b"], r["lo"], r["below"], r["upto"])
            for r in x.where("v IS NOT NULL").collect()]
    assert all(0 <= r[2] < cuts.blocks for r in rows)
    for v, _, b, lo, below, upto in rows:
        assert lo <= b <= upto
        held = [r[2] for r in rows if r[0] < v]
        assert not held or max(held) <= below
        assert all(lo <= r[2] for r in rows if r[0] >= v)
        assert all(r[2] <= upto for r in rows if r[0] <= v)


def test_ordered_operators_on_bursts(spark):
    df = bursts(spark).cache()
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), "id")
    got = wn.running_count(df, "t", ["k"], ["id"], blocks=9).select("id", "count")
    assert got.exceptAll(df.select("id", F.row_number().over(w).cast("long").alias("count"))).isEmpty() and got.count() == 3000
    lag = wn.blocked_lag(df, ["k"], "t", F.col("id"), "before", ["id"], blocks=9).select("id", "before")
    assert lag.exceptAll(df.select("id", F.lag("id").over(w).alias("before"))).isEmpty()
    runs = wn.state_runs(df, "k", "t", "s", ["id"], blocks=9)
    new = F.when(F.lag("s").over(w) == F.col("s"), 0).otherwise(1)
    plain = df.withColumn("n", new).withColumn("r", F.sum("n").over(w)).groupBy("k", "s", "r").agg(F.count(F.lit(1)).alias("length"))
    count = lambda d: sorted(map(tuple, d.groupBy("k", "s", "length").count().collect()))
    assert count(runs) == count(plain)
    # a missing tie-break still gives whole runs: every ordinal once
    some = wn.running_count(df, "t", [], blocks=9)
    assert [r["count"] for r in some.orderBy("count").select("count").collect()] == list(range(1, 3001))
    df.unpersist()


def test_unkeyed_lag_of_a_series(spark):
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") * 7200).alias("ts"), F.col("id").cast("double").alias("v"))
    out = wn.series_lag(df, "ts", "v", (), "1 hour").orderBy("bucket").collect()
    assert [r["prev"] for r in out] == [None, *map(float, range(499))]


def test_merge_intervals(spark):
    rng = random.Random(4)
    rows = [(a, a + rng.randint(0, 30)) for a in (rng.randint(0, 3000) for _ in range(400))] + [(10, 2), (None, 5), (7, None), (5000, 9000), (6000, 6500)]
    got = sorted(map(tuple, wn.merge_intervals(spark.createDataFrame(rows, "start int, end int"), blocks=7).collect()))
    want = []
    for a, b in sorted((a, b) for a, b in rows if a is not None and b is not None and a <= b):
        if want and a <= want[-1][1]:
            want[-1] = (want[-1][0], max(want[-1][1], b))
        else:
            want.append((a, b))
    assert got == want


# ------------------------------------------------------------------ W5, X5
LOG = "job string, ts timestamp, phase string, state string, percent double, fetched long, written long, total long"


def progress_log(spark, n=2400):
    k = F.col("id") % 60
    return spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 11).cast("string")).alias("job"),
        F.timestamp_micros(F.col("id") * 1_700_000 + (F.col("id") % 97 == 0).cast("int") * 500_000).alias("ts"),
        F.when(k < 20, "search").when(k < 45, "fetch").otherwise("write").alias("phase"),
        F.when(F.col("id") % 180 == 70, "PAUSED").otherwise("RUNNING").alias("state"), (F.hash("id") % 101).cast("double").alias("percent"),
        (k * 20).alias("fetched"), (k * 17 % 1000).alias("written"), F.lit(1000).cast("long").alias("total"), F.col("id"))


def plain_rule(rows):
    """Kept ids by the rule as stated, one event after the other."""
    kept, last = [], None
    for r in rows:
        if last is None or (r["phase"], r["state"]) != (last["phase"], last["state"]):
            keep = True
        else:
            gain = r["percent"] - last["percent"]
            moved = {"fetch": "fetched", "write": "written"}.get(r["phase"])
            edge = bool(moved) and r["total"] > 0 and r[moved] != last[moved] and (r[moved] == 0 or r[moved] >= r["total"])
            keep = gain >= 10 or (r["percent"] >= 100 > last["percent"]) or edge or (r["ts"] - last["ts"]).total_seconds() >= 10
        if keep:
            kept.append(r["id"])
            last = r
    return kept


def test_thinning_by_segments_equals_the_rule(spark):
    df = progress_log(spark).cache()
    want = []
    for job in {r["job"] for r in df.select("job").distinct().collect()}:
        want += plain_rule(df.where(F.col("job") == job).orderBy("ts", "id").collect())
    got = wn.thin_progress(df, tiebreak=["id"], blocks=8)
    assert sorted(r["id"] for r in got.select("id").collect()) == sorted(want) and got.columns == df.columns
    # the hot job is cut into many segments, none of them large
    seg = wn.progress_segments(df, tiebreak=["id"], blocks=8).where("job = 'hot'").groupBy("__seg").count().collect()
    assert len(seg) > 50 and max(r["count"] for r in seg) < 0.05 * sum(r["count"] for r in seg)
    df.unpersist()


def test_streams_equal_batch(spark, tmp_path):
    df = progress_log(spark, 600).drop("id")
    src = str(tmp_path / "log")
    df.write.parquet(src)
    thin = st.drain(st.stream_thin_progress(spark.readStream.schema(df.schema).parquet(src)), "t-thin")
    want = wn.thin_progress(df)
    assert thin.exceptAll(want).isEmpty() and want.exceptAll(thin).isEmpty()


def test_deadline_streams(spark, tmp_path):
    at = lambda h: f"2024-01-01 {h:02d}:00:00"
    rows = [("a", at(0)), ("a", at(1)), ("a", at(6)), ("b", at(2)), ("c", at(11)), (None, at(0)), ("z", at(12))]
    df = spark.createDataFrame(rows, "client string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "in")
    df.coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema(df.schema).parquet(src)
    seen = lambda d: sorted((r["client"], r["last_seen"].hour) for r in d.collect())
    got = seen(st.drain(st.stream_overdue_clients(stream(), "client", "ts", 3600, 2, "1 hour"), "t-overdue"))
    assert got == [("a", 1), ("a", 6), ("b", 2)]
    assert got == seen(st.overdue_events(df, "client", "ts", 3600, 2, "2024-01-01 11:00:00"))
    gone = st.drain(st.stream_expirations(stream(), "client", "ts", "4 hours", "1 hour"), "t-expired")
    assert seen(gone) == [("a", 1), ("a", 6), ("b", 2)] and {r["expired_at"].hour for r in gone.collect()} == {5, 10, 6}


def test_unseen_keys_by_state_with_a_time_to_live(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "client string, n int")
    src = str(tmp_path / "in")
    df.coalesce(1).write.parquet(src)
    out = st.stream_unseen(spark.readStream.schema(df.schema).parquet(src), "client", "1 hour")
    q = (out.writeStream.format("memory").queryName("unseen").option("checkpointLocation", str(tmp_path / "c")).start())
    def batches_past(n):
        for _ in range(120):                                             # such a stream never reports that it is done
            if q.lastProgress and q.lastProgress["batchId"] >= n:
                return q.lastProgress["batchId"]
            time.sleep(0.5)
        raise AssertionError(q.status)
    try:
        done = batches_past(0)
        df.coalesce(1).write.mode("append").parquet(src)                 # the same keys again
        batches_past(done + 2)
        got = spark.table("unseen").collect()
    finally:
        q.stop()
    assert sorted(r["client"] for r in got) == ["a", "b"] and {tuple(r.asDict()) for r in got} == {("client", "n")}


# ------------------------------------------------------------------ joins
def brute(a, b, f):
    return sorted((x, y) for x in a for y in b if f(x, y))


def test_interval_conflicts_on_bursts_and_long_ranges(spark):
    rng = random.Random(2)
    def some(n, seed):
        r = random.Random(seed)
        rows = [(i, 500.0, 500.0 + r.randint(0, 3)) if i % 3 == 0 else
                (i, float(s := r.randint(0, 1000)), float(s + r.choice([0, 1, 5, 400]))) for i in range(n)]
        return rows + [(n, -1e6, 1e6), (n + 1, 700.0, 600.0), (n + 2, None, 5.0), (n + 3, 3.0, None)]
    a, b = some(90, 1), some(70, 2)
    schema = "id int, start double, end double"
    for blocks in (4, 30, 64):
        j = jn.interval_conflicts(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), blocks=blocks)
        got = sorted((r["a_id"], r["b_id"]) for r in j.collect())
        want = sorted((x[0], y[0]) for x in a for y in b if None not in x + y and x[1] < y[2] and y[1] < x[2])
        assert got == want
    pts = [(i, rng.choice([500.0, float(rng.randint(0, 1000)), None])) for i in range(300)]
    for inclusive in (True, False):
        j = jn.range_join(spark.createDataFrame(pts, "p int, x double"), "x", spark.createDataFrame(b, schema), "start", "end",
                          inclusive_hi=inclusive, blocks=20)
        want = sorted((p, y[0]) for p, x in pts for y in b if x is not None and None not in y
                      and y[1] <= x and (x <= y[2] if inclusive else x < y[2]))
        assert sorted((r["p"], r["id"]) for r in j.collect()) == want


def test_a_long_interval_costs_few_copies(spark):
    points = spark.range(20000).select(F.col("id").cast("double").alias("x"))
    wide = spark.createDataFrame([(0, -1.0, 1e9)], "id int, lo double, hi double")
    cuts = bk.equi_depth(points, F.col("x"), F.xxhash64("x").cast("double"), 256)
    met = jn._meet(points, wide, cuts, F.col("x"), F.xxhash64("x").cast("double"), F.col("lo"), F.col("hi"), True)
    assert met.count() == 20000
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_closure_of_a_chain_takes_few_rounds(spark):
    from pathlib import Path
    n = 1000
    chain = spark.range(n).select(F.col("id").alias("role"), (F.col("id") + 1).alias("inherits"))
    got = jn.role_closure(chain)
    assert got.count() == (n + 1) * (n + 2) // 2
    folder = re.sub(r"/round=.*", "", got.inputFiles()[0].replace("file://", ""))
    assert len(list(Path(folder).glob("round=*"))) <= 12


def test_closure_with_cycles_and_branches(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 25), rng.randint(0, 25)) for _ in range(40)] + [(30, None), (31, 30)]
    got = {(r["role"], r["ancestor"]) for r in jn.role_closure(spark.createDataFrame(edges, "role int, inherits int")).collect()}
    up: dict = {}
    for a, b in edges:
        up.setdefault(a, set()).update([] if b is None else [b])
        if b is not None:
            up.setdefault(b, set())
    want = set()
    for a in up:
        todo, seen = [a], {a}
        while todo:
            for c in up[todo.pop()] - seen:
                seen.add(c)
                todo.append(c)
        want |= {(a, c) for c in seen}
    assert got == want


def test_globs_meet_names_by_equality(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("abc.-") for _ in range(rng.randint(0, 9))) for _ in range(150)] + ["web01.prod", "db-7"]
    globs = ["".join(rng.choice("ab*?c.") for _ in range(rng.randint(1, 6))) for _ in range(120)] + ["*", "?", "", "*b*", "w*1*d", "??*"]
    clients = spark.createDataFrame(list(enumerate(names)), "client int, hostname string")
    rules = spark.createDataFrame([(g,) for g in globs], "pattern string")
    hits = jn._pattern_hits(clients, rules, "hostname")
    rx = {g: re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in g)) for g in globs}
    want = sorted((i, g) for i, n in enumerate(names) for g in set(globs) if rx[g].fullmatch(n))
    assert sorted((r["client"], r["pattern"]) for r in hits.collect()) == want
    classes = jn.match_classes(clients, spark.createDataFrame([
        ("global", None, None, "allow", "w*1*d"), ("global", None, None, "deny", "*-*"), ("class", "x", None, "allow", "*b*"),
        ("app", "x", "one", "allow", "?*"), ("app", "y", "two", "deny", "web*")],
        "level string, class string, app string, kind string, pattern string"))
    got = {(r["client"], r["class"], r["app"]) for r in classes.collect()}
    assert (150, "x", "one") in got and (150, "y", "two") not in got and not any(c == 151 for c, _, _ in got)
    for plan in (hits, classes):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_prefix_join_has_one_key_per_length(spark):
    rng = random.Random(6)
    ips = [f"{rng.randint(0, 3)}.{rng.randint(0, 3)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}" for _ in range(200)] + ["bad", None, "1.2.3.4.5"]
    nets = ["0.0.0.0/0", *{f"{'.'.join(ip.split('.'))}/{rng.randint(1, 32)}" for ip in ips[:60]}, "300.1.1.1/8", "1.1.1.1/33", "2.2.2.2"]

    def number(ip):
        p = ip.split(".") if ip else []
        return sum(int(x) << (24 - 8 * i) for i, x in enumerate(p)) if len(p) == 4 and all(x.isdigit() and int(x) < 256 for x in p) else None

    def holds(net, ip):
        base, _, bits = net.partition("/")
        a, b, n = number(base), number(ip), int(bits or 32)
        return a is not None and b is not None and n <= 32 and a >> (32 - n) == b >> (32 - n)

    t = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id int, ip string")
    c = spark.createDataFrame([(n,) for n in nets], "cidr string")
    want = sorted((i, n) for i, ip in enumerate(ips) for n in nets if holds(n, ip))
    assert sorted((r["id"], r["cidr"]) for r in jn.cidr_match(t, "ip", c).collect()) == want
    best = {r["id"]: r["network"] for r in jn.longest_prefix(t, "ip", c).collect()}
    for i in range(len(ips)):
        own = [n for j, n in want if j == i]
        top = max((int(n.partition("/")[2] or 32) for n in own), default=None)
        assert best[i] == (min(n for n in own if int(n.partition("/")[2] or 32) == top) if own else None)
    inside = lambda a, b: holds(b, a.partition("/")[0]) and int(b.partition("/")[2] or 32) <= int(a.partition("/")[2] or 32)
    good = [n for n in nets if holds(n, n.partition("/")[0])]
    got = sorted((r["a_cidr"], r["b_cidr"]) for r in jn.cidr_overlaps(c, c).collect())
    assert got == sorted((a, b) for a in good for b in good if inside(a, b) or inside(b, a))
    assert jn.cidr_match(t, "ip", spark.createDataFrame([("x",)], "cidr string")).count() == 0


def test_exploded_prefix_keys_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jn, "BROADCAST_ROWS", 0, raising=False)
    t = spark.createDataFrame([(i, f"10.1.2.{i}") for i in range(20)], "id int, ip string")
    c = spark.createDataFrame([("10.0.0.0/8",), ("10.1.2.0/28",), ("10.1.2.0/24",)], "cidr string")
    for m in (jn.cidr_match(t, "ip", c), jn.cidr_overlaps(c, c)):
        plan = m._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert jn.cidr_match(t, "ip", c).count() == 20 + 16 + 20


def test_longest_prefix_pairs_an_address_once_per_length(spark, monkeypatch):
    """200 texts of one /0 and 200 of one /8 are two networks."""
    pairs = []
    match = jn.cidr_match
    monkeypatch.setattr(jn, "cidr_match", lambda *a: pairs.append(match(*a)) or pairs[-1])
    t = spark.createDataFrame([(i, f"10.1.2.{i % 9}") for i in range(20)] + [(20, "11.0.0.1"), (21, None)], "id int, ip string")
    c = spark.createDataFrame([(f"10.0.{i}.1/{b}",) for i in range(200) for b in (0, 8)], "cidr string")
    got = {r["id"]: r["network"] for r in jn.longest_prefix(t, "ip", c).collect()}
    assert got == {**{i: "10.0.0.1/8" for i in range(20)}, 20: "10.0.0.1/0", 21: None}
    assert pairs[0].count() == 9 * 2 + 1


# ----------------------------------------------------------- A10, S4
@pytest.mark.parametrize("most", [1000, 1])
def test_rollup_with_holes(spark, most, monkeypatch):
    monkeypatch.setattr(ru, "MAX_RANGES", most)
    df = spark.range(2000).select(F.timestamp_seconds(F.col("id") * 400).alias("ts"), (F.col("id") % 3).alias("d"),
                                  (F.col("id") % 17).cast("double").alias("v"))
    roll = ru.build_rollup(df, "ts", ["d"], ["v"])
    wrong = roll.withColumn("n", F.col("n") + 1000)          # tells what the summaries were used for
    cover = spark.createDataFrame([(0, 36000), (30000, 72000), (72000, 100000), (180100, 360000), (500000, 400000)], "a long, b long") \
        .select(F.timestamp_seconds("a").alias("start"), F.timestamp_seconds("b").alias("end"))
    ranges = sorted((r["start"].timestamp(), r["end"].timestamp()) for r in ru.covered_ranges(cover).collect())
    assert ranges == [(0.0, 97200.0), (183600.0, 360000.0)]
    direct = df.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("sum_v"), F.min("v").alias("min_v"), F.max("v").alias("max_v"))
    got = ru.query_rollup(roll, df, "ts", ["d"], ["v"], coverage=cover, summaries_only=False)
    assert got.exceptAll(direct).isEmpty() and got.count() == 3
    used = ru.query_rollup(wrong, df, "ts", ["d"], ["v"], coverage=cover, summaries_only=False)
    extra = used.agg(F.sum("n")).first()[0] - 2000
    assert extra == 1000 * roll.where("bucket < '1970-01-02 03:00:00' OR bucket >= '1970-01-03 03:00:00' AND bucket < '1970-01-05 04:00:00'").count()
    only = ru.query_rollup(roll, None, "ts", ["d"], ["v"], coverage=cover)
    assert only.agg(F.sum("n")).first()[0] < 2000


def test_a_page_reads_only_its_parts(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 10).alias("v")).repartition(5)
    index = fl.build_page_index(df, [F.col("v").desc(), F.col("id")], scratch_path(spark, "pages"), parts=8)
    rows = [r["id"] for r in df.orderBy(F.col("v").desc(), "id").collect()]
    for limit, offset in ((100, 0), (100, 100), (700, 2400), (0, 4990), (10, 6000), (0, 0)):
        want = rows[offset:offset + limit] if limit else rows[offset:]
        assert [r["id"] for r in index.page(limit, offset).collect()] == want
    assert len(index.page(100, 100).inputFiles()) == 1                   # the second page of the order
    sliced = fl.slice_rows(df, [F.col("v").desc(), F.col("id")], limit=100, offset=4950, index=fl.open_page_index(spark, index.path)).collect()
    assert [r["id"] for r in sliced] == rows[4950:] and {(r["total"], r["has_more"]) for r in sliced} == {(5000, False)}
    with pytest.raises(ValueError):
        index.page(-1, 0)
    empty = fl.build_page_index(df.limit(0), ["id"], scratch_path(spark, "pages"), parts=3)
    assert empty.total == 0


def test_short_tag_lists_equal_a_table_of_rules(spark):
    from quarry.operators import extract as ex
    df = spark.createDataFrame([(1, "a", 5), (2, "b", None), (3, None, 7), (4, "a", 7)], "id int, x string, n int")
    rules = [("x", "a", "t1"), ("x", "a", "t0"), ("n", 7, "t1"), ("n", None, "t9"), ("y", "a", "t8"), ("x", "b", "t2")]
    tags = lambda d: {r["id"]: r["tag"] for r in d.collect()}
    got = tags(ex.add_tags(df, rules))
    as_table = spark.createDataFrame([(f, None if v is None else str(v), t) for f, v, t in rules], "field string, value string, tag string")
    assert got == tags(ex.add_tags(df, as_table)) == {1: ["t0", "t1"], 2: ["t2"], 3: ["t1"], 4: ["t0", "t1"]}
