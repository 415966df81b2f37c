"""Joins, set operations and window operators on literal rows, including a
skewed key and brute-force comparisons."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.operators import joins as jn
from quarry.operators import windows as wn


def test_range_join_matches_brute_force(spark):
    pts = spark.range(0, 500).select((F.col("id") * 1.7).alias("x"))
    rng = spark.createDataFrame([(0.0, 10.0, "a"), (5.0, 300.0, "b"), (299.0, 299.5, "c"), (900.0, 901.0, "d")],
                                "lo double, hi double, band string")
    got = sorted((r["x"], r["band"]) for r in jn.range_join(pts, "x", rng, "lo", "hi", width=20.0).collect())
    exp = sorted((r["x"], r["band"]) for r in pts.join(rng, (pts.x >= rng.lo) & (pts.x <= rng.hi)).collect())
    assert got == exp


def test_interval_conflicts_no_duplicates(spark):
    a = spark.createDataFrame([(1, 0.0, 100000.0), (2, 50.0, 60.0)], "id int, start double, end double")
    b = spark.createDataFrame([(10, 90000.0, 200000.0), (11, 55.0, 56.0)], "id int, start double, end double")
    got = sorted((r["a_id"], r["b_id"]) for r in jn.interval_conflicts(a, b, width_seconds=1000.0).collect())
    assert got == [(1, 10), (1, 11), (2, 11)]


def test_cidr(spark):
    t = spark.createDataFrame([("10.1.2.3",), ("10.2.0.1",), ("192.168.1.7",), ("bad",)], "ip string")
    c = spark.createDataFrame([("10.1.0.0/16",), ("10.0.0.0/8",), ("192.168.1.0/30",)], "cidr string")
    got = sorted((r["ip"], r["cidr"]) for r in jn.cidr_match(t, "ip", c).collect())
    assert got == [("10.1.2.3", "10.0.0.0/8"), ("10.1.2.3", "10.1.0.0/16"), ("10.2.0.1", "10.0.0.0/8")]
    ov = sorted((r["a_cidr"], r["b_cidr"]) for r in jn.cidr_overlaps(c, c).collect())
    assert ("10.0.0.0/8", "10.1.0.0/16") in ov and ("192.168.1.0/30", "10.0.0.0/8") not in ov


def test_orphans_acl_members(spark):
    objs = spark.createDataFrame([("o1", "ann"), ("o2", "bob"), ("o3", "cat"), ("o4", None)], "object_id string, owner string")
    users = spark.createDataFrame([("ann", True), ("bob", False)], "user string, active boolean")
    st = {r["object_id"]: r["orphan_status"] for r in jn.orphans(objs, users).collect()}
    assert st == {"o1": "not_orphaned", "o2": "confirmed", "o3": "confirmed", "o4": "unconfirmed"}
    acl = spark.createDataFrame([("o1", "admin,power", True, True), ("o2", "user", True, True)],
                                "object_id string, role string, can_read boolean, can_write boolean")
    o2 = objs.withColumn("sharing", F.when(F.col("object_id") != "o3", F.lit("app")))
    ex = {r["object_id"]: r["exposure"] for r in jn.acl_exposure(o2, acl).collect()}
    assert ex == {"o1": "restricted_write", "o2": "broad_write", "o3": "unknown", "o4": "unknown"}
    m = spark.createDataFrame([("k1", "m1", "x"), ("k1", "m2", "y"), ("k2", "m1", "x")], "obj string, member string, sum string")
    cm = {r["obj"]: (r["n_present"], r["n_missing"], r["variants"], r["consistent"])
          for r in jn.compare_members(m, "obj", "member", ["sum"]).collect()}
    assert cm == {"k1": (2, 0, 2, False), "k2": (1, 1, 1, False)}
    assert [tuple(r) for r in jn.missing_members(m, "obj", "member", ["k1", "k2"]).select("obj", "member").collect()] == [("k2", "m2")]
    twice = spark.createDataFrame([("ann", True), ("ann", False)], "user string, active boolean")
    assert jn.orphans(objs, twice).count() == objs.count()              # two user rows, one status


def test_effective_capabilities_with_cycle(spark):
    ug = spark.createDataFrame([("u1", "g1")], "user string, group string")
    gr = spark.createDataFrame([("g1", "r1")], "group string, role string")
    inh = spark.createDataFrame([("r1", "r2"), ("r2", "r3"), ("r3", "r1")], "role string, inherits string")
    caps = spark.createDataFrame([("r3", "delete"), ("r1", "read")], "role string, capability string")
    got = sorted(r["capability"] for r in jn.effective_capabilities(ug, gr, inh, caps).collect())
    assert got == ["delete", "read"]


def test_server_classes_deny_wins(spark):
    clients = spark.createDataFrame([(1, "web01"), (2, "web02-dev"), (3, "db01"), (4, "db100")],
                                    "client int, hostname string")
    rules = spark.createDataFrame([("global", None, None, "deny", "*-dev"), ("class", "web", None, "allow", "web*"),
                                   ("class", "db", None, "allow", "db*"),
                                   ("app", "web", "nginx", "allow", "*"), ("app", "db", "pg", "allow", "db??")],
                                  "level string, class string, app string, kind string, pattern string")
    got = sorted((r["client"], r["class"], r["app"]) for r in jn.match_classes(clients, rules).collect())
    assert got == [(1, "web", "nginx"), (3, "db", "pg")]


def test_server_class_patterns(spark):
    """Every glob shape against a plain regex."""
    import re
    names = ["web01", "web", "w", "", "db.web", "xweby", "a*b", "axb", "web01.example"]
    clients = spark.createDataFrame(list(enumerate(names)), "client int, hostname string")
    globs = ["*", "web*", "*web", "*web*", "web01", "w?b", "a*b", "*.example", "we*1", "", "?"]
    rules = spark.createDataFrame([(g,) for g in globs], "pattern string")
    rx = {g: re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in g)) for g in globs}
    want = {(n, g) for n in names for g in globs if rx[g].fullmatch(n)}
    got = [(r["hostname"], r["pattern"]) for r in jn._pattern_hits(clients, rules, "hostname").collect()]
    assert set(got) == want and len(got) == len(want)


def test_ordered_operators_keep_null_rows(spark):
    rows = [(1, "a", 10), (2, "a", None), (3, None, 5), (4, None, 7), (5, "a", 12)]
    df = spark.createDataFrame(rows, "id int, k string, t int")
    got = {r["id"]: r["count"] for r in wn.running_count(df, "t", ["k"], ["id"], blocks=3).collect()}
    assert got == {2: 1, 1: 2, 5: 3, 3: 1, 4: 2}
    inv = spark.createDataFrame([(1, 0, None), (2, 1, None), (3, 2, 9), (4, 3, None), (5, None, 4)], "id int, s int, e int")
    got = {r["id"]: r["concurrent"] for r in wn.concurrency(inv, "s", "e", ["id"], blocks=3).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: None}
    obs = spark.createDataFrame([("k", 1, "up"), ("k", 2, None), ("k", 3, None), ("k", 4, "up"), (None, 1, "up")],
                                "k string, t int, s string")
    runs = {(r["k"], r["s"], r["start"], r["length"]) for r in wn.state_runs(obs, "k", "t", "s", blocks=2).collect()}
    assert runs == {("k", "up", 1, 1), ("k", None, 2, 2), ("k", "up", 4, 1), (None, "up", 1, 1)}
    dec = spark.createDataFrame([(1, "k", 5), (2, "k", None), (3, None, 5), (4, "z", 5), (5, "k", 2)], "did int, k string, t int")
    seen = spark.createDataFrame([("k", 2, 20), ("k", 2, 21), ("k", None, 99), (None, 1, 98)], "k string, t int, v int")
    got = {r["did"]: r["obs_v"] for r in jn.as_of(dec, seen, "k", "t", ["v"], blocks=3).collect()}
    assert got == {1: 21, 2: None, 3: None, 4: None, 5: 21}
    gaps = {r["k"]: (r["invocations"], r["min_gap"], r["max_gap"]) for r in wn.cadence(df, "k", "t", blocks=2).collect()}
    assert gaps == {"a": (3, 2.0, 2.0), None: (2, 2.0, 2.0)}


def test_secrets_are_found_raw(spark):
    from quarry.operators import filters as fl
    rows = [(1, 'x "q\\b" y', {"k": "v"}), (2, "plain", {"tok-77": "v"}), (3, None, None), (4, "s1", {"k": "zz"})]
    df = spark.createDataFrame(rows, "id int, t string, m map<string,string>")
    for secrets in (['"q\\b"', "tok-77", "zz"], [], ["", "1\",\"t"]):
        s = spark.createDataFrame([(x,) for x in secrets], "secret string")
        got = {r["id"]: r["has_secret"] for r in fl.flag_secret_rows(df, s, max_bytes=6).collect()}
        assert got == ({1: True, 2: True, 3: False, 4: True} if len(secrets) == 3 else dict.fromkeys((1, 2, 3, 4), False))


def test_set_ops_and_diff(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    r = jn.result_equivalence(a, b).collect()[0]
    assert (r["only_a"], r["only_b"], r["equivalent"]) == (2, 1, False)
    assert jn.result_equivalence(a, a).collect()[0]["equivalent"]
    d = {r["k"]: r["action"] for r in jn.minimal_diff(a, b, ["k"]).collect()}
    assert d == {1: "noop", 2: "remove", 3: "add"}
    toks = spark.createDataFrame([(["Foo", "bar", "FOO", " ", "Bar", "baz"],)], "t array<string>")
    assert toks.select(jn.dedupe_tokens("t")).collect()[0][0] == ["Foo", "bar", "baz"]


def test_blocked_running_count_with_hot_key_equals_window(spark):
    # one key holds 60% of the rows
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 5 < 3, F.lit(0)).otherwise(F.col("id") % 7).alias("k"),
        (F.col("id") * 37 % 1000).cast("double").alias("t"), F.col("id"))
    got = wn.running_count(df, "t", ["k"], ["id"], blocks=5)
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.withColumn("count", F.row_number().over(w))
    assert got.select("id", "count").exceptAll(exp.select("id", "count")).count() == 0
    assert got.count() == 3000


def test_as_of_matches_brute_force(spark):
    dec = spark.range(0, 200).select((F.col("id") % 3).alias("k"), (F.col("id") * 13 % 500).cast("double").alias("t"),
                                     F.col("id").alias("did"))
    obs = spark.range(0, 120).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 480).cast("double").alias("t"),
                                     (F.col("id") * 10).alias("v"))
    got = {r["did"]: r["obs_v"] for r in jn.as_of(dec, obs, "k", "t", ["v"], blocks=7).collect()}
    o = obs.collect()
    for r in dec.collect():
        cands = [x for x in o if x["k"] == r["k"] and x["t"] <= r["t"]]
        best = max(cands, key=lambda x: (x["t"], x["v"]))["v"] if cands else None
        if cands and sum(1 for x in cands if x["t"] == max(c["t"] for c in cands)) > 1:
            continue   # equal observation times: any of them is newest
        assert got[r["did"]] == best


def test_concurrency_and_state_runs(spark):
    inv = spark.createDataFrame([(1, 0.0, 10.0), (2, 5.0, 15.0), (3, 10.0, 12.0), (4, 20.0, 21.0)], "id int, s double, e double")
    got = {r["id"]: r["concurrent"] for r in wn.concurrency(inv, "s", "e", ["id"], blocks=6).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 1}
    obs = spark.createDataFrame([("a", 1.0, "down"), ("a", 2.0, "down"), ("a", 3.0, "up"), ("a", 4.0, "down")],
                                "k string, t double, s string")
    runs = sorted((r["s"], r["length"]) for r in wn.state_runs(obs, "k", "t", "s", blocks=4).collect())
    assert runs == [("down", 1), ("down", 2), ("up", 1)]


def test_latest_first_failing_trend(spark):
    df = spark.createDataFrame([("k", 1, None, "2026-01-01"), ("k", 2, "2026-01-03", "2026-01-01"), ("", 3, None, "2026-02-01")],
                               "key string, id int, updated_at string, created_at string")
    r = wn.latest_usable(df, "key", tiebreak="id").collect()
    assert len(r) == 1 and r[0]["id"] == 2
    ph = spark.createDataFrame([("o1", "a", "pass"), ("o1", "b", None), ("o2", "a", "pass"), ("o2", "c", "fail"),
                                ("o3", "a", "pass"), ("o3", "b", "pass"), ("o3", "c", "pass")], "obj string, p string, s string")
    got = {r["obj"]: (r["first_failing_phase"], r["failing_status"]) for r in
           wn.first_failing_phase(ph, "obj", "p", "s", ["a", "b", "c"]).collect()}
    assert got == {"o1": ("b", "unknown"), "o2": ("b", "missing"), "o3": (None, None)}
    ser = spark.createDataFrame([("2026-01-01 01:00:00", 1.0), ("2026-01-02 01:00:00", 3.0), ("2026-01-02 05:00:00", 4.0)],
                                "ts string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    t = wn.series_trend(ser, "ts", "v").collect()[0]
    assert t["sparkline"] == [1.0, 7.0] and t["latest"] == 7.0 and t["trend"] == 6.0


PROGRESS = "job string, ts string, phase string, state string, percent double, fetched long, written long, total long"


def test_thin_progress_rule(spark):
    rows = [(0, "search", "RUN", 0.0, 0, 0, True), (1, "search", "RUN", 5.0, 0, 0, False), (2, "search", "RUN", 9.0, 0, 0, False),
            (3, "search", "RUN", 11.0, 0, 0, True), (4, "search", "HOLD", 11.0, 0, 0, True), (5, "fetch", "HOLD", 12.0, 0, 0, True),
            (6, "fetch", "HOLD", 12.0, 40, 0, False), (7, "fetch", "HOLD", 12.0, 100, 0, True), (8, "fetch", "HOLD", 12.0, 100, 0, False),
            (17, "fetch", "HOLD", None, 100, 0, True), (18, "write", "HOLD", 95.0, 100, 5, True), (19, "write", "HOLD", 100.0, 100, 6, True),
            (20, "write", "HOLD", 100.0, 100, 7, False), (21, "write", "HOLD", 90.0, 100, 100, True),
            (22, "write", "HOLD", 100.0, 100, 100, True), (23, "write", "HOLD", 100.0, 100, 0, True)]
    data = [(j, f"2026-01-01 00:00:{t:02d}", ph, st, pc, f, w, 100) for j in ("a", "b", None) for t, ph, st, pc, f, w, _ in rows]
    df = spark.createDataFrame(data, PROGRESS).withColumn("ts", F.col("ts").cast("timestamp"))
    want = [t for t, *_, keep in rows if keep]
    for job in ("a", "b", None):
        got = wn.thin_progress(df).filter(F.col("job").eqNullSafe(job)).select(F.second("ts").alias("s")).collect()
        assert sorted(r["s"] for r in got) == want


def test_as_of_with_hot_key_matches_pandas(spark):
    import pandas as pd
    dec = spark.range(0, 2000).select(
        F.when(F.col("id") % 5 < 3, F.lit(0)).otherwise(F.col("id") % 4).alias("k"),
        ((F.col("id") * 7919) % 100000).cast("double").alias("t"), F.col("id").alias("did"))
    obs = spark.range(0, 1500).select(
        F.when(F.col("id") % 5 < 3, F.lit(0)).otherwise(F.col("id") % 4).alias("k"),
        ((F.col("id") * 104729 + 3) % 100000 + 0.5).cast("double").alias("t"), (F.col("id") * 10).alias("v"))
    got = {r["did"]: r["obs_v"] for r in jn.as_of(dec, obs, "k", "t", ["v"], blocks=8).collect()}
    d = dec.toPandas().sort_values("t")
    o = obs.toPandas().sort_values("t")
    exp = pd.merge_asof(d, o, on="t", by="k", direction="backward")
    for did, v in zip(exp["did"], exp["v"]):
        assert (got[did] is None and pd.isna(v)) or got[did] == v


def test_segments_of_a_progress_log_are_thinned_together():
    """The same events are kept as one segment after the other keeps."""
    import random
    rng = random.Random(3)
    n, lengths = 0, [1, 2, 40, 3, 7, 7, 1, 25, 300, 5, 60, 2]
    cuts = [0]
    for k in lengths:
        cuts.append(cuts[-1] + k)
    n = cuts[-1]
    rule = wn.ProgressRule([i * 2_000_000 for i in range(n)], [rng.choice(["search", "fetch", "write", None]) for _ in range(n)],
                           ["RUNNING"] * n, [rng.randint(0, 104) for _ in range(n)], [rng.choice([0, 5, 10, None]) for _ in range(n)],
                           [rng.choice([0, 10]) for _ in range(n)], [10] * n)
    for before in (None, rule.event(0)):
        want, last = [], before
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            kept, last = rule.keep(lo, hi, before if i == 0 else None)
            want.extend(kept.tolist())
        flags, left = rule.keep_each(cuts, before)
        assert flags.tolist() == want and left == last
    assert rule.keep_each([0, 3], None)[0].tolist() == rule.keep(0, 3, None)[0].tolist()
