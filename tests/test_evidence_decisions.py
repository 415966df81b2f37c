"""Evidence ledger (G) and decision tables (D): truth tables on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import decisions as dc
from quarry.operators import evidence as ev


def test_ledger_round_trip_conflicts_staleness(spark):
    wide = spark.createDataFrame([("o1", "ann", "app", None, "2026-01-01 00:00:00"),
                                  ("o1", "bob", "app", "r", "2026-02-01 00:00:00"),
                                  ("o2", None, "global", "w", "2026-02-01 00:00:00")],
                                 "name string, owner string, sharing string, acl string, t string") \
        .withColumn("t", F.col("t").cast("timestamp"))
    led = ev.to_ledger(wide, "name", source="export", observed_at="t")
    assert led.count() == 7       # nulls give no rows
    w = {r["object_id"]: r.asDict() for r in ev.from_ledger(led, ["owner", "sharing", "acl"]).collect()}
    assert w["o1"]["owner"] == "bob" and w["o2"]["owner"] is None and w["o2"]["acl"] == "w"
    c = ev.conflicts(led).collect()
    assert [(r["object_id"], r["field"], r["n_values"], r["first_value"], r["last_value"]) for r in c] == [
        ("o1", "owner", 2, "ann", "bob")]
    assert sorted({r["value"] for r in ev.conflicting_values(led).collect()}) == ["ann", "bob"]
    st = ev.mark_stale(led, "2026-02-10 00:00:00", "20 days")
    assert st.filter("stale").count() == 2
    assert ev.conflicts(st).count() == 0     # the old owner is stale: no current conflict
    miss = ev.missing_evidence(led, {"orphan": ["owner", "user_status"], "exposure": ["sharing", "acl"]})
    got = {(r["object_id"], r["decision"]): r["missing"] for r in miss.collect()}
    assert got[("o1", "orphan")] == ["user_status"] and got[("o1", "exposure")] == []
    assert got[("o2", "orphan")] == ["owner", "user_status"]
    lab = {r["source"]: r["evidence_label"] for r in ev.label_evidence(
        led.union(led.limit(1).withColumn("source", F.lit("documentation")))).collect()}
    assert lab == {"export": "observed", "documentation": "documented"}
    rep = ev.report_rows(led, missing=miss).filter("object_id = 'o2'").collect()[0]
    assert rep["unknowns"] == ["owner", "user_status"] and rep["n_facts"] == 2 and rep["next_step"] == "collect owner"
    assert ev.report_facts(led).filter("object_id = 'o2'").count() == 2
    decided = led.select("object_id").distinct().withColumn("next_step", F.lit("archive"))
    disputed = spark.createDataFrame([("o2", "owner")], "object_id string, field string")
    steps = {r["object_id"]: r["next_step"] for r in ev.report_rows(led, decided, None, disputed).collect()}
    assert steps.pop("o2") == "resolve owner" and set(steps.values()) <= {"archive"}
    assert {r["next_step"] for r in ev.report_rows(led).collect()} == {None}


def test_health_lanes(spark):
    checks = spark.createDataFrame([("c1", "Indexing queue blocked"), ("c2", "License warning"), ("c3", "weird")],
                                   "id string, check string")
    led = spark.createDataFrame([("c2", "pool", "p", "x", None), ("c2", "state", "w", "x", None)],
                                "object_id string, field string, value string, source string, observed_at timestamp")
    out = {r["id"]: r["lane"] for r in ev.health_lanes(checks).collect()}
    assert out == {"c1": "indexing", "c2": "license", "c3": "unmapped"}
    miss = {r["id"]: r["missing_evidence"] for r in ev.health_lanes(checks, ledger=led, id_col="id").collect()}
    assert miss["c2"] == ["capability", "usage", "warning_time"] and miss["c3"] == []


def test_exposure_status_truth_table(spark):
    rows = [
        (True, True, None, False, None, None, None, False, False, False, "Exposed"),
        (True, True, None, True, None, None, None, False, False, False, "Remediated"),
        (True, False, True, True, None, None, None, False, False, False, "Remediated"),
        (True, True, None, False, "accepted", True, "2099-01-01", False, False, False, "Excepted"),
        (True, True, None, False, "accepted", True, "2000-01-01", False, False, False, "Exposed"),
        (True, False, False, False, None, None, None, False, False, False, "Not exposed"),
        (True, True, None, False, None, None, None, True, False, False, "Unknown"),
        (True, True, None, False, None, None, None, False, True, False, "Unknown"),
        (False, True, None, False, None, None, None, False, False, False, "Unknown"),
        (True, True, None, False, None, None, None, False, False, True, "Unknown"),
        (True, None, None, None, None, None, None, False, False, False, "Unknown"),
    ]
    schema = ("matched boolean, affected boolean, previously_affected boolean, remediation_verified boolean, "
              "exception_status string, exception_in_scope boolean, exception_expiry string, stale boolean, "
              "conflict boolean, scanner_only boolean, expected string")
    out = dc.exposure_status(spark.createDataFrame(rows, schema), anchor="2026-06-01").collect()
    assert [r["exposure_status"] for r in out] == [r[-1] for r in rows]


def test_compatibility_and_readiness(spark):
    rows = [("compatible", True, False, None, None, "Compatible"),
            ("update_required", True, False, "2.0", None, "Update available"),
            ("incompatible", True, False, None, None, "Incompatible"),
            ("incompatible", True, False, None, "migrate", "Needs review"),
            ("compatible", False, False, None, None, "Needs review"),
            ("compatible", True, True, None, None, "Needs review"),
            (None, True, False, None, None, "Needs review")]
    df = spark.createDataFrame(rows, "verdict string, applicable boolean, stale boolean, alternative_version string, "
                                     "migration_path string, expected string")
    assert [r["compatibility"] for r in dc.compatibility_label(df).collect()] == [r[-1] for r in rows]
    ev_rows = [("c1", "pass", True, True), ("c1", "pass", True, True), ("c2", "fail", True, True),
               ("c3", "pass", True, False), ("c6", "pass", True, True), ("c6", "fail", True, False), ("c7", "pass", True, True), ("c7", None, True, True), ("c4", "pass", True, True), ("c4", "fail", True, True), ("c5", None, True, True)]
    e = spark.createDataFrame(ev_rows, "control string, result string, authoritative boolean, current boolean")
    got = {r["control"]: r["readiness"] for r in dc.control_readiness(e).collect()}
    assert got == {"c1": "pass", "c2": "fail", "c3": "unknown", "c4": "unknown", "c5": "unknown", "c6": "pass", "c7": "unknown"}


def test_go_no_go_dependency_recovery(spark):
    crit = [("p1", True, "met", "doc", False), ("p1", True, "met", "doc", False),
            ("p2", True, "met", "doc", False), ("p2", True, "blocker", "scan", False), ("p2", True, None, None, False),
            ("p3", True, "met", None, False), ("p4", True, "met", "doc", True)]
    c = spark.createDataFrame(crit, "plan string, mandatory boolean, status string, evidence string, conflict boolean")
    got = {r["plan"]: r["decision"] for r in dc.go_no_go(c).collect()}
    assert got == {"p1": "go", "p2": "no-go", "p3": "decision-blocked", "p4": "decision-blocked"}
    deps = spark.createDataFrame([("forwarders", True, False), ("premium products", None, True), ("apps and add-ons", None, None)],
                                 "group string, supported boolean, ruled_out boolean")
    assert [(r["result"], r["group_order"]) for r in dc.dependency_result(deps).collect()] == \
        [("compatible", 5), ("blocked", 3), ("unresolved", 4)]
    rec = spark.createDataFrame([(True, True, True), (None, True, False)],
                                "rollback_documented boolean, backup_evidenced boolean, restore_validated boolean")
    r = dc.recovery_status(rec).collect()
    assert r[0]["recovery_summary"] == "recovery evidenced" and r[1]["recovery_summary"] == "recovery readiness unconfirmed"
    assert r[1]["in_place_rollback"] == "unknown" and r[1]["protection"] == "evidenced"


def test_priority_lifecycle_change_cost_fit_stage(spark):
    objs = spark.createDataFrame([("confirmed", True, None, None), ("unconfirmed", True, None, True), (None, None, "broad_write", None)],
                                 "orphan_status string, scheduled boolean, exposure string, collision boolean")
    assert [r["priority"] for r in dc.governance_priority(objs).collect()] == ["higher", "medium", "higher"]
    o = spark.createDataFrame([("a",), ("b",), ("c",)], "object_id string")
    use = spark.createDataFrame([("a", dt.datetime(2026, 5, 1)), ("b", dt.datetime(2025, 1, 1))], "object_id string, last_used timestamp")
    deps = spark.createDataFrame([("b", 0), ("c", 2)], "object_id string, dependents int")
    got = {r["object_id"]: r["lifecycle"] for r in dc.lifecycle_candidates(o, use, deps, anchor="2026-06-01").collect()}
    assert got == {"a": "active", "b": "stale candidate", "c": "in use by dependents"}
    got2 = {r["object_id"]: r["lifecycle"] for r in dc.lifecycle_candidates(o, use, None, anchor="2026-06-01").collect()}
    assert got2 == {"a": "active", "b": "unconfirmed", "c": "unconfirmed"}
    none = dc.lifecycle_candidates(o, use.limit(0), deps.limit(0), anchor="2026-06-01").collect()
    assert {r["lifecycle"] for r in none} == {"unconfirmed"}
    ch = spark.createDataFrame([(0, [], False), (1, [], False), (0, ["owner"], False), (0, [], True), (None, None, None),
                                (0, None, False), (0, [], None), (None, [], True)],
                               "conflicts int, missing array<string>, prerequisite_failed boolean")
    assert [r["readiness"] for r in dc.change_readiness(ch).collect()] == [
        "ready", "blocked", "blocked", "not-ready", "blocked", "blocked", "blocked", "not-ready"]
    jobs = spark.createDataFrame([(3.0, None, None, None), (1.0, 20, None, None), (1.0, 1, 5.0, None), (1.0, 1, 600.0, 5000.0),
                                  (None, None, None, None)],
                                 "imbalance double, concurrent int, min_gap double, scan_to_result double")
    assert [r["cost_owner"] for r in dc.cost_owner(jobs).collect()] == ["platform", "workload", "invocation", "query", "unknown"]
    s = spark.createDataFrame([(1.0, True, 10, True), (0.5, True, 10, True), (None, True, 10, True), (1.0, True, 10**9, True)],
                              "coverage double, pruning boolean, cardinality long, qualified boolean")
    assert [r["acceleration_fit"] for r in dc.acceleration_fit(s).collect()] == \
        ["fit", "fails coverage", "missing coverage", "fails cardinality"]
    st = spark.createDataFrame([("p", 1, "9.0", "a1", True, True, True), ("p", 2, "9.1", "a1", True, True, True),
                                ("p", 3, "9.2", "a2", True, False, None),
                                ("q", 1, "9.0", "a1", True, True, True), ("q", 2, "9.1", "a1", True, True, False)],
                               "plan string, stage int, platform string, addon string, compatible boolean, completed boolean, threshold_met boolean")
    g = {r["plan"]: r["gate"] for r in dc.stage_gate(st, "plan", "stage", ["platform", "addon"]).collect()}
    assert g == {"p": "decision-blocked", "q": "decision-blocked"}
    ok = st.filter("stage < 3 AND plan = 'p'")
    assert {r["gate"] for r in dc.stage_gate(ok, "plan", "stage", ["platform", "addon"]).collect()} == {"ok"}
