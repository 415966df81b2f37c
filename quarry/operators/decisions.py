"""Decision tables (D1-D12): each is a first-match ``when`` chain over
evidence columns, or a small per-key aggregate feeding one.  Null means
"no evidence"; it is never read as false or as a pass.

Column contracts are stated per function; the values are the reference's
decision labels.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _true(c: str) -> Column:
    """Evidence says yes (null is not yes)."""
    return F.col(c) == F.lit(True)


def _false(c: str) -> Column:
    """Evidence says no (null is not no)."""
    return F.col(c) == F.lit(False)


# ------------------------------------------------------------------- D1
def exposure_status(df: DataFrame, anchor=None) -> DataFrame:
    """D1 Exposed / Not exposed / Remediated / Excepted / Unknown.

    Columns: ``matched`` (finding matched to inventory), ``affected``
    (environment within the affected condition), ``previously_affected``,
    ``remediation_verified``, ``exception_status`` ('accepted' ...),
    ``exception_in_scope``, ``exception_expiry``, ``stale``, ``conflict``,
    ``scanner_only`` (only a scanner CVE signal plus a role).
    Stale, conflicting, unmatched or scanner-only evidence -> Unknown; public
    affected-version facts alone never decide exposure.
    """
    cols = set(df.columns)

    def c(name):
        return F.col(name) if name in cols else F.lit(None)
    now = F.current_date() if anchor is None else F.lit(anchor).cast("date")
    exc_ok = (F.lower(c("exception_status")) == "accepted") & (c("exception_in_scope") == F.lit(True)) & \
        (c("exception_expiry").cast("date") >= now)
    status = (F.when((c("stale") == F.lit(True)) | (c("conflict") == F.lit(True)) | (c("matched") == F.lit(False))
                     | (c("scanner_only") == F.lit(True)), "Unknown")
              .when(((c("affected") == F.lit(True)) | (c("previously_affected") == F.lit(True)))
                    & (c("remediation_verified") == F.lit(True)), "Remediated")
              .when(exc_ok, "Excepted")
              .when(c("affected") == F.lit(True), "Exposed")
              .when((c("affected") == F.lit(False)) & ~F.coalesce(c("previously_affected") == F.lit(True), F.lit(False)),
                    "Not exposed")
              .otherwise("Unknown"))
    return df.withColumn("exposure_status", status)


# ------------------------------------------------------------------- D2
def compatibility_label(df: DataFrame) -> DataFrame:
    """D2 Compatible / Update available / Incompatible / Needs review; the
    first supported rule wins, labels never combine.

    Columns: ``verdict`` ('compatible', 'update_required',
    'incompatible'), ``applicable`` (app-specific, exact version and
    target), ``stale``, ``alternative_version`` (a version tested for the
    target), ``migration_path``.  Documentation silence is Needs review.
    """
    cols = set(df.columns)

    def c(name):
        return F.col(name) if name in cols else F.lit(None)
    usable = (c("applicable") == F.lit(True)) & ~F.coalesce(c("stale") == F.lit(True), F.lit(False))
    v = F.lower(c("verdict"))
    label = (F.when(usable & (v == "compatible"), "Compatible")
             .when(usable & (v == "update_required") & c("alternative_version").isNotNull(), "Update available")
             .when(usable & (v == "incompatible") & c("alternative_version").isNull()
                   & c("migration_path").isNull(), "Incompatible")
             .otherwise("Needs review"))
    return df.withColumn("compatibility", label)


# ------------------------------------------------------------------- D3
def control_readiness(evidence: DataFrame, control: str = "control") -> DataFrame:
    """D3 pass / fail / unknown per control.

    Evidence rows: ``result`` ('pass' | 'fail' | null), ``authoritative``,
    ``current``.  Only current authoritative rows count; stale or
    non-authoritative ones are context.  fail: some of them fail and none
    passes; pass: all of them pass; no such row, a row without a result, or
    a conflict: unknown.
    """
    good = _true("authoritative") & _true("current")
    r = F.lower(F.col("result"))
    agg = evidence.groupBy(control).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(good, 1).otherwise(0)).alias("counted"),
        F.sum(F.when(good & (r == "pass"), 1).otherwise(0)).alias("passes"),
        F.sum(F.when(good & (r == "fail"), 1).otherwise(0)).alias("fails"))
    status = (F.when((F.col("fails") > 0) & (F.col("passes") == 0), "fail")
              .when((F.col("passes") > 0) & (F.col("passes") == F.col("counted")), "pass")
              .otherwise("unknown"))
    return agg.withColumn("readiness", status).drop("counted")


# ------------------------------------------------------------------- D4
def go_no_go(criteria: DataFrame, plan: str = "plan") -> DataFrame:
    """D4 go / no-go / decision-blocked per plan.

    Criterion rows: ``mandatory``, ``status`` ('met' | 'blocker' | null),
    ``evidence`` (text; null = none), ``conflict``.  An evidenced blocker
    wins (no-go) over missing evidence (decision-blocked); go needs every
    mandatory criterion met with evidence.
    """
    st = F.lower(F.col("status"))
    has_ev = F.col("evidence").isNotNull() & ~F.coalesce(_true("conflict"), F.lit(False))
    agg = criteria.groupBy(plan).agg(
        F.sum(F.when((st == "blocker") & has_ev, 1).otherwise(0)).alias("blockers"),
        F.sum(F.when(_true("mandatory") & ~((st == "met") & has_ev).eqNullSafe(True), 1).otherwise(0)).alias("unproven"))
    decision = (F.when(F.col("blockers") > 0, "no-go")
                .when(F.col("unproven") > 0, "decision-blocked")
                .otherwise("go"))
    return agg.withColumn("decision", decision)


# ------------------------------------------------------------------- D5
# The dependency groups, in report order.
DEPENDENCY_GROUPS = ("platform and infrastructure", "topology and platform components", "premium products",
                     "apps and add-ons", "forwarders", "other deployment dependencies")


def dependency_result(deps: DataFrame) -> DataFrame:
    """D5 compatible / blocked / unresolved per dependency row, with the
    group's report position.  Columns: ``group``, ``supported`` (a current
    applicable source establishes the exact combination), ``ruled_out``."""
    order = F.create_map(*[x for i, g in enumerate(DEPENDENCY_GROUPS) for x in (F.lit(g), F.lit(i + 1))])
    res = (F.when(_true("ruled_out"), "blocked").when(_true("supported"), "compatible").otherwise("unresolved"))
    return deps.withColumn("result", res).withColumn("group_order", order[F.col("group")])


# ------------------------------------------------------------------- D6
def recovery_status(scopes: DataFrame) -> DataFrame:
    """D6 three separate answers per scope, never merged: in-place rollback
    documented; protections evidenced; restore validated.  Without backup
    and restore evidence the summary is 'recovery readiness unconfirmed'."""
    return (scopes
            .withColumn("in_place_rollback", F.when(_true("rollback_documented"), "supported")
                        .when(_false("rollback_documented"), "not supported").otherwise("unknown"))
            .withColumn("protection", F.when(_true("backup_evidenced"), "evidenced").otherwise("not evidenced"))
            .withColumn("restore", F.when(_true("restore_validated"), "validated").otherwise("not validated"))
            .withColumn("recovery_summary", F.when(_true("backup_evidenced") & _true("restore_validated"),
                                                   "recovery evidenced")
                        .otherwise("recovery readiness unconfirmed")))


# ------------------------------------------------------------------- D7
def governance_priority(objects: DataFrame) -> DataFrame:
    """D7 higher / medium / lower.  higher: confirmed orphan that is
    scheduled, broad evidenced write exposure, or a dependency-backed risk;
    medium: evidenced collision, unsupported ownership continuity, lookup
    gaps, recurring member differences with impact; else lower.  Unknowns
    never raise a priority."""
    cols = set(objects.columns)

    def c(name):
        return F.col(name) if name in cols else F.lit(None)
    higher = (((c("orphan_status") == "confirmed") & (c("scheduled") == F.lit(True)))
              | (c("exposure") == "broad_write") | (c("dependency_risk") == F.lit(True)))
    medium = ((c("collision") == F.lit(True)) | (c("ownership_gap") == F.lit(True))
              | (c("lookup_gap") == F.lit(True))
              | ((c("member_difference_recurring") == F.lit(True)) & (c("impact") == F.lit(True))))
    return objects.withColumn("priority", F.when(higher, "higher").when(medium, "medium").otherwise("lower"))


# ------------------------------------------------------------------- D8
def lifecycle_candidates(objects: DataFrame, usage: DataFrame | None, deps: DataFrame | None,
                         key: str = "object_id", last_used: str = "last_used", anchor=None,
                         stale_after: str = "90 days") -> DataFrame:
    """Lifecycle per object.  A recent use is ``active`` and a dependent
    is ``in use by dependents`` on its own evidence; ``stale candidate`` needs
    both a usage row and a dependency row for the object; anything less is
    ``unconfirmed``.

    ``usage``: (key, last_used) observations; ``deps``: (key, dependents)
    counts.  A table that is not given is evidence for no object.
    """
    out = objects
    if usage is not None:
        u = usage.groupBy(key).agg(F.max(last_used).alias("last_used"), F.lit(True).alias("__used"))
        out = out.join(u, key, "left")
    else:
        out = out.withColumn("last_used", F.lit(None).cast("timestamp")).withColumn("__used", F.lit(None).cast("boolean"))
    if deps is not None:
        d = deps.groupBy(key).agg(F.sum("dependents").alias("dependents"))
        out = out.join(d, key, "left")
    else:
        out = out.withColumn("dependents", F.lit(None).cast("long"))
    a = F.current_timestamp() if anchor is None else F.lit(anchor).cast("timestamp")
    recent = F.col("last_used").cast("timestamp") >= a - F.expr(f"INTERVAL {stale_after}")
    status = (F.when(F.coalesce(recent, F.lit(False)), "active")
              .when(F.coalesce(F.col("dependents"), F.lit(0)) > 0, "in use by dependents")
              .when(F.col("__used").isNotNull() & F.col("last_used").isNotNull() & F.col("dependents").isNotNull(),
                    "stale candidate")
              .otherwise("unconfirmed"))
    return out.withColumn("lifecycle", status).drop("__used")


# ------------------------------------------------------------------- D9
def change_readiness(changes: DataFrame) -> DataFrame:
    """D9 ready / not-ready / blocked per change.  blocked: a freeze or
    maintenance conflict (``conflicts`` > 0), missing evidence (``missing``
    non-empty), or any of the three columns unknown; not-ready: a failed
    prerequisite; ready only when all three are known and clear."""
    known = F.col("conflicts").isNotNull() & F.col("missing").isNotNull() & F.col("prerequisite_failed").isNotNull()
    open_ = (F.col("conflicts") > 0) | (F.size("missing") > 0)
    return changes.withColumn("readiness", F.when(F.coalesce(open_, F.lit(False)), "blocked")
                              .when(_true("prerequisite_failed"), "not-ready")
                              .when(~known, "blocked").otherwise("ready"))


# ------------------------------------------------------------------ D10
def cost_owner(jobs: DataFrame, imbalance_limit: float = 2.0, cadence_limit_s: float = 60.0,
               concurrency_limit: int = 10, scan_ratio_limit: float = 1000.0) -> DataFrame:
    """D10 platform / workload / invocation / query / unknown.  Platform and
    workload need deployment evidence (peer imbalance, resource pressure,
    concurrency); without any evidence a slow job stays unknown."""
    cols = set(jobs.columns)

    def c(name):
        return F.col(name) if name in cols else F.lit(None)
    owner = (F.when((c("imbalance") > imbalance_limit) | (c("resource_pressure") == F.lit(True)), "platform")
             .when(c("concurrent") > concurrency_limit, "workload")
             .when(c("min_gap") < cadence_limit_s, "invocation")
             .when(c("scan_to_result") > scan_ratio_limit, "query")
             .otherwise("unknown"))
    return jobs.withColumn("cost_owner", owner)


# ------------------------------------------------------------------ D11
def acceleration_fit(searches: DataFrame, min_coverage: float = 1.0, max_cardinality: int = 100_000) -> DataFrame:
    """Fit only when summary coverage, pruning, cardinality and
    qualification all hold; otherwise the first failing check is named
    (unknown inputs name themselves as missing)."""
    checks = [("coverage", F.col("coverage") >= min_coverage), ("pruning", _true("pruning")),
              ("cardinality", F.col("cardinality") <= max_cardinality), ("qualification", _true("qualified"))]
    reason = None
    for name, cond in checks:
        miss = cond.isNull()
        reason = (F.when(miss, F.lit(f"missing {name}")) if reason is None else reason.when(miss, F.lit(f"missing {name}")))
        reason = reason.when(~cond, F.lit(f"fails {name}"))
    return searches.withColumn("acceleration_fit", reason.otherwise(F.lit("fit")))


# ------------------------------------------------------------------ D12
def stage_gate(stages: DataFrame, plan: str, stage: str, dims: Sequence[str]) -> DataFrame:
    """A staged rollout is ``ok`` only when every stage changes exactly
    one dependency dimension from the previous stage, every combination
    has compatibility evidence (``compatible``) and every completed stage
    met its threshold; otherwise ``decision-blocked``.  Stages per plan are
    few, so the lag window per plan is small."""
    w = Window.partitionBy(plan).orderBy(stage)
    changed = sum((F.when(F.lag(d).over(w).isNull(), 0)
                   .when(~F.col(d).eqNullSafe(F.lag(d).over(w)), 1).otherwise(0) for d in dims), F.lit(0))
    first = F.row_number().over(w) == 1
    x = stages.withColumn("changed_dims", changed).withColumn("__first", first)
    row_ok = ((F.col("__first") | (F.col("changed_dims") == 1)) & _true("compatible")
              & (~_true("completed") | _true("threshold_met")))
    x = x.withColumn("stage_ok", row_ok)
    gate = x.groupBy(plan).agg(F.bool_and(F.coalesce(F.col("stage_ok"), F.lit(False))).alias("__all"))
    gate = gate.withColumn("gate", F.when(F.col("__all"), "ok").otherwise("decision-blocked")).drop("__all")
    return x.drop("__first").join(gate, plan)
