"""Evidence ledger (G1-G8): one row per object, field, value, source and
observation time, and the generic rules every assessment shares.

Unknown is a value of its own here: no rule turns a missing or conflicting
observation into a finding, and nothing uses ``coalesce(x, false)`` on
evidence.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEDGER_COLUMNS = ("object_id", "field", "value", "source", "observed_at")


# --------------------------------------------------------------- G1, G2
def to_ledger(df: DataFrame, id_cols: Sequence[str] | str, source: str | Column = "inventory",
              observed_at: str | Column | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """G1: wide -> ledger.  Every non-id column becomes (field, value as
    text); absent (null) values produce no row.  ``object_id`` is the id
    column, or the ids joined with ``|`` when there are several."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    fields = [c for c in (fields or df.columns) if c not in ids and c != observed_at]
    oid = F.col(ids[0]).cast("string") if len(ids) == 1 else F.concat_ws("|", *[F.col(c).cast("string") for c in ids])
    src = F.lit(source) if isinstance(source, str) else source
    obs = F.lit(None).cast("timestamp") if observed_at is None else (
        F.col(observed_at) if isinstance(observed_at, str) else observed_at)
    base = df.select(oid.alias("object_id"), src.alias("source"), obs.alias("observed_at"),
                     *[F.col(f).cast("string").alias(f) for f in fields])
    long = base.unpivot(["object_id", "source", "observed_at"], fields, "field", "value")
    return long.filter(F.col("value").isNotNull()).select(*LEDGER_COLUMNS)


def latest_values(ledger: DataFrame) -> DataFrame:
    """Newest value per (object, field); ties by greatest value (max_by)."""
    return ledger.groupBy("object_id", "field").agg(
        F.max_by(F.col("value"), F.struct(F.col("observed_at"), F.col("value"))).alias("value"))


def from_ledger(ledger: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Ledger -> wide, newest value per field (ties: greatest value).

    With ``fields`` this is one aggregation per object: a conditional
    ``max_by`` per field (rows of other fields have a null ordering and are
    ignored), combined map-side - one shuffle.  Without ``fields`` the
    field names are discovered by a pivot over the newest values."""
    if fields:
        aggs = [F.max_by(F.when(F.col("field") == f, F.col("value")),
                         F.when(F.col("field") == f, F.struct(F.col("observed_at"), F.col("value")))).alias(f)
                for f in fields]
        return ledger.groupBy("object_id").agg(*aggs)
    latest = latest_values(ledger)
    return latest.groupBy("object_id").pivot("field").agg(F.first("value"))


# ------------------------------------------------------------------- G3
def missing_evidence(ledger: DataFrame, required: Mapping[str, Sequence[str]],
                     objects: DataFrame | None = None) -> DataFrame:
    """Per object and decision, the required fields with no observation.

    ``required`` maps decision -> fields (a small rule table, inlined as
    literals).  The observed fields of each object are a set bounded by the
    number of fields; missing = required minus observed.  Only the decision
    whose fields are missing is blocked.  ``objects`` (one column
    ``object_id``) adds objects with no evidence at all.
    """
    observed = ledger.groupBy("object_id").agg(F.collect_set("field").alias("__obs"))
    if objects is not None:
        observed = objects.select("object_id").distinct().join(observed, "object_id", "left") \
            .withColumn("__obs", F.coalesce(F.col("__obs"), F.array().cast("array<string>")))
    rules = F.array(*[F.struct(F.lit(d).alias("decision"), F.array(*[F.lit(f) for f in fs]).alias("fields"))
                      for d, fs in required.items()])
    x = observed.select("object_id", "__obs", F.explode(rules).alias("__r"))
    miss = F.array_sort(F.array_except(F.col("__r.fields"), F.col("__obs")))
    return x.select("object_id", F.col("__r.decision").alias("decision"), miss.alias("missing"),
                    (F.size(miss) > 0).alias("blocked"))


# ------------------------------------------------------------- G4, G5, G6
def conflicts(ledger: DataFrame, current_only: bool = True) -> DataFrame:
    """Object fields with more than one distinct value: how many, the
    first and the last value, and the number of sources.  With
    ``current_only``, stale rows (``stale`` column) are ignored.
    ``conflicting_values`` keeps every value."""
    return (_usable(ledger, current_only).groupBy("object_id", "field")
            .agg(F.count_distinct("value").alias("n_values"), F.min("value").alias("first_value"),
                 F.max("value").alias("last_value"), F.count_distinct("source").alias("n_sources"))
            .filter(F.col("n_values") > 1))


def conflicting_values(ledger: DataFrame, current_only: bool = True) -> DataFrame:
    """G4 (long form): every (object, field, value, source) in conflict."""
    keys = ["object_id", "field"]
    rows = _usable(ledger, current_only).select(*keys, "value", "source").distinct()
    return rows.join(conflicts(ledger, current_only).select(*keys), keys, "left_semi")


def _usable(ledger: DataFrame, current_only: bool) -> DataFrame:
    return ledger.filter(~F.col("stale")) if current_only and "stale" in ledger.columns else ledger


def mark_stale(ledger: DataFrame, anchor, horizon: str) -> DataFrame:
    """``stale`` when observed before ``anchor - horizon`` (e.g.
    ``"7 days"``); an unknown observation time is not stale, but not current
    either (``current`` is then null)."""
    a = anchor if isinstance(anchor, Column) else F.lit(anchor).cast("timestamp")
    cutoff = a - F.expr(f"INTERVAL {horizon}")
    t = F.col("observed_at").cast("timestamp")
    return ledger.withColumn("stale", F.coalesce(t < cutoff, F.lit(False))) \
                 .withColumn("current", F.when(t.isNotNull(), t >= cutoff))


# Source kinds and the evidence label each gives, unless the caller brings their own.
SOURCE_LABELS = {"live": "observed", "export": "observed", "inventory": "observed", "scan": "observed",
                 "documentation": "documented", "advisory": "documented", "release_notes": "documented",
                 "inference": "inferred", "heuristic": "inferred"}


def label_evidence(ledger: DataFrame, source_kind: str = "source", labels: Mapping[str, str] | None = None) -> DataFrame:
    """Observed / documented / inferred / missing.  A null value is
    ``missing``; a source kind that ``labels`` does not list is ``inferred``
    (never observed)."""
    m = F.create_map(*[x for k, v in (labels or SOURCE_LABELS).items() for x in (F.lit(k), F.lit(v))])
    label = F.when(F.col("value").isNull(), "missing") \
             .otherwise(F.coalesce(m[F.lower(F.col(source_kind))], F.lit("inferred")))
    return ledger.withColumn("evidence_label", label)


# ------------------------------------------------------------------- G7
def report_facts(ledger: DataFrame) -> DataFrame:
    """G7 (long form): the supported facts, one row per object, field, value
    and source."""
    return ledger.where(F.col("value").isNotNull()).select("object_id", "field", "value", "source").distinct()


def report_rows(ledger: DataFrame, decisions: DataFrame | None = None,
                missing: DataFrame | None = None, disputed: DataFrame | None = None) -> DataFrame:
    """One report row per object: how many supported facts it has
    (``report_facts`` lists them), its ``unknowns`` (missing fields over all
    decisions, as many as the rules name), the columns of ``decisions``
    (object_id, ..., perhaps ``next_step``) and the next step.

    A conflict comes first (``disputed``: object_id, field, as ``conflicts``
    gives them), then the first unknown, then the decision's own step; an
    object without any of them needs none (null)."""
    out = report_facts(ledger).groupBy("object_id").agg(F.count(F.lit(1)).alias("n_facts"))
    out = ledger.select("object_id").distinct().join(out, "object_id", "left").fillna(0, ["n_facts"])
    steps = []
    if disputed is not None:
        per = disputed.groupBy("object_id").agg(F.min("field").alias("__disputed"))
        out = out.join(per, "object_id", "left")
        steps.append(F.when(F.col("__disputed").isNotNull(), F.concat(F.lit("resolve "), F.col("__disputed"))))
    if missing is not None:
        # distinct fields first: their number is bounded by the rules
        unk = (missing.select("object_id", F.explode("missing").alias("field")).distinct()
               .groupBy("object_id").agg(F.array_sort(F.collect_list("field")).alias("unknowns")))
        out = out.join(unk, "object_id", "left").withColumn(
            "unknowns", F.coalesce("unknowns", F.array().cast("array<string>")))
        steps.append(F.when(F.size("unknowns") > 0, F.concat(F.lit("collect "), F.get("unknowns", 0))))
    if decisions is not None:
        d = decisions
        if "next_step" in d.columns:
            d = d.withColumnRenamed("next_step", "__step")
            steps.append(F.col("__step"))
        out = out.join(d, "object_id", "left")
    out = out.withColumn("next_step", F.coalesce(*steps) if steps else F.lit(None).cast("string"))
    return out.drop("__disputed", "__step")


# ------------------------------------------------------------------- G8
# Health lanes and the smallest evidence each needs.
HEALTH_LANES = {
    "indexing": ["check", "affected_component", "indexing_rate", "queue_trend", "time", "impact"],
    "search": ["check", "search_id", "scheduler_signal", "failure_count", "time", "impact"],
    "forwarder": ["check", "affected_count", "last_seen", "receiving_tier", "time_window"],
    "disk": ["node", "mount", "utilization", "check", "trend"],
    "license": ["pool", "state", "usage", "warning_time", "capability"],
    "memory": ["node", "process", "check", "memory_pressure", "restart_evidence"],
    "queues": ["node", "queue", "fill", "duration", "impact"],
    "security": ["indicator", "surface", "time", "message"],
    "workload_management": ["indicator", "pool_class", "saturation", "affected_searches", "time", "impact"],
}
# Check-name patterns mapped to a lane (first match wins), unless the caller brings their own.
LANE_PATTERNS = (
    ("(?i)index|ingest|parsing", "indexing"), ("(?i)search|scheduler|skipped", "search"),
    ("(?i)forwarder|tcpin|receiver", "forwarder"), ("(?i)disk|volume|space", "disk"),
    ("(?i)licen", "license"), ("(?i)memory|oom|swap", "memory"), ("(?i)queue|pipeline", "queues"),
    ("(?i)security|cert|tls|auth", "security"), ("(?i)workload|pool", "workload_management"),
)


def health_lanes(checks: DataFrame, check_col: str = "check", ledger: DataFrame | None = None,
                 id_col: str | None = None, patterns: Sequence[tuple[str, str]] = LANE_PATTERNS) -> DataFrame:
    """Lane per check (first matching of ``patterns``; else ``unmapped``), the
    smallest evidence that lane needs, and - with a ledger keyed by
    ``id_col`` - which of it is missing (G3)."""
    lane = None
    for pat, name in patterns:
        cond = F.col(check_col).rlike(pat)
        lane = F.when(cond, F.lit(name)) if lane is None else lane.when(cond, F.lit(name))
    lane = lane.otherwise(F.lit("unmapped"))
    need = F.create_map(*[x for k, v in HEALTH_LANES.items() for x in (F.lit(k), F.array(*[F.lit(f) for f in v]))])
    out = checks.withColumn("lane", lane).withColumn(
        "required_evidence", F.coalesce(need[F.col("lane")], F.array().cast("array<string>")))
    if ledger is not None:
        obs = ledger.groupBy("object_id").agg(F.collect_set("field").alias("__obs"))
        key = id_col or check_col
        out = out.join(obs, out[key].cast("string") == obs["object_id"], "left").drop("object_id")
        out = out.withColumn("missing_evidence", F.array_sort(F.array_except(
            "required_evidence", F.coalesce(F.col("__obs"), F.array().cast("array<string>"))))).drop("__obs")
    return out
