"""Pre-aggregated rollups and the job/peer/finding/name/status summaries
(A10-A14, A16, A17).  All are group-bys that combine map-side before the
shuffle; per-group lists are bounded by construction or by distinct values.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ------------------------------------------------------------------ A10
def build_rollup(df: DataFrame, ts: str, dims: Sequence[str], measures: Sequence[str],
                 span: str = "1 hour") -> DataFrame:
    """A10: the acceleration summary: per (bucket, dims) the row count and
    the sum / min / max of each measure (all re-aggregatable).  Write it
    partitioned by bucket day for pruning (``save_rollup``)."""
    bucket = F.window(F.col(ts).cast("timestamp"), span).start.alias("bucket")
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        aggs += [F.sum(m).alias(f"sum_{m}"), F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
    return df.groupBy(bucket, *dims).agg(*aggs)


def save_rollup(rollup: DataFrame, path: str) -> None:
    (rollup.withColumn("bucket_day", F.to_date("bucket"))
     .write.mode("overwrite").partitionBy("bucket_day").parquet(path))


MAX_RANGES = 1_000          # covered ranges that become a filter on the raw rows' time


def _span_micros(df: DataFrame, span: str) -> int:
    return df.sparkSession.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {span}"))).first()[0]


def covered_ranges(coverage: DataFrame, span: str = "1 hour") -> DataFrame:
    """(start, end) of the whole buckets that a table of covered intervals
    (start, end; half-open, in any order, overlapping or not) covers: merged,
    then shrunk to bucket bounds.  A bucket that is covered in part counts as
    not covered."""
    from .windows import merge_intervals
    width = _span_micros(coverage, span)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    merged = merge_intervals(coverage.select(F.col("start").cast("timestamp").alias("start"),
                                             F.col("end").cast("timestamp").alias("end")))
    # ceiling and floor in whole numbers
    first = -F.floor(-micros("start") / F.lit(width)) * width
    last = F.floor(micros("end") / F.lit(width)) * width
    return (merged.select(F.timestamp_micros(first.cast("long")).alias("start"), F.timestamp_micros(last.cast("long")).alias("end"))
            .where("start < end"))


def query_rollup(rollup: DataFrame, raw: DataFrame | None, ts: str, dims: Sequence[str],
                 measures: Sequence[str], span: str = "1 hour", covered_until=None,
                 summaries_only: bool = True, group: Sequence[str] | None = None,
                 coverage: DataFrame | None = None) -> DataFrame:
    """A10: answer ``count, sum, min, max`` by ``group`` from the rollup.

    ``summaries_only=True`` uses the rollup alone (uncovered time is simply
    absent).  ``False`` adds raw rows for the buckets that the rollup does not
    cover: they are rolled up with the same code and unioned before the final
    re-aggregation, so covered data is never counted twice.

    What is covered is every bucket before ``covered_until``, or the whole
    buckets inside the intervals of ``coverage`` (start, end), which may leave
    holes anywhere.  Up to ``MAX_RANGES`` covered ranges become a filter on the
    time column, which reaches the scan of the raw rows; more are joined by
    bucket.  Rows without a time are in no bucket and are not counted.
    """
    group = list(group if group is not None else dims)
    parts, fresh = rollup, raw
    at = F.col(ts).cast("timestamp")
    if coverage is not None:
        ranges = covered_ranges(coverage, span)
        listed = ranges.limit(MAX_RANGES + 1).collect()
        if len(listed) <= MAX_RANGES:
            def inside(c):
                out = F.lit(False)
                for r in listed:
                    out = out | ((c >= F.lit(r["start"])) & (c < F.lit(r["end"])))
                return out
            parts = parts.filter(inside(F.col("bucket")))
            fresh = fresh.filter(~inside(at)) if fresh is not None else None
        else:
            buckets = ranges.select(F.explode(F.sequence("start", F.col("end") - F.expr(f"INTERVAL {span}"),
                                                         F.expr(f"INTERVAL {span}"))).alias("bucket"))
            parts = parts.join(buckets, "bucket", "left_semi")
            if fresh is not None:
                fresh = (fresh.withColumn("bucket", F.window(at, span).start).join(buckets, "bucket", "left_anti")
                         .drop("bucket"))
    elif covered_until is not None:
        until = F.lit(covered_until).cast("timestamp")
        parts = parts.filter(F.col("bucket") < until)
        fresh = fresh.filter(at >= until) if fresh is not None else None
    if not summaries_only and fresh is not None:
        parts = parts.unionByName(build_rollup(fresh, ts, dims, measures, span))
    aggs = [F.sum("n").alias("n")]
    for m in measures:
        aggs += [F.sum(f"sum_{m}").alias(f"sum_{m}"), F.min(f"min_{m}").alias(f"min_{m}"),
                 F.max(f"max_{m}").alias(f"max_{m}")]
    return parts.groupBy(*group).agg(*aggs)


# ------------------------------------------------------------------ A11
def rank_job_cost(jobs: DataFrame, job: str = "search_id", stage: str = "stage",
                  scan: str = "scan_count", events: str = "event_count", results: str = "result_count",
                  runtime: str = "run_seconds", top_stages: int = 1) -> DataFrame:
    """Per search: total scan/event/result counts and runtime, the
    scan-to-result ratio, and the costliest stage (by runtime).  Ranked by
    runtime, then scan count.  The costliest stage is a ``max_by`` (no
    per-search window)."""
    per = jobs.groupBy(job).agg(
        F.sum(scan).alias("scan_count"), F.sum(events).alias("event_count"),
        F.sum(results).alias("result_count"), F.sum(runtime).alias("run_seconds"),
        F.max_by(F.col(stage), F.struct(F.col(runtime), F.col(stage))).alias("high_cost_stage"))
    per = per.withColumn("scan_to_result", F.when(F.col("result_count") > 0,
                                                  F.col("scan_count") / F.col("result_count")))
    return per


def top_costly(per_job: DataFrame, n: int, job: str = "search_id") -> DataFrame:
    """The ``n`` costliest searches (a top-k, TakeOrderedAndProject)."""
    return per_job.orderBy(F.col("run_seconds").desc(), F.col("scan_count").desc(), F.col(job)).limit(n)


# ------------------------------------------------------------------ A12
def peer_skew(df: DataFrame, job: str, peer: str, seconds: str) -> DataFrame:
    """Per job, timing spread across peers: max, avg, stddev and the
    max/avg imbalance ratio (per-peer totals first, then across peers)."""
    per_peer = df.groupBy(job, peer).agg(F.sum(seconds).alias("__s"))
    return per_peer.groupBy(job).agg(
        F.count(F.lit(1)).alias("peers"), F.max("__s").alias("max_seconds"),
        F.avg("__s").alias("avg_seconds"), F.stddev_samp("__s").alias("stddev_seconds")
    ).withColumn("imbalance", F.when(F.col("avg_seconds") > 0, F.col("max_seconds") / F.col("avg_seconds")))


# ------------------------------------------------------------------ A13
def group_findings(df: DataFrame, keys: Sequence[str], finding: str = "finding") -> DataFrame:
    """Group findings only by evidenced shared keys; a row with a null
    key never merges with others (it forms its own single group).  Per group:
    distinct findings, the first of them and the rows; ``grouped_findings``
    names them all."""
    keys = list(keys)
    evidenced = _all_known(keys)
    grouped = df.filter(evidenced).groupBy(*keys).agg(
        F.count_distinct(finding).alias("n_findings"), F.min(finding).alias("first_finding"),
        F.count(F.lit(1)).alias("rows"))
    singles = df.filter(~evidenced).select(
        *keys, F.col(finding).isNotNull().cast("long").alias("n_findings"), F.col(finding).alias("first_finding"),
        F.lit(1).cast("long").alias("rows"))
    return grouped.unionByName(singles)


def grouped_findings(df: DataFrame, keys: Sequence[str], finding: str = "finding") -> DataFrame:
    """A13 (long form): one row per group and distinct finding; rows with a
    null key stay apart."""
    keys = list(keys)
    evidenced = _all_known(keys)
    return (df.filter(evidenced).select(*keys, finding).distinct()
            .unionByName(df.filter(~evidenced).select(*keys, finding)))


def _all_known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


# ------------------------------------------------------------------ A14
def name_collisions(df: DataFrame, name: str = "name", scope: Sequence[str] = ("object_type", "context")) -> DataFrame:
    """Names that occur more than once (case-insensitively) within one
    object type and context, with the number of spellings and the first."""
    return (df.groupBy(*scope, F.lower(F.col(name)).alias("name_key"))
            .agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct(name).alias("n_spellings"),
                 F.min(name).alias("first_spelling"))
            .filter(F.col("occurrences") > 1))


# ------------------------------------------------------------------ A16
# Delivery status codes and what each means.
STATUS_CLASSES = (
    (400, "bad_request", "check event format and required fields"),
    (401, "unauthorized", "check the token"),
    (403, "forbidden", "check that the token is enabled and allowed for the index"),
    (429, "throttled", "reduce the send rate or add capacity"),
    (500, "server_error", "check receiver health"),
    (503, "unavailable", "check receiver health and queue capacity"),
)


def status_class(code: Column) -> Column:
    out = None
    for c, name, _ in STATUS_CLASSES:
        out = F.when(code == c, F.lit(name)) if out is None else out.when(code == c, F.lit(name))
    return (out.when(code.between(200, 299), F.lit("ok"))
               .when(code.between(400, 499), F.lit("client_error"))
               .when(code.between(500, 599), F.lit("server_error"))
               .otherwise(F.lit("other")))


def status_rollup(df: DataFrame, status: str = "status_code", by: Sequence[str] = ()) -> DataFrame:
    """Responses per status class (and optional keys) with the next
    check for the class."""
    spark = df.sparkSession
    checks = spark.createDataFrame([(n, chk) for _, n, chk in STATUS_CLASSES], "status_class string, next_check string")
    g = df.groupBy(*by, status_class(F.col(status)).alias("status_class")).agg(F.count(F.lit(1)).alias("responses"))
    return g.join(F.broadcast(checks), "status_class", "left")


# ------------------------------------------------------------------ A17
def hit_scope_counts(hits: DataFrame, scope: str = "match_scope", group: Sequence[str] = ("query_id",)) -> DataFrame:
    """Over a hit set: hits, context-only hits, context-assisted hits
    (context adds terms) and title-only hits."""
    s = F.col(scope)
    return hits.groupBy(*group).agg(
        F.count(F.lit(1)).alias("hits"),
        F.sum(F.when(s == "table_context", 1).otherwise(0)).alias("context_only"),
        F.sum(F.when(F.coalesce(F.col("context_adds_terms"), F.lit(False)) & (s != "table_context"), 1)
              .otherwise(0)).alias("context_assisted"),
        F.sum(F.when(s == "title", 1).otherwise(0)).alias("title_only"))
