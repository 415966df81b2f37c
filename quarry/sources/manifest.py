"""Saved-result manifest as a table (M1, M4, M5, M6).

One row per saved result table; warnings are an ``array<struct>`` column,
not JSON text, and every operation is a column expression over that array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warning codes, the broad-fetch row threshold, retention age.
WARNING_LEGACY = "legacy"
WARNING_FULL_FETCH = "full_fetch"
BROAD_FETCH_ROWS = 10_000
DEFAULT_RETENTION = "24 hours"
DEFAULT_LIST_LIMIT = 100

WARNING_TYPE = T.ArrayType(T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("accepted", T.BooleanType()),
    T.StructField("accepted_at", T.LongType()),
]))
MANIFEST_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("app", T.StringType()),
    T.StructField("sid", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("earliest", T.StringType()),
    T.StructField("latest", T.StringType()),
    T.StructField("result_count", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("has_more", T.BooleanType()),
    T.StructField("run_duration", T.DoubleType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("warnings", WARNING_TYPE),
])


def manifest_row(spark: SparkSession, table_name: str, **meta) -> DataFrame:
    """One manifest row (unknown fields null, no warnings)."""
    row = {f.name: meta.get(f.name) for f in MANIFEST_SCHEMA.fields}
    row["table_name"] = table_name
    row["warnings"] = [dict(w) for w in (meta.get("warnings") or [])]
    return spark.createDataFrame([row], MANIFEST_SCHEMA)


# ------------------------------------------------------------------ M1
def list_results(manifest: DataFrame, limit: int | None = DEFAULT_LIST_LIMIT, table: str | None = None) -> DataFrame:
    """M1: newest first (created_at desc, then table_name), with the UTC
    creation time as text, warning counts and - with a limit - the
    ``truncated`` flag.  ``table`` narrows to one table (result info)."""
    from ..operators.summary import limit_flagged
    m = manifest if table is None else manifest.filter(F.col("table_name") == table)
    w = normalize_warnings(F.col("warnings"))
    m = (m.withColumn("warnings", w)
          .withColumn("created_at_utc", F.date_format(F.timestamp_seconds("created_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
          .withColumn("warning_count", F.size(F.filter(w, lambda x: ~x["accepted"])))
          .withColumn("accepted_warning_count", F.size(F.filter(w, lambda x: x["accepted"]))))
    order = [F.col("created_at").desc_nulls_last(), F.col("table_name").asc()]
    return limit_flagged(m, limit, order) if limit else m.orderBy(*order)


# ------------------------------------------------------------------ M4
def expired_results(manifest: DataFrame, anchor_epoch: int | Column, age: str = DEFAULT_RETENTION) -> DataFrame:
    """M4: tables created before ``anchor - age``; the caller deletes them."""
    a = anchor_epoch if isinstance(anchor_epoch, Column) else F.lit(int(anchor_epoch))
    cutoff = F.unix_timestamp(F.timestamp_seconds(a) - F.expr(f"INTERVAL {age}"))
    return manifest.filter(F.col("created_at") < cutoff)


# ------------------------------------------------------------------ M5
def normalize_code(code: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(code)), "-", "_")


def normalize_warnings(warnings: Column) -> Column:
    """M5: codes lower-cased with ``-`` -> ``_``; entries with an empty
    message dropped; empty code -> ``legacy``; accepted_at kept only for
    accepted entries."""
    kept = F.filter(warnings, lambda w: F.coalesce(F.trim(w["message"]), F.lit("")) != "")
    return F.transform(kept, lambda w: F.struct(
        F.when(F.coalesce(normalize_code(w["code"]), F.lit("")) == "", F.lit(WARNING_LEGACY))
         .otherwise(normalize_code(w["code"])).alias("code"),
        F.trim(w["message"]).alias("message"),
        F.coalesce(w["accepted"], F.lit(False)).alias("accepted"),
        F.when(F.coalesce(w["accepted"], F.lit(False)), w["accepted_at"]).otherwise(F.lit(0).cast("long"))
         .alias("accepted_at")))


def parse_warnings(raw: Column) -> Column:
    """M5: stored warning text -> array.  A JSON array of objects is read
    directly; an old JSON array of strings becomes ``legacy`` entries;
    anything malformed becomes an empty list.  The parsed type decides, so
    white space does not."""
    empty = F.array().cast(WARNING_TYPE)
    kind = F.schema_of_variant(F.try_parse_json(raw))
    as_text = F.from_json(raw, T.ArrayType(T.StringType()))
    legacy = F.transform(F.filter(as_text, lambda m: F.trim(m) != ""), lambda m: F.struct(
        F.lit(WARNING_LEGACY).alias("code"), F.trim(m).alias("message"), F.lit(False).alias("accepted"),
        F.lit(0).cast("long").alias("accepted_at")))
    out = (F.when(kind.startswith("ARRAY<OBJECT"), F.from_json(raw, WARNING_TYPE))
           .when(kind.startswith("ARRAY<STRING"), legacy).otherwise(empty))
    return normalize_warnings(F.coalesce(out, empty))


def replace_row(row: DataFrame, path: str) -> None:
    """Put one manifest row in place of the rows of its name.  The manifest is
    partitioned by table name, so only that name's folder is rewritten."""
    (row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("table_name").parquet(path))


def accept_warning(manifest: DataFrame, table: str, code: str, now_epoch: int | Column) -> DataFrame:
    """M5: mark every warning with ``code`` on ``table`` accepted, stamping
    the time once (idempotent: already accepted entries keep their time).
    Adds ``accept_found`` (the code exists) and ``accept_changed``."""
    c = F.lit(code.strip().lower().replace("-", "_"))
    now = now_epoch if isinstance(now_epoch, Column) else F.lit(int(now_epoch)).cast("long")
    w = normalize_warnings(F.col("warnings"))
    target = F.col("table_name") == F.lit(table)
    new = F.transform(w, lambda x: F.when(target & (x["code"] == c) & ~x["accepted"], F.struct(
        x["code"].alias("code"), x["message"].alias("message"), F.lit(True).alias("accepted"),
        now.alias("accepted_at"))).otherwise(x))
    found = target & F.exists(w, lambda x: x["code"] == c)
    changed = target & F.exists(w, lambda x: (x["code"] == c) & ~x["accepted"])
    # flags first: they must read the warnings as they were before accepting
    return manifest.withColumn("accept_found", found).withColumn("accept_changed", changed) \
                   .withColumn("warnings", new)


# ------------------------------------------------------------------ M6
def broad_fetch_warning(manifest: DataFrame, limit_col: str = "limit") -> DataFrame:
    """M6: a fetch of everything (limit 0) with more than 10 000 results
    adds a ``full_fetch`` warning (once)."""
    lim = F.col(limit_col) if limit_col in manifest.columns else F.lit(0)
    cond = (F.coalesce(lim, F.lit(0)) == 0) & (F.col("result_count") > BROAD_FETCH_ROWS)
    msg = F.format_string("fetched all %d results; narrow the search or set a limit", F.col("result_count"))
    entry = F.struct(F.lit(WARNING_FULL_FETCH).alias("code"), msg.alias("message"), F.lit(False).alias("accepted"),
                     F.lit(0).cast("long").alias("accepted_at"))
    w = F.coalesce(F.col("warnings"), F.array().cast(WARNING_TYPE))
    has = F.exists(w, lambda x: x["code"] == WARNING_FULL_FETCH)
    return manifest.withColumn("warnings", F.when(cond & ~has, F.concat(w, F.array(entry))).otherwise(w))
