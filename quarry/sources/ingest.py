"""Sources and sinks (S1, S3, S5-S10): loosely typed JSON rows, event
envelopes, raw lines, job-status payloads, JSON-lines output.

Schema inference is one distributed aggregate over (key, type) pairs;
everything after it is column expressions, so parsing runs in the scan tasks.
"""

from __future__ import annotations

import re
from typing import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names a source field may not take.
RESERVED = ("_row", "_json")


# ------------------------------------------------------------------ S1
_RAW_MAP = "map<string,string>"
_VARIANT_MAP = "map<string,variant>"


def _json_object(col: Column) -> Column:
    """The text if it is a JSON object, else null (other JSON is no row)."""
    return F.when(F.ltrim(col).startswith("{") & F.try_parse_json(col).isNotNull(), col)


def field_types(df: DataFrame, json_col: str) -> list[tuple[str, str]]:
    """Distinct ``(key, type)`` pairs over the object rows: one aggregate whose
    result is as long as the union of keys."""
    keyed = df.select(F.explode(F.from_json(_json_object(F.col(json_col)), _VARIANT_MAP)).alias("k", "v"))
    pairs = keyed.select("k", F.coalesce(F.schema_of_variant("v"), F.lit("VOID")).alias("t"))
    kind = F.regexp_extract("t", r"^[A-Z]+", 0)
    return [(r["k"], r["t"]) for r in pairs.select("k", kind.alias("t")).distinct().collect()]


def _column_type(kinds: set[str]) -> str | None:
    """Spark type of a column holding these variant types; None: as text."""
    kinds = kinds - {"VOID"}
    if kinds and kinds <= {"BIGINT", "INT", "SMALLINT", "TINYINT"}:
        return "bigint"
    if kinds and kinds <= {"BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL"}:
        return "double"
    if kinds == {"BOOLEAN"}:
        return "boolean"
    return None


def result_columns(fields: Sequence[tuple[str, str]]) -> list[tuple[str, list[str], str | None]]:
    """``(column, spellings, type)`` plan of a result table: drop reserved,
    empty and NUL names; keys differing only by case merge into one column
    named by the smallest spelling (a deterministic choice); sorted by name."""
    groups: dict[str, list[tuple[str, str]]] = {}
    for name, kind in fields:
        if name and "\x00" not in name and name.lower() not in RESERVED:
            groups.setdefault(name.lower(), []).append((name, kind))
    plan = []
    for pairs in groups.values():
        names = sorted({n for n, _ in pairs})
        plan.append((names[0], names, _column_type({k for _, k in pairs})))
    return sorted(plan)


def ingest_rows(df: DataFrame, json_col: str = "value", keep: Sequence[str] = (),
                fields: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """S1 (+S3): JSON rows -> result table: ``_json`` (the row as received),
    then one column per key seen in any row (union of keys), sorted by name.

    Keys and their types come from one distributed aggregate over the rows
    that are objects (or from ``fields``).  Integers become bigint, other
    numbers double, booleans boolean; text, nested values and keys of mixed
    types become text, scalars as they stand and nested values as JSON.  Any
    key name is allowed.  Keys differing only by case are coalesced into one
    column.  Rows that are no JSON object keep their ``_json`` and get nulls.
    ``keep`` carries other input columns through (e.g. an id); ``_row`` comes
    from ``with_row_number``.
    """
    plan = result_columns(field_types(df, json_col) if fields is None else fields)
    text = _json_object(F.col(json_col))
    x = df.select(*keep, F.col(json_col).alias("_json"), F.from_json(text, _RAW_MAP).alias("__m"),
                  F.from_json(text, _VARIANT_MAP).alias("__v"))
    cols = []
    for name, spellings, kind in plan:
        if kind is None:
            vals = [F.col("__m")[F.lit(k)] for k in spellings]
        else:
            vals = [F.try_variant_get(F.col("__v")[F.lit(k)], "$", kind) for k in spellings]
        cols.append(F.coalesce(*vals).alias(name))
    return x.select(*keep, "_json", *cols)


def read_json_rows(spark: SparkSession, path: str) -> DataFrame:
    """S1 from files: one JSON object per line."""
    return ingest_rows(spark.read.text(path), "value")


# ------------------------------------------------------------------ S3
def stringify_nested(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """S3: struct / array / map columns become JSON text; scalars stay."""
    out = []
    for f in df.schema.fields:
        if f.name not in exclude and isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ------------------------------------------------------------------ S5
def save_result(df: DataFrame, path: str, name: str, manifest_path: str | None = None,
                meta: Mapping[str, object] | None = None) -> None:
    """Write a result table (replacing an existing one of that name) and
    its manifest row (M1 schema), which replaces the row of that name."""
    import time
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]{0,127}", name):
        raise ValueError(f"invalid result table name {name!r}")
    target = f"{path.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(target)
    if manifest_path:
        from .manifest import manifest_row, replace_row
        spark = df.sparkSession
        rows = spark.read.parquet(target).count()
        m = dict(meta or {})
        m.setdefault("rows", rows)
        m.setdefault("result_count", rows)
        m.setdefault("created_at", int(time.time()))
        replace_row(manifest_row(spark, name, **m), manifest_path)


# ------------------------------------------------------------------ S6
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("sourcetype", T.StringType()),
    T.StructField("index", T.StringType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
])
DEFAULT_META = {"index": "main", "host": None, "source": None, "sourcetype": None}


def read_envelopes(df: DataFrame, col: str = "value", defaults: Mapping[str, object] | None = None,
                   received_at: Column | None = None) -> DataFrame:
    """Event envelopes -> events.  ``event`` may be text or any JSON
    value (kept as JSON text); ``time`` is epoch seconds (fractions kept),
    else the receive time; host/source/sourcetype/index fall back to the
    request/channel defaults; ``fields`` becomes a string map.  The same
    function serves a streaming DataFrame."""
    d = dict(DEFAULT_META, **(defaults or {}))
    p = F.from_json(F.col(col), ENVELOPE_SCHEMA)
    x = df.select("*", p.alias("__e"))
    t = F.col("__e.time").try_cast("double")
    recv = received_at if received_at is not None else F.current_timestamp()
    out = x.select(
        *[c for c in df.columns if c != col],
        F.col("__e.event").alias("event"),
        F.coalesce(F.timestamp_micros((t * 1_000_000).cast("long")), recv).alias("_time"),
        *[F.coalesce(F.col(f"__e.{k}"), F.lit(d.get(k)).cast("string")).alias(k)
          for k in ("host", "source", "sourcetype", "index")],
        F.col("__e.fields").alias("fields"),
    )
    return out.filter(F.col("event").isNotNull())


def rejected_envelopes(df: DataFrame, col: str = "value") -> DataFrame:
    """The rows ``read_envelopes`` does not turn into events, with the
    reason: ``not_json``, ``not_an_object`` or ``no_event``."""
    p = F.from_json(F.col(col), ENVELOPE_SCHEMA)
    reason = (F.when(F.try_parse_json(F.col(col)).isNull(), "not_json")
              .when(~F.ltrim(F.col(col)).startswith("{"), "not_an_object").otherwise("no_event"))
    return df.filter(p["event"].isNull()).withColumn("reason", reason)


# ------------------------------------------------------------------ S7
def read_raw(df: DataFrame, col: str = "value", defaults: Mapping[str, object] | None = None,
             received_at: Column | None = None, split_lines: bool = True) -> DataFrame:
    """Raw text -> one event per line (blank lines dropped), metadata
    from the request/channel defaults, receive time as ``_time``."""
    d = dict(DEFAULT_META, **(defaults or {}))
    lines = F.split(F.col(col), r"\r?\n") if split_lines else F.array(F.col(col))
    x = df.select(*[c for c in df.columns if c != col], F.posexplode(lines).alias("line_no", "_raw"))
    x = x.filter(F.trim(F.col("_raw")) != "")
    recv = received_at if received_at is not None else F.current_timestamp()
    return x.select("*", recv.alias("_time"),
                    *[F.lit(d.get(k)).cast("string").alias(k) for k in ("host", "source", "sourcetype", "index")])


# ------------------------------------------------------------------ S8
_PARTS = "array<struct<value:string,error:string>>"


def _json_objects(body: str | None) -> list[tuple]:
    """(object text, error) of the JSON objects in a body, in order."""
    import json
    decoder, out, at = json.JSONDecoder(), [], 0
    body = body or ""
    while True:
        while at < len(body) and body[at] in " \t\r\n,":
            at += 1
        if at == len(body):
            return out
        try:
            value, end = decoder.raw_decode(body, at)
            out.append((body[at:end], None if isinstance(value, dict) else "not an object"))
        except ValueError as e:
            # go on at the next object that starts after a closing brace or on a new line
            nxt = re.compile(r"(?<=\})\s*(?=\{)|\n\s*(?=\{)").search(body, at + 1)
            end = nxt.end() if nxt else len(body)
            out.append((body[at:end].strip(), str(e).split(":")[0].lower()))
        at = end


def split_envelopes(df: DataFrame, col: str = "value", error: str = "error") -> DataFrame:
    """A body holding several concatenated JSON objects (``{..}{..}`` or
    whitespace-separated) -> one row per object, its text as received.  A
    piece that is no JSON object stays as a row with the reason in ``error``;
    the objects after it are still read."""
    @F.pandas_udf(_PARTS)
    def parts(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: [{"value": v, "error": e} for v, e in _json_objects(b)])

    x = df.select(*[c for c in df.columns if c != col], F.posexplode(parts(F.col(col))).alias("part", "__p"))
    return x.select(*[c for c in x.columns if c != "__p"], F.col("__p.value").alias(col), F.col("__p.error").alias(error))


# ------------------------------------------------------------------ S9
JOB_STATUS_SCHEMA = T.StructType([T.StructField("entry", T.ArrayType(T.StructType([
    T.StructField("content", T.MapType(T.StringType(), T.StringType()))])))])


def _lenient_long(c: Column) -> Column:
    return F.coalesce(c.try_cast("double").try_cast("long"), F.lit(0).cast("long"))


def parse_job_status(df: DataFrame, col: str = "value") -> DataFrame:
    """The first ``entry[0].content`` of a job-status payload, leniently
    typed: numbers from numbers or numeric text (else 0), booleans from
    true/false text (else false), state upper-cased, progress clamped to
    [0, 1], ``done`` = isDone or state DONE, ``failed`` for FAILED/CANCELED."""
    c = F.get(F.from_json(F.col(col), JOB_STATUS_SCHEMA)["entry"], 0)["content"]
    state = F.upper(F.coalesce(c["dispatchState"], F.lit("")))
    prog = F.coalesce(c["doneProgress"].try_cast("double"), F.lit(0.0))
    is_done = F.coalesce(F.lower(F.trim(c["isDone"])).isin("true", "1", "t"), F.lit(False))
    return df.select(
        "*",
        state.alias("state"),
        F.least(F.greatest(prog, F.lit(0.0)), F.lit(1.0)).alias("done_progress"),
        _lenient_long(c["scanCount"]).alias("scan_count"),
        _lenient_long(c["eventCount"]).alias("event_count"),
        _lenient_long(c["resultCount"]).alias("result_count"),
        _lenient_long(c["resultPreviewCount"]).alias("result_preview_count"),
        F.coalesce(c["runDuration"].try_cast("double"), F.lit(0.0)).alias("run_duration"),
        (is_done | (state == "DONE")).alias("done"),
        state.isin("FAILED", "CANCELED", "CANCELLED").alias("failed"),
        c.isNotNull().alias("has_entry"))


# ----------------------------------------------------------------- S10
def to_jsonl(df: DataFrame, type_tag: str, out: str = "value") -> DataFrame:
    """One JSON object per row with a leading ``type`` tag."""
    return df.select(F.to_json(F.struct(F.lit(type_tag).alias("type"), *[F.col(c) for c in df.columns])).alias(out))


def write_jsonl(df: DataFrame, type_tag: str, path: str) -> None:
    to_jsonl(df, type_tag).write.mode("overwrite").text(path)
