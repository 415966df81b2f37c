"""Event selection by one correlation value.

A selector is resolved against the schema on the driver (no job), then the
sequence is ``filter -> select -> order by (_time, _row) -> limit``: the filter
is pushed into the scan and the ordered limit runs as a per-task top-k
(TakeOrderedAndProject), so no task ever holds more than ``limit + 1`` rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .summary import limit_flagged

# Candidate correlation-id columns, in lookup order, and the
# compact event columns, in output order.
REQUEST_ID_FIELDS = (
    "request_id", "requestId", "requestID", "req_id", "reqId",
    "trace_id", "traceId", "correlation_id", "correlationId",
)
COMPACT_COLUMNS = (
    "_row", "_time", "level", "severity", "service", "host", "source", "sourcetype",
    "operation", "method", "path", "handler", "codeName", "status", "statusCode",
    "message", "event",
)
DEFAULT_EVENT_LIMIT = 100


@dataclass(frozen=True)
class Matcher:
    mode: str          # field | json_field | request_id
    field: str         # column name, or json:<path>, or json:auto
    expr: Column       # the value compared as text
    value: str


def _text_of(df: DataFrame, name: str) -> Column:
    """A value as text the way a user reads it: integral doubles print
    without a fraction (200, not 200.0); nested values as JSON."""
    dtype = dict(df.dtypes)[name]
    col = F.col(name)
    if dtype in ("double", "float"):
        return F.when(col == F.floor(col), F.floor(col).cast("long").cast("string")) \
                .otherwise(col.cast("string"))
    if dtype.startswith(("struct", "array", "map")):
        return F.to_json(col)
    return col.cast("string")


def json_path_value(raw: Column, path: str) -> Column:
    """P4 helper: value at a JSON path, null when the text is not JSON."""
    if not path or not path.startswith("$"):
        raise ValueError("a JSON path must start with $")
    return F.get_json_object(raw, path)


def _by_request_id(df: DataFrame, value: str) -> tuple[str, Column]:
    """The first known id column, else the known id paths of ``_raw``."""
    named = [c for c in REQUEST_ID_FIELDS if c in df.columns]
    if named:
        return named[0], _text_of(df, named[0])
    paths = [json_path_value(F.col("_raw"), f"$.{c}") for c in REQUEST_ID_FIELDS]
    return "json:auto", F.coalesce(*paths)


def _by_field(df: DataFrame, name: str) -> tuple[str, Column]:
    return name, _text_of(df, name)


def _by_path(df: DataFrame, path: str) -> tuple[str, Column]:
    return f"json:{path}", json_path_value(F.col("_raw"), path)


# selector -> (how it reads a value, the columns of which it needs one)
SELECTORS = {
    "request_id": (_by_request_id, lambda arg: (*REQUEST_ID_FIELDS, "_raw")),
    "field": (_by_field, lambda arg: (arg,)),
    "json_field": (_by_path, lambda arg: ("_raw",)),
}


def resolve_matcher(df: DataFrame, value: str | None = None, field: str | None = None,
                    json_field: str | None = None, request_id: str | None = None) -> Matcher:
    """How rows are matched.  Exactly one selector of ``SELECTORS``
    is given; a request id is its own value, the others come with ``value``."""
    text = {k: (v or "").strip() for k, v in
            {"request_id": request_id, "field": field, "json_field": json_field, "value": value}.items()}
    chosen = [k for k in SELECTORS if text[k]]
    if len(chosen) != 1:
        raise ValueError(f"give exactly one of {', '.join(SELECTORS)}; got {', '.join(chosen) or 'none'}")
    mode = chosen[0]
    if (mode == "request_id") == bool(text["value"]):
        raise ValueError(f"{mode} takes {'no' if mode == 'request_id' else 'a'} value")
    read, needs = SELECTORS[mode]
    if not set(needs(text[mode])) & set(df.columns):
        raise ValueError(f"{mode} needs one of the columns {', '.join(needs(text[mode]))}")
    label, expr = read(df, text[mode])
    return Matcher(mode, label, expr, text["request_id"] or text["value"])


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_CANONICAL_INT = re.compile(r"^(0|-?[1-9][0-9]{0,18})$")


def match_condition(df: DataFrame, m: Matcher) -> Column:
    """The row predicate of a matcher.  Text equality on an integer column
    is rewritten to numeric equality (exactly equivalent: an integer's text
    is its canonical decimal form), which the scan can push down; a value
    that is not a canonical integer cannot match such a column."""
    if m.mode in ("field", "request_id") and not m.field.startswith("json:"):
        dtype = dict(df.dtypes).get(m.field)
        if dtype in _INTEGRAL:
            if _CANONICAL_INT.match(m.value):
                return F.col(m.field) == F.lit(int(m.value)).cast(dtype)
            return F.lit(False)
        if dtype == "string":
            return F.col(m.field) == F.lit(m.value)
    return m.expr == F.lit(m.value)


def match_field(df: DataFrame, field: str, value: str) -> DataFrame:
    """Rows whose column, read as text, equals ``value``."""
    m = resolve_matcher(df, value=value, field=field)
    return df.filter(match_condition(df, m))


def match_json(df: DataFrame, path: str, value: str, raw: str = "_raw") -> DataFrame:
    """Rows whose JSON text has ``value`` at ``path`` (bad JSON: no match)."""
    return df.filter(json_path_value(F.col(raw), path) == F.lit(value))


def match_request_id(df: DataFrame, value: str) -> DataFrame:
    """P5: rows carrying correlation id ``value`` in the first id column that
    exists, else in any of the id paths of ``_raw``."""
    m = resolve_matcher(df, request_id=value)
    return df.filter(match_condition(df, m))


def compact_columns(df: DataFrame) -> list[str]:
    return [c for c in COMPACT_COLUMNS if c in df.columns]


def compact_events(df: DataFrame, matcher: Matcher) -> DataFrame:
    """``matched_value`` followed by the known columns that exist."""
    return df.select(matcher.expr.alias("matched_value"), *compact_columns(df))


def event_order(df: DataFrame) -> list[Column]:
    """``_time, _row`` when a time column exists, else ``_row``."""
    cols = []
    if "_time" in df.columns:
        cols.append(F.col("_time").asc_nulls_first())
    if "_row" in df.columns:
        cols.append(F.col("_row").asc_nulls_first())
    return cols


def order_events(df: DataFrame) -> DataFrame:
    return df.orderBy(*event_order(df))


def event_sequence(df: DataFrame, value: str | None = None, field: str | None = None,
                   json_field: str | None = None, request_id: str | None = None,
                   limit: int | None = DEFAULT_EVENT_LIMIT, flag_truncation: bool = False) -> DataFrame:
    """The ordered compact events of one correlation value."""
    m = resolve_matcher(df, value, field, json_field, request_id)
    hits = df.filter(match_condition(df, m))
    order = event_order(df)
    compact = compact_events(hits, m)
    if limit is None:
        return compact.orderBy(*order)
    if flag_truncation:
        return limit_flagged(compact, limit, order)
    return compact.orderBy(*order).limit(limit)
