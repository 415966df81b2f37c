"""Field extraction and normalisation.

All extractions are column expressions over the raw text (regexp, split,
JSON path, XPath), so a whole normalisation spec compiles to one projection
inside one code-generated stage; nothing leaves the JVM.  The only joins are
the small-table lookups (E13, J5), and those are size-checked.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import first_occurrences
from ..functions.evalfns import eval_columns

# --------------------------------------------------------------- regexes
_NAMED = re.compile(r"\(\?P?<([A-Za-z_][A-Za-z0-9_]*)>")


def compile_named(pattern: str) -> tuple[str, list[tuple[str, int]]]:
    """Translate ``(?<name>..)`` / ``(?P<name>..)`` groups (names may hold
    underscores, which Java forbids) into plain capturing groups and return
    ``(java_pattern, [(name, group_index), ...])``."""
    out, names, i, group, in_class = [], [], 0, 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            out.append(pattern[i:i + 2])
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
            out.append(ch)
            i += 1
            continue
        if ch == "[":
            in_class = True
            out.append(ch)
            i += 1
            continue
        if ch == "(":
            m = _NAMED.match(pattern, i)
            if m:
                group += 1
                names.append((m.group(1), group))
                out.append("(")
                i = m.end()
                continue
            if not pattern.startswith("(?", i):
                group += 1
        out.append(ch)
        i += 1
    return "".join(out), names


def extract_regex(df: DataFrame, col: str, pattern: str, multivalue: bool = False) -> DataFrame:
    """E1 (rex / inline EXTRACT): one column per named group.  A non-match
    gives null (not the empty string); ``multivalue`` gives arrays."""
    java, names = compile_named(pattern)
    if not names:
        raise ValueError("pattern has no named groups")
    src = F.col(col)
    for name, idx in names:
        if multivalue:
            val = F.regexp_extract_all(src, F.lit(java), idx)
        else:
            val = F.when(src.rlike(java), F.regexp_extract(src, java, idx))
        df = df.withColumn(name, val)
    return df


def apply_transforms(df: DataFrame, col: str, rules: Sequence[str], multivalue: bool = False) -> DataFrame:
    """E2 (REPORT + transforms): apply every rule; a field keeps the first
    rule's value that matched (multivalue: values of all rules, in order)."""
    fields: dict[str, list[Column]] = {}
    for rule in rules:
        java, names = compile_named(rule)
        src = F.col(col)
        for name, idx in names:
            if multivalue:
                v = F.regexp_extract_all(src, F.lit(java), idx)
            else:
                v = F.when(src.rlike(java), F.regexp_extract(src, java, idx))
            fields.setdefault(name, []).append(v)
    for name, vals in fields.items():
        if multivalue:
            df = df.withColumn(name, F.concat(*vals) if len(vals) > 1 else vals[0])
        else:
            df = df.withColumn(name, F.coalesce(*vals) if len(vals) > 1 else vals[0])
    return df


def extract_delimited(df: DataFrame, col: str, delim: str, names: Sequence[str]) -> DataFrame:
    """E3 (DELIMS): the i-th piece becomes the i-th name; missing -> null."""
    parts = F.split(F.col(col), re.escape(delim))
    for i, name in enumerate(names):
        df = df.withColumn(name, F.get(parts, i))
    return df


def extract_kv(df: DataFrame, col: str, out: str = "kv",
               pair_delim: str = r"[\s,;&]", kv_delim: str = "=") -> DataFrame:
    """E4 (automatic key=value): ``map<string,string>`` of all
    distinct keys; double-quoted values are unquoted; the first
    occurrence of a key wins."""
    kd = re.escape(kv_delim)
    pat = rf'([A-Za-z_][A-Za-z0-9_.\-]*){kd}("[^"]*"|[^\s,;&"]*)'
    src = F.col(col)
    keys = F.regexp_extract_all(src, F.lit(pat), 1)
    vals = F.transform(F.regexp_extract_all(src, F.lit(pat), 2),
                       lambda v: F.regexp_replace(v, r'^"(.*)"$', "$1"))
    pairs = F.arrays_zip(keys.alias("k"), vals.alias("v"))
    firsts = first_occurrences(pairs, lambda p: p["k"])
    entries = F.transform(firsts, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value")))
    return df.withColumn(out, F.map_from_entries(entries))


def extract_table(df: DataFrame, col: str, out: str = "fields", line_no: str = "line") -> DataFrame:
    """E5 (multikv): the first line is the header; every later non-blank line
    becomes one output row with a ``map<header, value>`` (whitespace
    separated; extra values are dropped, missing ones are null)."""
    lines = F.filter(F.split(F.col(col), r"\r?\n"), lambda s: F.trim(s) != "")
    header = F.split(F.trim(F.get(lines, 0)), r"\s+")
    body = F.slice(lines, 2, 2147483646)
    exploded = df.select("*", header.alias("__hdr"), F.posexplode(body).alias("__pos", "__line"))
    vals = F.split(F.trim(F.col("__line")), r"\s+")
    entries = F.transform(F.col("__hdr"), lambda h, i: F.struct(h.alias("key"), F.get(vals, i).alias("value")))
    return (exploded.withColumn(out, F.map_from_entries(entries))
            .withColumn(line_no, F.col("__pos") + 2)
            .drop("__hdr", "__pos", "__line"))


def spath_to_jsonpath(path: str) -> str:
    """``a.b{0}.c`` / ``a{}.b`` (spath) -> ``$.a.b[0].c`` / ``$.a[*].b``."""
    if path.startswith("$"):
        return path
    p = re.sub(r"\{(\d+)\}", r"[\1]", path)
    p = p.replace("{}", "[*]")
    return "$." + p


def spath(df: DataFrame, col: str, paths: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Values at JSON paths (spath or ``$`` syntax); null on bad JSON."""
    items = paths.items() if isinstance(paths, Mapping) else [(p, p) for p in paths]
    for name, path in items:
        df = df.withColumn(name, F.get_json_object(F.col(col), spath_to_jsonpath(path)))
    return df


def extract_xml(df: DataFrame, col: str, paths: Mapping[str, str], loose: bool = True) -> DataFrame:
    """E7 (xpath / xmlkv).  ``loose`` (HTML and other markup that is not
    well-formed XML): the path is a tag name and the value is the trimmed
    text of its first element.  Strict mode evaluates real XPath."""
    for name, path in paths.items():
        if loose:
            tag = re.escape(path.strip("/").split("/")[-1])
            val = F.regexp_extract(F.col(col), rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)
            df = df.withColumn(name, F.when(val != "", F.trim(val)))
        else:
            df = df.withColumn(name, F.xpath_string(F.col(col), F.lit(path)))
    return df


def xmlkv(df: DataFrame, col: str, out: str = "xmlkv") -> DataFrame:
    """``<key>value</key>`` leaf pairs as a map (first occurrence wins)."""
    pat = r"<([A-Za-z_][\w.\-]*)(?:\s[^>]*)?>([^<]*)</\1\s*>"
    keys = F.regexp_extract_all(F.col(col), F.lit(pat), 1)
    vals = F.regexp_extract_all(F.col(col), F.lit(pat), 2)
    pairs = F.arrays_zip(keys.alias("k"), vals.alias("v"))
    firsts = first_occurrences(pairs, lambda p: p["k"])
    return df.withColumn(out, F.map_from_entries(
        F.transform(firsts, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value")))))


def template_to_regex(template: str) -> str:
    """``user={user} ip={ip}`` -> a named-group regex (values stop at the
    next literal, or at whitespace for the last field)."""
    parts = re.split(r"\{([A-Za-z_][A-Za-z0-9_]*)\}", template)
    out = []
    for i, part in enumerate(parts):
        if i % 2 == 0:
            out.append(re.escape(part))
        else:
            last = i == len(parts) - 2 and parts[-1] == ""
            out.append(f"(?<{part}>" + (r"\S+" if last else ".*?") + ")")
    return "".join(out)


def extract_template(df: DataFrame, col: str, template: str) -> DataFrame:
    return extract_regex(df, col, template_to_regex(template))


def mvexpand(df: DataFrame, col: str, delim: str | None = None) -> DataFrame:
    """One row per value; rows with no values are kept with null."""
    src = F.col(col)
    if delim is not None:
        src = F.split(src, re.escape(delim))
    return df.withColumn(col, F.explode_outer(src))


def alias_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """E10 (FIELDALIAS): ``new = coalesce(new, old)``; the original stays."""
    for old, new in mapping.items():
        if old not in df.columns:
            continue
        val = F.coalesce(F.col(new), F.col(old)) if new in df.columns else F.col(old)
        df = df.withColumn(new, val)
    return df


def calc_fields(df: DataFrame, exprs: Mapping[str, str | Column]) -> DataFrame:
    """E11 (EVAL- calculated fields)."""
    return eval_columns(df, dict(exprs))


def event_types(df: DataFrame, predicates: Mapping[str, str], out: str = "eventtype") -> DataFrame:
    """Names of every matching event-type predicate, in given order."""
    arr = F.array(*[F.when(F.coalesce(F.expr(p), F.lit(False)), F.lit(n)) for n, p in predicates.items()])
    return df.withColumn(out, F.array_compact(arr))


INLINE_RULES = 200          # tag rules given as a list that are looked up without a join


def add_tags(df: DataFrame, rules: DataFrame | Sequence[tuple], out: str = "tag") -> DataFrame:
    """Rules ``(field, value, tag)``; a row gets the sorted distinct tags
    of every rule whose field has that value (as text; null matches nothing).

    A short list of rules becomes one map per field, looked up in the row; a
    table of rules is combined per value and joined to the rows on that value
    (Spark picks the join from the measured size).
    """
    text = lambda v: None if v is None else str(v)
    none = F.array().cast("array<string>")
    if not isinstance(rules, DataFrame) and len(rules) <= INLINE_RULES:
        per: dict = {}
        for name, value, tag in rules:
            if name in df.columns and value is not None:
                per.setdefault(name, {}).setdefault(text(value), set()).add(tag)
        found = []
        for name, values in per.items():
            pairs = [x for v, ts in values.items() for x in (F.lit(v), F.array(*[F.lit(t) for t in sorted(ts)]))]
            found.append(F.coalesce(F.create_map(*pairs)[F.col(name).cast("string")], none))
        return df.withColumn(out, F.array_sort(F.array_distinct(F.concat(none, *found))))
    if not isinstance(rules, DataFrame):
        rules = df.sparkSession.createDataFrame([(f, text(v), t) for f, v, t in rules],
                                                "field string, value string, tag string")
    rules = rules.toDF("field", "value", "tag").withColumn("value", F.col("value").cast("string"))
    rules = rules.filter(F.col("field").isin(df.columns) & F.col("value").isNotNull())
    fields = sorted(r[0] for r in rules.select("field").distinct().collect())       # at most the columns of df
    held = []
    for k, name in enumerate(fields):
        per = (rules.filter(F.col("field") == name).groupBy(F.col("value").alias(f"__v{k}"))
               .agg(F.collect_set("tag").alias(f"__t{k}")))
        df = df.join(per, F.col(name).cast("string") == F.col(f"__v{k}"), "left").drop(f"__v{k}")
        held.append(f"__t{k}")
    tags = [F.coalesce(F.col(c), none) for c in held]
    return df.withColumn(out, F.array_sort(F.array_distinct(F.concat(none, *tags)))).drop(*held)


@dataclass
class NormalizeSpec:
    """The ordered normalisation steps for one source."""
    extractions: Sequence[tuple[str, str]] = field(default_factory=list)   # (column, regex)
    aliases: Mapping[str, str] = field(default_factory=dict)
    calculated: Mapping[str, str] = field(default_factory=dict)
    lookups: Sequence[tuple] = field(default_factory=list)   # (DataFrame, on, cols, default)
    eventtypes: Mapping[str, str] = field(default_factory=dict)
    tags: Sequence[tuple] = field(default_factory=list)


def normalize(df: DataFrame, spec: NormalizeSpec) -> DataFrame:
    """Extraction -> alias -> calculated -> lookup -> event type -> tag.
    Each step may read only fields produced by earlier steps."""
    from .joins import enrich
    for col, pattern in spec.extractions:
        df = extract_regex(df, col, pattern)
    df = alias_fields(df, spec.aliases)
    df = calc_fields(df, spec.calculated)
    for lk in spec.lookups:
        df = enrich(df, *lk)
    if spec.eventtypes:
        df = event_types(df, spec.eventtypes)
    if spec.tags:
        df = add_tags(df, spec.tags)
    return df


# ------------------------------------------------------------- E15 URLs
def normalize_url(col: ColumnOrName) -> Column:  # noqa: F821
    """struct(key, web, api, bases, scheme, host) of a target URL.

    No scheme means https; scheme and host are lower-cased; the web base
    maps port 8089 to 8000 and the API base maps no port or 8000 to 8089;
    ``bases`` is the sorted distinct list of the three.  Anything that is
    not an http(s) URL with a host, or whose port is no number, gives null.
    """
    raw = F.trim(F.col(col) if isinstance(col, str) else col)
    value = F.when(raw.contains("://"), raw).otherwise(F.concat(F.lit("https://"), raw))
    scheme = F.lower(F.regexp_extract(value, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    authority = F.regexp_extract(value, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    hostport = F.lower(F.regexp_replace(authority, r"^.*@", ""))
    host = F.regexp_extract(hostport, r"^(\[[^\]]*\]|[^:]*)", 1)
    port = F.regexp_extract(hostport, r"^(?:\[[^\]]*\]|[^:]*):(\d*)$", 1)
    prefix = F.concat(scheme, F.lit("://"))
    key = F.concat(prefix, hostport)
    api = F.when((port == "") | (port == "8000"), F.concat(prefix, host, F.lit(":8089"))).otherwise(key)
    web = F.when(port == "8089", F.concat(prefix, host, F.lit(":8000"))).otherwise(key)
    ok = scheme.isin("http", "https") & (host != "") & hostport.rlike(r"^(\[[^\]]*\]|[^:]*)(:\d*)?$")
    return F.when(ok & (raw != ""), F.struct(
        key.alias("key"), web.alias("web"), api.alias("api"),
        F.array_sort(F.array_distinct(F.array(key, web, api))).alias("bases"),
        scheme.alias("scheme"), hostport.alias("host")))


# ------------------------------------------------------------ E16 CIM
def conformance(df: DataFrame, required_fields: Sequence[str], required_tags: Sequence[str] = (),
                tag_col: str = "tag", constraint: str | None = None) -> DataFrame:
    """Per event, ``missing_fields`` (required fields that are null or
    absent) and ``missing_tags``; ``conforms`` when both are empty.  Only
    events matching ``constraint`` are checked."""
    present = set(df.columns)
    miss = F.array_compact(F.array(*[
        (F.when(F.col(f).isNull(), F.lit(f)) if f in present else F.lit(f)) for f in required_fields
    ])) if required_fields else F.array().cast("array<string>")
    if required_tags and tag_col in present:
        mtags = F.array_except(F.array(*[F.lit(t) for t in required_tags]),
                               F.coalesce(F.col(tag_col), F.array().cast("array<string>")))
    elif required_tags:
        mtags = F.array(*[F.lit(t) for t in required_tags])
    else:
        mtags = F.array().cast("array<string>")
    out = df if constraint is None else df.filter(F.expr(constraint))
    return (out.withColumn("missing_fields", miss).withColumn("missing_tags", mtags)
            .withColumn("conforms", (F.size("missing_fields") == 0) & (F.size("missing_tags") == 0)))


def field_coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Share of rows where each field is present (long format)."""
    aggs = [F.avg(F.col(f).isNotNull().cast("double")).alias(f) for f in fields]
    wide = df.agg(*aggs)
    return wide.unpivot([], list(fields), "field", "coverage")


# ------------------------------------------------------ E17 failures
# Failure kinds, their codes, and whether a retry can help.
FAILURE_CODES = (
    ("search_timeout", "search_timeout", True),
    ("search_failed", "search_failed", False),
    ("http", "remote_http_error", None),          # retryable for 5xx
    ("dns", "dns_lookup_failed", None),           # retryable when temporary/timeout, never not-found
    ("deadline", "network_timeout", True),
    ("canceled", "operation_canceled", False),
    ("tls", "tls_certificate_error", False),
    ("connection_refused", "connection_refused", False),
    ("unreachable", "network_unreachable", True),
    ("net_timeout", "network_timeout", True),
    ("url", "network_error", False),
)


def classify_failures(df: DataFrame, kind: str = "kind", status: str = "status_code",
                      dns_temporary: str = "dns_temporary", dns_not_found: str = "dns_not_found",
                      operation: str = "operation") -> DataFrame:
    """``error_code`` and ``retryable`` for failure log rows; first
    matching kind wins; an unknown kind with an operation becomes
    ``remote_operation_failed`` (not retryable), else no code."""
    k = F.lower(F.trim(F.col(kind)))
    code, retry = None, None
    for name, c, r in FAILURE_CODES:
        if name == "http":
            rv = (F.col(status) >= 500) & (F.col(status) < 600)
        elif name == "dns":
            rv = F.coalesce(F.col(dns_temporary), F.lit(False)) & ~F.coalesce(F.col(dns_not_found), F.lit(False))
        else:
            rv = F.lit(r)
        code = F.when(k == name, F.lit(c)) if code is None else code.when(k == name, F.lit(c))
        retry = F.when(k == name, rv) if retry is None else retry.when(k == name, rv)
    has_op = F.coalesce(F.trim(F.col(operation)), F.lit("")) != ""
    code = code.when(has_op, F.lit("remote_operation_failed"))
    retry = retry.when(has_op, F.lit(False)).otherwise(F.lit(None).cast("boolean"))
    return df.withColumn("error_code", code).withColumn("retryable", F.coalesce(retry, F.lit(False)))


# --------------------------------------------------------- E18, E19 text
def compact_text(col: ColumnOrName, max_len: int | None = None) -> Column:  # noqa: F821
    """Whitespace runs collapse to one space, trimmed, cut to max_len
    characters (the reference cuts bytes; we never split a character)."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.left(out, F.lit(max_len)) if max_len else out


def scalar_text(df: DataFrame, col: str) -> Column:
    """Trimmed text of a scalar; booleans as words; nested values and
    empty strings give null."""
    dtype = dict(df.dtypes)[col]
    c = F.col(col)
    if dtype.startswith(("struct", "array", "map")):
        return F.lit(None).cast("string")
    if dtype == "boolean":
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    if dtype in ("double", "float"):
        txt = F.when(c == F.floor(c), F.floor(c).cast("long").cast("string")).otherwise(c.cast("string"))
    else:
        txt = F.trim(c.cast("string"))
    return F.when(txt != "", txt)
