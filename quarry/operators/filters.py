"""Bounded SQL, row slices, row ordinals, relative time and secret scans
(P1, P9-P11, P13, S2, S4).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .summary import limit_flagged

DEFAULT_QUERY_LIMIT = 100


# --------------------------------------------------------------------------
# P1 bounded read-only SQL
# --------------------------------------------------------------------------

def normalize_query(spark: SparkSession, sql: str) -> str:
    """The text of one SELECT, checked on Spark's own parse of it: a single
    query (no command, no second statement) that calls no unsafe function."""
    from pyspark.errors import ParseException

    from .summary import UNSAFE_FUNCTIONS, _called
    text = re.sub(r"\s*;\s*$", "", (sql or "").strip())
    if not re.match(r"(?i)select\b", text):
        raise ValueError("the statement must be a SELECT")
    try:
        # as a subquery only a query parses
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(f"SELECT * FROM ({text})")
    except ParseException as e:
        raise ValueError("the statement must be one SELECT") from e
    if _called(spark, plan) & UNSAFE_FUNCTIONS:
        raise ValueError(f"the statement may not call {', '.join(sorted(UNSAFE_FUNCTIONS))}")
    return text


def query_results(spark: SparkSession, tables: Mapping[str, DataFrame] | DataFrame, sql: str,
                  limit: int | None = DEFAULT_QUERY_LIMIT, flag_truncation: bool = False) -> DataFrame:
    """Run a caller SELECT over ``results`` (and any other named tables).

    The caller's text is not rewritten: each table is registered under a
    unique temporary view, a CTE gives it the caller's name (``results`` ...)
    and the statement is wrapped as a subquery after it, so concurrent
    callers never share a view and anything that is not a query (DDL, DML,
    commands) is a parse error.  The views are dropped once the plan is
    analysed.  With ``limit`` the outer LIMIT is pushed down by Spark.
    """
    import uuid
    q = normalize_query(spark, sql)
    if isinstance(tables, DataFrame):
        tables = {"results": tables}
    aliases = {}
    for name, frame in tables.items():
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError(f"invalid table name {name!r}")
        view = f"__quarry_{name}_{uuid.uuid4().hex[:12]}"
        frame.createOrReplaceTempView(view)
        aliases[name] = view
    ctes = ", ".join(f"`{name}` AS (SELECT * FROM `{view}`)" for name, view in aliases.items())
    try:
        wrapped = spark.sql(f"WITH {ctes} SELECT * FROM ({q}) AS q")
        wrapped.schema          # analysed now; the views can go
    finally:
        for view in aliases.values():
            spark.catalog.dropTempView(view)
    if limit is None:
        return wrapped
    if flag_truncation:
        return limit_flagged(wrapped, limit)
    return wrapped.limit(limit)


# --------------------------------------------------------------------------
# S2 arrival ordinal, S4 slices, P10 templates
# --------------------------------------------------------------------------

def with_row_number(df: DataFrame, order_cols: Sequence[str | Column] | None = None, name: str = "_row") -> DataFrame:
    """1-based ordinal column, without a single-partition window.

    Each partition numbers its own rows (``monotonically_increasing_id`` keeps
    the position in its low 33 bits); one count per partition (a table with
    as many rows as partitions) gives every partition its offset, which is
    broadcast back.  With ``order_cols`` the data is first range-partitioned
    and sorted by that order and checkpointed to the shared checkpoint folder,
    so the partition contents cannot change between the count and the
    numbering (range boundaries come from sampling) and the job survives lost
    executors.  Without an order the ordinal is the arrival order (partition,
    then position).
    """
    order_cols = list(order_cols or [])
    if order_cols:
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        base = df.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols).checkpoint(eager=True)
    else:
        base = df
    tagged = (base.withColumn("__mono", F.monotonically_increasing_id())
                  .withColumn("__pid", F.shiftright(F.col("__mono"), 33))
                  .withColumn("__pos", F.col("__mono") - F.shiftleft(F.col("__pid"), 33)))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__off") + F.col("__pos") + 1).cast("long"))
            .drop("__mono", "__pid", "__pos", "__off"))


@dataclass(frozen=True)
class PageIndex:
    """A table written once in a stated order, with the ordinals its parts
    begin at; a page reads the parts it lies in and nothing else."""
    spark: SparkSession
    path: str
    starts: tuple[int, ...]             # rows before each part
    parts: tuple[int, ...]
    total: int

    def page(self, limit: int = 0, offset: int = 0) -> DataFrame:
        """Rows ``offset`` .. ``offset + limit`` (0: to the end), in order."""
        if offset < 0 or limit < 0:
            raise ValueError("offset and limit must be >= 0")
        end = min(offset + limit, self.total) if limit else self.total
        ends = (*self.starts[1:], self.total)
        hit = [(p, lo) for p, lo, hi in zip(self.parts, self.starts, ends) if lo < end and hi > offset]
        rows = self.spark.read.option("basePath", f"{self.path}/rows")
        if not hit:
            return self.spark.read.parquet(f"{self.path}/columns")
        x = rows.parquet(*[f"{self.path}/rows/__part={p}" for p, _ in hit])
        start = F.create_map(*[F.lit(v) for p, lo in hit for v in (p, lo)])[F.col("__part").cast("int")]
        x = x.withColumn("__ord", start.cast("long") + F.col("__pos"))
        return (x.where((F.col("__ord") >= offset) & (F.col("__ord") < end)).orderBy("__ord")
                .drop("__part", "__pos", "__ord"))


def build_page_index(df: DataFrame, order: Sequence[str | Column], path: str, parts: int | None = None) -> PageIndex:
    """Write ``df`` under ``path`` in range partitions of ``order``
    (one folder per part, each row with its place in the part) and the number
    of rows of every part beside it.  Pages of one index are stable: rows that
    are equal in ``order`` keep the places they were written at."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mono = F.monotonically_increasing_id()
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("__part", F.shiftright(mono, 33).cast("int"))
     .withColumn("__pos", mono.bitwiseAND(F.lit((1 << 33) - 1)))
     .write.partitionBy("__part").parquet(f"{path}/rows"))
    spark = df.sparkSession
    df.limit(0).coalesce(1).write.parquet(f"{path}/columns")
    columns = StructType([*df.schema.fields, StructField("__pos", LongType()), StructField("__part", IntegerType())])
    stored = spark.read.schema(columns).parquet(f"{path}/rows")
    stored.groupBy("__part").count().coalesce(1).write.parquet(f"{path}/parts")
    return open_page_index(spark, path)


def open_page_index(spark: SparkSession, path: str) -> PageIndex:
    rows = sorted((int(r["__part"]), r["count"]) for r in spark.read.parquet(f"{path}/parts").collect())   # one per part
    starts, total = [], 0
    for _, n in rows:
        starts.append(total)
        total += n
    return PageIndex(spark, path, tuple(starts), tuple(p for p, _ in rows), total)


def slice_rows(df: DataFrame, order: Sequence[Column], limit: int = 0, offset: int = 0,
               index: PageIndex | None = None) -> DataFrame:
    """``offset`` then ``limit`` rows (0 = all) of a stated order, with
    ``total`` and ``has_more = offset + returned < total`` on every row.

    ``total`` is one count (a scalar); ``returned`` follows from it, so both
    columns are literals on the page (no join).  With ``index`` (a
    ``build_page_index`` of the same table and order) the page is read from
    its parts, without sorting or counting again.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must be >= 0")
    total = index.total if index else df.count()
    left = max(total - offset, 0)
    returned = min(limit, left) if limit else left
    page = index.page(limit, offset) if index else page_rows(df, order, limit, offset)
    return page.withColumn("total", F.lit(total).cast("long")) \
               .withColumn("has_more", F.lit(offset + returned < total))


TOP_ROWS = 10_000               # pages that end earlier are a top-k


def page_rows(df: DataFrame, order: Sequence[str | Column], limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows ``offset`` .. ``offset + limit`` (0: to the end) of a stated order.

    A page near the start is a per-task top-k.  Any other page is cut from
    the range-partitioned order by ordinal (S2), so no task or driver holds
    what precedes it; the rows are the same."""
    if not offset and not limit:
        return df.orderBy(*order)
    if limit and offset + limit <= TOP_ROWS:
        page = df.orderBy(*order)
        return (page.offset(offset) if offset else page).limit(limit)
    numbered = with_row_number(df, order, "__ord")
    keep = F.col("__ord") > offset
    if limit:
        keep = keep & (F.col("__ord") <= offset + limit)
    return numbered.filter(keep).drop("__ord")


def sample_rows(df: DataFrame, n: int = 5, order: Sequence[Column] | None = None) -> DataFrame:
    """P10: the first ``n`` rows of an order (a preview)."""
    return (df.orderBy(*order) if order else df).limit(n)


def row_at(df: DataFrame, ordinal: int, row_col: str = "_row") -> DataFrame:
    """P10: the row with a given ordinal."""
    return df.filter(F.col(row_col) == F.lit(ordinal))


def count_rows(df: DataFrame) -> DataFrame:
    """P10: the row count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def make_results(spark: SparkSession, count: int = 1) -> DataFrame:
    """``makeresults count=N`` (an id column 0..N-1 and a timestamp)."""
    return spark.range(count).select(F.col("id"), F.current_timestamp().alias("_time"))


# --------------------------------------------------------------------------
# P9 relative time bounds
# --------------------------------------------------------------------------

_REL = re.compile(r"^\s*(?:(?P<sign>[+-])(?P<n>\d*)(?P<unit>s|sec|secs|second|seconds|m|min|mins|minute|minutes|"
                  r"h|hr|hrs|hour|hours|d|day|days|w|week|weeks|mon|month|months|y|year|years))?"
                  r"(?:@(?P<snap>s|m|h|d|w|mon|y|second|minute|hour|day|week|month|year))?\s*$")
# Time-unit spellings and the Spark interval/trunc unit each means.
_UNIT = {"s": "second", "sec": "second", "secs": "second", "second": "second", "seconds": "second",
         "m": "minute", "min": "minute", "mins": "minute", "minute": "minute", "minutes": "minute",
         "h": "hour", "hr": "hour", "hrs": "hour", "hour": "hour", "hours": "hour",
         "d": "day", "day": "day", "days": "day", "w": "week", "week": "week", "weeks": "week",
         "mon": "month", "month": "month", "months": "month",
         "y": "year", "year": "year", "years": "year"}


def relative_time(anchor: Column, spec: str) -> Column:
    """``now``, ``-15m``, ``-1h``, ``-24h@h``, ``@d`` relative to an
    anchor timestamp column.  The anchor is explicit, so results are
    deterministic (pass ``F.current_timestamp()`` for wall-clock now)."""
    spec = (spec or "").strip()
    if spec in ("", "now"):
        return anchor
    m = _REL.match(spec)
    if not m or (m.group("unit") is None and m.group("snap") is None):
        raise ValueError(f"unsupported relative time {spec!r}")
    out = anchor
    if m.group("unit"):
        n = int(m.group("n") or "1")
        unit = _UNIT[m.group("unit")]
        if unit == "week":
            n, unit = n * 7, "day"
        iv = F.expr(f"INTERVAL {n} {unit.upper()}")
        out = out - iv if m.group("sign") == "-" else out + iv
    if m.group("snap"):
        out = F.date_trunc(_UNIT[m.group("snap")], out)
    return out


# --------------------------------------------------------------------------
# P11 secret-bearing rows
# --------------------------------------------------------------------------

SECRET_BYTES = 64 << 20          # bound of one broadcast list of secrets


def _texts(value):
    """Every key and value of a row as text, nested data included."""
    if value is None:
        return
    if isinstance(value, dict):
        for k, v in value.items():
            yield str(k)
            yield from _texts(v)
    elif isinstance(value, (list, tuple)):
        for v in value:
            yield from _texts(v)
    elif isinstance(value, bool):
        yield "true" if value else "false"
    else:
        yield value if isinstance(value, str) else str(value)


def flag_secret_rows(df: DataFrame, secrets: DataFrame, secret_col: str = "secret",
                     flag: str = "has_secret", max_bytes: int = SECRET_BYTES) -> DataFrame:
    """Mark rows one of whose keys or values (nested data included) contains a
    known secret.

    Raw keys and values are searched, not a rendering of them, so quotes and
    backslashes match as they are.  The secrets become one Aho-Corasick
    automaton per task, so a row costs its length whatever the number of
    secrets: no join, no shuffle, one scan.  Lists above ``max_bytes`` are
    hashed into several bounded broadcasts that the same scan applies one
    after the other (exact).
    """
    listed = (secrets.select(F.col(secret_col).cast("string").alias("s"))
              .filter(F.length("s") > 0).distinct())
    size = listed.agg(F.sum(F.octet_length("s"))).first()[0] or 0
    n = max(1, -(-size // max_bytes))
    sc = df.sparkSession.sparkContext
    names = df.columns
    out = df.withColumn(flag, F.lit(False))
    for chunk in range(n):
        part = listed if n == 1 else listed.filter(F.pmod(F.xxhash64("s"), F.lit(n)) == chunk)
        held = sc.broadcast([r[0] for r in part.toLocalIterator()])     # at most max_bytes, checked above
        out = out.mapInArrow(_marker(held, len(names)), out.schema)
    return out


def _marker(held, at: int):
    def run(batches):
        import ahocorasick
        import pyarrow as pa
        machine = ahocorasick.Automaton()
        for s in held.value:
            machine.add_word(s, True)
        if held.value:
            machine.make_automaton()
        names = None
        for batch in batches:
            found = batch.column(at).to_pylist()
            if held.value:
                if names is None:                       # a secret in a column name flags every row
                    names = any(next(machine.iter(n), None) for n in batch.schema.names[:at])
                if names:
                    found = [True] * len(found)
                else:
                    plain = batch.select(list(range(at)))
                    for k, row in enumerate(plain.to_pylist()):
                        if not found[k]:
                            found[k] = any(next(machine.iter(t), None) for v in row.values() for t in _texts(v))
            yield batch.set_column(at, batch.schema.field(at), pa.array(found, pa.bool_()))
    return run
