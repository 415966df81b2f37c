"""Ordered and per-key operators (W1-W9) and the blocked prefix scans they
share.

Skew rule: a per-key window puts every row of a key into one task, so a key
holding a third of the data would be one task holding a third of the data.
Operators whose answer is an aggregate (W1 latest, W2 first failing phase)
use ``max_by``/``min_by`` aggregates instead, which combine map-side.
Operators that need a value per row (running counts, carried values,
islands) use a *blocked* scan: rows are partitioned by (key, block of the order column);
each block is scanned by a window; a per-(key, block) summary (one row per
block, far smaller than the data) supplies what happened in earlier blocks.
The block bounds are approximate quantiles of (order value, tie-break), so
every block holds about the same number of rows: a hot key, a burst at one
instant, rows without a time or an operator without a key are spread over as
many tasks as there are blocks.  Keys and order values may be null: null keys
form a group of their own, rows without an order value come first.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import equi_depth
from .joins import _num

def _tie_number(df: DataFrame, ties: Sequence[str]) -> Column:
    """A number that never decreases along the first tie-break column (nulls
    least; a text by its first six bytes), or a hash of the row without one.
    Blocks may cut one instant by it."""
    types = dict(df.dtypes)
    if not ties:
        return F.xxhash64(*[F.col(c) for c, k in df.dtypes if "map<" not in k and "variant" not in k]).cast("double")
    col, dtype = F.col(ties[0]), types[ties[0]]
    if dtype == "string":
        first = F.substring(F.rpad(F.hex(col.cast("binary")), 12, "0"), 1, 12)
        value = F.conv(first, 16, 10).cast("double")
    elif dtype == "boolean":
        value = col.cast("int").cast("double")
    elif dtype.startswith(("timestamp", "date")) or dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") \
            or dtype.startswith("decimal"):
        value = _num(col, dtype).cast("double")
    else:
        value = F.lit(0.0)                      # other types are not cut inside an instant
    return F.coalesce(value, F.lit(float("-inf")))


def _with_block(df: DataFrame, t: str, blocks: int | None, ties: Sequence[str] = (), flag: str | None = None) -> DataFrame:
    """``df`` plus ``__blk``, which increases along (t, flag, tie), nulls of
    ``t`` first, and ``__tie``, to order by after ``t`` (and ``flag``, a 0/1
    column).

    A time that fills more than one quantile (a burst at one instant, or rows
    without a time) is cut further by the tie number, so it is spread over as
    many blocks as its share of the rows.
    """
    n = blocks or max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = (df.withColumn("__num", _num(F.col(t), dict(df.dtypes)[t]).cast("double"))
         .withColumn("__tie", _tie_number(df, ties)))
    cuts = equi_depth(x, F.col("__num"), F.col("__tie"), n, flag is not None)
    return cuts.with_block(x, F.col("__num"), F.col("__tie"), "__blk", F.col(flag) if flag else None).drop("__num")


def _join_blocks(x: DataFrame, per: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach one row per (key, block) to the rows of that block, nulls equal."""
    names = [*keys, "__blk"]
    side = per.select(*[F.col(c).alias(f"__j_{c}") for c in names], *[c for c in per.columns if c not in names])
    on = [F.col(c).eqNullSafe(F.col(f"__j_{c}")) for c in names]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return x.join(side, cond, "left").drop(*[f"__j_{c}" for c in names])


def _earlier(keys: Sequence[str]):
    w = Window.partitionBy(*keys).orderBy("__blk") if keys else Window.orderBy("__blk")
    return w.rowsBetween(Window.unboundedPreceding, -1)


# ------------------------------------------------------ blocked helpers
def blocked_running_sum(df: DataFrame, keys: Sequence[str], t: str, value: Column | None,
                        out: str, tiebreak: Sequence[str] = (), blocks: int | None = None,
                        flag: str | None = None) -> DataFrame:
    """Running sum of ``value`` (1 per row when None) per key, in (t, flag,
    tiebreak) order (nulls first), inclusive of the current row."""
    keys = list(keys)
    v = F.lit(1).cast("long") if value is None else value
    x = _with_block(df, t, blocks, tiebreak, flag).withColumn("__v", v)
    order = [t, *([flag] if flag else []), "__tie", *tiebreak]
    w_in = (Window.partitionBy(*keys, "__blk").orderBy(*[F.col(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("__in", F.sum("__v").over(w_in))
    per = x.groupBy(*keys, "__blk").agg(F.sum("__v").alias("__bs"))
    offsets = per.select(*keys, "__blk", F.coalesce(F.sum("__bs").over(_earlier(keys)), F.lit(0)).alias("__off"))
    return (_join_blocks(x, offsets, keys).withColumn(out, F.col("__off") + F.coalesce(F.col("__in"), F.lit(0)))
            .drop("__blk", "__tie", "__v", "__in", "__off"))


def blocked_last(df: DataFrame, keys: Sequence[str], t: str, is_obs: str, obs: str,
                 blocks: int | None = None, out: str = "__carried") -> DataFrame:
    """Carry the newest non-null ``obs`` (a struct, set on observation rows)
    forward to every row at or after it, per key.  Observation rows sort
    before other rows at an equal time, equal-time observations by their
    values (the greatest is carried)."""
    keys = list(keys)
    # the newest is the greatest (time, values), so the order of equal-time observations does not matter
    newest = F.when(F.col(obs).isNotNull(), F.struct(F.col(t).alias("t"), F.col(obs).alias("o")))
    x = _with_block(df.withColumn("__late", 1 - F.col(is_obs).cast("int")), t, blocks, flag="__late")
    w_in = (Window.partitionBy(*keys, "__blk").orderBy(F.col(t), F.col("__late"), F.col("__tie"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("__in", F.max(newest).over(w_in))
    per = x.groupBy(*keys, "__blk").agg(F.max(newest).alias("__bl"))
    prev = per.select(*keys, "__blk", F.max("__bl").over(_earlier(keys)).alias("__prev"))
    return (_join_blocks(x, prev, keys).withColumn(out, F.coalesce(F.col("__in"), F.col("__prev"))["o"])
            .drop("__blk", "__tie", "__late", "__in", "__prev"))


def blocked_lag(df: DataFrame, keys: Sequence[str], t: str, value: Column, out: str,
                tiebreak: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """``value`` of the row before, per key in (t, tiebreak) order (null for a
    key's first row)."""
    keys = list(keys)
    x = _with_block(df, t, blocks, tiebreak).withColumn("__v", F.struct(value.alias("v")))
    order = [F.col(c) for c in (t, "__tie", *tiebreak)]
    x = x.withColumn("__in", F.lag("__v").over(Window.partitionBy(*keys, "__blk").orderBy(*order)))
    per = x.groupBy(*keys, "__blk").agg(F.max_by("__v", F.struct(*order)).alias("__bl"))
    prev = per.select(*keys, "__blk", F.last("__bl", ignorenulls=True).over(_earlier(keys)).alias("__prev"))
    return (_join_blocks(x, prev, keys).withColumn(out, F.coalesce("__in", "__prev")["v"])
            .drop("__blk", "__tie", "__v", "__in", "__prev"))


def merge_intervals(df: DataFrame, start: str = "start", end: str = "end", blocks: int | None = None) -> DataFrame:
    """(start, end): overlapping and touching intervals merged.  An interval
    begins a new one when it starts after every earlier end; both the greatest
    earlier end and the numbering are blocked scans.  Intervals without a
    bound, or that end before they start, are left out."""
    x = df.select(F.col(start).alias("start"), F.col(end).alias("end")).where("start <= end")
    x = _with_block(x, "start", blocks, ["end"])
    order = Window.partitionBy("__blk").orderBy("start", "__tie", "end")
    x = x.withColumn("__in", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    tops = x.groupBy("__blk").agg(F.max("end").alias("__top"))
    before = tops.select("__blk", F.max("__top").over(_earlier([])).alias("__before"))
    x = _join_blocks(x, before, []).withColumn("__far", F.greatest("__in", "__before")).drop("__in", "__before")
    x = x.withColumn("__new", F.when(F.col("start") <= F.col("__far"), 0).otherwise(1).cast("long"))
    x = x.withColumn("__in", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sums = x.groupBy("__blk").agg(F.sum("__new").alias("__bs"))
    offsets = sums.select("__blk", F.coalesce(F.sum("__bs").over(_earlier([])), F.lit(0)).alias("__off"))
    x = _join_blocks(x, offsets, []).withColumn("__island", F.col("__off") + F.col("__in"))
    return x.groupBy("__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")


# ------------------------------------------------------------- W1, W2
def latest_usable(df: DataFrame, key: str, ts_cols: Sequence[str] = ("updated_at", "created_at"),
                  usable: str | Column | None = None, tiebreak: str | None = None) -> DataFrame:
    """Per key, the newest usable record (by the first non-null of
    ``ts_cols``; equal times are broken by the greatest ``tiebreak`` value,
    the record's own id).  Empty keys and rows failing ``usable`` are
    skipped.  One ``max_by`` aggregate: partial aggregation keeps a hot key
    from landing in one task whole."""
    x = df.filter(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))
    if usable is not None:
        x = x.filter(F.expr(usable) if isinstance(usable, str) else usable)
    ts = F.coalesce(*[F.col(c) for c in ts_cols])
    rank = F.struct(ts.alias("t"), (F.col(tiebreak) if tiebreak else F.lit(None)).alias("k"))
    rec = F.struct(*[F.col(c) for c in df.columns])
    return x.groupBy(key).agg(F.max_by(rec, rank).alias("__r")).select("__r.*")


def first_failing_phase(df: DataFrame, key: str, phase: str, status: str,
                        phase_order: Sequence, pass_value: str = "pass") -> DataFrame:
    """Per object, the earliest phase (in ``phase_order``) that did not
    pass: its status is not ``pass_value``, is null ("unknown is not
    pass"), or the phase has no row at all (status ``missing``).  Objects
    whose phases all passed get nulls.  Observations are first combined to
    one row per (object, phase), so an object's list is bounded by the number
    of phases."""
    order_map = F.create_map(*[x for i, p in enumerate(phase_order) for x in (F.lit(p), F.lit(i))])
    x = df.withColumn("__ord", order_map[F.col(phase)]).filter(F.col("__ord").isNotNull())
    seen = F.coalesce(F.col(status).cast("string"), F.lit("unknown"))
    # one row per (key, phase) after a partial aggregate
    per_phase = x.groupBy(key, "__ord").agg(F.min(F.when(seen != pass_value, seen)).alias("__bad"))
    per = per_phase.groupBy(key).agg(
        F.collect_set(F.when(F.col("__bad").isNull(), F.col("__ord"))).alias("__ok"),
        F.collect_list(F.struct(F.col("__ord").alias("o"), F.col("__bad").alias("s"))).alias("__ps"))
    all_idx = F.sequence(F.lit(0), F.lit(len(phase_order) - 1))
    fail_idx = F.array_min(F.array_except(all_idx, F.col("__ok")))
    names = F.array(*[F.lit(p) for p in phase_order])
    at_fail = F.transform(F.filter("__ps", lambda p: p["o"] == fail_idx), lambda p: p["s"])
    return per.select(
        key,
        # get() (0-based, null-safe); element_at(names, <null expression> + 1) is not null-safe here
        F.get(names, fail_idx).alias("first_failing_phase"),
        F.when(fail_idx.isNotNull(), F.coalesce(F.array_min(at_fail), F.lit("missing"))).alias("failing_status"))


# ------------------------------------------------------------------ W3
def series_trend(df: DataFrame, ts: str, value: str, by: Sequence[str] = (), span: str = "1 day",
                 agg: str = "sum") -> DataFrame:
    """Per series, the sparkline (every bucket value in time order), the
    major value (last bucket) and the trend (last minus previous bucket).

    The raw rows are first aggregated to buckets (partial aggregation), so
    the collected list is bounded by the number of buckets, not rows.
    """
    by = list(by)
    fn = {"sum": F.sum, "count": F.count, "avg": F.avg, "max": F.max, "min": F.min}[agg]
    b = df.groupBy(*by, F.window(F.col(ts).cast("timestamp"), span).start.alias("bucket")) \
          .agg(fn(F.col(value)).alias("v"))
    pts = b.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("bucket", "v"))).alias("__pts"))
    n = F.size("__pts")
    return pts.select(
        *by,
        F.transform("__pts", lambda p: p["v"]).alias("sparkline"),
        F.element_at("__pts", -1)["v"].alias("latest"),
        F.when(n >= 2, F.element_at("__pts", -1)["v"] - F.element_at("__pts", -2)["v"]).alias("trend"),
        F.element_at("__pts", -1)["bucket"].alias("latest_bucket"))


def series_lag(df: DataFrame, ts: str, value: str, by: Sequence[str] = (), span: str = "1 day") -> DataFrame:
    """W3 (long form): one row per bucket with the previous bucket's value
    and the change, by a blocked lag over the buckets."""
    by = list(by)
    b = df.groupBy(*by, F.window(F.col(ts).cast("timestamp"), span).start.alias("bucket")) \
          .agg(F.sum(F.col(value)).alias("v"))
    return blocked_lag(b, by, "bucket", F.col("v"), "prev").withColumn("delta", F.col("v") - F.col("prev"))


# ------------------------------------------------------------------ W4
def running_count(df: DataFrame, order: str, by: Sequence[str] = (), tiebreak: Sequence[str] = (),
                  out: str = "count", blocks: int | None = None) -> DataFrame:
    """W4 (streamstats count): 1-based running count per ``by`` in
    (order, tiebreak) order, nulls first, by a blocked scan."""
    return blocked_running_sum(df, by, order, None, out, tiebreak, blocks)


# ------------------------------------------------------------------ W5
# Percentage points and seconds after which an event is kept.
PROGRESS_STEP = 10.0
PROGRESS_SECONDS = 10.0
FEW_SEGMENTS = 4            # segments of a batch that are thinned one by one
PROGRESS_COLUMNS = ("ts", "phase", "state", "percent", "fetched", "written", "total")


class ProgressRule:
    """The thinning rule over arrays of progress events in time order: an
    event is kept when, against the last *kept* one, phase or state differ,
    the percentage gained ``PROGRESS_STEP`` or first reached 100, a fetch or
    write begins or ends (its row counter moved to 0 or to the total), or
    ``PROGRESS_SECONDS`` passed.  Unknown numbers are 0."""

    def __init__(self, at, phase, state, percent, fetched, written, total):
        import numpy as np
        number = lambda c: np.nan_to_num(np.asarray([0 if v is None else v for v in c], dtype=float))
        self.at = np.asarray([0 if v is None else v for v in at], dtype=np.int64)       # microseconds
        self.phase, self.state = np.asarray(phase, dtype=object), np.asarray(state, dtype=object)
        self.percent, self.fetched, self.written, self.total = map(number, (percent, fetched, written, total))
        self.is_fetch, self.is_write = self.phase == "fetch", self.phase == "write"
        self.rows = np.where(self.is_fetch, self.fetched, np.where(self.is_write, self.written, 0))

    def event(self, i: int) -> tuple:
        return (int(self.at[i]), self.phase[i], self.state[i], *(float(c[i]) for c in (self.percent, self.fetched, self.written, self.total)))

    def _kept(self, lo: int, hi: int, last: tuple):
        import numpy as np
        s = slice(lo, hi)
        at, phase, state, percent, fetched, written, _ = last
        before = np.where(self.is_fetch[s], fetched, np.where(self.is_write[s], written, 0))
        edge = (self.total[s] > 0) & (self.rows[s] != before) & ~((self.rows[s] > 0) & (self.rows[s] < self.total[s]))
        return (edge | (self.phase[s] != phase) | (self.state[s] != state) | (self.percent[s] - percent >= PROGRESS_STEP)
                | ((self.percent[s] >= 100) & (percent < 100)) | (self.at[s] - at >= PROGRESS_SECONDS * 1_000_000))

    def keep(self, lo: int, hi: int, last: tuple | None):
        """(flags of events lo..hi, last kept event); ``last`` is the event
        kept before them, None at a start.  Each step looks for the next kept
        event in windows that double."""
        import numpy as np
        flags = np.zeros(hi - lo, dtype=bool)
        i = lo
        if last is None and lo < hi:
            flags[0], last, i = True, self.event(lo), lo + 1
        width = 32
        while i < hi:
            found = self._kept(i, min(i + width, hi), last)
            j = int(found.argmax())
            if found[j]:
                i += j
                flags[i - lo], last, width = True, self.event(i), 32
                i += 1
            else:
                i, width = i + len(found), width * 2
        return flags, last


    def keep_each(self, cuts, last: tuple | None):
        """(flags, last kept event of the last segment) of the segments between
        ``cuts``; ``last`` is what was kept of the first one before, None when
        it starts here.  The n-th events of all segments are judged at once;
        the longest few are finished one by one."""
        import numpy as np
        flags = np.zeros(cuts[-1], dtype=bool)
        if last is not None:
            flags[:cuts[1]], last = self.keep(0, cuts[1], last)
            cuts = cuts[1:]
        if len(cuts) == 1:
            return flags, last
        starts, ends = np.asarray(cuts[:-1]), np.asarray(cuts[1:])
        by_length = np.argsort(starts - ends, kind="stable")
        starts, ends = starts[by_length], ends[by_length]
        kept, flags[starts] = starts.copy(), True
        step = 1
        while (n := int(np.searchsorted(starts - ends, -step))) > FEW_SEGMENTS:
            i, was = starts[:n] + step, kept[:n]
            before = np.where(self.is_fetch[i], self.fetched[was], np.where(self.is_write[i], self.written[was], 0))
            edge = (self.total[i] > 0) & (self.rows[i] != before) & ~((self.rows[i] > 0) & (self.rows[i] < self.total[i]))
            new = (edge | (self.phase[i] != self.phase[was]) | (self.state[i] != self.state[was])
                   | (self.percent[i] - self.percent[was] >= PROGRESS_STEP)
                   | ((self.percent[i] >= 100) & (self.percent[was] < 100))
                   | (self.at[i] - self.at[was] >= PROGRESS_SECONDS * 1_000_000))
            flags[i[new]] = True
            kept[:n] = np.where(new, i, was)
            step += 1
        final = int(np.argmax(starts))
        last = self.event(int(kept[final]))
        for s in range(n):
            flags[starts[s] + step:ends[s]], left = self.keep(int(starts[s]) + step, int(ends[s]), self.event(int(kept[s])))
            last = left if s == final else last
        return flags, last


def progress_cuts(rule: ProgressRule) -> list[int]:
    """Where the segments of a job's events in time order begin (see
    ``progress_segments``), and their number.  What was kept before may be
    newer than the first events: a pause begins a segment only after a change
    of phase or state."""
    import numpy as np
    changed = (rule.phase[1:] != rule.phase[:-1]) | (rule.state[1:] != rule.state[:-1])
    changed = changed.astype(bool)
    paused = np.diff(rule.at) >= int(PROGRESS_SECONDS * 1_000_000)
    return [0, *(np.flatnonzero(changed | (paused & np.logical_or.accumulate(changed))) + 1).tolist(), len(rule.at)]


def progress_segments(df: DataFrame, job: str = "job", columns: Sequence[str] = PROGRESS_COLUMNS,
                      tiebreak: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """``df`` plus ``__seg``, the number of the segment an event belongs to,
    and ``__tie`` (order after the time).

    An event whose phase or state differs from the event before it, or that
    comes ``PROGRESS_SECONDS`` after it, is kept whatever was kept before:
    the event before is either kept itself or agrees with the last kept one.
    Such an event starts a segment that can be thinned on its own.  Both the
    event before and the numbering come from blocked scans over one set of
    blocks, so a busy job is cut up without a per-job window.
    """
    ts, phase, state = columns[:3]
    micros = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(0))
    x = _with_block(df, ts, blocks, tiebreak)
    x = x.withColumn("__v", F.struct(micros.alias("at"), F.col(phase).alias("p"), F.col(state).alias("s")))
    order = [F.col(c) for c in (ts, "__tie", *tiebreak)]
    w = Window.partitionBy(job, "__blk").orderBy(*order)
    x = x.withColumn("__in", F.lag("__v").over(w))
    per = x.groupBy(job, "__blk").agg(F.max_by("__v", F.struct(*order)).alias("__bl"))
    prev = per.select(job, "__blk", F.last("__bl", ignorenulls=True).over(_earlier([job])).alias("__prev"))
    x = _join_blocks(x, prev, [job]).withColumn("__b", F.coalesce("__in", "__prev"))
    same = (F.col("__v.p").eqNullSafe(F.col("__b.p")) & F.col("__v.s").eqNullSafe(F.col("__b.s"))
            & (F.col("__v.at") - F.col("__b.at") < int(PROGRESS_SECONDS * 1_000_000)))
    x = x.withColumn("__new", F.when(F.col("__b").isNotNull() & same, 0).otherwise(1).cast("long")).drop("__in", "__prev", "__b", "__v")
    x = x.withColumn("__in", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sums = x.groupBy(job, "__blk").agg(F.sum("__new").alias("__bs"))
    offsets = sums.select(job, "__blk", F.coalesce(F.sum("__bs").over(_earlier([job])), F.lit(0)).alias("__off"))
    return _join_blocks(x, offsets, [job]).withColumn("__seg", F.col("__off") + F.col("__in")).drop("__blk", "__new", "__in", "__off")


def thin_progress(df: DataFrame, job: str = "job", columns: Sequence[str] = PROGRESS_COLUMNS,
                  tiebreak: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Keep a progress event when it is its job's first, phase or state
    changed, the percentage gained 10 points or first reached 100 since the
    last *kept* event, a fetch or write begins or ends (its row counter moved
    to 0 or to the total), or 10 s passed since the last kept event.

    ``columns`` name time, phase, state, percent, fetched, written and total
    rows.  Jobs are cut into segments that do not depend on each other
    (``progress_segments``), dealt over the tasks by (job, segment) and
    thinned there by array code, with one event of state between batches."""
    names = df.columns

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        key, last = None, None
        for b in batches:
            at = lambda c: b.column(b.schema.get_field_index(c))
            times = pc.cast(pc.cast(at(columns[0]), pa.timestamp("us", at(columns[0]).type.tz)), pa.int64())
            rule = ProgressRule(times.to_pylist(), *[at(c).to_pylist() for c in columns[1:]])
            jobs, segs = np.asarray(at(job).to_pylist(), dtype=object), np.asarray(at("__seg"))
            if not len(segs):
                continue
            cuts = [0, *(np.flatnonzero((jobs[1:] != jobs[:-1]) | (segs[1:] != segs[:-1])) + 1).tolist(), len(segs)]
            flags, last = rule.keep_each(cuts, last if key == (jobs[0], segs[0]) else None)
            key = (jobs[-1], segs[-1])
            yield b.filter(pa.array(flags)).select(names)

    x = progress_segments(df, job, columns, tiebreak, blocks)
    return (x.repartition(job, "__seg").sortWithinPartitions(job, "__seg", columns[0], "__tie", *tiebreak)
            .mapInArrow(run, df.schema))


# ------------------------------------------------------------------ W6
def with_eta(df: DataFrame, mode: str = "mode", done: str = "done_fraction", rows: str = "rows",
             total: str = "total_rows", elapsed: str = "elapsed_seconds") -> DataFrame:
    """Percent, rate (rows/s), ETA seconds and estimated total.

    ``running`` rows use the done fraction; ``fetch``/``write`` rows use
    rows per elapsed second.  Unknown or impossible values become 0.
    """
    frac = F.least(F.greatest(F.coalesce(F.col(done), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    el = F.coalesce(F.col(elapsed).cast("double"), F.lit(0.0))
    n = F.coalesce(F.col(rows).cast("double"), F.lit(0.0))
    tot = F.coalesce(F.col(total).cast("double"), F.lit(0.0))
    rate = F.when(el > 0, n / el).otherwise(F.lit(0.0))
    is_run = F.col(mode) == "running"
    percent = F.when(is_run, frac * 100).otherwise(F.when(tot > 0, F.least(n / tot, F.lit(1.0)) * 100).otherwise(0.0))
    eta = F.when(is_run, F.when((frac > 0) & (frac < 1) & (el > 0), el * (1 - frac) / frac).otherwise(0.0)) \
           .otherwise(F.when((rate > 0) & (tot > n), (tot - n) / rate).otherwise(0.0))
    est_total = F.when(is_run, F.when(frac > 0, n / frac).otherwise(0.0)).otherwise(F.greatest(tot, n))
    return (df.withColumn("percent", percent).withColumn("rate", rate)
            .withColumn("eta_seconds", eta).withColumn("estimated_total", est_total))


# ------------------------------------------------------------------ W7
def concurrency(df: DataFrame, start: str, end: str, tiebreak: Sequence[str] = (),
                blocks: int | None = None) -> DataFrame:
    """For every invocation, how many invocations are running at its
    start (itself included): a +1/-1 sweep whose running sum is a blocked
    scan over time (global order, no single-partition window).  An end at
    the same instant as a start is processed first (half-open intervals).
    An invocation without an end is still running; one without a start is
    never counted and gets null."""
    known = df.filter(F.col(start).isNotNull())
    ev = known.select(*df.columns, F.col(start).alias("__t"), F.lit(1).alias("__d"), F.lit(1).alias("__s"))
    ends = (known.filter(F.col(end).isNotNull())
            .select(*df.columns, F.col(end).alias("__t"), F.lit(-1).alias("__d"), F.lit(0).alias("__s")))
    r = blocked_running_sum(ev.unionByName(ends), [], "__t", F.col("__d").cast("long"), "concurrent",
                            tiebreak, blocks, flag="__s")
    unknown = df.filter(F.col(start).isNull()).withColumn("concurrent", F.lit(None).cast("long"))
    return r.filter(F.col("__s") == 1).drop("__t", "__d", "__s").unionByName(unknown)


def cadence(df: DataFrame, key: str, ts: str, blocks: int | None = None) -> DataFrame:
    """Seconds since the same key's previous invocation, summarised per
    key (count, min/avg/max gap).  The previous time comes from the row's
    block or, for a block's first row, from the key's earlier blocks, so a
    busy key is spread over its blocks.  Rows without a time count as
    invocations and have no gap."""
    t = _num(F.col(ts), dict(df.dtypes)[ts])
    cut = [c for c in df.columns if c not in (key, ts)]         # rows of one instant are told apart by the other columns
    x = _with_block(df.select(F.col(key), F.col(ts), *cut), ts, blocks).withColumn("__t", t).select(F.col(key), "__blk", "__t")
    x = x.withColumn("__in", F.lag("__t").over(Window.partitionBy(key, "__blk").orderBy("__t")))
    per = x.groupBy(key, "__blk").agg(F.max("__t").alias("__last"))
    prev = per.select(key, "__blk", F.max("__last").over(_earlier([key])).alias("__prev"))
    g = _join_blocks(x, prev, [key]).withColumn("__gap", F.col("__t") - F.coalesce("__in", "__prev"))
    return g.groupBy(key).agg(F.count(F.lit(1)).alias("invocations"), F.min("__gap").alias("min_gap"),
                              F.avg("__gap").alias("avg_gap"), F.max("__gap").alias("max_gap"))


# ------------------------------------------------------------------ W8
def state_runs(df: DataFrame, key: str, ts: str, state: str, tiebreak: Sequence[str] = (),
               min_length: int = 1, blocks: int | None = None) -> DataFrame:
    """Maximal runs of consecutive observations with the same state per
    key (gaps and islands): ``run_id = n(key) - n(key, state)`` with both
    ordinals from blocked running counts.  Output: key, state, start, end,
    length; runs shorter than ``min_length`` are dropped.  A null state is a
    state like any other."""
    a = blocked_running_sum(df, [key], ts, None, "__n1", tiebreak, blocks)
    # the first ordinal is the order from here on
    b = blocked_running_sum(a, [key, state], ts, None, "__n2", ["__n1"], blocks)
    isl = b.withColumn("__run", F.col("__n1") - F.col("__n2"))
    runs = isl.groupBy(key, state, "__run").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("length"))
    return runs.filter(F.col("length") >= min_length).drop("__run")


# ------------------------------------------------------------------ W9
def rank_hits(hits: DataFrame, k: int | None, group: str = "query_id", score: str = "score",
              tiebreak: str = "doc_id", out: str = "rank") -> DataFrame:
    """Rank 1..n by score (desc) then tiebreak, per query; keep top k.

    ``row_number() <= k`` lets Spark insert a partial per-group limit before
    the shuffle (WindowGroupLimit), so each map task sends at most k rows
    per query - a query with a huge hit list does not become one big task.
    """
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(tiebreak).asc())
    r = hits.withColumn(out, F.row_number().over(w))
    return r.filter(F.col(out) <= k) if k else r
