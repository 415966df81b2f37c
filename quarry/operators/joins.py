"""Joins and set operations.

Physical strategy is Catalyst's and AQE's: equi-joins become sort-merge or
(broadcast) hash joins, and AQE converts to broadcast at runtime when the
measured side is small, or splits skewed partitions.  Range joins (J4, J12, J18)
and glob matches (J9) never fall back to a nested loop: both sides get a key
(tree node, prefix, literal piece), are equi-joined on it, then filtered exactly.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ------------------------------------------------------------ J1-J3
def inner_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "inner")


def outer_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    if how not in ("left", "right", "full"):
        raise ValueError("how must be left, right or full")
    return left.join(right, on, how)


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_anti")


# --------------------------------------------------- J4 range (bucketed)
def _bucket(col: Column, width: float) -> Column:
    return F.floor(col / F.lit(width)).cast("long")


def _num(col: Column, dtype: str) -> Column:
    """Timestamps/dates as epoch seconds so that widths are in seconds."""
    if dtype.startswith("timestamp"):
        return F.unix_micros(col.cast("timestamp")) / F.lit(1_000_000.0)
    if dtype == "date":
        return F.unix_date(col) * F.lit(86400.0)
    return col.cast("double")


TOP_LEVEL = 4               # a node of the interval tree spans at most 2^TOP_LEVEL blocks


def _meet(points: DataFrame, ranges: DataFrame, cuts, point: Column, tie: Column, lo: Column, hi: Column,
          inclusive_hi: bool) -> DataFrame:
    """Points x ranges that share a node of a tree over equi-depth blocks; a
    superset of the pairs with lo <= point < hi (or <= hi), each pair once.

    A point is at its block and the block's ancestors up to ``TOP_LEVEL``; a
    range is at the nodes that make up its run of blocks: at most two per
    level and one per top node it contains, so a long range is not copied per
    block, let alone per unit of time.
    """
    p = cuts.with_block(points, point, tie, "__p")
    p = p.select("*", F.explode(F.array(*[F.struct(F.lit(k).alias("l"), F.shiftright(F.col("__p"), k).alias("i"))
                                          for k in range(TOP_LEVEL + 1)])).alias("__node"))
    r = cuts.with_last_below(cuts.with_block(ranges, lo, None, "__lo"), hi, "__hi", inclusive_hi)
    nodes = []
    for k in range(TOP_LEVEL + 1):
        left, right = F.shiftright(F.col("__lo") + (2 ** k - 1), k), F.shiftright(F.col("__hi") + 1, k)
        some = left < right
        node = lambda i: F.struct(F.lit(k).alias("l"), i.cast("int").alias("i"))  # noqa: B023, E731
        if k < TOP_LEVEL:
            nodes.append(F.when(some & (left % 2 == 1), F.array(node(left))).otherwise(F.array()))
            nodes.append(F.when(some & (right % 2 == 1), F.array(node(right - 1))).otherwise(F.array()))
        else:
            nodes.append(F.when(some, F.transform(F.sequence(left, right - 1), node)).otherwise(F.array()))
    r = r.select("*", F.explode(F.array_distinct(F.concat(*nodes))).alias("__node"))
    return p.join(r.drop("__lo", "__hi"), "__node").drop("__node", "__p")


def range_join(points: DataFrame, point_col: str, ranges: DataFrame, lo_col: str, hi_col: str,
               width: float | None = None, inclusive_hi: bool = True, blocks: int | None = None) -> DataFrame:
    """Pair each point with every range ``lo <= x <= hi`` (or ``< hi``).

    By default points are cut into equi-depth blocks and meet the ranges at
    the nodes of a tree over them (``_meet``): a burst of points is spread
    over blocks and a wide range costs a few copies.  With ``width``, ranges
    are copied into the fixed-width buckets they cover, which is cheaper when
    all ranges have about that length.  Either way the plan is an equi-join
    with an exact filter, not a nested loop.
    """
    pt = dict(points.dtypes)[point_col]
    lt = dict(ranges.dtypes)[lo_col]
    cond_hi = F.col(point_col) <= F.col(hi_col) if inclusive_hi else F.col(point_col) < F.col(hi_col)
    exact = (F.col(point_col) >= F.col(lo_col)) & cond_hi
    if width is not None:
        p = points.withColumn("__b", _bucket(_num(F.col(point_col), pt), width))
        r = ranges.withColumn("__b", F.explode(F.sequence(
            _bucket(_num(F.col(lo_col), lt), width), _bucket(_num(F.col(hi_col), lt), width))))
        return p.join(r, "__b").filter(exact).drop("__b")
    from .blocks import equi_depth
    at, tie = _num(F.col(point_col), pt), F.xxhash64(*[F.col(c) for c in points.columns]).cast("double")
    cuts = equi_depth(points, at, tie, blocks or _block_count(points))
    known = ranges.filter(F.col(lo_col).isNotNull() & F.col(hi_col).isNotNull())
    return _meet(points.filter(F.col(point_col).isNotNull()), known, cuts, at, tie, _num(F.col(lo_col), lt),
                 _num(F.col(hi_col), lt), inclusive_hi).filter(exact)


def _block_count(df: DataFrame) -> int:
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# ------------------------------------------------------- J5 lookups
def enrich(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], cols: Sequence[str] | None = None,
           default: Mapping[str, object] | object | None = None) -> DataFrame:
    """Left join to a lookup table; unmatched rows stay, optional
    defaults fill what the lookup did not provide.  Spark broadcasts the
    lookup when its measured size allows."""
    keys = [on] if isinstance(on, str) else list(on)
    cols = list(cols) if cols is not None else [c for c in lookup.columns if c not in keys]
    out = df.join(lookup.select(*keys, *cols), keys, "left")
    if default is not None:
        defaults = default if isinstance(default, Mapping) else {c: default for c in cols}
        for c, v in defaults.items():
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


# ------------------------------------------------------- J6 orphans
def orphans(objects: DataFrame, users: DataFrame, owner_col: str = "owner", user_col: str = "user",
            active_col: str | None = "active") -> DataFrame:
    """``orphan_status`` per object.

    owner present and active -> ``not_orphaned``; owner absent from the user
    table, or present and inactive -> ``confirmed``; no user evidence at all
    (null owner, or a user row whose status is unknown) -> ``unconfirmed``,
    which is never reported as a finding.
    """
    # one row per user: active if any of its rows says so, unknown if none is known
    u = users.groupBy(F.col(user_col).alias("__u")).agg(
        F.bool_or(F.col(active_col) if active_col else F.lit(True)).alias("__active"),
        F.lit(True).alias("__known"))
    j = objects.join(u, F.col(owner_col) == F.col("__u"), "left")
    status = (F.when(F.col(owner_col).isNull(), "unconfirmed")
              .when(F.col("__known").isNull(), "confirmed")
              .when(F.col("__active").isNull(), "unconfirmed")
              .when(F.col("__active"), "not_orphaned")
              .otherwise("confirmed"))
    return j.withColumn("orphan_status", status).drop("__u", "__active", "__known")


# ------------------------------------------------------- J7 ACL
def acl_roles(acl: DataFrame, object_key: str = "object_id") -> DataFrame:
    """J7 (long form): one row per object and role with what it may do;
    ``role`` may be a comma-separated list in the input."""
    roles = acl.withColumn("role", F.explode(F.split(F.col("role"), r"\s*,\s*")))
    return roles.groupBy(object_key, "role").agg(F.bool_or("can_read").alias("can_read"), F.bool_or("can_write").alias("can_write"))


def acl_exposure(objects: DataFrame, acl: DataFrame, object_key: str = "object_id",
                 sharing_col: str = "sharing") -> DataFrame:
    """Write exposure per object from its ACL rows (object_id, role,
    can_read, can_write; see ``acl_roles`` for the roles themselves): the
    number of roles that may write and read, and ``exposure``.  It is stated
    only when both sharing and ACL evidence exist, else ``unknown``.  Only
    counts are kept per object, however many roles it lists."""
    per_obj = acl_roles(acl, object_key).groupBy(object_key).agg(
        F.count_if(F.col("can_write")).alias("n_write_roles"), F.count_if(F.col("can_read")).alias("n_read_roles"),
        F.bool_or(F.col("can_write") & F.col("role").isin("*", "user")).alias("__broad"))
    j = objects.join(per_obj, object_key, "left")
    exposure = (F.when(F.col(sharing_col).isNull() | F.col("n_write_roles").isNull(), "unknown")
                .when(F.col("__broad"), "broad_write").when(F.col("n_write_roles") > 0, "restricted_write")
                .otherwise("read_only"))
    return j.withColumn("exposure", exposure).drop("__broad")


# ------------------------------------------ J8 effective capabilities
def role_closure(inherits: DataFrame, role_col: str = "role", parent_col: str = "inherits",
                 max_rounds: int = 64) -> DataFrame:
    """Transitive closure ``(role, ancestor)`` (each role is its own ancestor)
    by path doubling: with the pairs joined by a walk of fewer than n steps and
    those joined by a walk of exactly n, one round gives the same for 2 n, so
    a chain of 1,000 roles takes 11 rounds.  Cycles terminate: the rounds end
    when one adds no pair.

    Every round is written as a table (``round=<k>``) under the shared
    checkpoint folder and read back, which cuts lineage (a lost executor
    recomputes one round, not the chain) and makes the accumulated closure
    a plain file scan.
    """
    from ..session import scratch_path
    spark = inherits.sparkSession
    root = scratch_path(spark, "closure")
    base = inherits.select(F.col(role_col).alias("r"), F.col(parent_col).alias("p"))
    ends = F.array(F.struct(F.col("r").alias("role"), F.col("r").alias("ancestor")),
                   F.struct(F.col("p").alias("role"), F.col("p").alias("ancestor")))
    (base.select(F.explode(ends).alias("x")).select("x.*")
     .filter(F.col("role").isNotNull()).distinct().write.mode("overwrite").parquet(f"{root}/round=0"))
    (base.filter(F.col("p").isNotNull() & F.col("r").isNotNull())
     .select(F.col("r").alias("role"), F.col("p").alias("ancestor"))
     .distinct().write.mode("overwrite").parquet(f"{root}/step=0"))
    for k in range(1, max_rounds + 1):
        closure = spark.read.parquet(*[f"{root}/round={i}" for i in range(k)])
        step = spark.read.parquet(f"{root}/step={k - 1}")          # walks of exactly 2^(k-1) steps

        def then(pairs: DataFrame) -> DataFrame:
            return (pairs.alias("f").join(step.alias("e"), F.col("f.ancestor") == F.col("e.role"))      # noqa: B023
                    .select(F.col("f.role").alias("role"), F.col("e.ancestor").alias("ancestor")).distinct())

        (then(closure).join(closure, ["role", "ancestor"], "left_anti")
         .write.mode("overwrite").parquet(f"{root}/round={k}"))
        if spark.read.parquet(f"{root}/round={k}").isEmpty():
            return closure
        then(step).write.mode("overwrite").parquet(f"{root}/step={k}")
    # never return a partial closure
    raise RuntimeError(f"role closure did not converge in {max_rounds} rounds")


def effective_capabilities(user_groups: DataFrame, group_roles: DataFrame, role_inherits: DataFrame,
                           role_caps: DataFrame, closure: DataFrame | None = None) -> DataFrame:
    """User -> group -> role -> inherited roles -> capability.

    Inputs: (user, group), (group, role), (role, inherits), (role, capability).
    Output: distinct (user, capability, via_role).  A role with no
    inheritance row is its own only ancestor.
    """
    closure = closure if closure is not None else role_closure(role_inherits)
    user_roles = user_groups.join(group_roles, "group").select("user", "role")
    reach = (user_roles.join(closure, "role", "left")
             .select("user", F.col("role").alias("via_role"),
                     F.coalesce(F.col("ancestor"), F.col("role")).alias("role")))
    return reach.join(role_caps, "role").select("user", "capability", "via_role").distinct()


# --------------------------------------------- J9 class/pattern match
GRAM = 3                    # characters of a literal piece that index a glob


def _grams(text: Column, n: Column) -> Column:
    """Distinct runs of ``n`` characters of a text."""
    last = F.length(text) - n + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                                          lambda i: F.substring(text, i, n)))).otherwise(F.array())


def _inner_hits(clients: DataFrame, p: DataFrame, match_col: str) -> DataFrame:
    """Globs with wildcards inside.  Each is indexed by one run of up to
    ``GRAM`` characters of its literal pieces, the one that the fewest client
    names hold; names meet it by equality and the glob is then checked.  A
    glob without a literal says only how long a name is and meets the names by
    their length."""
    name = F.col(match_col)
    regex = F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(
        F.regexp_replace(F.col("pattern"), r"([.\\+^$()\[\]{}|])", r"\\$1"), r"\*", ".*"), r"\?", "."), F.lit("$"))
    own = p.filter(F.col("kind") == "inner").select("pattern", regex.alias("__re"), F.filter(
        F.split("pattern", r"[*?]+"), lambda x: x != "").alias("pieces"))
    own = own.withColumn("n", F.when(F.size("pieces") > 0, F.least(F.lit(GRAM), F.array_max(F.transform("pieces", F.length)))))
    sizes = [r["n"] for r in own.where("n is not null").select("n").distinct().collect()]       # 1..GRAM
    names = clients.select(match_col).filter(name.isNotNull()).distinct()
    hits = clients.sparkSession.createDataFrame([], f"pattern string, `{match_col}` string")
    if sizes:
        held = names.select(match_col, F.explode(F.concat(*[_grams(name, F.lit(n)) for n in sizes])).alias("gram"))
        choices = own.where("n is not null").select("pattern", "__re", F.explode("pieces").alias("piece"), "n") \
            .select("pattern", "__re", F.explode(_grams(F.col("piece"), F.col("n"))).alias("gram")).distinct()
        seen = held.join(choices.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
        chosen = (choices.join(seen, "gram")            # a gram that no name holds: the glob matches none
                  .groupBy("pattern", "__re").agg(F.min_by("gram", F.struct("names", "gram")).alias("gram"),
                                                  F.count(F.lit(1)).alias("held"))
                  .join(choices.groupBy("pattern").agg(F.count(F.lit(1)).alias("all")), "pattern")
                  .where("held = all").select("pattern", "__re", "gram"))
        hits = held.join(chosen, "gram").where(F.expr(f"`{match_col}` RLIKE __re")).select("pattern", match_col)
    bare = own.where("n is null").select("pattern", F.length(F.regexp_replace("pattern", r"\*", "")).alias("least"),
                                         F.col("pattern").contains("*").alias("more"))
    longest = names.agg(F.max(F.length(name)).alias("m")).first()["m"] or 0
    lengths = bare.where(F.col("least") <= longest).select("pattern", F.explode(F.sequence(
        "least", F.when(F.col("more"), F.lit(longest)).otherwise(F.col("least")))).alias("__n"))
    by_length = names.withColumn("__n", F.length(name)).join(lengths, "__n").select("pattern", match_col)
    return clients.join(hits.unionByName(by_length), match_col)


def _pattern_hits(clients: DataFrame, patterns: DataFrame, match_col: str) -> DataFrame:
    """(client columns, pattern) for every glob that matches the client, by
    equi-joins only: literal patterns by equality, those with one leading or
    trailing ``*`` by a prefix or suffix of the pattern's length, others by a
    literal piece (``_inner_hits``)."""
    p = patterns.select("pattern").distinct()
    head, tail = F.col("pattern").startswith("*"), F.col("pattern").endswith("*")
    core = F.regexp_replace("pattern", r"^\*|\*$", "")
    p = p.withColumn("core", core).withColumn("kind", F.when(
        F.col("core").rlike(r"[*?]") | (head & tail & (F.col("pattern") != "*")), "inner")
        .when(F.col("pattern") == "*", "prefix").when(tail, "prefix").when(head, "suffix").otherwise("literal"))
    name = F.col(match_col)

    def by_part(kind: str, part) -> DataFrame:
        own = p.filter(F.col("kind") == kind).select("core", "pattern", F.length("core").alias("n"))
        sizes = [r["n"] for r in own.select("n").distinct().collect()]      # lengths of patterns: a short list
        cut = clients.withColumn("n", F.explode(F.filter(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"),
                                                         lambda n: n <= F.length(name))))
        return cut.withColumn("core", part(F.col("n"))).join(own, ["core", "n"]).drop("core", "n")

    literal = clients.join(p.filter(F.col("kind") == "literal").select("pattern"), name == F.col("pattern"))
    start = by_part("prefix", lambda n: F.substring(name, F.lit(1), n))
    end = by_part("suffix", lambda n: F.substring(name, F.length(name) - n + 1, n))
    inner = _inner_hits(clients, p, match_col).select(*literal.columns)
    return literal.unionByName(start).unionByName(end).unionByName(inner)


SPREAD = 16                 # parts of the list of targets


def match_classes(clients: DataFrame, rules: DataFrame, client_key: str = "client",
                  match_col: str = "hostname") -> DataFrame:
    """Server-class membership.

    ``rules`` = (level, class, app, kind, pattern) with level in
    global/class/app, kind allow/deny and ``*``/``?`` globs.  Targets are
    the (class, app) pairs named by app rules.  Global rules apply to every
    target, class rules to every app of the class.  A client belongs to
    (class, app) when a global or class allow rule matches (class
    membership), the app's allow rules - if it has any - also match, and no
    applicable deny rule at any level matches (deny wins).

    Each distinct pattern is matched once and the hits are written once;
    they meet the rules and the targets by equi-joins on pattern and class.
    Clients that a global rule denies leave before anything is expanded; those
    that one allows meet the targets part by part.
    """
    from ..session import scratch_path
    spark = clients.sparkSession
    app_rules = rules.filter(F.col("level") == "app")
    targets = app_rules.select("class", "app").distinct()
    where = scratch_path(spark, "class-hits")
    (_pattern_hits(clients.select(client_key, match_col), rules, match_col).select(client_key, "pattern")
     .join(rules, "pattern").select(client_key, "level", "class", "app", "kind").distinct().write.parquet(where))
    hits = spark.read.parquet(where)
    level = lambda name, kind: hits.filter((F.col("level") == name) & (F.col("kind") == kind))
    denied = level("global", "deny").select(client_key).distinct()
    by_class = level("class", "allow").select(client_key, "class").join(denied, client_key, "left_anti").join(targets, "class")
    # a global allow reaches every target: as many rows as the answer needs
    everywhere = (level("global", "allow").select(client_key).distinct().join(denied, client_key, "left_anti")
                  .withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
                  .join(targets.withColumn("__part", F.pmod(F.xxhash64("class", "app"), F.lit(SPREAD)).cast("int")), "__part"))
    member = by_class.select(client_key, "class", "app").unionByName(everywhere.select(client_key, "class", "app")).distinct()
    member = member.join(level("class", "deny").select(client_key, "class").distinct(), [client_key, "class"], "left_anti")
    member = member.join(level("app", "deny").select(client_key, "class", "app").distinct(),
                         [client_key, "class", "app"], "left_anti")
    limited = (app_rules.filter(F.col("kind") == "allow").select("class", "app").distinct()
               .withColumn("__limited", F.lit(True)))
    allowed = (level("app", "allow").select(client_key, "class", "app").distinct().withColumn("__allowed", F.lit(True)))
    return (member.join(limited, ["class", "app"], "left").join(allowed, [client_key, "class", "app"], "left")
            .filter(F.col("__limited").isNull() | F.col("__allowed").isNotNull()).select(client_key, "class", "app"))


# --------------------------------------------- J10 compatibility, J11
def join_compatibility(installed: DataFrame, matrix: DataFrame, target: str) -> DataFrame:
    """Attach the compatibility rows for ``target`` to each installed
    (component, version); label by D2 (see decisions.compatibility_label)."""
    from .decisions import compatibility_label
    m = matrix.filter(F.col("target") == F.lit(target)).drop("target")
    j = installed.join(m, ["component", "version"], "left")
    return compatibility_label(j)


def join_findings(findings: DataFrame, inventory: DataFrame, remediation: DataFrame | None,
                  exceptions: DataFrame | None) -> DataFrame:
    """Finding x inventory (path-level key) x remediation x exception;
    no roll-up across paths.  Exposure status by D1."""
    from .decisions import exposure_status
    j = findings.join(inventory, ["component", "path", "asset"], "left")
    if remediation is not None:
        j = j.join(remediation, ["finding", "component", "path", "asset"], "left")
    if exceptions is not None:
        j = j.join(exceptions.withColumnRenamed("status", "exception_status"), "finding", "left")
    return exposure_status(j)


# -------------------------------------------- J12 interval conflicts
def interval_conflicts(a: DataFrame, b: DataFrame, a_start: str = "start", a_end: str = "end",
                       b_start: str = "start", b_end: str = "end", width_seconds: float | None = None,
                       a_prefix: str = "a_", b_prefix: str = "b_", blocks: int | None = None) -> DataFrame:
    """Every pair with ``a.start < b.end and b.start < a.end``.

    In such a pair either b starts inside a (a.start <= b.start) or a starts
    inside b (b.start < a.start): two joins of points with ranges over
    equi-depth blocks of all starts (``_meet``), which no pair passes twice.  A
    burst of intervals at one instant is spread over blocks, and an interval of
    many years costs a few copies.  ``width_seconds`` is accepted and not
    needed.  Intervals without a start or an end conflict with none.
    """
    from .blocks import equi_depth
    a2 = a.select(*[F.col(c).alias(a_prefix + c) for c in a.columns])
    b2 = b.select(*[F.col(c).alias(b_prefix + c) for c in b.columns])
    ta, tb = dict(a.dtypes)[a_start], dict(b.dtypes)[b_start]
    sa, ea = _num(F.col(a_prefix + a_start), ta), _num(F.col(a_prefix + a_end), ta)
    sb, eb = _num(F.col(b_prefix + b_start), tb), _num(F.col(b_prefix + b_end), tb)
    a2, b2 = a2.filter(sa.isNotNull() & ea.isNotNull()), b2.filter(sb.isNotNull() & eb.isNotNull())
    tie_a = F.xxhash64(*[F.col(c) for c in a2.columns]).cast("double")
    tie_b = F.xxhash64(*[F.col(c) for c in b2.columns]).cast("double")
    starts = a2.select(sa.alias("v"), tie_a.alias("t")).unionByName(b2.select(sb.alias("v"), tie_b.alias("t")))
    cuts = equi_depth(starts, F.col("v"), F.col("t"), blocks or _block_count(a))
    overlap = (F.col(a_prefix + a_start) < F.col(b_prefix + b_end)) & \
              (F.col(b_prefix + b_start) < F.col(a_prefix + a_end))
    inside_a = _meet(b2, a2, cuts, sb, tie_b, sa, ea, False).filter(overlap & (sa <= sb))
    inside_b = _meet(a2, b2, cuts, sa, tie_a, sb, eb, False).filter(overlap & (sb < sa))
    return inside_a.unionByName(inside_b).select(*a2.columns, *b2.columns)


# ------------------------------------------- J13 baseline vs post
def compare_baseline(before: DataFrame, after: DataFrame, metric: str = "metric",
                     value: str = "value", threshold: float | str = 0.1,
                     direction: str = "lower_is_better") -> DataFrame:
    """Pair each metric before and after (full outer join).

    ``status``: ``unresolved`` when a side is missing; ``regressed`` when the
    relative change in the bad direction exceeds the threshold; else ``ok``.
    """
    b = before.select(F.col(metric), F.col(value).alias("baseline"))
    a = after.select(F.col(metric), F.col(value).alias("observed"))
    j = b.join(a, metric, "full")
    th = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    change = (F.col("observed") - F.col("baseline")) / F.abs(F.col("baseline"))
    bad = change > th if direction == "lower_is_better" else -change > th
    status = (F.when(F.col("baseline").isNull() | F.col("observed").isNull(), "unresolved")
              .when(F.col("baseline") == 0, F.when(F.col("observed") == 0, "ok").otherwise("unresolved"))
              .when(bad, "regressed").otherwise("ok"))
    return j.withColumn("change", F.when(F.col("baseline") != 0, change)).withColumn("status", status)


# --------------------------------------------- J14 / J15 delivery
def unacked(submitted: DataFrame, acks: DataFrame, on: Sequence[str]) -> DataFrame:
    """J14 (batch): submissions with no acknowledgement."""
    return submitted.join(acks.select(*on).distinct(), list(on), "left_anti")


def verify_markers(submitted: DataFrame, observed: DataFrame, on: Sequence[str],
                   ok_col: str = "response_ok") -> DataFrame:
    """``validated`` only when the response was OK *and* the marker was
    observed; ``not_observed`` when OK but unseen; ``rejected`` otherwise;
    ``unknown`` when the response status is unknown."""
    seen = observed.select(*on).distinct().withColumn("__seen", F.lit(True))
    j = submitted.join(seen, list(on), "left")
    status = (F.when(F.col(ok_col).isNull(), "unknown")
              .when(~F.col(ok_col), "rejected")
              .when(F.col("__seen").isNotNull(), "validated")
              .otherwise("not_observed"))
    return j.withColumn("delivery_status", status).drop("__seen")


# ----------------------------------------------------- J16 as-of
def as_of(decisions: DataFrame, observations: DataFrame, key: Sequence[str] | str, ts: str,
          value_cols: Sequence[str], obs_ts: str | None = None, blocks: int | None = None,
          prefix: str = "obs_") -> DataFrame:
    """For every decision row, the newest observation with the same key
    at or before the decision time (equal-time observations: the greatest
    values).  A decision without key or time stays, with no observation.

    Scales without a range join and without a per-key window: decisions and
    observations are unioned and tagged with a block of the time order.
    Inside a (key, block) partition a ``last(ignorenulls)`` window carries the
    newest observation forward; the newest observation of every earlier block
    comes from a per-(key, block) aggregate carried forward over blocks.
    """
    from .windows import blocked_last
    keys = [key] if isinstance(key, str) else list(key)
    obs_ts = obs_ts or ts
    vals = list(value_cols)
    d = decisions.withColumn("__is_obs", F.lit(0)).withColumn("__t", F.col(ts))
    o = observations.select(*keys, F.col(obs_ts).alias("__t"),
                            F.struct(F.col(obs_ts).alias(prefix + obs_ts if obs_ts == ts else obs_ts),
                                     *[F.col(v).alias(prefix + v) for v in vals]).alias("__obs"))
    timed = F.col("__t").isNotNull()
    for k in keys:
        timed = timed & F.col(k).isNotNull()
    o = o.withColumn("__is_obs", F.lit(1)).filter(timed)
    u = d.unionByName(o, allowMissingColumns=True)
    carried = blocked_last(u, keys, "__t", "__is_obs", "__obs", blocks)
    out = carried.filter(F.col("__is_obs") == 0)
    return out.select(*decisions.columns, F.col("__carried.*"))


# ------------------------------------------- J17 member comparison
def compare_members(df: DataFrame, object_key: Sequence[str] | str, member: str,
                    attrs: Sequence[str]) -> DataFrame:
    """Per object, how many members have it (``n_present``), how many
    lack it (``n_missing``), how many variants of its metadata they hold, and
    whether all agree.  The member count is one aggregate, so no objects x
    members product is formed; ``member_presence`` and ``missing_members``
    give the names."""
    keys = [object_key] if isinstance(object_key, str) else list(object_key)
    n_members = df.select(member).filter(F.col(member).isNotNull()).distinct().count()
    checksum = F.xxhash64(*[F.col(a) for a in attrs])
    # per (object, member) first: distinct counts of a hot object stay partial
    per = df.groupBy(*keys).agg(F.count_distinct(F.col(member)).alias("n_present"),
                                F.count_distinct(checksum).alias("variants"))
    return (per.withColumn("n_missing", F.lit(n_members).cast("long") - F.col("n_present"))
            .withColumn("consistent", (F.col("variants") <= 1) & (F.col("n_missing") == 0)))


def member_presence(df: DataFrame, object_key: Sequence[str] | str, member: str) -> DataFrame:
    """J17 (long form): one row per object and member that has it."""
    keys = [object_key] if isinstance(object_key, str) else list(object_key)
    return df.select(*keys, member).filter(F.col(member).isNotNull()).distinct()


def missing_members(df: DataFrame, object_key: str, member: str, objects: Sequence) -> DataFrame:
    """(object, member) for every member that lacks one of the asked
    ``objects`` (the caller's list; never all objects x members)."""
    asked = F.array(*[F.lit(o).cast(df.schema[object_key].dataType) for o in objects])
    members = df.select(member).filter(F.col(member).isNotNull()).distinct()
    pairs = members.select(F.explode(asked).alias(object_key), member)
    return pairs.join(member_presence(df, object_key, member), [object_key, member], "left_anti")


# ------------------------------------------------------ J18 CIDR
def ipv4_to_long(col: Column) -> Column:
    parts = F.split(col, r"\.")
    ok = col.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$")
    n = (F.get(parts, 0).cast("long") * 16777216 + F.get(parts, 1).cast("long") * 65536 +
         F.get(parts, 2).cast("long") * 256 + F.get(parts, 3).cast("long"))
    valid = ok & F.get(parts, 0).cast("int").between(0, 255) & F.get(parts, 1).cast("int").between(0, 255) & \
        F.get(parts, 2).cast("int").between(0, 255) & F.get(parts, 3).cast("int").between(0, 255)
    return F.when(valid, n)


def cidr_bounds(col: Column) -> Column:
    """struct(lo, hi) of an IPv4 CIDR ``a.b.c.d/n`` (host bits ignored)."""
    ip = ipv4_to_long(F.split(col, "/").getItem(0))
    bits = F.coalesce(F.get(F.split(col, "/"), 1).cast("int"), F.lit(32))
    size = F.power(F.lit(2.0), F.lit(32) - bits).cast("long")
    lo = ip - F.pmod(ip, size)
    return F.when(ip.isNotNull() & bits.between(0, 32), F.struct(lo.alias("lo"), (lo + size - 1).alias("hi")))


SHORT_BITS = 16             # prefixes of so many bits or fewer hold the busy keys: at most 131,071 different ones
BROADCAST_ROWS = 200_000    # networks that are broadcast at most


def _cidr_keys(df: DataFrame, col: Column) -> DataFrame:
    """``df`` plus (__bits, __prefix) of a valid IPv4 CIDR."""
    bits = F.coalesce(F.get(F.split(col, "/"), 1).cast("int"), F.lit(32))
    x = df.withColumn("__r", cidr_bounds(col)).filter(F.col("__r").isNotNull()).withColumn("__bits", bits)
    return x.withColumn("__prefix", F.expr("shiftright(__r.lo, 32 - __bits)")).drop("__r")


def _bits_present(cidrs: DataFrame) -> list[int]:
    return sorted(r[0] for r in cidrs.select("__bits").distinct().collect())        # 33 values at most


def _join_keys(exploded: DataFrame, own: DataFrame) -> DataFrame:
    """Join keys exploded from one table with a list of networks.  The list is
    broadcast after a check of its number, else both sides are shuffled; the
    exploded side is never broadcast (Spark takes it for no larger than the
    table it was made from)."""
    few = own.count() <= BROADCAST_ROWS
    return exploded.join(F.broadcast(own) if few else own.hint("merge"), ["__bits", "__prefix"])


def cidr_match(traffic: DataFrame, ip_col: str, cidrs: DataFrame, cidr_col: str = "cidr") -> DataFrame:
    """Pair each address with every CIDR containing it, by equality of
    (prefix length, prefix) over the lengths that the list holds: an address
    has at most 33 keys and a CIDR one, whatever its size.  Keys that much of
    the traffic shares are those of short prefixes; they are joined apart from
    the longer ones, each list broadcast after a check of its number."""
    c = _cidr_keys(cidrs, F.col(cidr_col))
    t = traffic.withColumn("__ip", ipv4_to_long(F.col(ip_col))).filter(F.col("__ip").isNotNull())
    present = _bits_present(c)

    def pairs(bits: list[int], own: DataFrame) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(n).alias("b"), F.shiftright(F.col("__ip"), 32 - n).alias("p")) for n in bits])
        x = t.withColumn("__k", F.explode(keys)).withColumn("__bits", F.col("__k.b")).withColumn("__prefix", F.col("__k.p"))
        return _join_keys(x, own).drop("__k", "__bits", "__prefix", "__ip")

    out = None
    for bits, own in (([n for n in present if n <= SHORT_BITS], c.filter(F.col("__bits") <= SHORT_BITS)),
                      ([n for n in present if n > SHORT_BITS], c.filter(F.col("__bits") > SHORT_BITS))):
        if bits:
            part = pairs(bits, own)
            out = part if out is None else out.unionByName(part)
    if out is None:                             # no valid CIDR
        from pyspark.sql.types import StructType
        return traffic.sparkSession.createDataFrame([], StructType(traffic.schema.fields + cidrs.schema.fields))
    return out


def longest_prefix(traffic: DataFrame, ip_col: str, cidrs: DataFrame, cidr_col: str = "cidr",
                   out: str = "network") -> DataFrame:
    """Every traffic row with the most specific CIDR containing its
    address (null if none; equal prefixes written differently: the least
    text).  Equal prefixes become one network, written once, before the
    distinct addresses are matched, so an address has at most 33 pairs; the
    result is joined back."""
    from ..session import scratch_path
    spark = traffic.sparkSession
    ips = traffic.select(F.col(ip_col)).filter(F.col(ip_col).isNotNull()).distinct()
    nets = (_cidr_keys(cidrs.select(cidr_col), F.col(cidr_col)).groupBy("__bits", "__prefix")
            .agg(F.min(cidr_col).alias(cidr_col)).select(cidr_col))
    path = scratch_path(spark, "networks")
    nets.write.parquet(path)
    nets = spark.read.parquet(path)
    bits = F.coalesce(F.get(F.split(F.col(cidr_col), "/"), 1).cast("int"), F.lit(32))
    best = cidr_match(ips, ip_col, nets, cidr_col).groupBy(ip_col).agg(F.max_by(cidr_col, bits).alias(out))
    return traffic.join(best, ip_col, "left")


def cidr_overlaps(a: DataFrame, b: DataFrame, col: str = "cidr") -> DataFrame:
    """Pairs of overlapping CIDRs from two lists.  Of two such networks
    one contains the other, so the narrower one's prefix, cut to the wider
    one's length, is equal to it."""
    x = _cidr_keys(a.select(F.col(col).alias("a_" + col)), F.col("a_" + col))
    y = _cidr_keys(b.select(F.col(col).alias("b_" + col)), F.col("b_" + col))

    def within(inner: DataFrame, outer: DataFrame, strictly: bool) -> DataFrame:
        bits = F.array(*[F.lit(n) for n in _bits_present(outer)]).cast("array<int>")
        fits = F.filter(bits, lambda n: (n < F.col("__bits")) if strictly else (n <= F.col("__bits")))
        cut = inner.withColumn("__n", F.explode(fits)).withColumn("__cut", F.expr("shiftright(__prefix, __bits - __n)"))
        cut = cut.drop("__bits", "__prefix").withColumnsRenamed({"__n": "__bits", "__cut": "__prefix"})
        return _join_keys(cut, outer).select("a_" + col, "b_" + col)

    return within(x, y, False).unionByName(within(y, x, True))


# ------------------------------------------------------ J19 chains
def chain(base: DataFrame, *children: Callable[[DataFrame], DataFrame], cache: bool = True) -> list[DataFrame]:
    """Several searches extending one shared base result.  The base is
    persisted (memory and disk) when reused, so it is computed once."""
    if cache and len(children) > 1:
        base = base.persist()
    return [fn(base) for fn in children]


# ------------------------------------------------------ U1-U3, U5, U6
def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def intersect(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    return a.intersectAll(b) if all else a.intersect(b)


def except_(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    return a.exceptAll(b) if all else a.subtract(b)


def result_equivalence(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows only in a, rows only in b (multiset), equivalent.

    Both sides are counted per distinct row in one aggregation (a union and
    a group-by, one shuffle), rather than two exceptAll plans."""
    cols = a.columns
    if sorted(cols) != sorted(b.columns):
        raise ValueError("results have different columns")
    ua = a.select(*cols).withColumn("__side", F.lit(1))
    ub = b.select(*cols).withColumn("__side", F.lit(-1))
    g = ua.unionByName(ub).groupBy(*cols).agg(
        F.sum(F.when(F.col("__side") == 1, 1).otherwise(0)).alias("__na"),
        F.sum(F.when(F.col("__side") == -1, 1).otherwise(0)).alias("__nb"))
    diff = g.select(F.greatest(F.col("__na") - F.col("__nb"), F.lit(0)).alias("oa"),
                    F.greatest(F.col("__nb") - F.col("__na"), F.lit(0)).alias("ob"))
    out = diff.agg(F.coalesce(F.sum("oa"), F.lit(0)).cast("long").alias("only_a"),
                   F.coalesce(F.sum("ob"), F.lit(0)).cast("long").alias("only_b"))
    return out.withColumn("equivalent", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def minimal_diff(current: DataFrame, desired: DataFrame, key: Sequence[str],
                 target: str | None = None) -> DataFrame:
    """Per (target,) entry: ``add`` (desired only), ``remove`` (current
    only) or ``noop`` (both)."""
    ks = ([target] if target else []) + list(key)
    c = current.select(*ks).distinct().withColumn("__c", F.lit(True))
    d = desired.select(*ks).distinct().withColumn("__d", F.lit(True))
    j = c.join(d, ks, "full")
    action = F.when(F.col("__c").isNull(), "add").when(F.col("__d").isNull(), "remove").otherwise("noop")
    return j.withColumn("action", action).drop("__c", "__d")


def dedupe_tokens(col: Column | str) -> Column:
    """Case-insensitive first-seen dedupe of an array of tokens; blank
    tokens are dropped, order of first appearance is kept (O(n log n) per
    array, see ``first_occurrences``)."""
    from ..functions.arrays import first_occurrences
    arr = F.col(col) if isinstance(col, str) else col
    toks = F.filter(F.transform(arr, lambda t: F.trim(t)), lambda t: t != "")
    return first_occurrences(toks, lambda t: F.lower(t))


def dedupe_urls(df: DataFrame, url: str = "url", title: str | None = "title",
                hosts: Sequence[str] | None = None) -> DataFrame:
    """One row per canonical URL (E15 key + path), non-blank title,
    optional allowed-host list; the smallest original URL is kept."""
    from .extract import normalize_url
    canon = F.concat(normalize_url(F.col(url))["key"],
                     F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)?", 1))
    out = df.withColumn("canonical_url", canon).filter(F.col("canonical_url").isNotNull())
    if title:
        out = out.filter(F.coalesce(F.trim(F.col(title)), F.lit("")) != "")
    if hosts:
        out = out.filter(normalize_url(F.col(url))["host"].isin(list(hosts)))
    return (out.groupBy("canonical_url").agg(F.min(F.col(url)).alias(url), F.count(F.lit(1)).alias("copies")))
