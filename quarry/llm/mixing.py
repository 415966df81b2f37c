"""Mixing sources to target weights by iterative proportional fitting.

Token sums per cell (source, language, topic) are raked until their margins
meet the targets: source factors, then language factors, then topic factors,
again and again.  Documents are then sampled with the probability of their
cell.  The expected tokens are ``keep`` of all tokens, no document is drawn
more than once, and the margins are fitted again under that bound: cells that
would need more than their tokens are kept whole and the others of the margin
make up for them.  Where a whole source, language or topic has fewer tokens
than its target's part of the budget, the target cannot be met by any draw:
all of it is kept, and the other values share the rest in proportion to their
targets.  ``attained`` gives target and expected share of each value.

The cell table is aggregated from the documents once and written.  Source
factors, of which there may be many, are closed-form sums per source inside
Spark; what reaches the driver per round is one row per (language, topic).
The draw is a hash of id and text, so it repeats exactly after a lost
executor; repeated rows share their draw.

Defined cases: null sources and languages are values of their own; null texts
have no tokens and no weight, and are kept with probability 1 of the scale;
targets of 0 and values without target get no weight; cells that the targets
cannot meet (empty combinations) end at the nearest raked weights after
``rounds``; an empty table gives no rows; further columns are kept by
``sample``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

TEMPER = 0.7                # default targets: token shares to this power
KEEP = 0.8                  # expected share of tokens kept
ROUNDS = 60
TOLERANCE = 1e-6
SEED = 20
LOCAL_CELLS = 20_000        # up to so many cells the bounded fit runs in the driver, with LOCAL_ROUNDS rounds
LOCAL_ROUNDS = 2_000        # (targets near the edge of what the tokens allow converge slowly)
_STEPS = 64                 # ratio classes per octave when the scale is solved


def topic_of(text):
    """Default topic: the form of a text, by plain rules."""
    cells = F.length(text) - F.length(F.replace(text, F.lit(" | "), F.lit("  ")))
    low = F.lower(text)
    return (F.when(text.isNull(), "none")
            .when(cells >= 5, "table")
            .when(low.contains("licen") | low.contains("rights reserved"), "legal")
            .when(F.length(text) < 400, "short")
            .when(F.length(text) >= 8000, "long").otherwise("prose"))


def token_count(text):
    """Number of words."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(parts, lambda w: w != "")).cast("bigint")


def tempered(values: dict, power: float = TEMPER) -> dict:
    """Targets from token sums: shares to ``power``, adding up to 1."""
    w = {k: float(v) ** power if v else 0.0 for k, v in values.items()}
    total = sum(w.values())
    return {k: v / total for k, v in w.items()} if total else w


def rake(cells: DataFrame, lang_target: dict | None = None, topic_target: dict | None = None,
         source_target: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) plus ``weight``, adding up to 1.

    ``source_target`` is a table (source, target); by default each margin's
    token shares are tempered.
    """
    spark = cells.sparkSession
    live = cells.where("tokens > 0")
    by_pair = {(r["lang"], r["topic"]): r["t"] for r in
               live.groupBy("lang", "topic").agg(F.sum("tokens").alias("t")).collect()}   # languages x topics rows
    if not by_pair:
        return cells.withColumn("weight", F.lit(0.0))
    langs, topics = sorted({k[0] for k in by_pair}), sorted({k[1] for k in by_pair})
    margin = lambda i, names: {x: sum(t for k, t in by_pair.items() if k[i] == x) for x in names}
    share = lambda want, names: np.array([max(want.get(x, 0.0), 0.0) for x in names])
    goal_l = share(lang_target or tempered(margin(0, langs)), langs)
    goal_t = share(topic_target or tempered(margin(1, topics)), topics)
    goal_l, goal_t = goal_l / max(goal_l.sum(), 1e-300), goal_t / max(goal_t.sum(), 1e-300)
    if source_target is None:
        source_target = live.groupBy("source").agg((F.sum("tokens") ** TEMPER).alias("target"))
    source_target = stash(source_target.select("source", F.col("target").cast("double").alias("target")), "mix-targets")
    whole = source_target.agg(F.sum("target")).first()[0] or 1.0
    goal = source_target.select("source", (F.col("target") / whole).alias("goal"))
    live = stash(live.join(goal, "source").select("source", "lang", "topic", "tokens", "goal"), "mix-cells")
    factor = np.ones((len(langs), len(topics)))

    def weighted(f: np.ndarray) -> DataFrame:
        """Cells with the factors and the closed-form source factor applied."""
        rows = [(x, y, float(f[i, j])) for i, x in enumerate(langs) for j, y in enumerate(topics)]
        small = F.broadcast(spark.createDataFrame(rows, "lang string, topic string, f double"))
        part = live.join(small, ["lang", "topic"]).withColumn("w", F.col("tokens") * F.col("f"))
        own = F.sum("w").over(Window.partitionBy("source"))          # languages x topics rows per source
        return part.withColumn("weight", F.when(own > 0, F.col("w") * F.col("goal") / own).otherwise(0.0))

    at = {(x, y): (i, j) for i, x in enumerate(langs) for j, y in enumerate(topics)}
    for _ in range(rounds):
        table = np.zeros_like(factor)
        for r in weighted(factor).groupBy("lang", "topic").agg(F.sum("weight").alias("w")).collect():
            table[at[r["lang"], r["topic"]]] = r["w"]
        off = max(np.abs(table.sum(1) - goal_l * table.sum()).max(), np.abs(table.sum(0) - goal_t * table.sum()).max())
        if off < TOLERANCE:
            break
        for _ in range(20):                                          # languages, then topics
            for axis, want in ((1, goal_l), (0, goal_t)):
                have = table.sum(axis)
                step = np.where(have > 0, want / np.maximum(have, 1e-300), 0.0)
                step = step[:, None] if axis else step[None, :]
                table, factor = table * step, factor * step
        factor /= max(factor.max(), 1e-300)
    out = weighted(factor).select("source", "lang", "topic", "weight")
    keys = ["source", "lang", "topic"]
    return cells.join(out, keys, "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))


def fill(goal: np.ndarray, room: np.ndarray, budget: float) -> np.ndarray:
    """Token goals min(room, level * goal) that add up to the budget."""
    lo, hi = 0.0, 1.0
    while np.minimum(room, hi * goal).sum() < min(budget, room[goal > 0].sum()) * (1 - 1e-12) and hi < 1e300:
        hi *= 2
    for _ in range(200):
        level = (lo + hi) / 2
        lo, hi = (level, hi) if np.minimum(room, level * goal).sum() < budget else (lo, level)
    return np.minimum(room, hi * goal)


def _solve(at, goal, t, u):
    """Factors at which the bounded sums min(t, factor * u) meet the goals."""
    lo, hi = np.full(len(goal), -10.0), np.full(len(goal), 10.0)
    for _ in range(50):
        mid = (lo + hi) / 2
        low = np.bincount(at, weights=np.minimum(t, u * np.exp(mid)[at]), minlength=len(goal)) < goal
        lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
    return np.exp((lo + hi) / 2)


def _fit_bounded(t: np.ndarray, w: np.ndarray, margins: list, budget: float) -> np.ndarray:
    """Expected tokens of the cells; ``margins`` hold the cells' position in
    each margin, the source last, so that the budget is met exactly."""
    goals = [fill(np.bincount(at, weights=w), np.bincount(at, weights=t), budget) for at in margins]
    u = w * budget
    for _ in range(LOCAL_ROUNDS):
        for at, goal in zip(margins, goals):
            u = np.clip(u * _solve(at, goal, t, u)[at], 1e-250, 1e250)
        x = np.minimum(t, u)
        if max(np.abs(np.bincount(at, weights=x) - goal).max() for at, goal in zip(margins, goals)) <= TOLERANCE * budget:
            break
    return x


def _level(rows: DataFrame, budget: float) -> float:
    """The level of ``fill`` for a table (goal, room), solved on classes of
    equal ratio, a bounded number of rows; refined within the class hit."""
    ratio = F.col("room") / F.col("goal")
    kind = F.floor(F.log2(ratio) * _STEPS)
    got = (rows.where("goal > 0 AND room > 0").groupBy(kind.alias("k"))
           .agg(F.sum("room").alias("t"), F.sum("goal").alias("w"), F.min(ratio).alias("lo"),
                F.max(ratio).alias("hi")).orderBy("k").collect())
    below, above, level = 0.0, sum(r["w"] for r in got), 0.0
    for r in got:
        if below + r["hi"] * (above - r["w"]) + r["t"] >= budget:            # the level lies in or before this class
            level = (budget - below) / above
            if level <= r["lo"]:
                return level
            inner = np.array(rows.where((F.col("goal") > 0) & (F.col("room") > 0) & (kind == r["k"]))
                             .groupBy(ratio.alias("r")).agg(F.sum("room"), F.sum("goal")).orderBy("r")
                             .limit(100_000).collect(), dtype=float)
            for q, t, w in inner:
                level = (budget - below) / above
                if level <= q:
                    return level
                below, above = below + t, above - w
            return (budget - below) / above if above > 0 else r["hi"]
        below, above = below + r["t"], above - r["w"]
    return got[-1]["hi"] * 2 if got else 0.0


def probabilities(raked: DataFrame, keep: float = KEEP, rounds: int = ROUNDS) -> DataFrame:
    """``raked`` plus ``probability``: the expected tokens are ``keep`` of all,
    and their margins those of ``weight`` as far as the tokens allow.

    A cell's expected tokens are min(tokens, weight * source factor * language
    factor * topic factor).  Source factors are closed-form sums inside Spark;
    the others are solved on classes of equal ratio per (language, topic), a
    bounded number of rows whatever the number of cells."""
    raked = stash(raked, "mix-raked")
    spark = raked.sparkSession
    live = raked.where("tokens > 0 AND weight > 0").select("source", "lang", "topic", "tokens", "weight")
    sums = live.groupBy("lang", "topic").agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w")).collect()
    zero = F.when(F.col("tokens") > 0, 0.0).otherwise(1.0)
    if not sums:
        return raked.withColumn("probability", zero)
    budget = min(keep * (raked.agg(F.sum("tokens")).first()[0] or 0), float(sum(r["t"] for r in sums)))
    langs, topics = sorted({r["lang"] for r in sums}), sorted({r["topic"] for r in sums})
    at_l, at_t = {x: i for i, x in enumerate(langs)}, {x: i for i, x in enumerate(topics)}
    keys = ["source", "lang", "topic"]
    if live.count() <= LOCAL_CELLS:
        rows = live.orderBy(*keys).collect()                         # at most LOCAL_CELLS
        t, w = (np.array([float(r[c]) for r in rows]) for c in ("tokens", "weight"))
        x = _fit_bounded(t, w, [np.unique([r[c] for r in rows], return_inverse=True)[1] for c in reversed(keys)], budget)
        out = spark.createDataFrame([(*r[:3], float(p)) for r, p in zip(rows, x / t)],
                                    "source string, lang string, topic string, probability double")
        return (raked.join(F.broadcast(out), keys, "left")
                .withColumn("probability", F.least(F.coalesce(F.col("probability"), zero), F.lit(1.0))))
    margin = lambda c, at, v: np.bincount([at[r[c]] for r in sums], weights=[float(r[v]) for r in sums])
    goal_l = fill(margin("lang", at_l, "w"), margin("lang", at_l, "t"), budget)
    goal_t = fill(margin("topic", at_t, "w"), margin("topic", at_t, "t"), budget)
    by_source = stash(live.groupBy("source").agg(F.sum("weight").alias("goal"), F.sum("tokens").cast("double").alias("room")),
                      "mix-sources")
    level = _level(by_source, budget)
    by_source = by_source.select("source", F.least(F.col("room"), F.col("goal") * float(level)).alias("goal"))
    live = stash(live.join(by_source, "source"), "mix-live")
    factor = np.ones((len(langs), len(topics)))

    def expected(f: np.ndarray) -> DataFrame:
        """Cells with ``x``, the tokens expected of them, and ``u`` before the bound."""
        rows = [(x, y, float(f[i, j])) for i, x in enumerate(langs) for j, y in enumerate(topics)]
        small = F.broadcast(spark.createDataFrame(rows, "lang string, topic string, f double"))
        part = live.join(small, ["lang", "topic"]).withColumn("u", F.col("weight") * F.col("f"))
        part = part.withColumn("r", F.col("tokens") / F.col("u"))
        own = Window.partitionBy("source")                           # languages x topics rows per source
        upto = own.orderBy("r", "lang", "topic").rowsBetween(Window.unboundedPreceding, 0)
        after = own.orderBy("r", "lang", "topic").rowsBetween(1, Window.unboundedFollowing)
        part = part.withColumn("__rest", F.coalesce(F.sum("u").over(after), F.lit(0.0)))
        # a cell is kept whole if its source's goal is not reached when its factor meets the bound
        part = part.withColumn("whole", F.sum("tokens").over(upto) + F.col("r") * F.col("__rest")
                               <= F.col("goal") * (1 + 1e-12))
        full = F.sum(F.when(F.col("whole"), F.col("tokens")).otherwise(0)).over(own)
        free = F.sum(F.when(F.col("whole"), 0.0).otherwise(F.col("u"))).over(own)
        part = part.withColumn("a", F.when(free > 0, F.greatest(F.col("goal") - full, F.lit(0.0)) / free)
                               .otherwise(F.max("r").over(own)))
        return (part.withColumn("u", F.col("u") * F.col("a"))
                .withColumn("x", F.when(F.col("whole"), F.col("tokens").cast("double"))
                            .otherwise(F.least(F.col("tokens").cast("double"), F.col("u")))))

    for _ in range(rounds):
        kind = F.when(F.col("whole") | (F.col("u") >= F.col("tokens")), -1 - F.floor(F.log2(F.greatest(
            F.col("u") / F.col("tokens"), F.lit(1.0))) * _STEPS)).otherwise(
            F.floor(F.log2(F.col("tokens") / F.col("u")) * _STEPS))
        got = (expected(factor).groupBy("lang", "topic", kind.alias("k"))
               .agg(F.sum("tokens").alias("t"), F.sum("u").alias("u"), F.sum("x").alias("x")).collect())
        i, j = np.array([at_l[r["lang"]] for r in got]), np.array([at_t[r["topic"]] for r in got])
        t, u, x = (np.array([float(r[c]) for r in got]) for c in "tux")
        off = max(np.abs(np.bincount(i, weights=x, minlength=len(langs)) - goal_l).max(),
                  np.abs(np.bincount(j, weights=x, minlength=len(topics)) - goal_t).max())
        if off <= TOLERANCE * budget:
            break
        for _ in range(10):                                          # languages, then topics
            for axis, (at, goal) in enumerate(((i, goal_l), (j, goal_t))):
                step = _solve(at, goal, t, u)
                u = u * step[at]
                factor = factor * (step[None, :] if axis else step[:, None])
        factor = np.clip(factor / np.exp(np.log(factor).mean()), 1e-30, 1e30)
    out = expected(factor).select("source", "lang", "topic", (F.col("x") / F.col("tokens")).alias("probability"))
    return (raked.join(out, keys, "left")
            .withColumn("probability", F.least(F.coalesce(F.col("probability"), zero), F.lit(1.0))))


def attained(cells: DataFrame) -> DataFrame:
    """(margin, value, target, share) of a table of ``probabilities``: each
    value's raked weight and its share of the expected tokens."""
    x = F.when(F.col("tokens") > 0, F.col("tokens") * F.col("probability")).otherwise(0.0)
    whole = cells.agg(F.sum(x).alias("__all"))
    one = lambda c: (cells.groupBy(F.lit(c).alias("margin"), F.col(c).alias("value"))
                     .agg(F.sum("weight").alias("target"), F.sum(x).alias("x")))
    return (one("source").unionByName(one("lang")).unionByName(one("topic")).crossJoin(F.broadcast(whole))
            .select("margin", "value", "target", (F.col("x") / F.col("__all")).alias("share")))


def calibrate(docs: DataFrame, topic=None, lang_target: dict | None = None, topic_target: dict | None = None,
              source_target: DataFrame | None = None, keep: float = KEEP, seed: int = SEED,
              id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              lang_col: str = "lang") -> DataFrame:
    """``docs`` plus __topic, __tokens, __probability and __sampled."""
    text = F.col(text_col).cast("string")
    none = F.lit("\u0000")                                             # the value of nulls
    marked = (docs.withColumn("__source", F.coalesce(F.col(source_col).cast("string"), none))
              .withColumn("__lang", F.coalesce(F.col(lang_col).cast("string"), none))
              .withColumn("__topic", topic_of(text) if topic is None else F.coalesce(topic, none))
              .withColumn("__tokens", token_count(text)))
    cells = stash(marked.groupBy(F.col("__source").alias("source"), F.col("__lang").alias("lang"),
                                 F.col("__topic").alias("topic")).agg(F.sum("__tokens").alias("tokens")), "mix-sums")
    weights = stash(probabilities(rake(cells, lang_target, topic_target, source_target), keep)
                    .select(F.col("source").alias("__source"), F.col("lang").alias("__lang"),
                            F.col("topic").alias("__topic"), F.col("probability").alias("__probability")), "mix-weights")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), text), 11) / F.lit(float(1 << 53))
    return (marked.join(weights, ["__source", "__lang", "__topic"], "left")
            .withColumn("__sampled", draw < F.col("__probability")))


def mixture_rows(docs: DataFrame, **options) -> DataFrame:
    """Topic, tokens, probability and draw of every document."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source", "lang")
    return calibrate(slim, **options).select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"),
        F.col("__probability").alias("probability"), F.col("__sampled").alias("sampled"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents, with their own columns."""
    return calibrate(docs, **options).where("__sampled").select(*[F.col(f"`{c}`") for c in docs.columns])
