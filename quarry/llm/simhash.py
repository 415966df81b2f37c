"""SimHash near-duplicates by exact vantage-point search.

Two fingerprints link when at most ``max_bits`` bits differ.  All links are
found without comparing all pairs:

1. Pigeonhole shards.  The 64 bits are cut into ``m`` blocks; two linked
   fingerprints agree on at least ``m - max_bits`` whole blocks, so for one
   choice of that many blocks (a mask) their masked distance to *any* vantage
   point is equal: the ball of a query lies in one shard of that mask.  ``m``
   grows with the number of distinct fingerprints so that shards stay small.
2. Vantage-point tree.  A shard above ``leaf`` rows is split at the median
   Hamming distance to a vantage point.  A fingerprint of the near side whose
   ball of ``max_bits`` crosses the boundary is also sent to the far side, so
   boundary-overlapping shards are searched and no pair is lost.  Where
   splitting no longer helps (a dense cluster), the shard is dealt into chunks
   and every pair of chunks is one group.
3. In a leaf, rows are sorted by distance to the leaf's vantage point; the
   triangle bound leaves only rows within ``max_bits`` of each other's
   distance, and only those are compared bit by bit.

A leaf emits one edge per fingerprint to the smallest one it reaches there,
never all pairs.  Components of the edges come from alternating large-star and
small-star rounds, each written as a table.  Only distinct fingerprints take
part; copies follow their fingerprint.

Defined cases: null and wordless texts have fingerprint zero and link like any
other; texts with fewer words than a shingle are one shingle; repeated rows
share a component; rows without id take part, the component id is the
smallest id present (null if there is none); an empty table gives no rows;
further columns are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, release, slices, stash

SHINGLE = 4
MAX_BITS = 4
LEAF = 512                  # rows a leaf may hold before it is split
LEVELS = 4                  # vantage-point splits before a dense shard is dealt into chunks
_PAIRS = 1 << 21            # candidate pairs compared at once


def shingle_hashes(text: bytes, k: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """XXH64 of each k-word shingle of the A-Z-lowered text."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    words = text.lower().split()                        # bytes: ASCII lower case, the six ASCII spaces
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = [0, *ends[:len(words) - k].tolist()]
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())],
                    dtype=np.uint64)


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    h = shingle_hashes(text, k)
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(h), 1 << 16):                # bounded memory for very long texts
        part = np.unpackbits(h[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint_column(text_col, k: int = SHINGLE):
    """The fingerprint as a signed 64-bit column."""
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        fps = [fingerprint(t, k) for part in slices(texts) for t in byte_texts(part)]
        release()
        return pa.array(np.array(fps, dtype=np.uint64).view(np.int64))

    return simhash(F.col(text_col).cast("string"))


def masks(m: int, max_bits: int) -> list[int]:
    """Masks of all choices of ``m - max_bits`` out of ``m`` bit blocks."""
    edges = [64 * i // m for i in range(m + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(m)]
    return [sum(c) for c in combinations(blocks, m - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _shards(fps: DataFrame, n: int, max_bits: int, leaf: int) -> DataFrame:
    """(mask, key, path, fp, home): each fingerprint once per mask.

    The number of blocks follows the number of fingerprints: the fewest
    masks whose keys are expected to hold no more than ``leaf`` of them.
    """
    m = max_bits + 1
    while m < max_bits + 3 and n > leaf << (64 * (m - max_bits) // m):
        m += 1
    choice = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(_signed(x)).alias("bits"))
                       for i, x in enumerate(masks(m, max_bits))])
    return (fps.select("fp", F.explode(choice).alias("c"))
            .select(F.col("c.mask").alias("mask"), F.col("fp").bitwiseAND(F.col("c.bits")).alias("key"),
                    F.lit(0).cast("long").alias("path"), "fp", F.lit(True).alias("home")))


def _distance(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def _split(shards: DataFrame, max_bits: int, leaf: int, levels: int) -> DataFrame:
    """Vantage-point levels for the shards above ``leaf`` rows."""
    group = ["mask", "key", "path"]
    done = None
    for level in range(levels + 1):
        # sums per shard: partial aggregation leaves one row per shard and task
        sizes = shards.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min_by("fp", F.xxhash64("fp")).alias("v"))
        big = stash(sizes.where(F.col("n") > leaf), "simhash-big")
        small = shards.join(big.select(*group), group, "left_anti")
        done = small if done is None else done.unionByName(small)
        if big.isEmpty():
            return done
        large = shards.join(big, group)
        if level == levels:                             # dense: every pair of chunks is one group
            g = F.ceil(F.col("n") / (leaf // 2)).cast("int")
            dealt = (large.withColumn("g", g).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("g")).cast("int"))
                     .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
                     .withColumn("path", F.xxhash64("path", F.least("c", "o"), F.greatest("c", "o"))))
            return done.unionByName(dealt.select(*group, "fp", "home"))
        large = large.withColumn("d", _distance(F.col("fp"), F.col("v")))
        cut = large.groupBy(*group).agg(F.percentile_approx("d", 0.5).alias("cut"))
        large = large.join(cut, group)
        d, edge = F.col("d"), F.col("cut")
        near = F.when(F.col("home"), d <= edge).otherwise(d <= edge + max_bits)
        far = d > edge - max_bits                       # a near row sent here only helps to find far ones
        sides = F.array(F.when(near, F.struct(F.lit(1).alias("side"), F.col("home").alias("home"))),
                        F.when(far, F.struct(F.lit(2).alias("side"), (F.col("home") & (d > edge)).alias("home"))))
        shards = stash(large.select("mask", "key", "path", "fp", F.explode(F.filter(sides, lambda x: x.isNotNull())).alias("s"))
                       .select("mask", "key", F.xxhash64("path", "s.side").alias("path"), "fp",
                               F.col("s.home").alias("home")), "simhash-level")
    return done


def _leaf_edges(fp: np.ndarray, group: np.ndarray, d: np.ndarray, max_bits: int):
    """(a, b) edges of rows sorted by (group, d): each row to the smallest
    fingerprint it reaches inside its group."""
    n = len(fp)
    key = group * 256 + d
    stop = np.searchsorted(key, key + max_bits, side="right")       # triangle bound, same group
    stop = np.minimum(stop, np.searchsorted(group, group, side="right"))
    width = stop - np.arange(1, n + 1)
    left, right = [], []
    total = np.concatenate([[0], np.cumsum(width)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + _PAIRS, side="right")) - 1)
        w = width[lo:hi]
        i = np.repeat(np.arange(lo, hi), w)
        j = i + 1 + np.arange(len(i)) - np.repeat(total[lo:hi] - total[lo], w)
        hit = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        left.append(i[hit])
        right.append(j[hit])
        lo = hi
    i, j = np.concatenate(left or [[]]).astype(np.int64), np.concatenate(right or [[]]).astype(np.int64)
    root = np.arange(n)
    while len(i):                                       # components of the batch's links
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    at = np.flatnonzero(root != np.arange(n))
    return fp[at], fp[root[at]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """Edges (a, b) that connect exactly the linked distinct fingerprints."""
    fps = fps.select("fp").distinct()
    fps = stash(fps, "simhash-distinct")
    leaves = _split(_shards(fps, fps.count(), max_bits, leaf), max_bits, leaf, levels)
    point = F.xxhash64("mask", "key", "path")           # the leaf's vantage point
    placed = (leaves.withColumn("leaf", point).withColumn("d", _distance(F.col("fp"), F.col("leaf")).cast("int"))
              .select("leaf", "d", "fp").repartition("leaf").sortWithinPartitions("leaf", "d"))

    def run(batches):
        kept = None
        for batch in _with_end(batches):
            if batch is not None:
                cols = [batch.column(k).to_numpy() for k in range(3)]
                if kept is not None:
                    cols = [np.concatenate(x) for x in zip(kept, cols)]
            else:
                cols = kept
            if cols is None or not len(cols[0]):
                continue
            # the last leaf may go on in the next batch
            whole = len(cols[0]) if batch is None else int(np.searchsorted(cols[0], cols[0][-1], side="left"))
            kept = [c[whole:] for c in cols]
            if not whole:
                continue
            names = cols[0][:whole]
            group = np.cumsum(np.concatenate([[0], names[1:] != names[:-1]]))
            a, b = _leaf_edges(cols[2][:whole].view(np.uint64), group, cols[1][:whole].astype(np.int64), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return placed.mapInArrow(run, "a bigint, b bigint").where("a <> b").distinct()


def _with_end(batches):
    yield from batches
    yield None


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of
    its component.  Large-star and small-star rounds: a node's neighbours move
    to the smallest one, found by an aggregate, so hubs are combined before
    the shuffle."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        j = e.join(low, "u")
        if large:
            return j.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))

    down = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(rounds):
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        big = star(both, True).where("u <> v").distinct()
        down = stash(star(big, False).where("u <> v").distinct(), "cc")
        state = down.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def roots(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of (doc_id, fp)."""
    each = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    label = components(links(each, max_bits))
    rooted = each.join(label.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.select("fp", "root").join(lowest, "root")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id for every row."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    marked = stash(slim.select("doc_id", fingerprint_column("text", k).alias("fp")), "simhash-fingerprints")
    found = stash(roots(marked, max_bits), "simhash-roots")
    return marked.join(found.select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id."""
    key = F.col(id_col).cast("bigint")
    fp = fingerprint_column(text_col, k)
    marked = stash(docs.select(key.alias("doc_id"), fp.alias("fp")), "simhash-fingerprints")
    found = roots(marked, max_bits).withColumnRenamed("component_id", "doc_id")
    # one (id, fingerprint) per group: the smallest id, then the smallest fingerprint that has it
    held = marked.withColumn("none", F.col("doc_id").isNull()).na.fill(0, ["doc_id"]).distinct()
    want = found.withColumn("none", F.col("doc_id").isNull()).na.fill(0, ["doc_id"])
    keepers = (held.join(want, ["fp", "doc_id", "none"]).groupBy("root", "doc_id", "none").agg(F.min("fp").alias("fp"))
               .select(F.col("doc_id").alias("__id"), F.col("none").alias("__none"), F.col("fp").alias("__fp")))
    # fingerprints are computed again rather than writing every text once more;
    # the join and the removal of exact repeats share one exchange
    names = ["__id", "__none", "__fp"]
    tagged = docs.withColumns({"__fp": fp, "__id": F.coalesce(key, F.lit(0)), "__none": key.isNull()})
    return (tagged.join(stash(keepers, "simhash-keepers"), names).dropDuplicates(names)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
