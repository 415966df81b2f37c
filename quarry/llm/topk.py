"""Exact top-k inner products by columnar branch-and-bound.

Vectors are kept in blocks in vertical layout (one row per dimension).  A
query block meets a candidate block dimension group by dimension group: after
each group the partial products plus the product of the norms of the
remaining dimensions bound what a candidate can still reach, candidates below
the query's floor leave, and the survivors are compacted before the next
group: first to the queries and candidates that still have a pair, then, when
few are left, to the pairs themselves.  A query's floor is its k-th best score against one bounded block of
candidates, so it never removes a true result; ties at the floor stay.

Blocks travel as binary rows.  Groups of at most about ``GROUP`` candidate
blocks meet groups of query blocks in the cells of a grid (cogrouped) with at
least as many cells as shuffle partitions, if there are that many pairs: a block
is copied once per group of the other side, and a task holds one cell, whatever
the table size or however many vectors are equal.  Inside a cell the floors rise
from block to block.  The k best of each pair of blocks are ranked by one window
per query.

Components are kept as 32-bit integers, or as 64-bit ones in blocks that need
them; where sums of products leave what a double holds exactly, survivors are
scored again in 64-bit integers and the bounds get room for rounding.

Defined cases: a vector that is null or holds a null or non-finite component
takes no part, nor does a row without id or one with a component beyond 64 bits once
scaled; a score beyond 64 bits is not defined; shorter vectors count as padded
by zeros; rows with the query's own id are not its candidates; each query row
gets its own ranks; with fewer than k candidates all are returned; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
DIM_GROUP = 16
SCALE = 64
GROUP = 16                  # blocks of a side in a cell of the grid, about
EXACT = float(1 << 53)      # integers below are exact in a double
SPARSE = 0.02               # share of surviving pairs below which they are carried on one by one

_BLOCK = "block string, n int, dims int, ids binary, cells binary"


def quantize(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) with x as double."""
    return np.floor(scale * values.astype(np.float64))


def _blocks(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """Rows (block, n, dims, ids, cells): at most ``size`` vectors each,
    ``cells`` holding int32 or int64 values dimension by dimension."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        task, made = TaskContext.get().partitionId(), 0
        ids: list = []
        rows: list = []

        def flush():
            nonlocal made, ids, rows
            dims = max(map(len, rows))
            wide = max((float(np.abs(r).max()) for r in rows if len(r)), default=0.0) >= 2 ** 31 - 1
            cells = np.zeros((dims, len(rows)), dtype=np.int64 if wide else np.int32)
            for j, row in enumerate(rows):
                cells[:len(row), j] = row
            out = pa.RecordBatch.from_pydict({
                "block": [f"{task}-{made}"], "n": pa.array([len(rows)], pa.int32()),
                "dims": pa.array([dims], pa.int32()), "ids": [np.asarray(ids, dtype=np.int64).tobytes()],
                "cells": [cells.tobytes()]})
            made, ids, rows = made + 1, [], []
            return out

        for batch in batches:
            for i, vec in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not vec.is_valid or vec.values.null_count:
                    continue
                x = vec.values.to_numpy(zero_copy_only=False)
                if not np.isfinite(x).all():
                    continue
                row = quantize(x, scale)
                if len(row) and np.abs(row).max() >= 2.0 ** 63:
                    continue
                ids.append(i)
                rows.append(row)
                if len(rows) == size:
                    yield flush()
        if rows:
            yield flush()

    return vectors.mapInArrow(run, _BLOCK)


def _matrix(n: int, dims: int, ids: bytes, cells: bytes):
    kind = np.int32 if len(cells) == 4 * n * dims else np.int64
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(cells, dtype=kind).reshape(dims, n)


def _same_dims(q: np.ndarray, c: np.ndarray):
    dims = max(len(q), len(c))
    pad = lambda m: m if len(m) == dims else np.vstack([m, np.zeros((dims - len(m), m.shape[1]))])
    return pad(q), pad(c)


def _rest(m: np.ndarray) -> np.ndarray:
    """Row d: norm of each vector over dimensions d.. (one more row of zeros)."""
    mass = np.zeros((len(m) + 1, m.shape[1]))
    mass[:-1] = np.cumsum((m.astype(np.float64) ** 2)[::-1], axis=0)[::-1]
    return np.sqrt(mass)


def block_topk(qids, q, cids, c, floor, k: int, group: int = DIM_GROUP):
    """(query index, candidate id, score) of the k best per query of a block pair."""
    whole_q, whole_c = _same_dims(q, c)
    q, c = whole_q.astype(np.float64), whole_c.astype(np.float64)
    dims = len(q)
    left_q, left_c = _rest(q), _rest(c)
    most = (left_q[0].max() if q.size else 0.0) * (left_c[0].max() if c.size else 0.0)
    exact = most < EXACT / 4
    # room for rounding: of the norms, and of the sums where they are not exact (scores are integers)
    room = 1 + (0 if exact else most * 2.0 ** -40)
    step = min(group, dims)
    rows, cols = np.arange(q.shape[1]), np.arange(c.shape[1])
    partial = q[:step].T @ c[:step]
    other = cids[None, :] != qids[:, None]
    while True:
        alive = other & (partial + left_q[step][rows, None] * left_c[step][None, cols] + room >= floor[rows, None])
        if step >= dims or alive.sum() <= SPARSE * alive.size:
            break
        # compaction: queries and candidates without a surviving pair leave
        some_q, some_c = alive.any(1), alive.any(0)
        if not (some_q.all() and some_c.all()):
            rows, cols = rows[some_q], cols[some_c]
            partial, other = partial[some_q][:, some_c], alive[some_q][:, some_c]
        else:
            other = alive
        end = min(step + group, dims)
        partial += q[step:end, rows].T @ c[step:end, cols]
        step = end
    at_q, at_c = np.nonzero(alive)                   # few pairs are left: only they are carried on
    qi, ci, score = rows[at_q], cols[at_c], partial[at_q, at_c]
    while step < dims and len(qi):
        end = min(step + group, dims)
        for d in range(step, end):
            score += q[d, qi] * c[d, ci]
        step = end
        keep = score + left_q[step, qi] * left_c[step, ci] + room >= floor[qi]
        qi, ci, score = qi[keep], ci[keep], score[keep]
    keep = score + (0 if exact else room) >= floor[qi]
    qi, ci, score = qi[keep], ci[keep], score[keep]
    if exact:
        score = score.astype(np.int64)
    else:
        score = np.zeros(len(qi), dtype=np.int64)
        for d in range(dims):                        # 64-bit sums wrap, and are right if the score fits
            score += whole_q[d, qi].astype(np.int64) * whole_c[d, ci].astype(np.int64)
    ids = cids[ci]
    order = np.lexsort((ids, -score, qi))
    qi, ids, score = qi[order], ids[order], score[order]
    first = np.searchsorted(qi, qi, side="left")
    best = np.arange(len(qi)) - first < k
    return qi[best], ids[best], score[best]


def _floors(qi: np.ndarray, score: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-th best score of every query that has k of them, else -inf; a
    little less where a double does not hold the score."""
    worst = np.full(n, np.inf)
    np.minimum.at(worst, qi, np.nextafter(score.astype(np.float64), -np.inf) if len(score) and np.abs(score).max() >= EXACT
                  else score.astype(np.float64))
    return np.where(np.bincount(qi, minlength=n) >= k, worst, -np.inf)


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = SCALE,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest inner products of each vector whose id is divisible by
    ``every`` with all other rows; ties go to the smaller id."""
    slim = vectors.select(F.col(id_col).cast("bigint").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    # written: block names come from the tasks that made the blocks
    cands = stash(_blocks(slim, CANDIDATE_BLOCK, scale), "topk-candidates")
    queries = stash(_blocks(slim.where(F.col("id") % every == 0), QUERY_BLOCK, scale), "topk-queries")

    # one candidate block (bounded) gives every query a floor
    sample = cands.orderBy(F.col("n").desc(), "block").limit(1).collect()
    pilot = tuple(sample[0])[1:] if sample else None

    def floors(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                qids, q = _matrix(r["n"], r["dims"], r["ids"], r["cells"])
                cids, c = _matrix(*pilot)
                qi, _, score = block_topk(qids, q, cids, c, np.full(len(qids), -np.inf), k)
                out.append(_floors(qi, score, len(qids), k).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "floor"])

    queries = stash(queries.mapInArrow(floors, _BLOCK + ", floor binary"), "topk-floors")
    # grid of groups: a block goes to its group's cells, once per group of the other side
    nc, nq = max(1, cands.count()), max(1, queries.count())
    cells = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_rows = min(nc, max(-(-nc // GROUP), math.isqrt(cells * nc // nq) + 1))
    n_cols = min(nq, max(-(-nq // GROUP), -(-cells // n_rows)))
    slot = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    dealt_c = cands.select(slot(n_rows).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(n_cols - 1))).alias("s"),
                           "n", "dims", "ids", "cells")
    dealt_q = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("r"), slot(n_cols).alias("s"),
                             "block", "n", "dims", "ids", "cells", "floor")

    def search(asked, held):
        import pyarrow as pa
        empty = pa.schema([("qb", pa.string()), ("qi", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                           ("score", pa.int64())])
        out = []
        for i in range(asked.num_rows):
            qv = {c: asked.column(c)[i].as_py() for c in ("block", "n", "dims", "ids", "cells", "floor")}
            qids, q = _matrix(qv["n"], qv["dims"], qv["ids"], qv["cells"])
            floor = np.frombuffer(qv["floor"])
            for j in range(held.num_rows):
                cids, c = _matrix(*(held.column(x)[j].as_py() for x in ("n", "dims", "ids", "cells")))
                qi, ids, score = block_topk(qids, q, cids, c, floor, k)
                floor = np.maximum(floor, _floors(qi, score, len(qids), k))
                out.append(pa.Table.from_pydict({"qb": [qv["block"]] * len(qi), "qi": qi.astype(np.int32),
                                                 "query_id": qids[qi], "vec_id": ids, "score": score}, schema=empty))
        return pa.concat_tables(out) if out else empty.empty_table()

    # cells are heavy in work, not in bytes: a stated number of partitions is not merged
    parts = n_rows * n_cols if n_rows * n_cols < 2 * cells else 2 * cells
    found = dealt_q.repartition(parts, "r", "s").groupBy("r", "s").cogroup(
        dealt_c.repartition(parts, "r", "s").groupBy("r", "s")).applyInArrow(
        search, "qb string, qi int, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("qb", "qi").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def oracle_sql(k: int = 20, every: int = 20, scale: int = SCALE) -> str:
    """DuckDB SQL over ``embeddings``."""
    return f"""
WITH v AS (
  SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM d q JOIN d c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % {every} = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= {k}"""
