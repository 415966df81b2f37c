import math

import numpy as np
import pytest

from quarry.llm import topk

KIND = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, every):
    ok = [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float))) for i, v, _ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    pad = lambda v, n: np.pad(v, (0, n - len(v)))
    n = max([len(v) for _, v in ok], default=0)
    for q, v in ok:
        if q % every == 0:
            s = sorted((-int(pad(v, n) @ pad(w, n)), i) for i, w in ok if i != q)[:k]
            out |= {(q, r + 1, i, -x) for r, (x, i) in enumerate(s)}
    return out


@pytest.mark.parametrize("block", [(1024, 4096), (3, 7)])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block[1])
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 37)], 0) for i in range(150)]
    rows += [(i, rows[5][1], 0) for i in range(150, 200)]                # ties
    rows += [(201, None, 0), (202, [1.0, None], 0), (203, [float("nan")] * 37, 0), (None, rows[0][1], 0),
             (204, [0.5, -0.25], 0), (240, [], 0), (-20, [float("inf")] * 37, 0), (-40, rows[9][1], 0)]
    got = topk.top_k(spark.createDataFrame(rows, KIND).repartition(3), k=6, every=20).collect()
    assert {tuple(r) for r in got} == brute(rows, 6, 20)
    assert len(got) == len(brute(rows, 6, 20))


def test_fewer_candidates_and_empty(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [0.5, 0.5], 0)]
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, KIND)).collect()] == [(0, 1, 1, 64 * 32 + 128 * 32)]
    assert topk.top_k(spark.createDataFrame([], KIND)).count() == 0


@pytest.mark.parametrize("size", [1e5, 1e7, 1e9])
def test_large_components_are_exact(spark, size):
    """Scores beyond what a double holds, with neighbours that differ by one."""
    rng = np.random.default_rng(3)
    big = [[float(x) for x in rng.integers(-8, 8, 6) / 64] for _ in range(40)]
    for i, v in enumerate(big):
        v[0] = size + (i % 7) / 64
        v[1] = -size if i % 2 else 1 / 64
    rows = [(i, v) for i, v in enumerate(big)] + [(100, [1 / 64, 0.0, 0.0]), (101, [size] * 6), (102, [1e18, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(2)
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    whole = [(i, v) for i, v in whole if max(abs(x) for x in v) < 2 ** 63]
    want = set()
    for q, v in whole:
        if q % 20 == 0:
            scores = {i: sum(a * b for a, b in zip(v, w)) for i, w in whole if i != q}
            best = sorted(scores, key=lambda i: (-scores[i], i))[:5]
            if all(abs(s) < 2 ** 63 for s in scores.values()):
                want |= {(q, r, i, scores[i]) for r, i in enumerate(best, 1)}
    got = {tuple(r) for r in topk.top_k(df, k=5).collect() if r["query_id"] in {w[0] for w in want}}
    assert want and got == want


def test_many_blocks_meet_once(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 5)
    monkeypatch.setattr(topk, "GROUP", 3)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8)], 0) for i in range(300)]
    got = topk.top_k(spark.createDataFrame(rows, KIND).repartition(4), k=4, every=10).collect()
    assert {tuple(r) for r in got} == brute(rows, 4, 10) and len(got) == 120
