import random

import numpy as np
import pytest
import xxhash
from helpers_llm import corpus, docs_frame, prose

from quarry.llm import simhash


def brute_fp(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, bits=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def near_rows():
    rng = random.Random(5)
    rows = corpus()
    long = prose(rng, 400).split()
    for i in range(25):                                                  # chains of small edits
        long[rng.randrange(400)] = f"edit{i}"
        rows.append((500 + i, " ".join(long), "en", "src0", 1))
    return rows


def test_spark_hash_is_the_named_one(spark):
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_rows_equal_brute_force(spark):
    rows = near_rows()
    got = simhash.near_duplicates(docs_frame(spark, rows, extra=True).repartition(4)).collect()
    fps = [brute_fp(r[1]) for r in rows]
    comp = groups(fps)
    lowest = {}
    for r, c in zip(rows, comp):
        if r[0] is not None:
            lowest[c] = min(lowest.get(c, r[0]), r[0])
    want = sorted(((r[0], f"{f:016x}", lowest.get(c)) for r, f, c in zip(rows, fps, comp)), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert len(set(comp)) < len(rows) - 10


@pytest.mark.parametrize("leaf,levels", [(512, 4), (64, 3), (64, 0)])
def test_splitting_loses_no_link(spark, leaf, levels):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 63, 80, dtype=np.uint64)]
    out = list(base)
    for k in range(400):                                                 # a dense cluster and loose ones
        x = base[k % 20] if k % 2 else base[0]
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    fps = sorted(set(out))
    want = {}
    for f, c in zip(fps, groups(fps)):
        want.setdefault(c, set()).add(np.uint64(f).view(np.int64).item())
    df = spark.createDataFrame([(np.uint64(f).view(np.int64).item(),) for f in fps], "fp bigint")
    edges = simhash.links(df, 4, leaf, levels)
    got = {}
    for r in simhash.components(edges).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values() if len(v) > 1}


def test_keep_one(spark):
    rows = near_rows()
    df = docs_frame(spark, rows, extra=True)
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    fps = [brute_fp(r[1]) for r in rows]
    comp = groups(fps)
    got = out.collect()
    assert len(got) == len(set(comp))                                    # one per group, null ids included
    by = {r[0]: c for r, c in zip(rows, comp)}
    assert len({by[r.doc_id] for r in got}) == len(got)


def test_empty(spark):
    assert simhash.near_duplicates(docs_frame(spark, [])).count() == 0
    assert simhash.keep_one(docs_frame(spark, [])).count() == 0
