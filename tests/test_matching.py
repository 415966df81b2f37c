"""AND queries scored inside the tasks (T8, T9): what leaves a task grows with
the queries, not with their hits."""

import numpy as np
import pyarrow as pa
import pytest

import quarry.session
from quarry.operators import matching as mt
from quarry.operators import text as tx
from quarry.operators import text_index as ti
from quarry.session import scratch_path

DOCS = "doc_id long, title string, body string, metadata string, context string"


@pytest.fixture
def paths(monkeypatch):
    """Scratch tables by their names."""
    out = {}

    def named(spark, name):
        out[name] = scratch_path(spark, name)
        return out[name]
    monkeypatch.setattr(quarry.session, "scratch_path", named)
    monkeypatch.setattr(ti, "scratch_path", named)
    return out


def many(spark, n=600, asked=40):
    """All documents answer all queries."""
    docs = spark.createDataFrame([(i, "", "red fox " + "very " * (i % 7) + "quick", "", "") for i in range(n)], DOCS).repartition(3)
    return docs, spark.createDataFrame([(q, "red_fox quick") for q in range(asked)], "query_id long, text string")


def want(n, k):
    # shorter documents score higher, ties by id
    return sorted(range(n), key=lambda i: (i % 7, i))[:k]


def test_pairs_of_queries_and_documents_are_not_written(spark, paths):
    docs, queries = many(spark)
    got = {}
    for r in tx.search_text(docs, queries, k=3).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["doc_id"]
        assert r["truncated"]
    assert len(got) == 40 and all([x[1], x[2], x[3]] == want(600, 3) for x in got.values())
    # the driver term's postings, not 40 x 600 pairs
    assert spark.read.parquet(paths["text-candidates"]).count() == 600


def test_bounds_of_queries_and_blocks_stay_in_their_tasks(spark, paths):
    docs, queries = many(spark)
    index = ti.build_index(docs, scratch_path(spark, "test-index"), block_docs=4)
    hits, blocks = ti.search_index(index, queries, k=3)
    got = {}
    for r in hits.collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["doc_id"]
    assert len(got) == 40 and all([x[1], x[2], x[3]] == want(600, 3) for x in got.values())
    n = {r["query_id"]: r["candidates"] for r in blocks.collect()}
    assert len(n) == 40 and len(set(n.values())) == 1 and n[0] >= 150
    # before: a row for each of the blocks
    tasks = spark.read.parquet(paths["text-bounds"]).inputFiles()
    assert spark.read.parquet(paths["text-bounds"]).count() <= 40 * (ti.FIRST_BLOCKS + 1) * max(len(tasks), 1) < 40 * n[0]


def test_ids_of_several_documents_count_as_before(spark):
    """Parts of a document in other blocks add up to one hit."""
    docs = spark.createDataFrame([(i, "", f"red fox {'very ' * (i % 5)}", "", "") for i in range(200)] + [(7, "", "red fox", "", "")] * 2,
                                 DOCS).coalesce(1)
    index = ti.build_index(docs, scratch_path(spark, "test-index"), block_docs=8)
    assert sorted(r[0] for r in index.shared.collect()) == [7]
    hits = ti.search_index(index, spark.createDataFrame([(1, "red fox")], "query_id long, text string"), k=300)[0].collect()
    assert {r["doc_id"] for r in hits} == set(range(200))


def queries_of(rows, leads, counts, n, units):
    col = lambda x, i, t=np.int64: np.asarray([r[i] for r in x], t)
    return mt.Queries(pa.array(range(n)), pa.array([str(u) for u in range(units)]),
                      {"query": col(rows, 0), "term": col(rows, 1), "alt": col(rows, 2), "part": col(rows, 3), "unit": col(rows, 4), "idf": col(rows, 5, float)},
                      {"query": col(leads, 0), "unit": col(leads, 1)}, {"query": col(counts, 0), "terms": col(counts, 1), "n": col(counts, 2)})


@pytest.mark.parametrize("piece", [1, 7, 1 << 19])
def test_matches_equal_a_plain_loop(monkeypatch, piece):
    monkeypatch.setattr(mt, "PIECE", piece)
    rng = np.random.default_rng(3)
    posts = {(u, d): float(rng.uniform(0.1, 2)) for u in range(8) for d in range(30) if rng.random() < 0.5}
    rows, leads, counts = [], [], []
    for q in range(20):
        terms = rng.integers(1, 4)
        for t in range(terms):
            rows.append((q, t, 0, 0, int(rng.integers(8)), float(rng.uniform(0.1, 3))))
            if rng.random() < 0.4:
                rows += [(q, t, 1, p, int(rng.integers(8)), float(rng.uniform(0.1, 3))) for p in (0, 1)]
        leads += sorted({(q, r[4]) for r in rows if r[0] == q and r[1] == 0})
        counts.append((q, terms if q else terms + 1, 1 + q % 2))
    got = []
    batch = queries_of(rows, leads, counts, 20, 8)
    u, d = (np.asarray([k[i] for k in posts], np.int64) for i in (0, 1))
    for q, doc, score in batch.matches(u, d, 30, np.asarray(list(posts.values()))):
        got += zip(q.tolist(), doc.tolist(), np.round(score, 9).tolist())
    plain = []
    for q, n, copies in counts:
        for doc in range(30):
            if not any((unit, doc) in posts for x, unit in leads if x == q):
                continue
            mine = [r for r in rows if r[0] == q and (r[4], doc) in posts]
            holds = {t for t in {r[1] for r in mine} if any(r[1] == t and r[2] == 0 for r in mine)
                     or {r[3] for r in mine if r[1] == t and r[2] == 1} == {0, 1}}
            if len(holds) == n:
                plain += [(q, doc, round(sum(r[5] * posts[r[4], doc] for r in mine), 9))] * copies
    assert len(plain) > 20 and [x[:2] for x in sorted(got)] == [x[:2] for x in sorted(plain)]
    assert np.allclose([x[2] for x in sorted(got)], [x[2] for x in sorted(plain)])


def test_best_keeps_the_first_ids_of_equal_scores(monkeypatch):
    monkeypatch.setattr(mt, "PIECE", 5)
    best = mt.Best(2, 3)
    for ids in ([9, None, 4], [1, 8, 2], [3]):
        best.add(np.zeros(len(ids), np.int64), np.full(len(ids), 0.5), pa.array(ids, pa.int64()))
    best.add(np.array([1, 0]), np.array([0.1, 0.7]), pa.array([5, 6]))
    out = [(int(a), float(b), c) for q, s, i in best.rows() for a, b, c in zip(q, s, i.to_pylist())]
    assert out == [(0, 0.7, 6), (0, 0.5, None), (0, 0.5, 1), (1, 0.1, 5)]
