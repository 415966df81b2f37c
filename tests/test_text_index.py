"""The block-max index (T7, T9) and phrases by place lists (T3) against the
one-pass search and a plain scan."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import text as tx
from quarry.operators import text_index as ti
from quarry.session import scratch_path

DOCS = "doc_id long, title string, body string, metadata string, context string"


def corpus(n, seed=1, vocab=60):
    """Zipf-like words; a few documents hold rare words or are empty."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["Café", "naïve", "Über", "x_y", "don't"]
    weight = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(n):
        body = " ".join(rng.choices(words, weight, k=rng.randint(0, 40)))
        if i % 37 == 0:
            body += " needle " * rng.randint(1, 3)
        rows.append((i, rng.choice(["alpha", "beta w1", ""]), body, "", "table t"))
    return rows


QUERIES = ["w0", "w0 w1 w2", "needle w0", "cafe", "NAIVE uber", "x_y", "w0_w1", "don't w3", "w1_w0_w2 w4", "missing", "w5 missing",
           "table t", "?!", "", "alpha", "w0 w0"]


def rows_of(df):
    return sorted((r["query_id"], r["doc_id"], round(r["score"], 9), r["rank"], r["truncated"]) for r in df.collect())


@pytest.fixture(scope="module")
def data(spark):
    docs = spark.createDataFrame(corpus(700), DOCS).repartition(4, "doc_id")
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, text string")
    return docs, queries, ti.build_index(docs, scratch_path(spark, "test-index"), block_docs=16)


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_hits_equal_the_one_pass_search(spark, data, k):
    docs, queries, index = data
    hits, blocks = ti.search_index(index, queries, k=k)
    want = rows_of(tx.search_text(docs, queries, k=k))
    assert rows_of(hits) == want and want
    read = {r["query_id"]: (r["candidates"], r["read"]) for r in blocks.collect()}
    assert all(0 < b <= a for a, b in read.values())
    if k == 1:                                      # most blocks that hold the terms are skipped
        assert sum(b for _, b in read.values()) < 0.7 * sum(a for a, _ in read.values())


def test_index_is_read_again_from_its_folder(spark, data):
    docs, queries, _ = data
    path = scratch_path(spark, "test-index")
    ti.build_index(docs, path, block_docs=50)
    again = ti.open_index(spark, path)
    assert again.n_docs == 700
    assert rows_of(ti.search_index(again, queries, k=3, first=1)[0]) == rows_of(tx.search_text(docs, queries, k=3))


def test_phrases_by_plain_scan(spark, data):
    docs, _, _ = data
    for phrase in ("w0_w1", "w1_w0_w2", "don't", "x_y_w0"):
        words = [w.lower() for w in phrase.replace("'", "_").split("_")]

        def holds(r):
            for f in ("title", "body", "metadata", "context"):
                toks = [t for t in "".join(c if c.isalnum() else " " for c in r[f].lower()).split()]
                if any(toks[i:i + len(words)] == words for i in range(len(toks))):
                    return True
            return False

        want = {r["doc_id"] for r in docs.collect() if holds(r)}
        q = spark.createDataFrame([(1, phrase)], "query_id long, text string")
        assert {r["doc_id"] for r in tx.search_text(docs, q, k=None).collect()} == want


def test_accents_are_folded_both_ways(spark):
    docs = spark.createDataFrame([(1, "", "Le Café est là", "", ""), (2, "", "cafe", "", ""), (3, "", "CAFÉ", "", ""),
                                  (4, "", "Straße äöü", "", ""), (5, "", "cafetière", "", "")], DOCS)
    find = lambda q: {r["doc_id"] for r in tx.search_text(
        docs, spark.createDataFrame([(1, q)], "query_id long, text string"), k=None).collect()}
    assert find("cafe") == find("Café") == find("café") == {1, 2, 3}
    assert find("aou") == {4} and find("straße") == {4} and find("strasse") == set()


def test_empty_documents_and_queries(spark):
    none = spark.createDataFrame([], DOCS)
    queries = spark.createDataFrame([(1, "a"), (2, "..."), (3, None)], "query_id long, text string")
    index = ti.build_index(none, scratch_path(spark, "test-index"))
    assert index.n_docs == 0 and ti.search_index(index, queries)[0].count() == 0
    assert {r["query_id"] for r in tx.query_errors(queries).collect()} == {2, 3}
    blank = spark.createDataFrame([(1, "", "", "", ""), (2, None, "a", None, "")], DOCS)
    index = ti.build_index(blank, scratch_path(spark, "test-index"))
    assert index.n_docs == 2 and [r["doc_id"] for r in ti.search_index(index, queries)[0].collect()] == [2]


def test_context_only_hit_gets_the_context_title(spark):
    docs = tx.build_documents(spark.createDataFrame([(1, "boom")], "_row long, message string"), "web_logs")
    q = spark.createDataFrame([(1, "web logs"), (2, "boom")], "query_id long, text string")
    got = {r["query_id"]: r["title"] for r in tx.search_text(docs, q, explain=True, table_name="web_logs").collect()}
    assert got == {1: "table context search web_logs", 2: "boom"}


def test_frequent_token_is_spread_over_files(spark):
    """Rows of one token are dealt by block: no file holds them all."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("").alias("title"), F.lit("common").alias("body"),
                                    F.lit("").alias("metadata"), F.lit("").alias("context"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")         # small files stay apart
    try:
        index = ti.build_index(docs, scratch_path(spark, "test-index"), block_docs=10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = [r["count"] for r in index.rows.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) >= 400 and max(per_file) < 0.5 * sum(per_file)


def test_rows_of_a_block_stay_in_one_file(spark):
    docs = spark.createDataFrame(corpus(200, seed=5), DOCS).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = ti.build_index(docs, scratch_path(spark, "test-index"), block_docs=16)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = index.rows.withColumn("file", F.input_file_name()).groupBy("block").agg(F.count_distinct("file").alias("n"), F.count(F.lit(1)).alias("rows"),
                                            F.count_distinct("token").alias("tokens")).collect()
    assert len(files) > 10 and all(r["n"] == 1 and r["rows"] == r["tokens"] for r in files)
    got = {(r["token"], r["doc_id"]): r["places"] for r in index.rows.select("token", F.explode("postings").alias("p"))
           .select("token", "p.doc_id", "p.places").collect()}
    want = {}
    for r in docs.select("doc_id", *[tx.match_tokens(F.col(f)).alias(f) for f in tx.FIELDS]).collect():
        for i, f in enumerate(tx.FIELDS):
            for j, t in enumerate(r[f]):
                want.setdefault((t, r["doc_id"]), []).append(i * tx.FIELD_SPAN + j)
    assert got == want


def test_phrase_rows_come_from_runs_of_words(spark):
    """Rows of one id and length in a block are one document; a field's last
    word and the next one's first are no neighbours."""
    rows = [(1, "", "one two one two", "", "two"), (2, "", "one x", "", ""), (2, "", "y two", "", ""), (3, "one", "two", "", ""),
            (None, "", "one two", "", ""), (4, "", None, "", "")]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    index = ti.build_index(docs, scratch_path(spark, "test-index"))
    words = index.rows.where("token in ('one', 'two')").select("token", "block", "postings")
    runs = words.coalesce(1).mapInArrow(ti._word_runs([2]), "unit string, block long, doc_id long, doc_len long, place int").collect()
    span = tx.FIELD_SPAN
    assert sorted((str(r["doc_id"]), r["unit"], r["place"] - span) for r in runs) == [
        ("1", "one two", 0), ("1", "one two", 2), ("1", "two one", 1), ("2", "one two", 0), ("None", "one two", 0)]
