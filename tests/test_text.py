"""Text recall (T1-T13) on literal rows."""

from pyspark.sql import functions as F

from quarry.operators import filters as fl
from quarry.operators import text as tx

META = {"origin": "harbour", "query": "cargo index=manifests", "pages": 3, "blank": " "}
ROWS = [("2025-11-02T06:00:00Z", "gate", "lorry waits"),
        ("2025-11-02T06:01:00Z", "gate", "seal_code_x7 refused 503 Missing paper"), (None, None, None)]
COLUMNS = "_time string, service string, message string"


def docs_of(spark, rows, schema, name, meta=META):
    df = fl.with_row_number(spark.createDataFrame(rows, schema))
    return tx.build_documents(df, name, metadata=meta)


def search(spark, docs, q, k=10, explain=True):
    queries = spark.createDataFrame([(1, q)], "query_id long, text string")
    return tx.search_text(docs, queries, k=k, explain=explain).orderBy("rank").collect()


def test_phrase_and_terms_hit_body(spark):
    docs = docs_of(spark, ROWS, COLUMNS, "gate_book")
    hits = search(spark, docs, "seal_code_x7 503 Missing")
    assert len(hits) == 1 and hits[0]["doc_id"] == 2 and not hits[0]["truncated"]
    assert "body" in hits[0]["match_scope"] and "seal_code_x7" in hits[0]["snippet"]
    assert hits[0]["row_text_query"] == "seal_code_x7 503 Missing"


def test_context_only_hits(spark):
    docs = docs_of(spark, ROWS, COLUMNS, "gate_book")
    hits = search(spark, docs, "manifests cargo")
    assert len(hits) == 3 and all(h["match_scope"] == "table_context" for h in hits)
    assert all(h["context_only"] for h in hits)


def test_query_syntax_is_plain_text_and_ticket_ids_split(spark):
    docs = docs_of(spark, [("the crane OR the belt, see RM-4410 tonight",), ("RM 44100 elsewhere",), ("4410 without its letters",)],
                   "message string", "notes")
    assert [h["doc_id"] for h in search(spark, docs, 'OR "crane" rm4410')] == [1]


def test_phrase_requires_adjacency(spark):
    docs = docs_of(spark, [("red blue green",), ("blue red green",), ("blue green red",)], "message string", "p")
    hits = search(spark, docs, "blue_red_green")
    assert [h["doc_id"] for h in hits] == [2]


def test_title_weight_ranks_first_and_limit_truncates(spark):
    rows = [("alpha", "beta gamma"), ("beta", "alpha gamma"), ("other", "beta alpha")]
    docs = docs_of(spark, rows, "service string, message string", "w")
    hits = search(spark, docs, "beta", k=1, explain=False)
    assert len(hits) == 1 and hits[0]["doc_id"] == 2 and hits[0]["truncated"]


def test_no_match_returns_nothing(spark):
    docs = docs_of(spark, ROWS, COLUMNS, "gate_book")
    assert search(spark, docs, "submarine") == []


def test_document_fields(spark):
    rows = [("2025-11-02T06:01:00Z", "gate", "bump", "k9", False)]
    d = docs_of(spark, rows, "_time string, service string, message string, extra string, flag boolean", "dock-book.v3",
                meta={}).collect()[0]
    assert d["title"] == "2025-11-02T06:01:00Z gate"
    assert d["body"] == "bump extra k9 flag false"
    assert d["context"] == "table dock-book.v3 dock book v3 dock book v 3"
    assert d["metadata"] == ""


def test_fallback_title(spark):
    d = docs_of(spark, [("  ", "lot-12")], "message string, name string", "t", meta={}).collect()[0]
    assert d["title"] == "lot-12"
    d = docs_of(spark, [(1.5,)], "x double", "t", meta={}).collect()[0]
    assert d["title"] == tx.FALLBACK_TITLE


def test_strong_single_token(spark):
    df = spark.createDataFrame([("fig",), ("qr48",), ("palmTree",), ("x_y",), ("driftwood",), ("Fig",)], "t string")
    got = [r[0] for r in df.select(tx.strong_single_token(F.col("t"))).collect()]
    assert got == [False, True, True, True, True, False]


def test_row_specific_query_drops_weak_single_word(spark):
    docs = docs_of(spark, ROWS, COLUMNS, "gate_book")
    hits = search(spark, docs, "lorry")
    assert len(hits) == 1 and hits[0]["row_text_query"] == ""


# -------------------------------------------- growing batches of queries
def _docs(spark, texts):
    rows = [(i, "src", t, "", "table t") for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, title string, body string, metadata string, context string")


def _scratch(monkeypatch):
    from quarry import session
    paths, make = {}, session.scratch_path

    def named(spark, name):
        paths[name] = make(spark, name)
        return paths[name]
    monkeypatch.setattr(session, "scratch_path", named)
    return paths


def test_phrases_are_kept_only_where_they_stand(spark, monkeypatch):
    """Every document holds all three words, one holds the phrase."""
    paths = _scratch(monkeypatch)
    docs = _docs(spark, [(i, "red blue green red") for i in range(30)] + [(30, "a red green blue"), (31, "red green"), (32, None)])
    q = spark.createDataFrame([(1, "red_green'blue"), (2, "green_blue a"), (3, "blue_table")], "query_id long, text string")
    hits = tx.search_text(docs, q, k=5).collect()
    assert sorted((r["query_id"], r["doc_id"]) for r in hits) == [(1, 30), (2, 30)]
    index = spark.read.parquet(paths["text-index"]).where("token is not null")
    assert sorted(r["token"] for r in index.collect()) == ["a", "green blue", "red green blue"]


def test_phrases_of_rows_that_share_an_id(spark):
    """Rows with one id are one document, its places are merged."""
    docs = _docs(spark, [(1, "one two"), (1, "one two"), (2, "one x"), (2, "y two"), (3, "two one"), (None, "one two"), (None, "one two")])
    q = spark.createDataFrame([(7, "one_two")], "query_id long, text string")
    hits = tx.search_text(docs, q, k=5).collect()
    assert sorted(r["doc_id"] for r in hits) == [1, 2]
    assert len({round(r["score"], 9) for r in hits}) == 1


def test_ticket_candidates_hold_the_rarer_part(spark, monkeypatch):
    paths = _scratch(monkeypatch)
    docs = _docs(spark, [(i, f"ticket INC-{1000 + i} open") for i in range(60)] + [(60, "RM1007 1007"), (61, "inc1007")])
    q = spark.createDataFrame([(i, f"inc{1000 + i}") for i in range(20)], "query_id long, text string")
    hits = tx.search_text(docs, q, k=5).collect()
    assert sorted((r["query_id"], r["doc_id"]) for r in hits) == sorted([(i, i) for i in range(20)] + [(7, 61)])
    assert spark.read.parquet(paths["text-candidates"]).count() == 22


def test_explained_hits_leave_the_documents_in_place(spark):
    docs = _docs(spark, [(i, f"word{i} red") for i in range(10)])
    q = spark.createDataFrame([(1, "red")], "query_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = tx.search_text(docs, q, k=3, explain=True)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [doc_id" in plan and "SortMergeJoin [doc_id" not in plan
        assert sorted(r["doc_id"] for r in hits.collect()) == [0, 1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_token_stats_shuffle_tokens_only(spark):
    docs = _docs(spark, [(i, "red Red blue") for i in range(20)])
    out = tx.token_stats(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(token" in plan and "hashpartitioning(doc_id" not in plan and ", doc_id" not in plan.split("hashpartitioning", 1)[1]
    got = {r["token"]: (r["docs"], r["occurrences"]) for r in out.collect()}
    assert got == {"red": (20, 40), "blue": (20, 20), "src": (20, 20), "table": (20, 20), "t": (20, 20)}


def test_token_stats_of_shared_and_missing_ids(spark):
    docs = _docs(spark, [(1, "a a"), (1, "a b"), (2, "b"), (None, "a"), (None, "c"), (3, None)])
    got = {r["token"]: (r["docs"], r["occurrences"]) for r in tx.token_stats(docs).collect()}
    assert got == {"a": (1, 4), "b": (2, 2), "c": (0, 1), "src": (3, 6), "table": (3, 6), "t": (3, 6)}
