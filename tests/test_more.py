"""Remaining paths: saved postings index, stream timers, status rollup,
compatibility/finding joins, head/offset, row generator."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from quarry.functions import evalfns as ef
from quarry.operators import filters as fl
from quarry.operators import joins as jn
from quarry.operators import rollups as ru
from quarry.operators import summary as sm
from quarry.operators import text as tx
from quarry.streaming import streams as st


def test_saved_postings_index_gives_same_hits(spark):
    docs_df = fl.with_row_number(spark.createDataFrame(
        [("alpha beta gamma",), ("beta beta delta",), ("request remote tok alpha",), ("gamma",)], "message string"))
    docs = tx.build_documents(docs_df, "idx_test", metadata={})
    queries = spark.createDataFrame([(1, "beta"), (2, "alpha request_remote_tok"), (3, "gamma alpha")],
                                    "query_id long, text string")
    direct = sorted((r["query_id"], r["doc_id"], round(r["score"], 9)) for r in tx.search_text(docs, queries).collect())
    path = tempfile.mkdtemp(prefix="quarry-postings-") + "/p"
    tx.save_postings(tx.build_postings(docs), path)
    stats = tx.corpus_stats(docs)
    via_index = sorted((r["query_id"], r["doc_id"], round(r["score"], 9))
                       for r in tx.search_text(docs, queries, postings=spark.read.parquet(path), stats=stats).collect())
    assert direct == via_index and [(q, d) for q, d, _ in direct] == [(1, 1), (1, 2), (2, 3), (3, 1)]


def test_large_batch_uses_shuffle_joins_and_same_result(spark):
    docs_df = fl.with_row_number(spark.createDataFrame([("a b c",), ("b c d",), ("c d e",)], "message string"))
    docs = tx.build_documents(docs_df, "t", metadata={})
    q = spark.createDataFrame([(1, "b c"), (2, "d")], "query_id long, text string")
    a = sorted((r["query_id"], r["doc_id"]) for r in tx.search_text(docs, q).collect())
    b = sorted((r["query_id"], r["doc_id"]) for r in tx.search_text(docs, q, max_broadcast_tokens=0).collect())
    assert a == b == [(1, 1), (1, 2), (2, 2), (2, 3)]


def test_stream_overdue_timer(spark):
    d = tempfile.mkdtemp(prefix="quarry-od-")
    base = dt.datetime(2026, 1, 1)
    rows = [("c1", base), ("c2", base), ("c1", base + dt.timedelta(hours=1))]
    spark.createDataFrame(rows, "client string, ts timestamp").write.mode("overwrite").parquet(d)
    # a later check-in from another client advances the watermark past c2's deadline only
    spark.createDataFrame([("c3", base + dt.timedelta(hours=4))], "client string, ts timestamp") \
        .write.mode("append").parquet(d)
    spark.createDataFrame([("c3", base + dt.timedelta(hours=4, minutes=1))], "client string, ts timestamp") \
        .write.mode("append").parquet(d)
    s = spark.readStream.schema("client string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(d)
    q = st.run_available(st.stream_overdue_clients(s, "client", "ts", 3600, 3, "0 seconds"),
                         tempfile.mkdtemp(prefix="quarry-ck-"), query_name="x4_out")
    got = {r["client"] for r in spark.sql("SELECT client FROM x4_out").collect()}
    q.stop()
    assert got <= {"c2", "c1"} and "c3" not in got


def test_status_rollup(spark):
    df = spark.createDataFrame([(200,), (401,), (401,), (429,), (502,), (418,)], "status_code int")
    got = {r["status_class"]: (r["responses"], r["next_check"]) for r in ru.status_rollup(df).collect()}
    assert got["unauthorized"] == (2, "check the token") and got["ok"][0] == 1
    assert got["server_error"][0] == 1 and got["client_error"] == (1, None)


def test_compatibility_and_findings_joins(spark):
    installed = spark.createDataFrame([("addon", "1.0"), ("app", "2.0")], "component string, version string")
    matrix = spark.createDataFrame([("addon", "1.0", "9.3", "compatible", True), ("app", "2.0", "9.2", "compatible", True)],
                                   "component string, version string, target string, verdict string, applicable boolean")
    got = {r["component"]: r["compatibility"] for r in jn.join_compatibility(installed, matrix, "9.3").collect()}
    assert got == {"addon": "Compatible", "app": "Needs review"}
    findings = spark.createDataFrame([("F1", "lib", "/a", "h1"), ("F1", "lib", "/b", "h1")],
                                     "finding string, component string, path string, asset string")
    inventory = spark.createDataFrame([("lib", "/a", "h1", True, True), ("lib", "/b", "h1", True, True)],
                                      "component string, path string, asset string, matched boolean, affected boolean")
    remediation = spark.createDataFrame([("F1", "lib", "/a", "h1", True)],
                                        "finding string, component string, path string, asset string, remediation_verified boolean")
    got = {r["path"]: r["exposure_status"] for r in jn.join_findings(findings, inventory, remediation, None).collect()}
    assert got == {"/a": "Remediated", "/b": "Exposed"}      # paths are assessed independently


def test_head_offset_and_row_generator(spark):
    df = spark.range(0, 10)
    assert [r["id"] for r in sm.head(df, 3, offset=4, order=[F.col("id")]).collect()] == [4, 5, 6]
    assert sm.head(df, 0, order=[F.col("id")]).count() == 10
    assert [r["id"] for r in sm.head(df, 0, offset=7, order=[F.col("id").desc()]).collect()] == [2, 1, 0]
    from quarry.operators import filters as fl
    far = fl.page_rows(spark.range(0, 30_000, 1, 5), [F.col("id")], 3, 20_000)
    assert [r["id"] for r in far.collect()] == [20_000, 20_001, 20_002]
    mk = fl.make_results(spark, 5)
    assert mk.count() == 5 and mk.columns == ["id", "_time"]
    r = spark.range(1).select(ef.now().alias("n"), ef.random(7).alias("r"), ef.exact(F.lit(1)).alias("e")).collect()[0]
    assert r["n"] > 1_700_000_000 and 0 <= r["r"] < 1 and r["e"] == 1.0
