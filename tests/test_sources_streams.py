"""Sources, manifest (S, M) and streaming operators (X): fixture payloads,
and every stream checked against the batch result on the same files."""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from quarry.sources import ingest as ig
from quarry.sources import manifest as mf
from quarry.streaming import streams as st


def fresh_dir(prefix):
    return tempfile.mkdtemp(prefix=prefix)


def test_ingest_rows_union_case_reserved(spark):
    lines = [json.dumps({"event": "login", "service": "identity", "nested": {"a": 1}}),
             json.dumps({"event": "logout", "service": "identity", "count": 2, "_json": "reserved field", "Event": "X"}),
             "plain text"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = ig.ingest_rows(df)
    assert out.columns == ["_json", "Event", "count", "nested", "service"]
    rows = out.collect()
    assert rows[0]["nested"] == '{"a":1}' and rows[0]["Event"] == "login" and rows[1]["count"] == 2
    assert rows[1]["Event"] == "X" and rows[2]["service"] is None and rows[2]["_json"] == "plain text"


def test_ingest_rows_of_any_shape(spark):
    lines = ["5", "[1,2]", "{bad", None, '{"a,b": 1, "c: d": "x", "e<f": [1], "q\\"r": true, "m": 1, "n": 1}',
             '{"a,b": 2.5, "m": "t", "n": {"z": "y"}, "void": null}']
    df = spark.createDataFrame(list(enumerate(lines)), "id int, value string")
    out = {r["id"]: r for r in ig.ingest_rows(df, keep=["id"]).collect()}
    assert all(out[k]["a,b"] is None and out[k]["_json"] == lines[k] for k in range(4))
    r, s = out[4], out[5]
    assert (r["a,b"], r["c: d"], r["e<f"], r['q"r'], r["m"], r["n"]) == (1.0, "x", "[1]", True, "1", "1")
    assert (s["a,b"], s["m"], s["n"], s["void"]) == (2.5, "t", '{"z":"y"}', None)
    assert ig.ingest_rows(df.limit(2)).columns == ["_json"]


def test_saving_a_name_twice_leaves_one_manifest_row(spark):
    d = fresh_dir("quarry-twice-")
    df = spark.createDataFrame([(1,), (2,)], "n int")
    for k in (1, 2):
        ig.save_result(df.limit(k), d, "same", manifest_path=f"{d}/_manifest", meta={"created_at": k})
        ig.save_result(df, d, f"other{k}", manifest_path=f"{d}/_manifest", meta={"created_at": 9})
    got = sorted((r["table_name"], r["result_count"]) for r in spark.read.parquet(f"{d}/_manifest").collect())
    assert got == [("other1", 2), ("other2", 2), ("same", 2)]


def test_warning_text_is_parsed_by_type(spark):
    raw = ['[ {"code":"x","message":"m"}]', '[ "old"]', "[]", "nope", None, '{"code":"x"}']
    df = spark.createDataFrame([(r,) for r in raw], "w string")
    got = [[(x["code"], x["message"]) for x in r["p"]] for r in df.select(mf.parse_warnings(F.col("w")).alias("p")).collect()]
    assert got == [[("x", "m")], [("legacy", "old")], [], [], [], []]


def test_save_result_and_manifest(spark):
    d = fresh_dir("quarry-save-")
    df = spark.createDataFrame([("login",), ("logout",)], "event string")
    ig.save_result(df, d, "sample", manifest_path=f"{d}/_manifest",
                   meta={"url": "https://search.example.com", "app": "search", "query": "search index=test",
                         "earliest": "-1m", "latest": "now", "run_duration": 0.3, "created_at": 1000})
    ig.save_result(df.limit(1), d, "sample2", manifest_path=f"{d}/_manifest", meta={"created_at": 2000})
    assert spark.read.parquet(f"{d}/sample").count() == 2
    m = spark.read.parquet(f"{d}/_manifest")
    lst = mf.list_results(m, limit=1).collect()
    assert len(lst) == 1 and lst[0]["table_name"] == "sample2" and lst[0]["truncated"]
    assert lst[0]["created_at_utc"] == "1970-01-01T00:33:20Z"
    exp = [r["table_name"] for r in mf.expired_results(m, 1000 + 86400 + 500).collect()]
    assert exp == ["sample"]
    try:
        ig.save_result(df, d, "bad-name")
        assert False
    except ValueError:
        pass


def test_warning_lifecycle(spark):
    m = mf.manifest_row(spark, "t1", result_count=10001, warnings=[
        {"code": "Full-Fetch", "message": " fetched all ", "accepted": False, "accepted_at": 0},
        {"code": "", "message": "old style", "accepted": False, "accepted_at": 5},
        {"code": "x", "message": "  ", "accepted": False, "accepted_at": 0}])
    w = m.select(mf.normalize_warnings(F.col("warnings")).alias("w")).collect()[0]["w"]
    assert [(x["code"], x["message"], x["accepted_at"]) for x in w] == [("full_fetch", "fetched all", 0), ("legacy", "old style", 0)]
    a1 = mf.accept_warning(m, "t1", "FULL-FETCH", 1234).collect()[0]
    assert a1["accept_found"] and a1["accept_changed"]
    assert [(x["code"], x["accepted"], x["accepted_at"]) for x in a1["warnings"]][0] == ("full_fetch", True, 1234)
    again = mf.accept_warning(spark.createDataFrame([a1.asDict()], m.schema.add("accept_found", "boolean").add("accept_changed", "boolean"))
                              .drop("accept_found", "accept_changed"), "t1", "full_fetch", 9999).collect()[0]
    assert not again["accept_changed"] and again["warnings"][0]["accepted_at"] == 1234
    raw = spark.createDataFrame([('["old one", " "]',), ('[{"code":"A-B","message":"m","accepted":true,"accepted_at":7}]',), ("{bad",)], "r string")
    parsed = [r["p"] for r in raw.select(mf.parse_warnings(F.col("r")).alias("p")).collect()]
    assert [(x["code"], x["message"]) for x in parsed[0]] == [("legacy", "old one")]
    assert (parsed[1][0]["code"], parsed[1][0]["accepted_at"]) == ("a_b", 7) and parsed[2] == []
    bf = mf.broad_fetch_warning(mf.manifest_row(spark, "t2", result_count=10001)).collect()[0]
    assert [x["code"] for x in bf["warnings"]] == ["full_fetch"]
    assert mf.broad_fetch_warning(mf.manifest_row(spark, "t3", result_count=10000)).collect()[0]["warnings"] == []


def test_job_status_payloads(spark):
    running = {"entry": [{"content": {"dispatchState": "running", "isDone": False, "doneProgress": 0.25,
                                      "scanCount": 40, "eventCount": 12, "resultCount": 3, "resultPreviewCount": 2,
                                      "runDuration": 1.5}}]}
    done = {"entry": [{"content": {"dispatchState": "DONE", "isDone": "true", "doneProgress": "1.5",
                                   "scanCount": "80", "eventCount": 20, "resultCount": "x", "resultPreviewCount": 2,
                                   "runDuration": 2.5}}]}
    df = spark.createDataFrame([(json.dumps(running),), (json.dumps(done),), ('{"entry": []}',)], "value string")
    r = ig.parse_job_status(df).collect()
    assert (r[0]["state"], r[0]["done"], r[0]["done_progress"], r[0]["scan_count"]) == ("RUNNING", False, 0.25, 40)
    assert (r[1]["done"], r[1]["done_progress"], r[1]["scan_count"], r[1]["result_count"]) == (True, 1.0, 80, 0)
    assert r[2]["has_entry"] is False


def test_envelopes_raw_split_jsonl(spark):
    env = [(json.dumps({"event": {"msg": "hi"}, "time": 1700000000.5, "host": "h1", "fields": {"a": "1"}}),),
           (json.dumps({"event": "plain", "index": "ops"}),), (json.dumps({"host": "no event"}),)]
    out = ig.read_envelopes(spark.createDataFrame(env, "value string"), defaults={"sourcetype": "st"},
                            received_at=F.lit("2026-01-01 00:00:00").cast("timestamp")).collect()
    assert len(out) == 2 and out[0]["event"] == '{"msg":"hi"}' and str(out[0]["_time"]) == "2023-11-14 22:13:20.500000"
    assert (out[0]["index"], out[0]["sourcetype"], out[0]["fields"]) == ("main", "st", {"a": "1"})
    assert (out[1]["index"], str(out[1]["_time"])) == ("ops", "2026-01-01 00:00:00")
    raw = ig.read_raw(spark.createDataFrame([("a\n\nb\r\nc",)], "value string")).collect()
    assert [r["_raw"] for r in raw] == ["a", "b", "c"]
    body = spark.createDataFrame([('{"event":"a"}{"event":"b"} {"event":"c"}',)], "value string")
    parts = [json.loads(r["value"])["event"] for r in ig.split_envelopes(body).collect()]
    assert parts == ["a", "b", "c"]
    odd = [('{"event":"a}{b","fields":{"k":"v"}}{oops {"x":1}}\n{"event":"z"} 5',), (None,), ("",)]
    got = [(r["value"], r["error"] is None) for r in ig.split_envelopes(spark.createDataFrame(odd, "value string")).collect()]
    assert got == [('{"event":"a}{b","fields":{"k":"v"}}', True), ('{oops {"x":1}}', False), ('{"event":"z"}', True), ("5", False)]
    kept = ig.read_envelopes(ig.split_envelopes(spark.createDataFrame(odd[:1], "value string"))).collect()
    assert kept[0]["fields"] == {"k": "v"} and [r["event"] for r in kept] == ["a}{b", "z"]
    bad = spark.createDataFrame([("{x",), ("[1]",), ('{"host":"h"}',), ('{"event":1}',)], "value string")
    assert [r["reason"] for r in ig.rejected_envelopes(bad).collect()] == ["not_json", "not_an_object", "no_event"]
    j = ig.to_jsonl(spark.createDataFrame([(1, "x")], "n int, s string"), "result").collect()[0]["value"]
    assert json.loads(j) == {"type": "result", "n": 1, "s": "x"}


def _write_parts(spark, df, d, parts=3):
    df.repartition(parts).write.mode("overwrite").parquet(d)


def test_stream_summary_equals_batch(spark):
    src = fresh_dir("quarry-src-")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    _write_parts(spark, e, src)
    stream = spark.readStream.schema(e.schema).parquet(src)
    s = st.stream_summary(stream, "ts", "1 day", "1 hour", ["event_type"], metric="value", thresholds=(50,),
                          error_where="value > 100")
    q = st.run_available(s, fresh_dir("quarry-ck-"), query_name="x2_out")
    from quarry.plans.registry import rounded
    got = rounded(spark.sql("SELECT * FROM x2_out"), 9)
    batch = rounded(st.stream_summary(e, "ts", "1 day", "1 hour", ["event_type"], metric="value", thresholds=(50,),
                                      error_where="value > 100"), 9)
    # append mode holds back windows the watermark has not passed: the last day
    last = batch.agg(F.max("window_start")).collect()[0][0]
    assert got.exceptAll(batch.filter(F.col("window_start") < last)).count() == 0
    assert batch.filter(F.col("window_start") < last).exceptAll(got).count() == 0
    q.stop()


def test_stream_envelopes_and_sessions(spark):
    src = fresh_dir("quarry-env-")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(300)
    env = e.select(F.to_json(F.struct(F.col("event_type").alias("event"),
                                      F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
                                      F.col("user_id").cast("string").alias("host"))).alias("value"))
    env.repartition(2).write.mode("overwrite").text(src)
    stream = st.stream_envelopes(spark, src, {"index": "idx"})
    q = st.run_available(stream, fresh_dir("quarry-ck-"), query_name="x1_out")
    assert spark.sql("SELECT * FROM x1_out").drop("_time", "fields").exceptAll(
        ig.read_envelopes(spark.read.text(src), "value", {"index": "idx"}).drop("_time", "fields")).count() == 0
    assert spark.sql("SELECT count(*) FROM x1_out").collect()[0][0] == 300
    q.stop()
    batch = st.activity_sessions(e, "user_id", "ts", "6 hours")
    assert batch.agg(F.sum("events")).collect()[0][0] == 300


def test_stream_unacked_and_retention(spark):
    base = 1_700_000_000
    subs = [(i, base + i * 10) for i in range(6)]
    acks = [(0, base + 5), (1, base + 10 + 500), (3, base + 30 + 2)]
    sd, ad = fresh_dir("quarry-sub-"), fresh_dir("quarry-ack-")
    spark.createDataFrame(subs, "ack_id int, t long").withColumn("t", F.timestamp_seconds("t")).write.mode("overwrite").parquet(sd)
    spark.createDataFrame(acks, "ack_id int, t long").withColumn("t", F.timestamp_seconds("t")).write.mode("overwrite").parquet(ad)
    # a late marker pushes both watermarks past every bound
    spark.createDataFrame([(99, base + 100000)], "ack_id int, t long").withColumn("t", F.timestamp_seconds("t")) \
        .write.mode("append").parquet(sd)
    spark.createDataFrame([(98, base + 100000)], "ack_id int, t long").withColumn("t", F.timestamp_seconds("t")) \
        .write.mode("append").parquet(ad)
    schema = "ack_id int, t timestamp"
    s1 = spark.readStream.schema(schema).parquet(sd)
    a1 = spark.readStream.schema(schema).parquet(ad)
    out = st.stream_unacked(s1, a1, ["ack_id"], "t", "t", "60 seconds")
    q = st.run_available(out, fresh_dir("quarry-ck-"), query_name="x3_out")
    first = sorted(r["ack_id"] for r in spark.sql("SELECT ack_id FROM x3_out").collect())
    q.stop()
    # micro-batch timing decides when state is flushed; re-run drains the rest
    q2 = st.run_available(st.stream_unacked(spark.readStream.schema(schema).parquet(sd),
                                            spark.readStream.schema(schema).parquet(ad), ["ack_id"], "t", "t", "60 seconds"),
                          fresh_dir("quarry-ck-"), query_name="x3_out2")
    got = sorted(set(first) | {r["ack_id"] for r in spark.sql("SELECT ack_id FROM x3_out2").collect()})
    q2.stop()
    assert set(got) <= {1, 2, 4, 5, 99} and {1, 2, 4, 5} & set(got)
    rd = fresh_dir("quarry-ret-")
    spark.createDataFrame([("a", base), ("a", base), ("b", base + 2), ("old", base - 4000), ("none", None)], "k string, t long") \
        .withColumn("t", F.timestamp_seconds("t")).write.mode("overwrite").parquet(rd)
    now = str(spark.range(1).select(F.timestamp_seconds(F.lit(base + 10)).cast("string")).first()[0])
    r = st.stream_retention(spark.readStream.schema("k string, t timestamp").parquet(rd), "t", "1 hour", now)
    q3 = st.run_available(r, fresh_dir("quarry-ck-"), query_name="x7_out")
    assert sorted(x["k"] for x in spark.sql("SELECT k FROM x7_out").collect()) == ["a", "a", "b"]
    q3.stop()


def test_stream_thin_progress_equals_batch(spark):
    from quarry.operators.windows import thin_progress
    rows = []
    for job in ("j1", "j2"):
        for i in range(40):
            rows.append((job, 1_700_000_000 + i * 3, "run" if i < 25 else "fetch", "RUNNING", float(min(i * 4, 100)),
                         max(0, i - 26) * 10, 0, 100))
    df = spark.createDataFrame(rows, "job string, t long, phase string, state string, percent double, "
                                     "fetched long, written long, total long") \
        .withColumn("ts", F.timestamp_seconds("t")).drop("t")
    d = fresh_dir("quarry-prog-")
    # progress arrives in time order: three appended time slices
    for lo, hi in ((0, 40), (40, 80), (80, 200)):
        t0 = 1_700_000_000
        df.filter((F.col("ts") >= F.timestamp_seconds(F.lit(t0 + lo))) & (F.col("ts") < F.timestamp_seconds(F.lit(t0 + hi)))) \
          .coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d)
    q = st.run_available(st.stream_thin_progress(stream), fresh_dir("quarry-ck-"), query_name="x5_out")
    got = spark.sql("SELECT * FROM x5_out")
    batch = thin_progress(spark.read.parquet(d))
    assert got.exceptAll(batch).count() == batch.exceptAll(got).count() == 0 < got.count() < df.count()
    q.stop()


def test_overdue_batch(spark):
    df = spark.createDataFrame([("c1", "2026-01-01 00:00:00"), ("c1", "2026-01-01 05:00:00"), ("c2", "2026-01-01 00:00:00")],
                               "client string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r["client"]: r["overdue"] for r in st.overdue_clients(df, "client", "ts", 3600, 3, "2026-01-01 06:00:00").collect()}
    assert got == {"c1": False, "c2": True}


def test_stream_sessions_equal_batch(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts")
    batch = st.activity_sessions(e, "user_id", "ts", "6 hours").select("user_id", "session_start", "session_end", "events")
    # one data batch
    src = fresh_dir("quarry-sess1-")
    e.coalesce(1).write.mode("overwrite").parquet(src)
    q = st.run_available(st.activity_sessions(spark.readStream.schema(e.schema).parquet(src), "user_id", "ts",
                                              "6 hours", watermark="1 hour"), fresh_dir("quarry-ck-"), query_name="x6_one")
    got = spark.sql("SELECT user_id, session_start, session_end, events FROM x6_one")
    wm = e.agg(F.max("ts")).collect()[0][0]
    closed = batch.filter(F.col("session_end") <= F.lit(wm).cast("timestamp") - F.expr("INTERVAL 1 HOUR"))
    assert got.exceptAll(batch).count() == 0 and closed.exceptAll(got).count() == 0
    # a filter on the session end must not cut sessions (regression)
    one = batch.filter((F.col("user_id") == 12) & (F.col("session_end") <= "2024-01-30 22:00:00"))
    assert all(r["events"] != 5 or r["session_start"].day != 30 for r in one.collect())
    q.stop()
    # time-ordered slices over several micro-batches: never a session batch does not have
    src = fresh_dir("quarry-sess-")
    for lo, hi in (("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2024-02-01")):
        e.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = st.run_available(st.activity_sessions(stream, "user_id", "ts", "6 hours", watermark="1 hour"),
                         fresh_dir("quarry-ck-"), query_name="x6_out")
    got = spark.sql("SELECT user_id, session_start, session_end, events FROM x6_out")
    assert got.count() > 0 and got.exceptAll(batch).count() == 0
    q.stop()
