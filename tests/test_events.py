"""Event sequence (P3-P7, O4) and bounded SQL (P1) on fixture rows."""

import pytest

from quarry.operators import events as ev
from quarry.operators import filters as fl

# A kiln plant's log: one burn with two steps at the same second, one without a time, another burn between them.
STEPS = [("2025-11-02T04:30:10Z", "burn-7", "tr-a", "kiln", "heat", "INFO", "heat up"),
         ("2025-11-02T04:20:00Z", "burn-7", "tr-a", "kiln", "load", "INFO", "load bricks"),
         ("2025-11-02T04:30:10Z", "burn-7", "tr-b", "fan", "blow", "WARN", "fan late"),
         ("2025-11-02T04:25:00Z", "burn-8", "tr-c", "kiln", "load", "INFO", "other load"),
         (None, "burn-7", None, "kiln", "note", "INFO", "undated note"),
         ("2025-11-02T05:00:00Z", None, "tr-a", "kiln", "idle", "INFO", "no burn")]
STEPS_SCHEMA = "_time string, session_id string, trace_id string, component string, operation string, severity string, message string"
# Payloads: two of one order, one of another, one cut off, one a bare number, one missing.
PAYLOADS = [("2025-11-02T06:00:00Z", '{"requestId":"ord-55","cart":{"id":"c-9"}}', "shop", "cart opened"),
            ("2025-11-02T06:00:05Z", '{"requestId":"ord-56","cart":{"id":"c-8"}}', "shop", "other cart"),
            ("2025-11-02T06:00:06Z", '{"requestId":"ord-55"', "shop", "cut off"),
            ("2025-11-02T06:00:07Z", "17", "shop", "number"), ("2025-11-02T06:00:08Z", None, "shop", "nothing"),
            ("2025-11-02T06:00:09Z", '{"requestId":"ord-55","cart":{"id":"c-9"}}', "till", "cart paid")]
PAYLOADS_SCHEMA = "_time string, _raw string, component string, message string"


def with_rows(spark, data, schema):
    df = spark.createDataFrame(data, schema)
    return fl.with_row_number(df)


def test_field_match_sequence(spark):
    df = with_rows(spark, STEPS, STEPS_SCHEMA)
    out = ev.event_sequence(df, field="session_id", value="burn-7")
    assert out.columns[:3] == ["matched_value", "_row", "_time"]
    msgs = [r["message"] for r in out.collect()]
    assert set(msgs) == {"load bricks", "heat up", "fan late", "undated note"}
    # equal seconds keep the order of arrival
    assert [m for m in msgs if m != "undated note"] == ["load bricks", "heat up", "fan late"]
    assert ev.event_sequence(df, field="session_id", value="burn-9").count() == 0


def test_request_id_from_raw_json(spark):
    df = with_rows(spark, PAYLOADS, PAYLOADS_SCHEMA)
    m = ev.resolve_matcher(df, request_id="ord-55")
    assert (m.mode, m.field) == ("request_id", "json:auto")
    out = ev.event_sequence(df, request_id="ord-55").collect()
    assert [r["message"] for r in out] == ["cart opened", "cart paid"]


def test_request_id_prefers_existing_column(spark):
    df = with_rows(spark, STEPS, STEPS_SCHEMA)
    m = ev.resolve_matcher(df, request_id="tr-a")
    assert (m.mode, m.field) == ("request_id", "trace_id")
    assert ev.match_request_id(df, "tr-a").count() == 3


def test_json_path_match(spark):
    df = with_rows(spark, PAYLOADS, PAYLOADS_SCHEMA)
    out = ev.event_sequence(df, json_field="$.cart.id", value="c-9").collect()
    assert len(out) == 2 and out[0]["message"] == "cart opened"


def test_numbers_match_as_text(spark):
    df = spark.createDataFrame([(73.0,), (73.25,), (None,)], "status double")
    assert ev.match_field(df, "status", "73").count() == 1


@pytest.mark.parametrize("kwargs,msg", [
    (dict(request_id="x", field="a", value="b"), "exactly one of .* got request_id, field"),
    (dict(), "exactly one of .* got none"),
    (dict(field="session_id", json_field="$.a", value="x"), "exactly one of"),
    (dict(field=" ", json_field=None, value="x"), "exactly one of"),
    (dict(field="session_id"), "field takes a value"),
    (dict(request_id="x", value="y"), "request_id takes no value"),
    (dict(field="nope", value="x"), "needs one of the columns nope"),
    (dict(json_field="$.a", value="x"), "needs one of the columns _raw"),
])
def test_selector_conflicts(spark, kwargs, msg):
    df = with_rows(spark, STEPS, STEPS_SCHEMA)
    with pytest.raises(ValueError, match=msg):
        ev.resolve_matcher(df, **kwargs)


def test_bounded_sql_limit_flag(spark):
    df = spark.createDataFrame([("ash", 3), ("elm", 4), ("oak", None)], "tree string, rings int")
    out = fl.query_results(spark, df, "SELECT tree, rings FROM results LIMIT 700", limit=1,
                           flag_truncation=True).collect()
    assert len(out) == 1 and out[0]["truncated"] is True


def test_json_selector_needs_a_path(spark):
    with pytest.raises(ValueError, match="JSON path"):
        ev.resolve_matcher(spark.createDataFrame([("{}",)], "_raw string"), json_field="a.b", value="x")


def test_bounded_sql_accepts_semicolons_in_text(spark):
    df = spark.createDataFrame([("a;b",), ("drop table x",)], "t string")
    assert fl.query_results(spark, df, "SELECT t FROM results WHERE t = 'a;b';").count() == 1
    assert fl.query_results(spark, df, "select t from results where t like 'drop%'").count() == 1


@pytest.mark.parametrize("sql", ["", "DELETE FROM results", "SELECT 1; SELECT 2", "SELECT 1;;", "INSERT INTO results SELECT 1",
                                 "SELECT reflect('java.lang.System', 'exit', 1)", "SELECT 1) UNION (SELECT 2; DROP TABLE x",
                                 "SELECT (SELECT max(java_method('java.lang.Math', 'abs', a)) FROM results)",
                                 "SELECT a FROM results WHERE a IN (SELECT try_reflect('x', 'y') FROM results)"])
def test_bounded_sql_rejects(spark, sql):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        fl.query_results(spark, df, sql)


def test_bounded_sql_subquery_blocks_commands(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(Exception):
        fl.query_results(spark, df, "SELECT 1) AS q; DROP TABLE results; SELECT (1").collect()


def test_row_number_and_slice(spark):
    df = spark.range(0, 50).withColumnRenamed("id", "k").repartition(4)
    numbered = fl.with_row_number(df, ["k"])
    assert [r["_row"] for r in numbered.orderBy("k").collect()] == list(range(1, 51))
    page = fl.slice_rows(spark.range(0, 10), [__import__("pyspark.sql.functions", fromlist=["col"]).col("id")],
                         limit=3, offset=8).collect()
    assert [r["id"] for r in page] == [8, 9] and page[0]["has_more"] is False and page[0]["total"] == 10


def test_relative_time(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("2025-03-01 07:08:09",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    r = df.select(fl.relative_time(F.col("t"), "-24h@h").alias("a"), fl.relative_time(F.col("t"), "-15m").alias("b"),
                  fl.relative_time(F.col("t"), "@d").alias("c")).collect()[0]
    assert str(r["a"]) == "2025-02-28 07:00:00" and str(r["b"]) == "2025-03-01 06:53:09"
    assert str(r["c"]) == "2025-03-01 00:00:00"
    with pytest.raises(ValueError):
        fl.relative_time(F.col("t"), "yesterday")


def test_bounded_sql_callers_do_not_share_views(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(10,)], "x int")
    qa = fl.query_results(spark, a, "SELECT sum(x) AS s FROM results")
    qb = fl.query_results(spark, {"results": b, "other": a}, "SELECT sum(r.x) + count(o.x) AS s FROM results r, other o")
    assert qa.collect()[0]["s"] == 3 and qb.collect()[0]["s"] == 22
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("__quarry_")]
