"""Eval functions (F) and extraction (E) on literal rows."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import evalfns as ef
from quarry.operators import extract as ex


def one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [("a",)], schema)
    return df.select(col.alias("v")).collect()[0]["v"]


def test_conversions(spark):
    assert one(spark, ef.tonumber("x"), [("12abc",)]) is None
    assert one(spark, ef.tonumber("x"), [(" 3.5 ",)]) == 3.5
    assert one(spark, ef.tostring("x", "commas"), [(1234567,)], "x long") == "1,234,567"
    assert one(spark, ef.tostring("x", "hex"), [(255,)], "x long") == "FF"
    assert one(spark, ef.tostring("x", "duration"), [(3725,)], "x long") == "01:02:05"
    assert one(spark, ef.tostring("x", "duration"), [(90061,)], "x long") == "1+01:01:01"


def test_multivalue(spark):
    arr = F.split(F.lit("a,b,c"), ",")
    assert one(spark, ef.mvcount(arr)) == 3
    assert one(spark, ef.mvindex(arr, 0)) == "a"
    assert one(spark, ef.mvindex(arr, 5)) is None
    assert one(spark, ef.mvcount(F.lit(None).cast("array<string>"))) is None
    assert one(spark, ef.split(F.lit("a.b.c"), ".")) == ["a", "b", "c"]
    assert one(spark, ef.mvjoin(arr, ";")) == "a;b;c"


def test_conditions_and_math(spark):
    assert one(spark, ef.case(F.lit(False), "a", F.lit(True), "b", "c")) == "b"
    assert one(spark, ef.case(F.lit(False), "a", "c")) == "c"
    assert one(spark, ef.if_(F.lit(1) > 2, "y", "n")) == "n"
    assert one(spark, ef.max_(F.lit(3), F.lit(None).cast("int"), F.lit(7))) == 7
    assert one(spark, ef.round_(F.lit(2.5), 0)) == 3.0
    assert one(spark, ef.sigfig(F.lit(123456.0), 3)) == pytest.approx(123000.0)
    assert one(spark, ef.sigfig(F.lit(0.0012345), 2)) == pytest.approx(0.0012)
    assert one(spark, ef.concat_str(F.lit("a"), "-", F.lit(None).cast("string"))) is None
    assert one(spark, ef.add(F.lit(9223372036854775807), 1)) is None


def test_time_formats(spark):
    assert ef.java_pattern("%Y-%m-%d %H:%M:%S") == "yyyy'-'MM'-'dd' 'HH':'mm':'ss"
    assert one(spark, ef.strftime(F.lit(0), "%A %d %B %Y %I%p")) == "Thursday 01 January 1970 12AM"
    assert one(spark, ef.strptime(F.lit("2026/05/18 12:00:00"), "%Y/%m/%d %H:%M:%S")) == 1779105600
    assert one(spark, ef.strptime(F.lit("garbage"), "%Y/%m/%d")) is None


def test_url_hash_json(spark):
    assert one(spark, ef.urlencode(F.lit("a b&c"))) == "a+b%26c"
    assert one(spark, ef.urldecode(F.lit("a+b%26c"))) == "a b&c"
    assert one(spark, ef.md5(F.lit("abc"))) == "900150983cd24fb0d6963f7d28e17f72"
    assert one(spark, ef.sha(F.lit("abc"), 1)) == "a9993e364706816aba3e25717850c26c9cd0d89d"
    assert one(spark, ef.json_extract(F.lit('{"k": 69}'), "$.k")) == "69"
    assert one(spark, ef.json_valid(F.lit("plain text"))) is False
    assert one(spark, ef.json_valid(F.lit('{"a":[1]}'))) is True


def test_searchmatch(spark):
    assert one(spark, ef.searchmatch(F.lit("Request FAILED for user_1"), "failed USER_1")) is True
    assert one(spark, ef.searchmatch(F.lit("Request failed"), "failed user")) is False
    with pytest.raises(ValueError):
        ef.searchmatch(F.lit("x"), "!!!")


def test_regex_extraction_named_groups(spark):
    df = spark.createDataFrame([("user=alice ip=10.0.0.1",), ("nothing",)], "raw string")
    out = ex.extract_regex(df, "raw", r"user=(?<user_name>\w+) ip=(?P<src_ip>[\d.]+)").collect()
    assert (out[0]["user_name"], out[0]["src_ip"]) == ("alice", "10.0.0.1")
    assert out[1]["user_name"] is None
    java, names = ex.compile_named(r"(a)(?:b)(?<x>c)[(](?<y>d)")
    assert names == [("x", 2), ("y", 3)]


def test_transforms_delims_kv(spark):
    df = spark.createDataFrame([('a=1, b="two words"; a=3 c=4',)], "raw string")
    kv = ex.extract_kv(df, "raw").collect()[0]["kv"]
    assert kv == {"a": "1", "b": "two words", "c": "4"}
    many = spark.createDataFrame([(" ".join(f"k{i}={i}" for i in range(150)),)], "raw string")
    assert len(ex.extract_kv(many, "raw").collect()[0]["kv"]) == 150
    d = spark.createDataFrame([("x|y",)], "raw string")
    r = ex.extract_delimited(d, "raw", "|", ["f1", "f2", "f3"]).collect()[0]
    assert (r["f1"], r["f2"], r["f3"]) == ("x", "y", None)
    t = ex.apply_transforms(spark.createDataFrame([("id=7 code=9",)], "raw string"), "raw",
                            [r"id=(?<n>\d+)", r"code=(?<n>\d+)"], multivalue=True).collect()[0]
    assert t["n"] == ["7", "9"]


def test_multikv_template_xml(spark):
    text = "PID USER CMD\n1 root init\n22 bob  bash\n"
    rows = ex.extract_table(spark.createDataFrame([(text,)], "raw string"), "raw").orderBy("line").collect()
    assert [r["fields"]["USER"] for r in rows] == ["root", "bob"] and rows[0]["line"] == 2
    t = ex.extract_template(spark.createDataFrame([("user=al at=12:00",)], "raw string"), "raw",
                            "user={user_name} at={when}").collect()[0]
    assert (t["user_name"], t["when"]) == ("al", "12:00")
    x = ex.xmlkv(spark.createDataFrame([("<a>1</a><b x='y'>2</b><a>3</a>",)], "raw string"), "raw").collect()[0]
    assert x["xmlkv"] == {"a": "1", "b": "2"}
    s = ex.extract_xml(spark.createDataFrame([("<r><t>v</t></r>",)], "raw string"), "raw", {"t": "/r/t"},
                       loose=False).collect()[0]
    assert s["t"] == "v"


def test_alias_calc_eventtype_tags_pipeline(spark):
    df = spark.createDataFrame([("login", 5, None), ("error", 900, "x")], "action string, ms int, dest string")
    spec = ex.NormalizeSpec(aliases={"action": "act"}, calculated={"slow": "ms > 500"},
                            eventtypes={"failure": "action = 'error'", "slow_event": "slow"},
                            tags=[("act", "error", "alert"), ("slow", "true", "perf")])
    out = ex.normalize(df, spec).orderBy("ms").collect()
    assert out[0]["act"] == "login" and out[0]["eventtype"] == [] and out[0]["tag"] == []
    assert out[1]["eventtype"] == ["failure", "slow_event"] and out[1]["tag"] == ["alert", "perf"]
    conf = ex.conformance(ex.normalize(df, spec), ["dest", "user"], ["alert"]).orderBy("ms").collect()
    assert conf[0]["missing_fields"] == ["dest", "user"] and conf[0]["missing_tags"] == ["alert"]
    assert conf[1]["missing_fields"] == ["user"] and conf[1]["missing_tags"] == []


def test_tags_of_tables_and_lists_agree(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "None")], "id int, v string")
    triples = [("v", "a", "t1"), ("v", "a", "t2"), ("v", "c", "t3"), ("v", None, "never"), ("absent", "a", "never")]
    want = {1: ["t1", "t2"], 2: [], 3: ["t3"], 4: [], 5: []}
    table = spark.createDataFrame(triples, "f string, val string, tag string")
    for rules in (triples, table):
        assert {r["id"]: r["tag"] for r in ex.add_tags(df, rules).collect()} == want
    assert {tuple(r["tag"]) for r in ex.add_tags(df, []).collect()} == {()}


def test_url_normalisation(spark):
    df = spark.createDataFrame([("Search.Example.com",), ("http://h:8089/x",), ("ftp://h",), ("https://h:9000",)],
                               "u string")
    out = [r["n"] for r in df.select(ex.normalize_url("u").alias("n")).collect()]
    assert out[0]["key"] == "https://search.example.com" and out[0]["api"] == "https://search.example.com:8089"
    assert out[1]["web"] == "http://h:8000" and out[1]["api"] == "http://h:8089"
    assert out[1]["bases"] == ["http://h:8000", "http://h:8089"]
    assert out[2] is None
    assert out[3]["bases"] == ["https://h:9000"]


def test_failure_taxonomy(spark):
    rows = [("http", 503, None, None, "search"), ("http", 404, None, None, "search"),
            ("dns", None, True, False, None), ("dns", None, True, True, None), ("weird", None, None, None, "fetch"),
            ("weird", None, None, None, None), ("search_timeout", None, None, None, None)]
    df = spark.createDataFrame(rows, "kind string, status_code int, dns_temporary boolean, dns_not_found boolean, operation string")
    got = [(r["error_code"], r["retryable"]) for r in ex.classify_failures(df).collect()]
    assert got == [("remote_http_error", True), ("remote_http_error", False), ("dns_lookup_failed", True),
                   ("dns_lookup_failed", False), ("remote_operation_failed", False), (None, False),
                   ("search_timeout", True)]


def test_compact_and_scalar_text(spark):
    assert one(spark, ex.compact_text(F.lit("  a \n\t b  "))) == "a b"
    assert one(spark, ex.compact_text(F.lit("abcdef"), 3)) == "abc"
    df = spark.createDataFrame([(True, 200.0, 1.5, " x ", "")], "b boolean, d double, f double, s string, e string")
    r = df.select(*[ex.scalar_text(df, c).alias(c) for c in df.columns]).collect()[0]
    assert (r["b"], r["d"], r["f"], r["s"], r["e"]) == ("true", "200", "1.5", "x", None)
