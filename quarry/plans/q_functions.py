"""Registered queries: eval functions (F) and field extraction (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import evalfns as ef
from ..operators import extract as ex
from .registry import register, rounded, table


# ------------------------------------------------------------------ F
@register("f_strings", sql="""
SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, CAST(length(p_name) AS INTEGER) AS len,
       substr(p_name, 2, 4) AS sub, trim('  ' || p_type || ' ') AS tr, ltrim('  ' || p_type || ' ') AS ltr,
       rtrim('  ' || p_type || ' ') AS rtr, regexp_replace(p_name, '[aeiou]', '_', 'g') AS rep,
       contains(p_name, 'ring') AS has_ring, p_brand || '-' || p_type AS combo,
       CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words, string_split(p_name, ' ')[2] AS second,
       array_to_string(string_split(p_name, ' '), '|') AS joined, CAST(p_size AS VARCHAR) AS size_txt,
       TRY_CAST(CAST(p_size AS VARCHAR) || '.5' AS DOUBLE) AS num, TRY_CAST(p_type AS DOUBLE) AS bad_num,
       p_name = 'red plate' AS is_red_plate
FROM part
""")
def f_strings(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    padded = F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))
    words = ef.split("p_name", " ")
    return p.select(
        "p_partkey", ef.upper("p_name").alias("up"), ef.lower("p_brand").alias("low"),
        ef.len_("p_name").alias("len"), ef.substr("p_name", 2, 4).alias("sub"),
        ef.trim(padded).alias("tr"), ef.ltrim(padded).alias("ltr"), ef.rtrim(padded).alias("rtr"),
        ef.replace("p_name", "[aeiou]", "_").alias("rep"), ef.contains("p_name", "ring").alias("has_ring"),
        ef.concat_str(F.col("p_brand"), "-", F.col("p_type")).alias("combo"), ef.mvcount(words).alias("words"),
        ef.mvindex(words, 1).alias("second"), ef.mvjoin(words, "|").alias("joined"),
        ef.tostring("p_size").alias("size_txt"),
        ef.tonumber(F.concat(F.col("p_size").cast("string"), F.lit(".5"))).alias("num"),
        ef.tonumber("p_type").alias("bad_num"), ef.eq("p_name", "red plate").alias("is_red_plate"))


@register("f_math", sql="""
SELECT l_orderkey, l_linenumber,
       round(abs(l_discount - 0.05), 6) AS a, CAST(ceil(l_extendedprice / 7) AS BIGINT) AS c,
       CAST(floor(l_extendedprice / 7) AS BIGINT) AS f, round(l_extendedprice / 7, 2) AS r,
       round(sqrt(l_quantity), 6) AS sq, round(power(l_quantity, 2), 6) AS pw,
       round(greatest(l_tax, l_discount), 6) AS mx, round(least(l_tax, l_discount), 6) AS mn,
       CASE WHEN l_quantity > 25 THEN 'big' ELSE 'small' END AS size_class,
       CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_linestatus = 'O' THEN 'open' ELSE 'other' END AS state,
       coalesce(NULL, l_returnflag) AS flag, l_tax IS NULL AS no_tax, l_tax IS NOT NULL AS has_tax,
       l_orderkey + l_linenumber AS total_key,
       format('{:,}', l_orderkey * 1000 + l_linenumber) AS commas, hex(l_orderkey) AS hx,
       CASE WHEN (l_orderkey * 37) >= 86400 THEN CAST((l_orderkey * 37) // 86400 AS VARCHAR) || '+' ELSE '' END
         || lpad(CAST(((l_orderkey * 37) % 86400) // 3600 AS VARCHAR), 2, '0') || ':'
         || lpad(CAST(((l_orderkey * 37) % 3600) // 60 AS VARCHAR), 2, '0') || ':'
         || lpad(CAST((l_orderkey * 37) % 60 AS VARCHAR), 2, '0') AS dur
FROM lineitem
""")
def f_math(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    price7 = F.col("l_extendedprice") / 7
    out = li.select(
        "l_orderkey", "l_linenumber",
        ef.abs_(F.col("l_discount") - 0.05).alias("a"), ef.ceil(price7).alias("c"),
        ef.floor(price7).alias("f"), ef.round_(price7, 2).alias("r"), ef.sqrt("l_quantity").alias("sq"),
        ef.power("l_quantity", 2).alias("pw"), ef.max_("l_tax", "l_discount").alias("mx"),
        ef.min_("l_tax", "l_discount").alias("mn"),
        ef.if_(F.col("l_quantity") > 25, "big", "small").alias("size_class"),
        ef.case(F.col("l_returnflag") == "R", "returned", F.col("l_linestatus") == "O", "open", "other").alias("state"),
        ef.coalesce(F.lit(None).cast("string"), "l_returnflag").alias("flag"),
        ef.isnull("l_tax").alias("no_tax"), ef.isnotnull("l_tax").alias("has_tax"),
        ef.add("l_orderkey", "l_linenumber").alias("total_key"),
        ef.tostring(F.col("l_orderkey") * 1000 + F.col("l_linenumber"), "commas").alias("commas"),
        ef.tostring("l_orderkey", "hex").alias("hx"),
        ef.tostring(F.col("l_orderkey") * 37, "duration").alias("dur"))
    return rounded(out)


@register("f_dates", sql="""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(ts, '%a %d %b %y %I%p') AS human,
       strftime(ts, '%A, %B') AS names,
       CAST(floor(epoch(ts)) AS BIGINT) AS parsed
FROM events
""")
def f_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    epoch = ef.epoch("ts")
    text = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    return e.select(
        "event_id", epoch.alias("epoch"), ef.strftime(epoch, "%Y-%m-%d %H:%M:%S").alias("iso"),
        ef.strftime(epoch, "%a %d %b %y %I%p").alias("human"), ef.strftime(epoch, "%A, %B").alias("names"),
        ef.strptime(text, "%Y/%m/%d %H:%M:%S").alias("parsed"))


@register("f_url_hash", sql="""
SELECT page_id,
       replace(replace(replace(url_encode(url), '%20', '+'), '~', '%7E'), '%2A', '*') AS enc,
       url AS dec, md5(url) AS h_md5, sha1(url) AS h_sha1, sha256(url) AS h_sha256
FROM pages
""")
def f_url_hash(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    enc = ef.urlencode("url")
    return p.select("page_id", enc.alias("enc"), ef.urldecode(enc).alias("dec"), ef.md5("url").alias("h_md5"),
                    ef.sha("url", 1).alias("h_sha1"), ef.sha("url", 256).alias("h_sha256"))


@register("f_json", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k, json_valid(props) AS valid_props,
       json_valid(event_type) AS valid_type
FROM events
""")
def f_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", ef.json_extract("props", "$.k").alias("k"),
                    ef.json_valid("props").alias("valid_props"), ef.json_valid("event_type").alias("valid_type"))


TERM_RE_SQL = r"[\p{L}\p{N}_]+(?:''[\p{L}\p{N}_]+)*"   # quote doubled for SQL


@register("f_searchmatch", sql=f"""
SELECT doc_id, list_has_all(regexp_extract_all(lower(text), '{TERM_RE_SQL}'), ['the', 'and']) AS matched
FROM documents
""")
def f_searchmatch(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", ef.searchmatch("text", "The AND").alias("matched"))


# ------------------------------------------------------------------ E
URL_RE_SQL = r"^(https?)://([^/:]+)(?::(\d+))?(/[^?]*)?"


@register("e1_regex", sql=f"""
SELECT page_id,
       CASE WHEN regexp_matches(url, '{URL_RE_SQL}') THEN regexp_extract(url, '{URL_RE_SQL}', 1) END AS scheme,
       CASE WHEN regexp_matches(url, '{URL_RE_SQL}') THEN regexp_extract(url, '{URL_RE_SQL}', 2) END AS host_name,
       CASE WHEN regexp_matches(url, '{URL_RE_SQL}') THEN regexp_extract(url, '{URL_RE_SQL}', 3) END AS port,
       CASE WHEN regexp_matches(url, '{URL_RE_SQL}') THEN regexp_extract(url, '{URL_RE_SQL}', 4) END AS url_path
FROM pages
""")
def e1_regex(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    out = ex.extract_regex(p, "url", r"^(?<scheme>https?)://(?<host_name>[^/:]+)(?::(?<port>\d+))?(?<url_path>/[^?]*)?")
    return out.drop("url")


@register("e2_transforms", sql="""
SELECT page_id,
       CASE WHEN regexp_matches(url, 'page=(\\d+)') THEN regexp_extract(url, 'page=(\\d+)', 1) END AS page,
       CASE WHEN regexp_matches(url, 'ref=(\\w+)') THEN regexp_extract(url, 'ref=(\\w+)', 1) END AS ref,
       coalesce(CASE WHEN regexp_matches(url, '/([a-z]{2})/') THEN regexp_extract(url, '/([a-z]{2})/', 1) END,
                CASE WHEN regexp_matches(html, 'lang="([a-z]{2})"') THEN regexp_extract(html, 'lang="([a-z]{2})"', 1) END) AS lang
FROM pages
""")
def e2_transforms(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = ex.apply_transforms(p, "url", [r"page=(?<page>\d+)", r"ref=(?<ref>\w+)", r"/(?<lang>[a-z]{2})/"])
    out = out.withColumnRenamed("lang", "lang_url")
    out = ex.apply_transforms(out, "html", [r'lang="(?<lang>[a-z]{2})"'])
    return out.select("page_id", "page", "ref", F.coalesce("lang_url", "lang").alias("lang"))


@register("e3_delims", sql="""
SELECT c_custkey, split_part(c_name, '#', 1) AS prefix, split_part(c_name, '#', 2) AS number
FROM customer
""")
def e3_delims(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return ex.extract_delimited(c, "c_name", "#", ["prefix", "number"]).drop("c_name")


KV_RE_SQL = r'([A-Za-z_][A-Za-z0-9_.\-]*)=("[^"]*"|[^\s,;&"]*)'


@register("e4_kv", sql=f"""
SELECT page_id,
       CAST(len(list_distinct(regexp_extract_all(url, '{KV_RE_SQL}', 1))) AS INTEGER) AS n_keys,
       regexp_extract_all(url, '{KV_RE_SQL}', 2)[list_position(regexp_extract_all(url, '{KV_RE_SQL}', 1), 'page')] AS page,
       regexp_extract_all(url, '{KV_RE_SQL}', 2)[list_position(regexp_extract_all(url, '{KV_RE_SQL}', 1), 'ref')] AS ref
FROM pages
""")
def e4_kv(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    out = ex.extract_kv(p, "url")
    return out.select("page_id", F.size("kv").alias("n_keys"), F.col("kv")["page"].alias("page"),
                      F.col("kv")["ref"].alias("ref"))


@register("e6_spath", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k,
       json_extract_string(json_object('type', event_type, 'inner', json_object('user', user_id, 'tags', json_array(event_type, 'x'))), '$.inner.user') AS inner_user,
       json_extract_string(json_object('type', event_type, 'inner', json_object('user', user_id, 'tags', json_array(event_type, 'x'))), '$.inner.tags[0]') AS first_tag
FROM events
""")
def e6_spath(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(F.col("event_type").alias("type"), F.struct(
        F.col("user_id").alias("user"), F.array("event_type", F.lit("x")).alias("tags")).alias("inner")))
    x = e.select("event_id", "props", doc.alias("doc"))
    x = ex.spath(x, "props", {"k": "k"})
    x = ex.spath(x, "doc", {"inner_user": "inner.user", "first_tag": "inner.tags{0}"})
    return x.select("event_id", "k", "inner_user", "first_tag")


@register("e7_xml", sql=r"""
SELECT page_id,
       NULLIF(trim(regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1)), '') AS title,
       NULLIF(trim(regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1)), '') AS h1
FROM pages
""")
def e7_xml(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    return ex.extract_xml(p, "html", {"title": "title", "h1": "h1"}).drop("html")


@register("e9_mvexpand", sql="""
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS p_name FROM part
""")
def e9_mvexpand(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return ex.mvexpand(p, "p_name", delim=" ")


@register("e14_normalize", sql="""
WITH n AS (
  SELECT e.event_id, event_type, event_type AS action, value, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k,
         CASE WHEN value >= 100 THEN 'high' ELSE 'low' END AS value_band, coalesce(c.c_mktsegment, 'NONE') AS segment
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id)
SELECT event_id, action, k, value_band, segment,
       array_to_string(list_filter([CASE WHEN event_type = 'error' THEN 'failure' END,
                                    CASE WHEN event_type = 'purchase' AND value > 50 THEN 'money' END], lambda x: x IS NOT NULL), ',') AS eventtype,
       array_to_string(list_sort(list_distinct(list_filter([
            CASE WHEN event_type = 'error' THEN 'alert' END,
            CASE WHEN event_type = 'purchase' THEN 'commerce' END,
            CASE WHEN segment = 'MACHINERY' THEN 'heavy' END,
            CASE WHEN value_band = 'high' THEN 'notable' END], lambda x: x IS NOT NULL))), ',') AS tag
FROM n
""")
def e14_normalize(spark, sf_dir):
    """All six steps: a value pulled out of the payload, an alias, a
    calculated band, the user's segment looked up, event types and tags."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    spec = ex.NormalizeSpec(
        extractions=[("props", r'"k":\s*"?(?<k>[^",}]+)')],
        aliases={"event_type": "action"},
        calculated={"value_band": "CASE WHEN value >= 100 THEN 'high' ELSE 'low' END"},
        lookups=[(segments, "user_id", ["segment"], "NONE")],
        eventtypes={"failure": "event_type = 'error'", "money": "event_type = 'purchase' AND value > 50"},
        tags=[("event_type", "error", "alert"), ("event_type", "purchase", "commerce"),
              ("segment", "MACHINERY", "heavy"), ("value_band", "high", "notable")])
    out = ex.normalize(e, spec)
    return out.select("event_id", "action", "k", "value_band", "segment", F.array_join("eventtype", ",").alias("eventtype"),
                      F.array_join("tag", ",").alias("tag"))


@register("e13_tags_table", sql="""
WITH rules AS (
  SELECT 'c_mktsegment' AS field, c_mktsegment AS value, 'seg_' || lower(c_mktsegment) AS tag
  FROM (SELECT DISTINCT c_mktsegment FROM customer)
  UNION ALL
  SELECT 'c_nationkey', CAST(n_nationkey AS VARCHAR), 'region_' || CAST(n_regionkey AS VARCHAR) FROM nation)
SELECT c.c_custkey, array_to_string(list_sort(list_distinct(list(r.tag))), ',') AS tag
FROM customer c JOIN rules r
  ON (r.field = 'c_mktsegment' AND r.value = c.c_mktsegment) OR (r.field = 'c_nationkey' AND r.value = CAST(c.c_nationkey AS VARCHAR))
GROUP BY c.c_custkey
""")
def e13_tags_table(spark, sf_dir):
    """Tag rules derived from the data (segment and region tags)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    seg = c.select("c_mktsegment").distinct().select(
        F.lit("c_mktsegment").alias("field"), F.col("c_mktsegment").alias("value"),
        F.concat(F.lit("seg_"), F.lower("c_mktsegment")).alias("tag"))
    reg = n.select(F.lit("c_nationkey").alias("field"), F.col("n_nationkey").cast("string").alias("value"),
                   F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")).alias("tag"))
    out = ex.add_tags(c, seg.unionByName(reg))
    return out.select("c_custkey", F.array_join("tag", ",").alias("tag"))


@register("e15_url", sql=r"""
WITH u AS (
  SELECT page_id, trim(url) AS raw FROM pages),
v AS (
  SELECT page_id, CASE WHEN contains(raw, '://') THEN raw ELSE 'https://' || raw END AS value FROM u),
p AS (
  SELECT page_id, lower(regexp_extract(value, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) AS scheme,
         lower(regexp_replace(regexp_extract(value, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', '')) AS hostport
  FROM v),
h AS (
  SELECT page_id, scheme, hostport, regexp_extract(hostport, '^(\[[^\]]*\]|[^:]*)', 1) AS host,
         regexp_extract(hostport, '^(?:\[[^\]]*\]|[^:]*):(\d*)$', 1) AS port FROM p),
b AS (
  SELECT page_id, scheme, hostport, scheme || '://' || hostport AS key,
         CASE WHEN port = '8089' THEN scheme || '://' || host || ':8000' ELSE scheme || '://' || hostport END AS web,
         CASE WHEN port = '' OR port = '8000' THEN scheme || '://' || host || ':8089' ELSE scheme || '://' || hostport END AS api,
         scheme IN ('http', 'https') AND host <> '' AS ok
  FROM h)
SELECT page_id, CASE WHEN ok THEN key END AS key, CASE WHEN ok THEN web END AS web, CASE WHEN ok THEN api END AS api,
       CASE WHEN ok THEN array_to_string(list_sort(list_distinct([key, web, api])), ' ') END AS bases,
       CASE WHEN ok THEN hostport END AS host
FROM b
""")
def e15_url(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    n = ex.normalize_url("url")
    return p.select("page_id", n["key"].alias("key"), n["web"].alias("web"), n["api"].alias("api"),
                    F.array_join(n["bases"], " ").alias("bases"), n["host"].alias("host"))


_TARGETS = """CASE c_custkey % 7 WHEN 0 THEN 'H' || c_nationkey || '.example' WHEN 1 THEN 'http://h' || c_nationkey || ':8089/x'
  WHEN 2 THEN 'https://user@h:8000?q=1' WHEN 3 THEN 'https://h:abc' WHEN 4 THEN 'ftp://h' WHEN 5 THEN ' https://[::1]:9000/ ' ELSE '' END"""


@register("e15_url_ports", sql="""
WITH k AS (SELECT c_custkey, c_custkey % 7 AS k, CAST(c_nationkey AS VARCHAR) AS n FROM customer)
SELECT c_custkey,
  CASE k WHEN 0 THEN 'https://h' || n || '.example' WHEN 1 THEN 'http://h' || n || ':8089' WHEN 2 THEN 'https://h:8000'
    WHEN 5 THEN 'https://[::1]:9000' END AS key,
  CASE k WHEN 0 THEN 'https://h' || n || '.example' WHEN 1 THEN 'http://h' || n || ':8000' WHEN 2 THEN 'https://h:8000'
    WHEN 5 THEN 'https://[::1]:9000' END AS web,
  CASE k WHEN 0 THEN 'https://h' || n || '.example:8089' WHEN 1 THEN 'http://h' || n || ':8089' WHEN 2 THEN 'https://h:8089'
    WHEN 5 THEN 'https://[::1]:9000' END AS api
FROM k
""")
def e15_url_ports(spark, sf_dir):
    """Targets without scheme, with ports, users, brackets, and malformed ones."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_TARGETS).alias("url"))
    n = ex.normalize_url("url")
    return c.select("c_custkey", n["key"].alias("key"), n["web"].alias("web"), n["api"].alias("api"))


@register("e16_conformance", sql="""
SELECT event_id,
       CASE WHEN event_type = 'view' THEN 'dest' ELSE '' END AS missing_fields,
       CASE WHEN event_type = 'error' OR value > 100 THEN '' ELSE 'alert' END AS missing_tags,
       event_type <> 'view' AND (event_type = 'error' OR value > 100) AS conforms
FROM events WHERE value > 20
""")
def e16_conformance(spark, sf_dir):
    """Views have no destination; errors and high values are alerts."""
    e = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", "props", F.when(F.col("event_type") != "view", F.lit("web")).alias("dest"),
        F.when(F.col("value") > 100, "high").otherwise("low").alias("band"))
    tagged = ex.add_tags(e, [("event_type", "error", "alert"), ("band", "high", "alert")])
    out = ex.conformance(tagged, ["props", "dest"], ["alert"], constraint="value > 20")
    return out.select("event_id", F.array_join("missing_fields", ",").alias("missing_fields"),
                      F.array_join("missing_tags", ",").alias("missing_tags"), "conforms")


@register("a15_field_coverage", sql="""
SELECT 'c_name' AS field, avg(CASE WHEN c_name IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS coverage FROM customer
UNION ALL SELECT 'c_acctbal', avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE FROM customer
UNION ALL SELECT 'c_mktsegment', avg(CASE WHEN c_mktsegment IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE FROM customer
""")
def a15_field_coverage(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    c = c.withColumn("c_acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    return rounded(ex.field_coverage(c, ["c_name", "c_acctbal", "c_mktsegment"]))


@register("e18_compact_text", sql=r"""
SELECT doc_id, CAST(length(trim(regexp_replace(text, '[ \t\n\f\r\x0B]+', ' ', 'g'))) AS INTEGER) AS n_chars_compact,
       md5(trim(regexp_replace(text, '[ \t\n\f\r\x0B]+', ' ', 'g'))) AS digest
FROM documents
""")
def e18_compact_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    c = ex.compact_text("text")
    return d.select("doc_id", F.length(c).alias("n_chars_compact"), F.md5(c.cast("binary")).alias("digest"))


@register("e5_multikv", sql=r"""
SELECT conv_id, CAST(turn + 2 AS INTEGER) AS line, CAST(turn AS VARCHAR) AS turn, role,
       CAST(len(regexp_split_to_array(trim(text), '\s+')) AS VARCHAR) AS words
FROM conversations
""")
def e5_multikv(spark, sf_dir):
    """Every conversation rendered as a small table (header ``turn role
    words``, one line per turn in turn order; the collected list per
    conversation is bounded by its turns) and read back with the tabular
    extractor."""
    c = table(spark, sf_dir, "conversations")
    line = F.concat_ws(" ", F.col("turn").cast("string"), F.col("role"),
                       F.size(F.split(F.trim(F.col("text")), r"\s+")).cast("string"))
    tables = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("rows"))
    text = F.concat(F.lit("turn role words\n"), F.array_join(F.transform("rows", lambda r: r["l"]), "\n"))
    out = ex.extract_table(tables.select("conv_id", text.alias("raw")), "raw")
    return out.select("conv_id", F.col("line").cast("int").alias("line"), F.col("fields")["turn"].alias("turn"),
                      F.col("fields")["role"].alias("role"), F.col("fields")["words"].alias("words"))


@register("e8_template", sql="""
SELECT event_id, CAST(user_id AS VARCHAR) AS user_name, event_type AS kind
FROM events
""")
def e8_template(spark, sf_dir):
    """Every event written as ``user=<id> type=<event type>`` and read back
    with a key/value template."""
    e = table(spark, sf_dir, "events")
    raw = F.concat(F.lit("user="), F.col("user_id").cast("string"), F.lit(" type="), F.col("event_type"))
    out = ex.extract_template(e.select("event_id", raw.alias("raw")), "raw", "user={user_name} type={kind}")
    return out.select("event_id", "user_name", "kind")


@register("e17_failure_taxonomy", sql="""
WITH f AS (
  SELECT event_id,
         CASE event_type WHEN 'error' THEN 'http' WHEN 'click' THEN 'DNS ' WHEN 'view' THEN 'net_timeout'
                         WHEN 'signup' THEN 'unexpected' ELSE 'canceled' END AS kind,
         400 + (user_id % 3) * 100 AS status_code, value > 50 AS dns_temporary, value > 400 AS dns_not_found,
         CASE WHEN value > 100 THEN 'fetch' END AS operation
  FROM events)
SELECT event_id,
  CASE lower(trim(kind)) WHEN 'http' THEN 'remote_http_error' WHEN 'dns' THEN 'dns_lookup_failed'
       WHEN 'net_timeout' THEN 'network_timeout' WHEN 'canceled' THEN 'operation_canceled'
       ELSE CASE WHEN coalesce(trim(operation), '') <> '' THEN 'remote_operation_failed' END END AS error_code,
  CASE lower(trim(kind)) WHEN 'http' THEN status_code >= 500 AND status_code < 600
       WHEN 'dns' THEN dns_temporary AND NOT dns_not_found
       WHEN 'net_timeout' THEN true WHEN 'canceled' THEN false ELSE false END AS retryable
FROM f
""")
def e17_failure_taxonomy(spark, sf_dir):
    """Events read as failure log rows (event type -> failure kind, user ->
    HTTP status 400/500/600, value -> DNS flags and whether an operation is
    named), classified into code and retryable."""
    e = table(spark, sf_dir, "events")
    kind = (F.when(F.col("event_type") == "error", "http").when(F.col("event_type") == "click", "DNS ")
            .when(F.col("event_type") == "view", "net_timeout").when(F.col("event_type") == "signup", "unexpected")
            .otherwise("canceled"))
    logs = e.select("event_id", kind.alias("kind"),
                    (F.lit(400) + F.pmod(F.col("user_id"), F.lit(3)) * 100).alias("status_code"),
                    (F.col("value") > 50).alias("dns_temporary"), (F.col("value") > 400).alias("dns_not_found"),
                    F.when(F.col("value") > 100, F.lit("fetch")).alias("operation"))
    return ex.classify_failures(logs).select("event_id", "error_code", "retryable")
