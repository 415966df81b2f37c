"""Host-level quality rules, in DataFrame functions only.

Every document gets its own counts and one hard rule set (``base_failed``).
Rule failures are then added up per host (the ``source`` column), the host's
failure rate is shrunk towards the corpus by a beta prior whose two
parameters come from the hosts themselves (method of moments), and the
verdict on the host is joined back: documents of a host whose shrunk rate
exceeds ``max_host_rate`` must also meet the soft rules (few symbols, few
repeated lines, a plausible mean word length); on other hosts the hard rules
alone decide.  A clean document therefore survives on any host.

Per-document work stays inside the row: words, windows and lines are arrays,
repeats are found by sorting (hash, position) pairs, so nothing of a document
is shuffled.  Only one row of sums per host and task is.

Defined cases: null text has no words and fails the hard rules; a null host
is a host of its own; repeated rows get equal verdicts; an empty table gives
no rows; further columns are ignored by ``assess`` and returned unchanged by
``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

SPACES = r" \t\n\u000B\u000C\r"
# Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50              # hard rule
MAX_REPEAT_PCT = 50         # hard rule, percent of words in repeated windows
MAX_SYMBOLS_PER_100_WORDS = 10      # soft rules
MAX_DUP_LINES = 3
MEAN_WORD_CHARS = (2, 15)
MAX_HOST_RATE = 0.5         # hosts whose shrunk failure rate is higher are strict


def _let(value: str, name: str, body: str) -> str:
    """Bind ``value`` to ``name`` inside ``body``: evaluated once per row,
    also where the optimizer merges projections."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _words(text: str) -> str:
    return f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"


def _repeat_words(words: str) -> str:
    """Words inside 3-word windows that occur twice or more.

    Windows are (hash, position) pairs; sorted, equal hashes stand together.
    Covered words are summed over the sorted repeated positions: each adds
    the distance to the next one, 3 at most.
    """
    # two independent 64-bit hashes per window
    windows = (f"zip_with(zip_with({words}, slice({words}, 2, size({words})), (a, b) -> struct(a, b)), "
               f"slice({words}, 3, size({words})), (p, c) -> "
               "struct(xxhash64(p.a, p.b, c) AS h, hash(p.a, p.b, c) AS g))")
    pairs = (f"transform(slice({windows}, 1, size({words}) - 2), "
             "(x, i) -> struct(x.h AS h, x.g AS g, i AS i))")
    same = "(a, b) -> a.h = b.h AND a.g = b.g"
    flags = f"zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s)), {same})"      # k equals k + 1
    marked = _let(flags, "e", "filter(transform(s, (x, k) -> if((k > 0 AND e[k - 1]) OR "
                              "(k < size(e) AND e[k]), x.i, NULL)), v -> v IS NOT NULL)")
    covered = ("aggregate(sort_array({m}), struct(0L AS n, -3 AS last), "
               "(acc, p) -> struct(acc.n + least(3, p - acc.last) AS n, p AS last), acc -> acc.n)")
    body = _let(f"array_sort({pairs})", "s", _let(marked, "m", covered.format(m="m")))
    return f"CASE WHEN size({words}) < 4 THEN 0L ELSE {body} END"


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct column ``__q`` with the counts of each document."""
    t = "t"
    lines = (f"filter(split({t}, '\\n', -1), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')")
    stats = ("named_struct("
             "'n_words', CAST(size(ws) AS BIGINT), "
             f"'word_chars', CAST(length(translate({t}, '{SPACES}', '')) AS BIGINT), "
             f"'n_symbols', CAST(length({t}) - length(translate({t}, '{SYMBOLS}', '')) AS BIGINT), "
             "'n_dup_lines', " + _let(lines, "ls", "CAST(size(ls) - size(array_distinct(ls)) AS BIGINT)") + ", "
             "'n_repeat_words', " + _repeat_words("ws") + ")")
    text = f"coalesce(CAST(`{text_col}` AS STRING), '')"
    return docs.withColumn("__q", F.expr(_let(text, "t", _let(_words("t"), "ws", stats))))


def host_verdicts(measured: DataFrame, host_col: str = "source",
                  max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: failures, shrunk rate and whether it is strict.

    Beta prior by moments over the hosts' raw rates, each host weighing the
    same: mean m and variance v give a + b = m(1 - m)/v - 1, kept within
    [1, 1000] (no spread, or a single host: 1000, the corpus rate).
    """
    per_host = measured.groupBy(F.col(host_col).alias("__host")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("__failed").cast("long")).alias("failed"))
    moments = per_host.agg(F.avg(F.col("failed") / F.col("docs")).alias("m"),
                           F.var_pop(F.col("failed") / F.col("docs")).alias("v"))
    weight = F.when(F.col("v") > 0, F.least(F.lit(1000.0), F.greatest(
        F.lit(1.0), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))).otherwise(F.lit(1000.0))
    rate = (F.col("failed") + F.col("m") * F.col("k")) / (F.col("docs") + F.col("k"))
    return (per_host.crossJoin(F.broadcast(moments.select("m", weight.alias("k"))))   # one row of moments
            .select("__host", "docs", "failed", rate.alias("host_rate"))
            .withColumn("strict", F.col("host_rate") > max_host_rate))


def assess(measured: DataFrame, host_col: str = "source",
           max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``measured`` (with ``__q``) plus ``__failed``, ``__host_rate`` and ``__kept``."""
    q = F.col("__q")
    measured = measured.withColumn(
        "__failed", (q.n_words < MIN_WORDS) | (100 * q.n_repeat_words > MAX_REPEAT_PCT * q.n_words))
    # written: its measured size lets Spark send the few rows to the documents
    hosts = stash(host_verdicts(measured, host_col, max_host_rate), "quality-hosts")
    soft = ((100 * q.n_symbols <= MAX_SYMBOLS_PER_100_WORDS * q.n_words)
            & (q.n_dup_lines <= MAX_DUP_LINES)
            & (q.word_chars >= MEAN_WORD_CHARS[0] * q.n_words)
            & (q.word_chars <= MEAN_WORD_CHARS[1] * q.n_words))
    # every helper column is prefixed: the documents' own may have any name
    own = hosts.select("__host", F.col("host_rate").alias("__host_rate"), F.col("strict").alias("__strict"))
    joined = measured.join(own, F.col(f"`{host_col}`").eqNullSafe(F.col("__host")), "left").drop("__host")
    return (joined.withColumn("__kept", ~F.col("__failed") & (~F.col("__strict") | soft)).drop("__strict"))


def quality_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts and verdict per document."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(host_col).alias("source"))
    # the counts feed the host sums and the result: written once, without the text
    a = assess(stash(measure(slim).drop("text"), "quality-counts"), "source", max_host_rate)
    q = F.col("__q")
    return a.select("doc_id", q.n_words.alias("n_words"), q.word_chars.alias("word_chars"),
                    q.n_symbols.alias("n_symbols"), q.n_dup_lines.alias("n_dup_lines"),
                    q.n_repeat_words.alias("n_repeat_words"), F.col("__failed").alias("base_failed"),
                    F.col("__kept").alias("kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                     max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that pass, with their own columns."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return assess(stash(measure(docs, text_col), "quality-docs"), host_col, max_host_rate) \
        .where("__kept").select(*cols)


def oracle_sql(docs: str = "documents", max_host_rate: float = MAX_HOST_RATE) -> str:
    """DuckDB SQL for ``quality_rows`` over the table ``docs``."""
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM {docs}),
tok AS (
  SELECT rid, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM base),
win AS (
  SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM tok)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n >= 2),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
lin AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM base)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
m AS (
  SELECT b.doc_id, b.source, CAST(len(k.ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(b.t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(b.t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM base b JOIN tok k USING (rid) LEFT JOIN lin l USING (rid) LEFT JOIN cov c USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS docs, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS failed FROM f GROUP BY source),
p AS (SELECT avg(failed / docs) AS m, var_pop(failed / docs) AS v FROM h),
w AS (SELECT m, CASE WHEN v > 0 THEN least(1000.0, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1000.0 END AS k FROM p),
s AS (SELECT source, (failed + m * k) / (docs + k) > {max_host_rate} AS strict FROM h, w)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (NOT strict OR (100 * n_symbols <= {MAX_SYMBOLS_PER_100_WORDS} * n_words
    AND n_dup_lines <= {MAX_DUP_LINES} AND word_chars >= {MEAN_WORD_CHARS[0]} * n_words
    AND word_chars <= {MEAN_WORD_CHARS[1]} * n_words)) AS kept
FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source"""
