"""Full-text recall over result rows with BM25 ranking and hit explanations
(T1-T13, A17 inputs).

Shape of the plan (for a *batch* of queries; one query is a one-row table):

1. query terms (T1-T3) become a small table of phrases, one row per
   (query, term, alternative, part, offset, token);
2. documents (T4, T5) are tokenised per field and exploded with positions,
   then filtered to the tokens any query needs (broadcast semi-join of a
   size-checked token list) - the only full pass over the text;
3. phrases of several words are equal to runs of as many words of a field,
   found by an equi-join (the phrase side is broadcast, so a very common token
   is never a hot shuffle key) and a group-by on (phrase, doc);
4. BM25 per (query, doc) uses the field weights, the row length in tokens
   over all fields and the phrase document frequency (T8);
5. the AND rule keeps documents that satisfy every term; the top k + 1 per
   query are kept with ``row_number() <= k + 1`` (Spark limits each group
   map-side before the shuffle) (T9, W9);
6. explanations (coverage, scope, row-specific query, snippet; T10-T13) are
   computed only for the surviving hits, with array functions.

No documents x queries product is ever formed.
"""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import matching as mt
from .extract import compact_text

# Token patterns, ticket-id prefixes, field weights and caps.
QUERY_TOKEN_RE = r"[\p{L}\p{N}_]+(?:'[\p{L}\p{N}_]+)*"
INDEX_TOKEN_RE = r"[\p{L}\p{N}]+"
TICKET_RE = r"^([A-Za-z]{2,8})([0-9]{3,})$"
TICKET_PREFIXES = ("cinc", "config", "inc", "msb", "piinc", "rm", "scp", "spl", "to", "vuln")
FIELDS = ("title", "body", "metadata", "context")
FIELD_WEIGHTS = {"title": 4.0, "body": 2.0, "metadata": 1.0, "context": 0.25}
TITLE_FIELDS = ("_time", "host", "source", "sourcetype", "component", "service", "operation", "severity", "level")
BODY_FIELDS = ("_raw", "message", "error", "exception", "request_id", "requestId", "trace_id", "traceId")
FALLBACK_TITLE_FIELDS = (
    "title", "name", "id", "operationId", "operation_id", "operation",
    "request_id", "requestId", "trace_id", "traceId",
    "pod_name", "k8s_pod_name", "pod", "k8s_namespace", "namespace",
    "path", "method", "message", "error", "exception", "url", "query", "text", "_raw",
)
FALLBACK_TITLE = "saved search row"
DEFAULT_K = 20
BM25_K1 = 1.2
BM25_B = 0.75


# ------------------------------------------------------------ tokens
def index_tokens(text: Column) -> Column:
    """Lower-cased index tokens (letters and digits) of a text, in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(INDEX_TOKEN_RE), 0)


def _accent_rule() -> tuple[str, str]:
    """Letters with diacritics (Latin, Greek, Cyrillic) and their base
    letters, from their canonical decomposition; combining marks come last
    and have no counterpart, so ``translate`` deletes them."""
    import unicodedata
    pairs = []
    for code in [*range(0xC0, 0x530), *range(0x1E00, 0x2000)]:
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isalpha() and all(unicodedata.combining(c) for c in parts[1:]):
            pairs.append((chr(code), parts[0]))
    marks = "".join(chr(c) for c in range(0x300, 0x370))
    return "".join(a for a, _ in pairs) + marks, "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _accent_rule()


def fold(text: Column) -> Column:
    """Lower case without diacritics (``Café`` -> ``cafe``).  A text of
    ASCII only has none and is not searched for them."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.octet_length(low) == F.length(low), low).otherwise(F.translate(low, _ACCENTED, _PLAIN))


def match_tokens(text: Column) -> Column:
    """The tokens that the index and queries are matched by: index tokens
    without diacritics.  Coverage and explanations compare words as written."""
    return F.regexp_extract_all(fold(text), F.lit(INDEX_TOKEN_RE), 0)


def query_tokens(text: Column) -> Column:
    """Query terms (letters, digits, ``_``, inner apostrophes), as typed."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(QUERY_TOKEN_RE), 0)


def ticket_parts(token: Column) -> tuple[Column, Column, Column]:
    """(is_ticket, lower prefix, number) of a compact ticket id."""
    prefix = F.regexp_extract(token, TICKET_RE, 1)
    number = F.regexp_extract(token, TICKET_RE, 2)
    ok = token.rlike(TICKET_RE) & F.lower(prefix).isin(*TICKET_PREFIXES)
    return ok, F.lower(prefix), number


def _covered(token: Column, token_set: Column) -> Column:
    """A (lower-case) token counts as present in a token array when it is
    there, or when it is a ticket id whose prefix and number both are."""
    ok, prefix, number = ticket_parts(token)
    return F.array_contains(token_set, token) | (
        ok & F.array_contains(token_set, prefix) & F.array_contains(token_set, number))


# ------------------------------------------------------- T4, T5 documents
def _scalar_text(df: DataFrame, name: str) -> Column:
    from .extract import scalar_text
    return scalar_text(df, name)


def table_context(table_name: str) -> str:
    """T4 context: ``table <name>`` plus the name with separators as spaces
    and with letter/digit runs split (each only when it differs)."""
    name = (table_name or "").strip()
    if not name:
        return ""
    spaced = re.sub(r"[_\-.]", " ", name)
    split = " ".join(re.findall(r"[A-Za-z]+|[0-9]+", name))
    parts = ["table", name]
    if spaced != name:
        parts.append(spaced)
    if split and split != spaced:
        parts.append(split)
    return " ".join(parts)


def build_documents(df: DataFrame, table_name: str, row_col: str = "_row",
                    metadata: Mapping[str, object] | None = None,
                    caps: Mapping[str, int] | None = None) -> DataFrame:
    """T4/T5: one search document per row: ``doc_id, title, body, metadata,
    context``.

    title = the non-empty title fields in order (else the first non-empty
    fallback field, else a constant); body = the body fields in order, then
    every remaining field as ``key value`` in key order; metadata is empty;
    context = the table-name forms plus the search metadata as ``key value``.
    Whitespace is collapsed.  Texts are indexed whole unless ``caps`` names a
    most number of characters per field.
    """
    caps = dict(caps or {})
    cols = [c for c in df.columns if c not in (row_col, "_json") and c]
    present = set(cols)
    texts = {c: _scalar_text(df, c) for c in cols}
    used = set()
    title_parts = []
    for f in TITLE_FIELDS:
        if f in present:
            title_parts.append(texts[f])
            used.add(f)
    body_parts = []
    for f in BODY_FIELDS:
        if f in present:
            body_parts.append(texts[f])
            used.add(f)
    for f in sorted(c for c in cols if c not in used):
        body_parts.append(F.when(texts[f].isNotNull(), F.concat(F.lit(f + " "), texts[f])))
    title = F.concat_ws(" ", *title_parts) if title_parts else F.lit("")
    fallback = F.coalesce(*[texts[f] for f in FALLBACK_TITLE_FIELDS if f in present], F.lit(FALLBACK_TITLE)) \
        if any(f in present for f in FALLBACK_TITLE_FIELDS) else F.lit(FALLBACK_TITLE)
    title = F.when(title == "", fallback).otherwise(title)
    body = F.concat_ws(" ", *body_parts) if body_parts else F.lit("")
    meta_parts = [f"{k} {v}" for k, v in sorted((metadata or {}).items()) if v is not None and str(v).strip() != ""]
    context = " ".join(p for p in [table_context(table_name), " ".join(meta_parts)] if p)
    return df.select(
        F.col(row_col).cast("long").alias("doc_id"),
        compact_text(title, caps.get("title")).alias("title"),
        compact_text(body, caps.get("body")).alias("body"),
        F.lit("").alias("metadata"),
        compact_text(F.lit(context), caps.get("context")).alias("context"))


# ----------------------------------------------------------- T1-T3 terms
def query_phrases(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """One row per (query, term, alternative, part, offset, token).

    Term ``t`` is the phrase of its index tokens (alternative 0); a ticket id
    also gets alternative 1 = prefix AND number (two one-token parts).  A
    query without any term has no row here; ``query_errors`` lists it.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.posexplode(query_tokens(F.col(text))).alias("term_idx", "term"))
    ok, prefix, number = ticket_parts(F.col("term"))
    alts = F.array(
        F.struct(F.lit(0).alias("alt"), F.array(match_tokens(F.col("term"))).alias("parts")),
        F.struct(F.lit(1).alias("alt"), F.when(ok, F.array(F.array(prefix), F.array(number)))
                 .otherwise(F.array().cast("array<array<string>>")).alias("parts")))
    x = q.select("query_id", "term_idx", "term", F.explode(alts).alias("a"))
    x = x.select("query_id", "term_idx", "term", F.col("a.alt").alias("alt"),
                 F.posexplode("a.parts").alias("part", "tokens"))
    x = x.filter(F.size("tokens") > 0)
    x = x.withColumn("n_tokens", F.size("tokens"))
    return x.select("query_id", "term_idx", "term", "alt", "part", "n_tokens",
                    F.posexplode("tokens").alias("offset", "token"))


NO_TERM = "the query needs at least one searchable word or number"


def query_errors(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """``(query_id, error)`` for every query that holds no word or number."""
    return queries.where(F.size(query_tokens(F.col(text))) == 0).select(
        F.col(query_id).alias("query_id"), F.lit(NO_TERM).alias("error"))


def query_term_counts(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    return queries.select(F.col(query_id).alias("query_id"), F.size(query_tokens(F.col(text))).alias("n_terms"))


# ------------------------------------------------------------ T7 postings
LEN_FIELD = "__len"


def grams(tokens: Column, n: int) -> Column:
    """The runs of ``n`` neighbouring tokens, each joined by spaces, in order."""
    if n == 1:
        return tokens
    firsts = F.slice(tokens, 1, F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
    return F.transform(firsts, lambda _, i: F.array_join(F.slice(tokens, i + 1, n), " "))


def doc_tokens(docs: DataFrame, length_row: bool = False, lengths: Sequence[int] = (1,)) -> DataFrame:
    """Per document, in one pass: ``__f`` = array of (field, tokens) and the
    row length in tokens over all fields (``doc_len``).  ``length_row`` adds
    an element with no tokens, which explodes to one marker row per document
    (field ``__len``, null token) carrying ``doc_len``.  ``lengths``: instead
    of the tokens, the runs of so many tokens."""
    items = [F.struct(F.lit(f).alias("field"), match_tokens(F.col(f)).alias("toks")) for f in FIELDS]
    x = docs.select("doc_id", F.array(*items).alias("__f"))
    x = x.withColumn("doc_len", F.aggregate("__f", F.lit(0).cast("long"),
                                            lambda acc, s: acc + F.size(s["toks"])))
    if tuple(lengths) != (1,):
        x = x.withColumn("__f", F.flatten(F.transform("__f", lambda s: F.array(
            *[F.struct(s["field"].alias("field"), grams(s["toks"], n).alias("toks")) for n in lengths]))))
    if length_row:
        marker = F.struct(F.lit(LEN_FIELD).alias("field"), F.array().cast("array<string>").alias("toks"))
        x = x.withColumn("__f", F.concat(F.col("__f"), F.array(marker)))
    return x


def _explode_postings(tok: DataFrame) -> DataFrame:
    # *_outer on purpose: a plain explode makes Spark infer a
    # ``size(array) > 0`` filter that re-evaluates the whole tokenising
    # expression (and is pushed below the exchange); empty arrays are
    # dropped by the explicit token filter instead.
    x = tok.select("doc_id", "doc_len", F.explode_outer("__f").alias("__x"))
    x = x.select("doc_id", "doc_len", F.col("__x.field").alias("field"),
                 F.posexplode_outer("__x.toks").alias("pos", "token"))
    return x.filter(F.col("token").isNotNull() | (F.col("field") == LEN_FIELD))


def build_postings(docs: DataFrame) -> DataFrame:
    """``(doc_id, doc_len, field, pos, token)`` for every token of every
    field, with a ``bucket`` (token hash mod 256) for partitioned storage."""
    return _explode_postings(doc_tokens(docs)).withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(256)))


def save_postings(postings: DataFrame, path: str) -> None:
    """Persist postings partitioned by token bucket: a query batch then reads
    only the buckets of its tokens (partition pruning on ``bucket``)."""
    postings.write.mode("overwrite").partitionBy("bucket").parquet(path)


def token_stats(docs: DataFrame) -> DataFrame:
    """T7 check: per token, documents containing it and total occurrences.
    A row with an id of its own counts once for each of its words, so only
    tokens are shuffled; rows that share an id are told apart by (token, id)."""
    count = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    again = count.select(F.col("doc_id").alias("__again"))
    same = F.col("doc_id").eqNullSafe(F.col("__again"))
    shared = again.limit(1).count() > 0
    alone = docs.join(again, same, "left_anti") if shared else docs
    toks = doc_tokens(alone).select(F.flatten(F.transform("__f", lambda s: s["toks"])).alias("t"))
    sets = F.array(F.struct(F.lit(1).alias("d"), F.lit(0).alias("o"), F.array_distinct("t").alias("t")),
                   F.struct(F.lit(0).alias("d"), F.lit(1).alias("o"), F.col("t").alias("t")))
    p = (toks.select(F.explode_outer(sets).alias("x")).select("x.d", "x.o", F.explode_outer("x.t").alias("token"))
         .filter(F.col("token").isNotNull()).groupBy("token").agg(F.sum("d").alias("docs"), F.sum("o").alias("occurrences")))
    if shared:
        rest = build_postings(docs.join(again, same, "left_semi"))
        p = (p.unionByName(rest.groupBy("token").agg(F.count_distinct("doc_id").alias("docs"), F.count(F.lit(1)).alias("occurrences")))
             .groupBy("token").agg(F.sum("docs").alias("docs"), F.sum("occurrences").alias("occurrences")))
    return p


FIELD_SPAN = 1 << 28        # a position is field number x FIELD_SPAN + place in the field


def place(field: Column, pos: Column) -> Column:
    """One integer per (field, position): neighbours in a field differ by one,
    and no two fields meet."""
    number = F.create_map(*[x for i, f in enumerate(FIELDS) for x in (F.lit(f), F.lit(i * FIELD_SPAN))])
    return number[field] + pos


def place_weight(places: Column, weights: Mapping[str, float]) -> Column:
    """Summed field weights of an array of places."""
    per_field = F.array(*[F.lit(float(weights[f])) for f in FIELDS])
    return F.aggregate(places, F.lit(0.0), lambda acc, p: acc + F.get(per_field, (p / FIELD_SPAN).cast("int")))


def phrase_places(lists: Column) -> Column:
    """Where a phrase starts, from ``array<struct<offset, places>>`` of its
    tokens in one document: the place lists, shifted by their offsets,
    intersected."""
    shifted = F.transform(lists, lambda x: F.transform(x["places"], lambda p: p - x["offset"]))
    return F.aggregate(F.slice(shifted, 2, F.greatest(F.size(shifted) - 1, F.lit(0))), F.get(shifted, 0), F.array_intersect)


def term_index(docs: DataFrame, tokens: DataFrame, weights: Mapping[str, float] | None = None,
               broadcast_tokens: bool = True, with_places: bool = False, lengths: Sequence[int] = (1,)) -> DataFrame:
    """``(doc_id, token, wtf, doc_len, n)`` for the given tokens (weighted
    term frequency over the fields), plus one row per document with a null
    token carrying its length and in ``n`` the number of rows with its id:
    everything BM25 needs from one pass over the text.  A token of several
    words joined by spaces is a phrase; ``lengths`` names the numbers of words
    that tokens have.  With ``with_places`` (lists cost a slower aggregate),
    ``places`` says where the tokens that ``tokens`` flags in ``in_phrase``
    stand.  The token list is broadcast when the caller has checked its size
    (it grows with the query batch, not the corpus)."""
    weights = dict(FIELD_WEIGHTS, **(weights or {}))
    wcol = F.create_map(*[x for f in FIELDS for x in (F.lit(f), F.lit(float(weights[f])))])
    post = _explode_postings(doc_tokens(docs, length_row=True, lengths=lengths))
    flag = F.col("in_phrase") if with_places else F.lit(False)
    need = tokens.groupBy(F.col("token").alias("__token")).agg(F.bool_or(flag).alias("in_phrase")).withColumn("__need", F.lit(True))
    # rows without a token are dealt by their document
    key = F.coalesce(F.col("token"), F.concat(F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    flagged = post.join(F.broadcast(need) if broadcast_tokens else need.hint("merge"), key == F.col("__token"), "left")
    kept = flagged.filter(F.col("__need") | (F.col("field") == LEN_FIELD))
    aggs = [F.sum(wcol[F.col("field")]).alias("wtf"), F.first("doc_len").alias("doc_len"), F.count(F.lit(1)).alias("n")]
    if with_places:
        aggs.append(F.collect_list(F.when(F.col("in_phrase"), place(F.col("field"), F.col("pos")))).alias("places"))
    return kept.groupBy("doc_id", "token").agg(*aggs)


def _placed_phrases(index: DataFrame, phrases: DataFrame, weights: Mapping[str, float], bc) -> DataFrame:
    """``(doc_id, token, wtf, doc_len)`` of the phrases (pkey, n_tokens,
    offset, token; several words), from place lists of their words."""
    pkey = ["query_id", "term_idx", "alt", "part"]
    parts = phrases.join(_named(phrases).withColumnRenamed("token", "phrase"), pkey) \
        .select("phrase", "n_tokens", "offset", "token").distinct()       # equal phrases of the batch are matched once
    return (index.join(bc(parts), "token").groupBy("phrase", "doc_id")
            .agg(F.collect_list(F.struct("offset", "places")).alias("lists"), F.first("n_tokens").alias("n_tokens"),
                 F.first("doc_len").alias("doc_len"))
            .filter(F.size("lists") == F.col("n_tokens"))
            .withColumn("starts", phrase_places(F.col("lists"))).filter(F.size("starts") > 0)
            .select("doc_id", F.col("phrase").alias("token"), place_weight(F.col("starts"), weights).alias("wtf"), "doc_len"))


def _named(phrases: DataFrame) -> DataFrame:
    """(pkey, token): the words of each phrase joined by spaces."""
    words = F.transform(F.array_sort(F.collect_set(F.struct("offset", "token"))), lambda x: x["token"])
    return phrases.groupBy("query_id", "term_idx", "alt", "part").agg(F.array_join(words, " ").alias("token"))


def corpus_stats(docs: DataFrame) -> tuple[int, float]:
    """Row count and average row length in tokens (two scalars)."""
    st = doc_tokens(docs).agg(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("avgdl")).first()
    return int(st["n"] or 0), float(st["avgdl"] or 0.0)


# ------------------------------------------------------------- T8, T9
def search_text(docs: DataFrame, queries: DataFrame, k: int | None = DEFAULT_K,
                query_id: str = "query_id", text: str = "text",
                weights: Mapping[str, float] | None = None, k1: float = BM25_K1, b: float = BM25_B,
                max_broadcast_tokens: int = 300_000, max_broadcast_pairs: int = 200_000, explain: bool = False,
                postings: DataFrame | None = None, stats: tuple[int, float] | None = None,
                table_name: str | None = None) -> DataFrame:
    """BM25 top-k per query, all terms ANDed.

    ``docs``: doc_id, title, body, metadata, context.  ``queries``: query_id,
    text.  Output: query_id, doc_id, score (higher is better), rank,
    truncated (more than k hits existed); with ``explain`` also the T10-T13
    columns.  Ties rank by doc_id.  A saved index (``postings`` read from
    ``save_postings`` plus its ``stats``) replaces the tokenising pass.

    Conjunctive evaluation, exact scores:

    * one pass over the text keeps the postings of the words the batch
      needs and folds them into ``(doc, token) -> weighted frequency``;
      each token's document frequency comes from that table, so IDF is exact;
    * per query the term with the fewest documents is the *driver*: only
      documents holding it can satisfy the AND rule, so only
      (candidate document x query term) pairs are scored - never the full
      posting list of a common word times every query using it; they are
      scored inside the tasks (``matching``), which let out the best k + 1
      hits of each query, so that the pairs are never shuffled or written;
    * multi-word terms (``a_b``, ``don't``) are looked up, like words, among
      the runs of as many words of each field, so no document meets a phrase
      that it does not hold.  Documents of several rows, and saved postings,
      intersect place lists instead.
    """
    weights = dict(FIELD_WEIGHTS, **(weights or {}))
    pkey = ["query_id", "term_idx", "alt", "part"]
    ph = query_phrases(queries, query_id, text).select(*pkey, "n_tokens", "offset", "token")
    shape = ph.agg(F.count(F.lit(1)).alias("n"), F.collect_set("n_tokens").alias("lengths"),
                   F.count_distinct("query_id").alias("queries")).first()
    n_ph, lengths = int(shape["n"]), sorted(shape["lengths"]) or [1]
    has_multi = lengths[-1] > 1
    # the phrase table grows with the query batch, not with the corpus; it is
    # broadcast while its checked size allows, else joined by shuffle
    bc = (lambda d: F.broadcast(d)) if n_ph <= max_broadcast_tokens else (lambda d: d)
    # units: a word, or the words of a phrase joined by spaces
    units, mph = ph.filter(F.col("n_tokens") == 1).select(*pkey, "token"), ph.filter(F.col("n_tokens") > 1)
    if has_multi:
        units = units.unionByName(_named(mph))
    in_phrase = ph.select("token", (F.col("n_tokens") > 1).alias("in_phrase"))
    wcol = F.create_map(*[x for f in FIELDS for x in (F.lit(f), F.lit(float(weights[f])))])
    spark = docs.sparkSession

    from ..session import scratch_path

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    if postings is None:
        # one pass over the text, written to the shared checkpoint folder:
        # (doc, unit) -> weighted term frequency for the needed units and
        # one length row per document.  Stats, IDF and scoring all read it.
        few = n_ph <= max_broadcast_tokens
        lies = None
        if few:
            # counted inside the rows, which are not dealt anew
            wanted = [r[0] for r in units.select("token").distinct().collect()]
            fields = docs.select("doc_id", F.array(*[match_tokens(F.col(f)) for f in FIELDS]).alias("f"))
            found = fields.mapInArrow(mt.unit_rows(wanted, [float(weights[f]) for f in FIELDS]),
                                      f"doc_id {dict(docs.dtypes)['doc_id']}, token string, wtf double, doc_len long, n long")
            idx, lies = keep(found, "text-index"), "__span"
            lens = idx.filter(F.col("token").isNull()).groupBy("doc_id").agg(F.first("doc_len").alias("doc_len"), F.sum("n").alias("n"))
        else:
            idx = keep(term_index(docs, units, weights, few, lengths=lengths), "text-index")
            lens = idx.filter(F.col("token").isNull())
        st = lens.agg(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("avgdl"), F.max("n").alias("most")).first()
        stats = stats or (int(st["n"] or 0), float(st["avgdl"] or 0.0))
        dt = idx.filter(F.col("token").isNotNull()).select("doc_id", "token", "wtf", "doc_len")
        if few:
            own = idx.withColumn("__span", F.xxhash64(F.input_file_name(), F.expr("input_file_block_start()"))) \
                .filter(F.col("token").isNotNull()).select("doc_id", "token", "wtf", "doc_len", "__span")
        if (has_multi or few) and (st["most"] or 0) > 1:
            # rows with one id are one document, whose words of one place are
            # alternatives: its phrases are found by place lists
            again = lens.filter(F.col("n") > 1).select(F.col("doc_id").alias("__again"))
            same = F.col("doc_id").eqNullSafe(F.col("__again"))
            several = F.col("token").contains(" ")
            merged = None
            if few:
                merged = (dt.filter(~several).join(again, same, "left_semi").groupBy("doc_id", "token")
                          .agg(F.sum("wtf").alias("wtf"), F.first("doc_len").alias("doc_len")))
                own = own.join(again, same, "left_anti")
                dt = dt.join(again, same, "left_anti").unionByName(merged)
            else:
                dt = dt.filter(~several).unionByName(dt.filter(several).join(again, same, "left_anti"))
            if has_multi:
                placed = term_index(docs.join(again, same, "left_semi"), in_phrase, weights, few, True)
                placed = keep(_placed_phrases(placed.filter(F.col("token").isNotNull()), mph, weights, bc), "text-placed")
                dt = dt.unionByName(placed)
                merged = merged.unionByName(placed) if merged is not None else None
        else:
            merged = None
    else:
        lies = None
        buckets = [r[0] for r in ph.select(F.pmod(F.xxhash64("token"), F.lit(256))).distinct().collect()]
        post = postings.filter(F.col("bucket").isin(buckets)).join(bc(in_phrase), "token", "left_semi")
        listed = [F.collect_list(place(F.col("field"), F.col("pos"))).alias("places")] if has_multi else []
        dt = post.groupBy("doc_id", "token").agg(
            F.sum(wcol[F.col("field")]).alias("wtf"), F.first("doc_len").alias("doc_len"), *listed)
        if has_multi:
            dt = dt.drop("places").unionByName(_placed_phrases(dt, mph, weights, bc))
    n_docs, avgdl = stats if stats is not None else corpus_stats(docs)
    if n_docs == 0:
        return _empty_hits(spark)
    tdf = dt.groupBy("token").agg(F.count(F.lit(1)).alias("n_hit"))
    phrase_df = units.join(bc(tdf), "token", "left").select(
        *pkey, "token", F.coalesce(F.col("n_hit"), F.lit(0)).alias("n_hit"))

    # driver term per query: smallest (documents with alternative 0) +
    # (documents with the rarer part of alternative 1, which needs both);
    # ties -> lowest term
    lead = phrase_df.groupBy("query_id", "term_idx", "alt").agg(
        F.min_by("token", F.struct("n_hit", "part")).alias("token"), F.min("n_hit").alias("n_hit"))
    size = lead.groupBy("query_id", "term_idx").agg(F.sum("n_hit").alias("size"))
    driver = size.groupBy("query_id").agg(
        F.min_by(F.col("term_idx"), F.struct(F.col("size"), F.col("term_idx"))).alias("term_idx"))
    drv = lead.join(bc(driver), ["query_id", "term_idx"]).select("query_id", "token")
    # postings of the driver terms: only their documents can be hits
    cands = keep(dt.join(bc(drv.select("token").distinct()), "token", "left_semi").select("doc_id", "token"), "text-candidates")
    near = F.broadcast(cands.select("doc_id").distinct()) if cands.count() <= max_broadcast_pairs else None
    only = lambda d: d.join(near, "doc_id", "left_semi") if near is not None else d

    # the documents of a task meet all queries there; only the best k + 1 of
    # each query leave it, so no (query, document) pairs are shuffled
    idf = F.log((F.lit(float(n_docs)) - F.col("n_hit") + 0.5) / (F.col("n_hit") + 0.5))
    idf_t = phrase_df.select(*pkey, F.when(idf <= 0, F.lit(1e-6)).otherwise(idf).alias("idf"))
    asked = units.join(bc(idf_t), pkey).withColumnRenamed("token", "unit")
    parts = mt.collect_queries(asked, drv.withColumnRenamed("token", "unit"), query_term_counts(queries, query_id, text))
    if not parts:
        hits = _empty_hits(spark).select("query_id", "doc_id", "score")
    elif lies is None:
        hits = mt.best_documents(only(dt), parts, k + 1 if k else None, avgdl, k1, b).select("query_id", "doc_id", "score")
    else:
        # documents at the ends of a read file's part may be cut: they are brought together
        best = keep(mt.best_documents(only(own), parts, k + 1 if k else None, avgdl, k1, b, span=lies), "text-best")
        cut = best.filter(F.col("query_id").isNull()).select("doc_id", "token", "wtf", "doc_len")
        cut = cut.unionByName(only(merged)) if merged is not None else cut
        hits = (best.filter(F.col("query_id").isNotNull()).select("query_id", "doc_id", "score")
                .unionByName(mt.best_documents(cut, parts, k + 1 if k else None, avgdl, k1, b).select("query_id", "doc_id", "score")))

    # top k + 1 per query (partial per-group limit before the shuffle)
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), F.col("doc_id").asc())
    ranked = hits.withColumn("rank", F.row_number().over(w))
    if k:
        ranked = ranked.filter(F.col("rank") <= k + 1)
        ranked = (ranked.withColumn("truncated", F.max("rank").over(Window.partitionBy("query_id")) > k)
                  .filter(F.col("rank") <= k))
    else:
        ranked = ranked.withColumn("truncated", F.lit(False))
    if not explain:
        return ranked
    qtext = queries.select(F.col(query_id).alias("query_id"), F.col(text).alias("query_text"))
    hits = ranked.join(qtext, "query_id")
    # at most k hits a query: broadcast when few, so that the texts stay where they are
    hits = F.broadcast(hits) if k and k * shape["queries"] <= max_broadcast_pairs else hits
    return explain_hits(hits.join(docs, "doc_id"), table_name=table_name)


def _empty_hits(spark) -> DataFrame:
    schema = "query_id long, doc_id long, score double, rank int, truncated boolean"
    return spark.createDataFrame([], schema)


# ------------------------------------------------------- T10-T13 explain
def strong_single_token(token: Column) -> Column:
    """A lone query word is specific enough when it has ``_``, ASCII
    letters and digits with length >= 4, an upper-case letter after a
    lower-case one, or at least 8 bytes."""
    return (token.contains("_") | (token.rlike("[A-Za-z]") & token.rlike("[0-9]") & (F.octet_length(token) >= 4))
            | token.rlike("[a-z].*[A-Z]") | (F.octet_length(token) >= 8))


def context_title(table_name: str, source: str = "", kind: str = "search") -> str:
    """Title of a hit that only the table's context brought: where the table
    came from, what it holds, its name."""
    return " ".join(x for x in ("table context", source, kind, table_name) if x)


def explain_hits(hits: DataFrame, query_text: str = "query_text", table_name: str | None = None) -> DataFrame:
    """T10-T13 for a (small) hit set carrying the query text and the
    document fields: per-field coverage, ``match_scope``,
    ``context_adds_terms``, ``row_text_query``, ``row_content_query`` and a
    ``snippet``.  With ``table_name``, a context-only hit gets
    ``context_title(table_name)`` as its title."""
    q = F.col(query_text)
    qtok = F.array_distinct(index_tokens(q))
    sets = {f: F.array_distinct(index_tokens(F.col(f))) for f in FIELDS}
    x = hits.withColumn("__q", qtok)
    for f in FIELDS:
        x = x.withColumn(f"__s_{f}", sets[f])

    def cov(f):
        return F.filter("__q", lambda t: _covered(t, F.col(f"__s_{f}")))
    for f in FIELDS:
        x = x.withColumn(f"__c_{f}", cov(f)).withColumn(f"coverage_{f}", F.size(f"__c_{f}"))

    # T12 scope: first covering field among body, title, row_metadata; the
    # other two only if they add terms; context appended only if it adds
    order = [("body", "body"), ("title", "title"), ("metadata", "row_metadata")]

    def scope_for(first: int):
        names, covered, adds_ctx = [F.lit(order[first][1])], F.col(f"__c_{order[first][0]}"), None
        parts = []
        for i, (f, label) in enumerate(order):
            if i == first:
                continue
            new = F.array_except(F.col(f"__c_{f}"), covered)
            parts.append(F.when(F.size(new) > 0, F.lit(label)))
            covered = F.array_union(covered, F.col(f"__c_{f}"))
        ctx_new = F.size(F.array_except(F.col("__c_context"), covered)) > 0
        names = names + parts + [F.when(ctx_new, F.lit("table_context"))]
        return F.concat_ws("+", *names), ctx_new

    firsts = [F.size(f"__c_{f}") > 0 for f, _ in order]
    s0, c0 = scope_for(0)
    s1, c1 = scope_for(1)
    s2, c2 = scope_for(2)
    scope = (F.when(firsts[0], s0).when(firsts[1], s1).when(firsts[2], s2)
             .when(F.size("__c_context") > 0, F.lit("table_context")).otherwise(F.lit("")))
    adds = F.when(firsts[0], c0).when(firsts[1], c1).when(firsts[2], c2).otherwise(F.lit(False))
    x = x.withColumn("match_scope", scope).withColumn("context_adds_terms", adds)

    # T13 row-specific query (query words as typed, deduped ignoring case)
    raw = query_tokens(q)
    low = F.transform(raw, lambda t: F.lower(t))
    uniq = F.filter(raw, lambda t, i: F.array_position(low, F.lower(t)) == i + 1)

    def row_query(row_set: Column) -> Column:
        def in_text(t):
            parts = index_tokens(t)
            return _covered(F.lower(t), row_set) | (
                (F.size(F.array_distinct(parts)) > 1) & (F.size(F.array_except(parts, row_set)) == 0))
        kept = F.filter(uniq, in_text)
        return F.when(F.size(kept) == 0, F.lit("")) \
                .when((F.size(kept) == 1) & ~strong_single_token(F.get(kept, 0)), F.lit("")) \
                .otherwise(F.array_join(kept, " "))

    row_all = F.array_distinct(F.concat(F.col("__s_title"), F.col("__s_body"), F.col("__s_metadata")))
    row_content = F.array_distinct(F.concat(F.col("__s_body"), F.col("__s_metadata")))
    x = x.withColumn("row_text_query", row_query(row_all)).withColumn("row_content_query", row_query(row_content))

    # T10 snippet: body, then title, then metadata when covered, else context
    src = (F.when(F.col("coverage_body") > 0, F.col("body"))
           .when(F.col("coverage_title") > 0, F.col("title"))
           .when(F.col("coverage_metadata") > 0, F.col("metadata"))
           .otherwise(F.col("context")))
    x = x.withColumn("snippet", snippet(src, F.col("__q")))
    ctx_only = ((F.col("coverage_body") == 0) & (F.col("coverage_title") == 0) & (F.col("coverage_metadata") == 0)
                & (F.col("coverage_context") > 0))
    x = x.withColumn("context_only", ctx_only)
    if table_name is not None:
        x = x.withColumn("title", F.when(ctx_only, F.lit(context_title(table_name))).otherwise(F.col("title")))
    return x.drop(*[c for c in x.columns if c.startswith("__")])


def snippet(text: Column, qtok: Column, width: int = 24) -> Column:
    """Up to ``width`` words starting a few words before the first word
    holding a query token; `` ... `` marks a cut on either side."""
    words = F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+")
    hits = F.transform(words, lambda w: F.size(F.array_intersect(index_tokens(w), qtok)) > 0)
    first = F.coalesce(F.array_position(hits, F.lit(True)), F.lit(1))
    n = F.size(words)
    start = F.greatest(F.lit(1), F.least(first - F.lit(width // 4), n - F.lit(width) + 1))
    body = F.array_join(F.slice(words, start, width), " ")
    return F.concat(F.when(start > 1, F.lit("... ")).otherwise(F.lit("")), body,
                    F.when(start + width - 1 < n, F.lit(" ...")).otherwise(F.lit("")))


def term_coverage(hits: DataFrame, query_text: str = "query_text") -> DataFrame:
    """T11 on its own: distinct query index tokens present per field."""
    q = F.array_distinct(index_tokens(F.col(query_text)))
    out = hits
    for f in FIELDS:
        s = F.array_distinct(index_tokens(F.col(f)))
        out = out.withColumn(f"coverage_{f}", F.size(F.filter(q, lambda t: _covered(t, s))))
    return out
