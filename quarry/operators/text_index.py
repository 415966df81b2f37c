"""A stored block-max inverted index for text recall.

``build_index`` writes one row per (token, block of documents):

    token, block, postings array<struct<doc_id, doc_len, wtf, places>>

and a head (token, block, n_docs, top) for each of them in a table of its own.
``top`` is the largest value that the token adds to a score in the block,
before its IDF; ``places`` are the sorted positions of the token in one
document.  Rows stay in the file of their block, so a very frequent token is
spread over files by its blocks, and building needs no shuffle and no sort
that spills.  ``stats`` beside it holds the number of documents and their mean
length, ``shared`` the ids that several documents have.

``search_index`` answers a batch of queries with the hits and scores of
``text.search_text``, reading few postings:

1. the heads give document frequencies, and
   for each query the blocks that hold all its terms with an upper bound of
   any score in them; only blocks of the query's rarest term are looked at;
2. the ``first`` most promising blocks per query are scored, which gives the
   score of the k-th hit so far;
3. of the remaining blocks, those whose bound reaches that score are scored;
   no other block can hold a hit of the top k.

Bounds (1) and the remaining blocks (3) are worked out inside the tasks
(``matching``), each with some whole blocks and the query batch: (query, block)
and (query, document) pairs are neither shuffled nor written.

Terms of several words (``a_b``, ``don't``) are looked up among the runs of
neighbouring words that the place lists of a block make; the corpus is not
tokenised again.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import matching as mt
from . import text as tx

BLOCK_DOCS = 64             # documents of a block at most
FIRST_BLOCKS = 4            # blocks per query scored before the bound is used
SLACK = 1e-6                # bounds are compared with this much to spare


@dataclass(frozen=True)
class TextIndex:
    """An index opened for reading."""
    rows: DataFrame
    heads: DataFrame
    n_docs: int
    mean_len: float
    weights: Mapping[str, float]
    k1: float
    b: float
    shared: DataFrame           # (doc_id): ids that several documents have


def _part(wtf, doc_len, mean_len: float, k1: float, b: float):
    """A phrase's share of a BM25 score before its IDF."""
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * doc_len / F.lit(mean_len if mean_len > 0 else 1.0))
    return wtf * (k1 + 1.0) / (wtf + norm)


def _whole_blocks(batches, least: int = 1):
    """The rows of Arrow batches in tables of whole blocks; rows of a block
    follow each other."""
    return mt.whole_groups(batches, "block", least)


def _flat(column):
    """(values, number of values per row) of an Arrow list column."""
    import pyarrow as pa
    import pyarrow.compute as pc
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)


def _documents(block, doc_id, doc_len):
    """Numbers of the different (block, doc_id, doc_len) in their order, and
    where each stands first."""
    import numpy as np
    import pyarrow.compute as pc
    codes = pc.fill_null(pc.dictionary_encode(doc_id).indices, -1).to_numpy(zero_copy_only=False)
    key = np.stack([block, codes, doc_len])
    order = np.lexsort(key[::-1])
    new = np.ones(len(order), bool)
    new[1:] = (key[:, order[1:]] != key[:, order[:-1]]).any(axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _block_rows(weights: list[float]):
    """(token, block, postings) of documents (block, doc_id, tokens by
    field), for ``mapInArrow``; the row with a null token holds every document
    of the block."""
    span = tx.FIELD_SPAN

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        per_field = np.asarray(weights)

        def lists(values, starts, total):
            return pa.ListArray.from_arrays(pa.array(np.append(starts, total), pa.int32()), values)

        for t in _whole_blocks(batches):
            fields, n_fields = _flat(t.column("f"))
            words, n_words = _flat(fields)
            row = np.repeat(np.arange(t.num_rows), n_fields)
            field = np.arange(len(row)) - np.repeat(np.cumsum(n_fields) - n_fields, n_fields)
            doc_len = np.bincount(row, weights=n_words, minlength=t.num_rows).astype(np.int64)
            block = t.column("block").to_numpy()
            doc, first = _documents(block, t.column("doc_id").combine_chunks(), doc_len)
            ids = pc.take(t.column("doc_id").combine_chunks(), pa.array(first))
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            lens, blocks = doc_len[first], block[first]

            def postings(docs, wtf, places):
                return pa.StructArray.from_arrays([pc.take(ids, pa.array(docs)), pa.array(lens[docs]), pa.array(wtf), places],
                                                  names=["doc_id", "doc_len", "wtf", "places"])

            def batch(tokens, in_block, values):
                return pa.RecordBatch.from_arrays([tokens, pa.array(in_block), values], names=["token", "block", "postings"])

            # every document once, without a token
            n = len(first)
            start = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
            none = lists(pa.array([], pa.int32()), np.zeros(n, np.int32), 0)
            yield batch(pa.nulls(len(start), pa.string()), blocks[start],
                        lists(postings(np.arange(n), np.zeros(n), none), start, n))
            if not len(words):
                continue
            coded = pc.dictionary_encode(words)
            code = coded.indices.to_numpy()
            at = np.arange(len(code)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
            in_field = np.repeat(field, n_words)
            doc = np.repeat(doc[row], n_words)
            place = in_field * span + at
            order = np.lexsort((place, doc, code, blocks[doc]))
            code, doc, place, in_field = code[order], doc[order], place[order].astype(np.int32), in_field[order]
            new = np.append(True, (doc[1:] != doc[:-1]) | (code[1:] != code[:-1]))
            post = np.flatnonzero(new)                                  # where a posting begins
            p_code, p_doc = code[post], doc[post]
            p_block = blocks[p_doc]
            out = np.flatnonzero(np.append(True, (p_code[1:] != p_code[:-1]) | (p_block[1:] != p_block[:-1])))
            values = postings(p_doc, np.add.reduceat(per_field[in_field], post), lists(pa.array(place), post, len(place)))
            yield batch(pc.take(coded.dictionary, pa.array(p_code[out])), p_block[out], lists(values, out, len(post)))
    return run


def build_index(docs: DataFrame, path: str, weights: Mapping[str, float] | None = None, k1: float = tx.BM25_K1,
                b: float = tx.BM25_B, block_docs: int = BLOCK_DOCS) -> TextIndex:
    """Write the index of search documents (doc_id, title, body, metadata,
    context) under ``path`` and open it.

    Documents are blocked in the order they are read; a block lies in one
    partition and its tokens are sorted there by array code, so neither texts
    nor single tokens are shuffled.  Weights and BM25 parameters are fixed
    here, as ``top`` depends on them.
    """
    spark = docs.sparkSession
    weights = dict(tx.FIELD_WEIGHTS, **(weights or {}))
    blocked = docs.withColumn("block", F.expr(f"monotonically_increasing_id() div {int(block_docs)}"))
    toks = blocked.select("block", "doc_id", F.array(*[tx.match_tokens(F.col(f)) for f in tx.FIELDS]).alias("f"))
    doc_type = dict(docs.dtypes)["doc_id"]
    rows = toks.mapInArrow(_block_rows([float(weights[f]) for f in tx.FIELDS]),
                           f"token string, block long, postings array<struct<doc_id:{doc_type},doc_len:long,wtf:double,places:array<int>>>")
    rows.write.parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    st = (stored.where("token is null").select(F.explode("postings.doc_len").alias("n"))
          .agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean")).first())
    n_docs, mean_len = int(st["docs"]), float(st["mean"] or 0.0)
    (stored.where("token is null").select(F.explode("postings.doc_id").alias("doc_id")).groupBy("doc_id")
     .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id").write.parquet(f"{path}/shared"))
    top = F.array_max(F.transform("postings", lambda p: _part(p["wtf"], p["doc_len"], mean_len, k1, b)))
    (stored.where("token is not null").select("token", "block", F.size("postings").alias("n_docs"), top.alias("top"))
     .write.parquet(f"{path}/heads"))
    spark.createDataFrame([(n_docs, mean_len, k1, b, weights)],
                          "n_docs long, mean_len double, k1 double, b double, weights map<string,double>") \
        .coalesce(1).write.parquet(f"{path}/stats")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> TextIndex:
    st = spark.read.parquet(f"{path}/stats").first()
    return TextIndex(spark.read.parquet(f"{path}/rows").where("token is not null"), spark.read.parquet(f"{path}/heads"), st["n_docs"], st["mean_len"], st["weights"], st["k1"], st["b"],
                     spark.read.parquet(f"{path}/shared"))


def _units(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """(query_id, term_idx, alt, part, unit, tokens): a unit is a phrase's
    words joined by spaces, so equal phrases of the batch are one unit."""
    key = ["query_id", "term_idx", "alt", "part"]
    return (tx.query_phrases(queries, query_id, text).groupBy(*key)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("offset", "token"))), lambda x: x["token"]).alias("tokens"))
            .withColumn("unit", F.array_join("tokens", " ")))


def _word_runs(lengths: list[int]):
    """(unit, block, doc_id, doc_len, place) of the runs of neighbouring words
    in index rows (token, block, postings) that lie together by block, for
    ``mapInArrow``; a run has as many words as ``lengths`` says."""
    def run(batches):
        from itertools import product

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for t in _whole_blocks(batches):
            posts, n_posts = _flat(t.column("postings"))
            places, n_places = _flat(pc.struct_field(posts, [3]))
            row = np.repeat(np.arange(t.num_rows), n_posts)
            block, ids = t.column("block").to_numpy()[row], pc.struct_field(posts, [0])
            doc_len = pc.struct_field(posts, [1]).to_numpy(zero_copy_only=False)
            doc, first = _documents(block, ids, doc_len)
            word = pc.dictionary_encode(t.column("token").combine_chunks())
            codes, names = word.indices.to_numpy(zero_copy_only=False), word.dictionary
            x = np.stack([np.repeat(doc, n_places), places.to_numpy(zero_copy_only=False), np.repeat(codes[row], n_places)])
            x = x[:, np.lexsort(x[::-1])]
            x = x[:, np.append(True, (x[:, 1:] != x[:, :-1]).any(axis=0))[:x.shape[1]]]
            # a place has two words where rows with one id were merged
            twice = np.unique(x[0, 1:][(x[0, 1:] == x[0, :-1]) & (x[1, 1:] == x[1, :-1])])
            merged = x[:, np.isin(x[0], twice)]
            x = x[:, ~np.isin(x[0], twice)]

            def batch(units, docs, at):
                head = pa.array(first[docs])
                return pa.RecordBatch.from_arrays(
                    [units, pa.array(block[first[docs]]), pc.take(ids, head), pa.array(doc_len[first[docs]]), pa.array(at.astype(np.int32))],
                    names=["unit", "block", "doc_id", "doc_len", "place"])

            for n in lengths:
                i = np.arange(max(x.shape[1] - n + 1, 0))
                i = i[(x[0, i] == x[0, i + n - 1]) & (x[1, i + n - 1] - x[1, i] == n - 1)]
                for lo in range(0, len(i), 100_000):
                    j = i[lo:lo + 100_000]
                    yield batch(pc.binary_join_element_wise(*[pc.take(names, pa.array(x[2, j + k])) for k in range(n)], " "),
                                x[0, j], x[1, j])
            for d in twice:
                own = merged[1:, merged[0] == d]
                at = {int(p): own[1, own[0] == p] for p in np.unique(own[0])}
                for n in lengths:
                    for p in at:
                        if all(p + k in at for k in range(n)):
                            units = [" ".join(names[int(c)].as_py() for c in cs) for cs in product(*[at[p + k] for k in range(n)])]
                            yield batch(pa.array(units, pa.string()), np.full(len(units), d), np.full(len(units), p))
    return run


def _phrase_rows(index: TextIndex, phrases: DataFrame, few) -> DataFrame:
    """Index rows of phrases of several words, from the place lists of their
    words: (unit, block, n_docs, top, postings).  The lists meet by block, and
    the runs of words in each document are looked up among the phrases, so no
    document meets a phrase that it does not hold."""
    words = phrases.select(F.explode("tokens").alias("token")).distinct()
    lengths = [r[0] for r in phrases.select(F.size("tokens")).distinct().collect()]     # one number per length
    doc_type = index.rows.schema["postings"].dataType.elementType["doc_id"].dataType.simpleString()
    lists = (index.rows.select("token", "block", "postings").join(few(words), "token", "left_semi")
             .repartition("block").sortWithinPartitions("block"))
    runs = lists.mapInArrow(_word_runs(lengths), f"unit string, block long, doc_id {doc_type}, doc_len long, place int")
    docs = (runs.join(few(phrases.select("unit").distinct()), "unit", "left_semi").groupBy("unit", "block", "doc_id", "doc_len")
            .agg(F.array_sort(F.collect_list("place")).alias("places"))
            .withColumn("wtf", tx.place_weight(F.col("places"), index.weights)))
    top = F.max(_part(F.col("wtf"), F.col("doc_len"), index.mean_len, index.k1, index.b))
    return docs.groupBy("unit", "block").agg(
        F.count(F.lit(1)).cast("int").alias("n_docs"), top.alias("top"),
        F.collect_list(F.struct("doc_id", "doc_len", "wtf", "places")).alias("postings"))


def _holds_all(alt, part, idx):
    """Number of terms that hold: alternative 0 is there, or both parts of
    alternative 1 are."""
    whole = F.collect_set(F.when(alt == 0, idx))
    left = F.collect_set(F.when((alt == 1) & (part == 0), idx))
    right = F.collect_set(F.when((alt == 1) & (part == 1), idx))
    return F.size(F.array_union(whole, F.array_intersect(left, right)))


def _each_part(rows: DataFrame, parts: list, run, columns: str) -> DataFrame:
    """``rows`` against every part of the query batch."""
    out = None
    for part in parts:
        found = rows.mapInArrow(run(part), f"query_id {mt._sql_type(part.ids.type)}, {columns}")
        out = found if out is None else out.unionByName(found)
    return out


def _counts(n, queries):
    """(queries, counts) of those that have any, as Arrow arrays."""
    import numpy as np
    import pyarrow as pa
    some = np.flatnonzero(n)
    return queries.ids.take(pa.array(some)), pa.array(n[some])


def _best_blocks(queries, first: int):
    """(query_id, block, bound, candidates) of index heads (unit, block, top)
    that lie together by block, for ``mapInArrow``: the ``first`` blocks of each
    query with the highest bounds, and in a row without a block the number of
    blocks that hold all its terms."""
    names = ["query_id", "block", "bound", "candidates"]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        best, n = mt.Best(len(queries.ids), first, digits=None), np.zeros(len(queries.ids), np.int64)
        for t in _whole_blocks(batches, mt.CHUNK):
            number, at = np.unique(t.column("block").to_numpy(), return_inverse=True)
            unit, have = mt.units_of(queries, t.column("unit"))
            for q, block, bound in queries.matches(unit, at[have], len(number), t.column("top").to_numpy()[have]):
                n += np.bincount(q, minlength=len(n))
                best.add(q, bound, pa.array(number[block]))
        for q, bound, block in best.rows():
            yield pa.RecordBatch.from_arrays([queries.ids.take(pa.array(q)), block, pa.array(bound), pa.nulls(len(q), pa.int64())], names=names)
        ids, n = _counts(n, queries)
        yield pa.RecordBatch.from_arrays([ids, pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.float64()), n], names=names)
    return run


def _rest_of_blocks(queries, k: int, floors, seen, apart, index: TextIndex):
    """(query_id, doc_id, score, block, copies, read) of index rows (unit, block,
    postings) that lie together by block, for ``mapInArrow``.  Blocks with
    a bound that reaches the query's score in ``floors`` (query_id, floor) and
    that were not ``seen`` (query_id, block) are read: rows with a score are
    the best ``k`` of their documents, rows with ``read`` say how many there
    were.  Documents whose id is in ``apart`` (any id where it is None) are left
    to the caller: rows with ``copies`` name their blocks."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    whole = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    number = lambda c: pc.fill_null(pc.index_in(whole(c), value_set=queries.ids), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at, least = number(floors["query_id"]), np.full(len(queries.ids), -np.inf)
    least[at[at >= 0]] = floors["floor"].to_numpy()[at >= 0] - SLACK
    seen_q, seen_block = number(seen["query_id"]), seen["block"].to_numpy()
    seen_q, seen_block = seen_q[seen_q >= 0], seen_block[seen_q >= 0]
    mean_len, k1, b = index.mean_len, index.k1, index.b
    names = ["query_id", "doc_id", "score", "block", "copies", "read"]

    def run(batches):
        best, n = mt.Best(len(queries.ids), k, floor=least), np.zeros(len(queries.ids), np.int64)
        doc_type = None
        for t in _whole_blocks(batches, mt.CHUNK // 16):
            blocks, at = np.unique(t.column("block").to_numpy(), return_inverse=True)
            unit, have = mt.units_of(queries, t.column("unit"))
            t, at = t.take(pa.array(have)).combine_chunks(), at[have]
            posts, n_posts = _flat(t.column("postings"))
            ids, doc_len, wtf = (whole(pc.struct_field(posts, [i])) for i in range(3))
            doc_type = ids.type
            value = mt.part_of(wtf.to_numpy(zero_copy_only=False), doc_len.to_numpy(zero_copy_only=False), mean_len, k1, b)
            top = np.maximum.reduceat(value, np.cumsum(n_posts) - n_posts) if len(value) else value
            # the blocks to read, and how often the query asks for them
            here = np.searchsorted(blocks, seen_block)
            here = np.where(blocks[np.minimum(here, len(blocks) - 1)] == seen_block, here, -1)
            done = np.unique((seen_q * len(blocks) + here)[here >= 0])
            pairs = [np.empty(0, np.int64)]
            for q, block, bound in queries.matches(unit, at, len(blocks), top):
                key = (q * len(blocks) + block)[bound >= least[q]]
                pairs.append(key[~np.isin(key, done)])
            pair, copies = np.unique(np.concatenate(pairs), return_counts=True)
            if not len(pair):
                continue
            n += np.bincount(pair // len(blocks), weights=copies, minlength=len(n)).astype(np.int64)
            unit, in_block = np.repeat(unit, n_posts), np.repeat(at, n_posts)
            theirs = np.ones(len(unit), bool) if apart is None else pc.is_in(ids, value_set=apart).to_numpy(zero_copy_only=False)
            if theirs.any():
                put = np.isin(pair % len(blocks), in_block[theirs])
                yield pa.RecordBatch.from_arrays(
                    [queries.ids.take(pa.array(pair[put] // len(blocks))), pa.nulls(int(put.sum()), doc_type), pa.nulls(int(put.sum()), pa.float64()),
                     pa.array(blocks[pair[put] % len(blocks)]), pa.array(copies[put]), pa.nulls(int(put.sum()), pa.int64())], names=names)
                own = np.flatnonzero(~theirs)
                unit, in_block, value, ids, doc_len = unit[own], in_block[own], value[own], ids.take(pa.array(own)), doc_len.take(pa.array(own))
                if not len(unit):
                    continue
            doc, first = _documents(in_block, ids, doc_len.to_numpy(zero_copy_only=False))
            lies = in_block[first]

            def times(q, d):
                key = q * len(blocks) + lies[d]
                x = np.minimum(np.searchsorted(pair, key), len(pair) - 1)
                return np.where(pair[x] == key, copies[x], 0)

            for q, d, score in queries.matches(unit, doc, len(first), value, among=lambda q, d: times(q, d) > 0):
                best.add(q, score * times(q, d), ids.take(pa.array(first[d])))
        for q, score, ids in best.rows():
            empty = pa.nulls(len(q), pa.int64())
            yield pa.RecordBatch.from_arrays([queries.ids.take(pa.array(q)), ids, pa.array(score), empty, empty, empty], names=names)
        if doc_type is not None:
            ids, n = _counts(n, queries)
            empty = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.nulls(len(n), doc_type), pa.nulls(len(n), pa.float64()), empty, empty, n], names=names)
    return run


def search_index(index: TextIndex, queries: DataFrame, k: int = tx.DEFAULT_K, query_id: str = "query_id",
                 text: str = "text", first: int = FIRST_BLOCKS,
                 max_broadcast_units: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(hits, blocks): the hits of ``text.search_text`` (query_id, doc_id,
    score, rank, truncated), and per query the blocks of the index that hold
    all its terms (``candidates``) and those whose postings were scored
    (``read``).  Queries without a term have no hits (``text.query_errors``
    lists them)."""
    spark = index.rows.sparkSession

    def keep(df: DataFrame, name: str) -> DataFrame:
        where = scratch_path(spark, name)
        df.write.parquet(where)
        return spark.read.parquet(where)

    doc_type = index.rows.schema["postings"].dataType.elementType["doc_id"].dataType.simpleString()
    units = keep(_units(queries, query_id, text), "text-units")
    shape = units.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("tokens")).alias("longest")).first()
    # the unit table grows with the query batch, not with the corpus
    few = F.broadcast if shape["n"] <= max_broadcast_units else (lambda df: df)
    single = few(units.where(F.size("tokens") == 1).select("unit").distinct())
    rows = index.rows.select(F.col("token").alias("unit"), "block", "postings").join(single, "unit", "left_semi")
    heads = index.heads.withColumnRenamed("token", "unit").join(single, "unit", "left_semi")
    if (shape["longest"] or 0) > 1:
        phrases = units.where(F.size("tokens") > 1).select("unit", "tokens").distinct()
        found = keep(_phrase_rows(index, phrases, few), "text-phrases")
        rows, heads = rows.unionByName(found.select("unit", "block", "postings")), heads.unionByName(found.drop("postings"))
    heads = keep(heads.select("unit", "block", "n_docs", "top"), "text-heads")

    # exact document frequencies and IDF; the rarest term of each query leads
    df = units.select("unit").distinct().join(heads.groupBy("unit").agg(F.sum("n_docs").alias("df")), "unit", "left") \
        .select("unit", F.coalesce("df", F.lit(0)).alias("df"))
    idf = F.log((F.lit(float(index.n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = keep(units.drop("tokens").join(df, "unit").withColumn("idf", F.when(idf <= 0, F.lit(1e-6)).otherwise(idf)), "text-asked")
    lead = asked.groupBy("query_id", "term_idx", "alt").agg(       # alternative 1 needs both parts: the rarer one leads
        F.min_by("unit", F.struct("df", "part")).alias("unit"), F.min("df").alias("df"))
    size = lead.groupBy("query_id", "term_idx").agg(F.sum("df").alias("size"))
    chosen = size.groupBy("query_id").agg(F.min_by("term_idx", F.struct("size", "term_idx")).alias("term_idx"))
    leading = lead.join(chosen, ["query_id", "term_idx"]).select("query_id", "unit")
    n_terms = tx.query_term_counts(queries, query_id, text)

    # blocks that hold all terms of a query, with a bound of every score in them
    parts = mt.collect_queries(asked, leading, n_terms)
    if not parts:
        none = asked.select("query_id").limit(0)
        return (none.select("query_id", F.lit(None).cast(doc_type).alias("doc_id"), F.lit(0.0).alias("score"), F.lit(1).alias("rank"),
                            F.lit(False).alias("truncated")),
                none.select("query_id", F.lit(0).cast("long").alias("candidates"), F.lit(0).cast("long").alias("read")))
    placed = heads.select("unit", "block", "top").repartition("block").sortWithinPartitions("block")
    bounds = keep(_each_part(placed, parts, lambda part: _best_blocks(part, first), "block long, bound double, candidates long"), "text-bounds")
    order = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
    begun = keep(bounds.where("block is not null").withColumn("n", F.row_number().over(order)).where(F.col("n") <= first)
                 .select("query_id", "block"), "text-begun")

    def score(chosen: DataFrame, ids: DataFrame | None = None) -> DataFrame:
        need = chosen.join(few(asked), "query_id")
        # few chosen blocks are broadcast, so that the postings stay where they are
        need = F.broadcast(need) if need.count() <= max_broadcast_units else need
        docs = (rows.select("unit", "block", "postings").join(need, ["unit", "block"])
                .select("query_id", "term_idx", "alt", "part", "idf", F.explode("postings").alias("p")))
        if ids is not None:
            docs = docs.join(few(ids), F.col("p.doc_id").eqNullSafe(ids["doc_id"]), "left_semi")
        share = _part(F.col("p.wtf"), F.col("p.doc_len"), index.mean_len, index.k1, index.b)
        return (docs.groupBy("query_id", F.col("p.doc_id").alias("doc_id"))
                .agg(_holds_all(F.col("alt"), F.col("part"), F.col("term_idx")).alias("held"),
                     F.sum(F.col("idf") * share).alias("score"))
                .join(few(n_terms), "query_id").where("held = n_terms").select("query_id", "doc_id", "score"))

    best = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), F.col("doc_id").asc())
    first_hits = keep(score(begun).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n"), "text-hits")
    floor = first_hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")) \
        .where(F.col("n") > k).select("query_id", "floor")
    # the remaining blocks: their best documents, and how many blocks were read
    again = index.shared.limit(max_broadcast_units + 1).toArrow()["doc_id"].combine_chunks()
    apart = again if len(again) <= max_broadcast_units else None
    floors, seen = floor.where("query_id is not null").toArrow(), begun.toArrow()
    placed = (rows.select("unit", "block", F.transform("postings", lambda p: F.struct(*[p[c].alias(c) for c in ("doc_id", "doc_len", "wtf")])).alias("postings"))
              .repartition("block").sortWithinPartitions("block"))
    rest = keep(_each_part(placed, parts, lambda part: _rest_of_blocks(part, k + 1, floors, seen, apart, index),
                           f"doc_id {doc_type}, score double, block long, copies long, read long"), "text-rest")
    more = rest.where("score is not null").select("query_id", "doc_id", "score")
    if len(again):
        # documents that share an id are one hit, wherever they lie
        left = rest.where("copies is not null").select("query_id", "block", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")
        more = more.unionByName(score(left, index.shared if apart is not None else None))
    hits = first_hits.unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    hits = (hits.withColumn("truncated", F.max("rank").over(Window.partitionBy("query_id")) > k).where(F.col("rank") <= k)
            .select("query_id", "doc_id", "score", "rank", "truncated"))
    read = (begun.select("query_id", F.lit(1).alias("n")).unionByName(rest.where("read is not null").select("query_id", F.col("read").alias("n")))
            .groupBy("query_id").agg(F.sum("n").alias("read")))
    blocks = (bounds.where("candidates is not null").groupBy("query_id").agg(F.sum("candidates").alias("candidates"))
              .join(read, "query_id", "left").select("query_id", "candidates", "read"))
    return hits, blocks
