"""AND queries scored inside the tasks.

The documents of a task meet the whole query batch there, and only its best
hits of each query leave it: the number of (query, document) pairs, which grows
with the product of both tables, is never shuffled or written.  A task holds
``QUERY_ROWS`` query terms, ``CHUNK`` postings and ``PIECE`` looked-up terms at
a time; larger query batches are answered in several passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_ROWS = 200_000        # query terms that a task holds at once
CHUNK = 1 << 18             # postings searched together
PIECE = 1 << 19             # (query, document, term) looked up together


def whole_groups(batches, column: str, least: int = 1):
    """The rows of Arrow batches in tables of at least ``least`` rows and of
    whole groups; rows of a group (equal ``column``) follow each other."""
    import numpy as np
    import pyarrow as pa
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < least:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        new = group_starts(t.column(column))
        cut = int(np.flatnonzero(new)[-1])
        if cut:
            yield t.slice(0, cut)
        t = t.slice(cut)
        # copied, as a slice keeps the whole table alive
        held = t.take(pa.array(np.arange(t.num_rows))).to_batches() if cut else t.to_batches()
        n = t.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(column):
    """Flags of the values that differ from the one before; nulls are equal."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    codes = pc.fill_null(pc.dictionary_encode(column).indices, -1).to_numpy(zero_copy_only=False)
    return np.append(True, codes[1:] != codes[:-1])[:len(codes)]


def _cuts(sizes, most: int):
    """Ranges (lo, hi) of neighbours whose sizes add up to about ``most``."""
    import numpy as np
    total = np.cumsum(sizes)
    ends = np.flatnonzero(np.append((total[1:] // most) != (total[:-1] // most), True)) + 1
    return zip([0, *ends[:-1].tolist()], ends.tolist())


class Queries:
    """A query batch as arrays.  Rows (query, term, alternative, part, unit,
    idf) lie by query; ``leads`` are the units of which a hit holds one."""

    def __init__(self, ids, units, rows: dict, leads: dict, counts: dict):
        """``ids``, ``units``: Arrow arrays; the others: columns whose ``query``
        and ``unit`` are numbers in them."""
        import numpy as np
        self.ids, self.units, n = ids, units, len(ids)
        order = np.lexsort((rows["part"], rows["alt"], rows["term"], rows["query"]))
        query, term, alt, part = (rows[c][order] for c in ("query", "term", "alt", "part"))
        self.unit, self.idf = rows["unit"][order], rows["idf"][order]
        self.n_rows = np.bincount(query, minlength=n)
        self.first = np.cumsum(self.n_rows) - self.n_rows
        self.new_term = np.append(True, (query[1:] != query[:-1]) | (term[1:] != term[:-1]))[:len(query)]
        self.whole, self.left, self.right = alt == 0, (alt == 1) & (part == 0), (alt == 1) & (part == 1)
        order = np.lexsort((leads["unit"], leads["query"]))
        self.lead_query, self.lead_unit = leads["query"][order], leads["unit"][order]
        # how often a query asks for so many terms: once, unless ids repeat
        self.most = int(max(counts["terms"].max(initial=0), 0)) + 1
        order = np.argsort(counts["query"] * self.most + counts["terms"])
        self.count_key, self.count = (counts["query"] * self.most + counts["terms"])[order], counts["n"][order]

    def matches(self, unit, doc, n_docs: int, value, among=None):
        """Yield (queries, documents, scores) of the documents that hold all
        terms; ``unit``, ``doc``, ``value`` have one entry for each unit of each
        document.  ``among`` flags the (query, document) to look at."""
        import numpy as np
        if not len(unit):
            return
        key = unit * n_docs + doc
        order = np.argsort(key, kind="stable")
        key, doc, value = key[order], doc[order], value[order]
        per_unit = np.bincount(unit, minlength=len(self.units))
        start = np.cumsum(per_unit) - per_unit
        lead = np.flatnonzero(per_unit[self.lead_unit])
        if not len(lead):
            return
        q_lead, u_lead = self.lead_query[lead], self.lead_unit[lead]
        n = per_unit[u_lead]
        first = np.flatnonzero(np.append(True, q_lead[1:] != q_lead[:-1]))
        ends = np.append(first[1:], len(lead))
        for a, b in _cuts(np.add.reduceat(n, first), PIECE):
            s = slice(first[a], ends[b - 1])
            times = n[s]
            q = np.repeat(q_lead[s], times)
            d = doc[np.arange(len(q)) + np.repeat(start[u_lead[s]] - (np.cumsum(times) - times), times)]
            if len(times) > b - a:                              # a query with several leads
                pair = np.unique(q * n_docs + d)
                q, d = pair // n_docs, pair % n_docs
            if among is not None:
                look = among(q, d)
                q, d = q[look], d[look]
            if not len(q):
                continue
            for lo, hi in _cuts(self.n_rows[q], PIECE):
                yield self._score(key, value, q[lo:hi], d[lo:hi], n_docs)

    def _score(self, key, value, q, d, n_docs: int):
        import numpy as np
        rows = self.n_rows[q]
        begin = np.cumsum(rows) - rows
        t = np.arange(int(rows.sum())) + np.repeat(self.first[q] - begin, rows)
        want = self.unit[t] * n_docs + np.repeat(d, rows)
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        there = key[at] == want
        score = np.add.reduceat(np.where(there, self.idf[t] * value[at], 0.0), begin)
        # a term holds when alternative 0 is there, or both parts of alternative 1 are
        term = np.flatnonzero(self.new_term[t])
        holds = np.logical_or.reduceat(there & self.whole[t], term)
        if self.left.any():
            holds |= (np.logical_or.reduceat(there & self.left[t], term) & np.logical_or.reduceat(there & self.right[t], term))
        held = np.add.reduceat(holds.astype(np.int64), np.searchsorted(term, begin))
        want = q * self.most + np.minimum(held, self.most - 1)
        at = np.minimum(np.searchsorted(self.count_key, want), len(self.count_key) - 1)
        times = np.where((self.count_key[at] == want) & (held < self.most), self.count[at], 0)
        return np.repeat(q, times), np.repeat(d, times), np.repeat(score, times)


class Best:
    """The best ``k`` rows of each query, by ``score`` (rounded to ``digits``)
    downwards and id upwards; ``floor`` names scores that none may fall below."""

    def __init__(self, n_queries: int, k: int, digits: int | None = 9, floor=None):
        import numpy as np
        self.k, self.digits = k, digits
        self.floor = np.full(n_queries, -np.inf) if floor is None else floor.copy()
        self.kept, self.wait, self.n_wait = None, [], 0

    def add(self, q, score, ids) -> None:
        import numpy as np
        import pyarrow as pa
        by = score if self.digits is None else np.round(score, self.digits)
        good = np.flatnonzero(by >= self.floor[q])
        if len(good):
            self.wait.append((q[good], by[good], score[good], ids.take(pa.array(good))))
            self.n_wait += len(good)
            if self.n_wait > PIECE:
                self._merge()

    def _merge(self) -> None:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        parts = ([self.kept] if self.kept else []) + self.wait
        self.wait, self.n_wait = [], 0
        if not parts:
            return
        q, by, score = (np.concatenate([p[i] for p in parts]) for i in range(3))
        ids = pa.concat_arrays([p[3] for p in parts])
        rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
        order = np.lexsort((rank, -by, q))
        start = np.flatnonzero(np.append(True, q[order][1:] != q[order][:-1]))
        place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        order, place = order[place < self.k], place[place < self.k]
        self.kept = (q[order], by[order], score[order], ids.take(pa.array(order)))
        full = place == self.k - 1
        self.floor[self.kept[0][full]] = np.maximum(self.floor[self.kept[0][full]], self.kept[1][full])

    def rows(self):
        """(queries, scores, ids) in parts."""
        self._merge()
        if self.kept:
            q, _, score, ids = self.kept
            for lo in range(0, len(q), 100_000):
                yield q[lo:lo + 100_000], score[lo:lo + 100_000], ids.slice(lo, 100_000)


def collect_queries(asked: DataFrame, leads: DataFrame, n_terms: DataFrame) -> list[Queries]:
    """The query batch in parts of about ``QUERY_ROWS`` rows: ``asked`` (query_id,
    term_idx, alt, part, unit, idf), ``leads`` (query_id, unit), ``n_terms``
    (query_id, n_terms).  The driver holds a few numbers for each query term,
    nothing that grows with the documents."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    known = F.col("query_id").isNotNull()
    rows = asked.where(known).select("query_id", "term_idx", "alt", "part", "unit", "idf").toArrow()
    lead = leads.where(known).select("query_id", "unit").distinct().toArrow()
    count = n_terms.where(known).groupBy("query_id", "n_terms").agg(F.count(F.lit(1)).alias("n")).toArrow()
    if not rows.num_rows:
        return []
    whole = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    ids = whole(pc.unique(rows["query_id"]))
    number = lambda c, among: pc.fill_null(pc.index_in(whole(c), value_set=among), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    ints = lambda c: c.to_numpy().astype(np.int64)
    query, l_query, c_query = (number(t["query_id"], ids) for t in (rows, lead, count))
    per_query = np.bincount(query, minlength=len(ids))
    out = []
    for lo, hi in _cuts(per_query, QUERY_ROWS):
        r, m, c = (np.flatnonzero((x >= lo) & (x < hi)) for x in (query, l_query, c_query))
        some, led, n = rows.take(pa.array(r)), lead.take(pa.array(m)), count.take(pa.array(c))
        units = whole(pc.unique(pa.chunked_array([*some["unit"].chunks, *led["unit"].chunks], pa.string())))
        out.append(Queries(
            ids.slice(lo, hi - lo).take(pa.array(np.arange(hi - lo))), units,
            {"query": query[r] - lo, "term": ints(some["term_idx"]), "alt": ints(some["alt"]), "part": ints(some["part"]),
             "unit": number(some["unit"], units), "idf": some["idf"].to_numpy()},
            {"query": l_query[m] - lo, "unit": number(led["unit"], units)},
            {"query": c_query[c] - lo, "terms": ints(n["n_terms"]), "n": ints(n["n"])}))
    return out


def units_of(queries: Queries, tokens):
    """Unit numbers of Arrow tokens, and which rows have one."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    tokens = tokens.combine_chunks() if isinstance(tokens, pa.ChunkedArray) else tokens
    unit = pc.fill_null(pc.index_in(tokens, value_set=queries.units), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    have = np.flatnonzero(unit >= 0)
    return unit[have], have


def part_of(wtf, doc_len, mean_len: float, k1: float, b: float):
    """A unit's share of a BM25 score before its IDF (arrays)."""
    return wtf * (k1 + 1.0) / (wtf + k1 * ((1 - b) + b * doc_len / (mean_len if mean_len > 0 else 1.0)))


def best_documents(units: DataFrame, parts: list[Queries], k: int | None, mean_len: float, k1: float, b: float,
                   span: str | None = None) -> DataFrame:
    """(query_id, doc_id, score): of each task's documents the best ``k`` for
    each query (all of them without ``k``).  ``units``: (doc_id, token, wtf,
    doc_len), one row for each unit of a document.  Documents are brought
    together by id, or with ``span`` they lie together already where that column
    is equal; the first and last one of a span may go on in another and come
    out as their rows, without a query."""
    types = dict(units.dtypes)
    columns = ["doc_id", "token", "wtf", "doc_len"]

    def search(queries: Queries, edges: bool):
        def run(batches):
            import numpy as np
            import pyarrow as pa
            best = Best(len(queries.ids), k) if k else None
            names = ["query_id", "doc_id", "score", *columns[1:]]
            kinds = [pa.string(), pa.float64(), pa.int64()]

            def batch(q, score, ids):
                return pa.RecordBatch.from_arrays([queries.ids.take(pa.array(q)), ids, pa.array(score), *(pa.nulls(len(q), x) for x in kinds)], names=names)

            def search_rows(t, new):
                ids = t.column("doc_id").combine_chunks()
                doc, n_docs = np.cumsum(new) - 1, int(new.sum())
                ids = ids.take(pa.array(np.flatnonzero(new)))
                unit, have = units_of(queries, t.column("token"))
                value = part_of(t.column("wtf").to_numpy()[have], t.column("doc_len").to_numpy()[have], mean_len, k1, b)
                for q, d, score in queries.matches(unit, doc[have], n_docs, value):
                    if best is not None:
                        best.add(q, score, ids.take(pa.array(d)))
                    else:
                        yield batch(q, score, ids.take(pa.array(d)))

            if span is None:
                for t in whole_groups(batches, "doc_id", CHUNK):
                    yield from search_rows(t, group_starts(t.column("doc_id")))
            else:
                for t in whole_groups(batches, "doc_id", CHUNK):
                    new = group_starts(t.column("doc_id")) | group_starts(t.column(span))
                    at, doc = np.flatnonzero(new), np.cumsum(new) - 1
                    where = t.column(span).to_numpy()[at]
                    # a table begins and ends somewhere inside a span
                    edge = np.append(True, where[1:] != where[:-1]) | np.append(where[1:] != where[:-1], True)
                    out = edge[doc]
                    if edges:
                        some = t.take(pa.array(np.flatnonzero(out))).combine_chunks()
                        own = [pa.nulls(some.num_rows, queries.ids.type), some.column("doc_id"), pa.nulls(some.num_rows, pa.float64()), *(some.column(c) for c in columns[1:])]
                        yield from pa.table([*own], names=names).combine_chunks().to_batches()
                    inner = np.flatnonzero(~out)
                    if len(inner):
                        yield from search_rows(t.take(pa.array(inner)).combine_chunks(), new[inner])
            if best is not None:
                for q, score, some in best.rows():
                    yield batch(q, score, some)
        return run

    dealt = units.where(F.col("doc_id").isNotNull())
    if span is None:
        dealt = dealt.repartition("doc_id").sortWithinPartitions("doc_id")
    out = None
    for i, queries in enumerate(parts):
        hits = dealt.mapInArrow(search(queries, i == 0), f"query_id {_sql_type(queries.ids.type)}, doc_id {types['doc_id']}, score double, token string, wtf double, doc_len long")
        out = hits if out is None else out.unionByName(hits)
    return out


def _few_words(batch):
    """A batch of documents in slices of about ``PIECE`` words."""
    import numpy as np
    import pyarrow.compute as pc
    if not batch.num_rows:
        return
    n = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    words = pc.fill_null(pc.list_value_length(batch.column(1).flatten()), 0).to_numpy(zero_copy_only=False)
    total = np.append(0, np.cumsum(words))
    ends = np.cumsum(n)
    for lo, hi in _cuts(total[ends] - total[ends - n] + 1, PIECE):
        yield batch.slice(lo, hi - lo)


def unit_rows(phrases: list[str], weights: list[float]):
    """(doc_id, token, wtf, doc_len, n) of documents (doc_id, tokens by field),
    for ``mapInArrow``: a row for each unit that a document holds, ``wtf`` the
    summed weights of its places, and a row without a token for each document.
    A unit is a word, or neighbouring words of a field joined by spaces."""
    units = sorted(set(phrases))

    def tables():
        """Word numbers; of each length (prefix, word) -> run, as sorted keys;
        unit of each run."""
        import numpy as np
        split = [u.split(" ") for u in units]
        words = {w: i for i, w in enumerate(sorted({w for x in split for w in x}))}
        levels, run_of = [], np.array([[words[x[0]] for x in split]], np.int64)[0] if units else np.empty(0, np.int64)
        size = len(words)
        unit_of = np.full(max(size, 1), -1)
        for i, x in enumerate(split):
            if len(x) == 1:
                unit_of[words[x[0]]] = i
        levels.append((None, unit_of))
        for n in range(2, max(map(len, split), default=1) + 1):
            longer = [i for i, x in enumerate(split) if len(x) >= n]
            keys = np.array([run_of[i] * size + words[split[i][n - 1]] for i in longer], np.int64)
            known = np.unique(keys)
            run_of[longer] = np.searchsorted(known, keys)
            unit_of = np.full(len(known), -1)
            for i in longer:
                if len(split[i]) == n:
                    unit_of[run_of[i]] = i
            levels.append((known, unit_of))
        return words, levels

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        words, levels = tables()
        per_field, names = np.asarray(weights), pa.array(units, pa.string())
        for b in (x for b in batches for x in _few_words(b)):
            fields = b.column(1)
            n_fields = pc.fill_null(pc.list_value_length(fields), 0).to_numpy(zero_copy_only=False)
            lists = fields.flatten()
            n_words = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            coded = pc.dictionary_encode(lists.flatten())
            row = np.repeat(np.arange(b.num_rows), n_fields)
            field = np.arange(len(row)) - np.repeat(np.cumsum(n_fields) - n_fields, n_fields)
            doc_len = np.bincount(row, weights=n_words, minlength=b.num_rows).astype(np.int64)
            number = np.array([words.get(w, -1) for w in coded.dictionary.to_pylist()] or [-1], np.int64)
            word = number[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.empty(0, np.int64)
            which = np.repeat(np.arange(len(row)), n_words)          # list of each word
            found_unit, found_at = [], []
            at = np.flatnonzero(word >= 0)
            runs = word[at]
            for n, (known, unit_of) in enumerate(levels, 1):
                if n > 1:
                    ok = at + n - 1 < len(word)
                    at, runs = at[ok], runs[ok]
                    ok = (which[at + n - 1] == which[at]) & (word[at + n - 1] >= 0)
                    at, runs = at[ok], runs[ok]
                    key = runs * len(words) + word[at + n - 1]
                    x = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
                    ok = known[x] == key
                    at, runs = at[ok], x[ok]
                unit = unit_of[runs]
                found_unit.append(unit[unit >= 0])
                found_at.append(at[unit >= 0])
            unit, at = np.concatenate(found_unit), which[np.concatenate(found_at)]
            doc, wtf = row[at], per_field[field[at]]
            order = np.lexsort((unit, doc))
            unit, doc, wtf = unit[order], doc[order], wtf[order]
            new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (unit[1:] != unit[:-1]))[:len(doc)])
            wtf = np.add.reduceat(wtf, new) if len(new) else wtf
            unit, doc = unit[new], doc[new]
            # a document's own row stands before those of its units
            n_rows = b.num_rows
            place = np.lexsort((np.append(np.full(n_rows, -1), unit), np.append(np.arange(n_rows), doc)))
            doc = np.append(np.arange(n_rows), doc)[place]
            unit = np.append(np.full(n_rows, -1), unit)[place]
            wtf = np.append(np.zeros(n_rows), wtf)[place]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), names.take(pa.array(unit, pa.int64(), mask=unit < 0)), pa.array(wtf),
                 pa.array(doc_len[doc]), pa.array(np.where(unit < 0, 1, 0))], names=["doc_id", "token", "wtf", "doc_len", "n"])
    return run


def _sql_type(kind) -> str:
    from pyspark.sql.pandas.types import from_arrow_type
    return from_arrow_type(kind).simpleString()
