"""Repeated-passage removal with a count-min prefilter.

Every word covered by a window of ``WINDOW`` words whose word sequence also
starts anywhere else is removed.

1. Sketch.  A window is represented by its anchor, the least hash among the
   ``GRAM``-word grams inside it; equal windows have equal anchors at equal
   offsets.  Each task counts its anchor positions in count-min rows; the
   partial sketches are merged cell by cell (shards of columns, so no task or
   row holds a whole sketch).  A merged cell never undercounts, so a window
   whose anchor is estimated once occurs once.  The width follows the corpus
   up to ``MAX_CELLS``; beyond that the sketch only lets more windows through.
2. Exact groups.  A second pass over the texts emits 128-bit digests of the
   windows whose anchors are estimated repeated, as runs of neighbouring
   windows under their common anchor, equal runs of a task combined.  Grouped
   by anchor, equal digests are counted exactly.  Anchors estimated frequent
   (a line that opens a third of all documents) are grouped by the digest
   itself, so that unequal surroundings do not meet in one group.
3. The word ranges found go back to their documents by id and text hash.

Defined cases: null and short texts have no windows and stay as they are;
repeated rows repeat all their windows; windows never cross documents; an
empty table gives no rows; rows without id are handled like others; further
columns are ignored by ``removal_rows`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, release, slices, stash

WINDOW = 35
GRAM = 8
ROWS = 2                    # count-min rows
CELLS_PER_ANCHOR = 8
MAX_CELLS = 1 << 30         # per row: 128 MB of bits at most
SHARD_BITS = 20
FREQUENT = 64               # estimated count from which windows are grouped by digest
CHUNK_WORDS = 1 << 17       # words handled at once (a longer document is one chunk)

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_ROW_KEYS = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@lru_cache(maxsize=2)
def _powers(n: int):
    one = np.ones(1, dtype=np.uint64)
    up = np.cumprod(np.concatenate([one, np.full(n, _BASE, dtype=np.uint64)]))
    down = np.cumprod(np.concatenate([one, np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)]))
    return up, down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _slide(op, x: np.ndarray, width: int) -> np.ndarray:
    """op over every run of ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return op(x[:-rest], x[rest:]) if rest else x


class Chunk:
    """Anchors and digests of the windows of some documents' words."""

    def __init__(self, texts: list[list[bytes]], window: int):
        import xxhash
        ids: dict[bytes, int] = {}
        flat = np.fromiter((ids.setdefault(w, len(ids)) for words in texts for w in words), dtype=np.int64)
        two = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, ids)), dtype=np.uint64).reshape(-1, 2)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        first = np.cumsum(size) - size
        n, self.window = len(flat), window
        gram = min(GRAM, window)
        up, down = _powers(1 << max(18, n.bit_length()))
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(two[:, k][flat] * up[:n])]) for k in (0, 1)]
        over = lambda s, w: _mixed((s[w:] - s[:-w]) * down[:n + 1 - w])
        grams = np.maximum(over(sums[0], gram), np.uint64(1))
        per = window - gram + 1                              # grams in a window
        least = _slide(np.minimum, grams, per)               # by window start
        start = np.arange(len(least))
        doc = np.searchsorted(first, start, side="right") - 1
        # skip empty documents that share a first word position
        valid = start + window <= first[doc] + size[doc]
        pad = np.zeros(per - 1, np.uint64)
        reach = _slide(np.maximum, np.concatenate([pad, np.where(valid, least, np.uint64(0)), pad]), per)
        #: hash of every gram position that is the anchor of some window
        self.anchors = grams[(grams == reach)]
        self.start = start[valid]
        self.least = least[valid]
        self.doc = doc[valid]
        self.word = self.start - first[self.doc]             # window start inside its document
        self._sums, self._over = sums, over

    def digests(self) -> np.ndarray:
        """(windows, 2) 128-bit digests."""
        return np.stack([self._over(s, self.window)[self.start] for s in self._sums], axis=1)


def _chunks(rows, window: int):
    """(documents, Chunk) of about CHUNK_WORDS words; ``rows`` are (key, words)."""
    held, n = [], 0
    for key, words in rows:
        if len(words) < window:
            continue
        held.append((key, words))
        n += len(words)
        if n >= CHUNK_WORDS:
            yield [k for k, _ in held], Chunk([w for _, w in held], window)
            held, n = [], 0
    if held:
        yield [k for k, _ in held], Chunk([w for _, w in held], window)


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (anchors * _ROW_KEYS[row]) >> np.uint64(64 - bits)


class Sketch:
    """The merged count-min rows, as far as the second pass needs them: a bit
    per cell counted twice or more, and the few cells counted often."""

    def __init__(self, bits: int, repeated: list[np.ndarray], frequent: list[np.ndarray]):
        self.bits, self.repeated, self.frequent = bits, repeated, frequent

    def least(self, anchors: np.ndarray):
        """(estimated repeated, estimated frequent) flags."""
        twice = np.ones(len(anchors), bool)
        often = np.ones(len(anchors), bool)
        for row in range(ROWS):
            c = _cells(anchors, row, self.bits)
            twice &= (self.repeated[row][c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1
            often &= np.isin(c, self.frequent[row])
        return twice, often


def build_sketch(docs: DataFrame, window: int, bits: int) -> Sketch:
    """Merge the partial sketches of all tasks; (text,) rows."""
    shard_bits = min(SHARD_BITS, bits)

    def partial(batches):
        rows = ((None, t.split()) for b in batches for x in slices(b) for t in byte_texts(x.column(0)))
        for _, chunk in _chunks(rows, window):
            for row in range(ROWS):
                cell, n = np.unique(_cells(chunk.anchors, row, bits), return_counts=True)
                packed = (cell & np.uint64((1 << shard_bits) - 1)).astype(np.uint32) | (
                    np.minimum(n, FREQUENT).astype(np.uint32) << np.uint32(shard_bits))
                shard = (cell >> np.uint64(shard_bits)).astype(np.int64)
                at = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else [0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * (len(at) - 1), pa.int32()), pa.array(shard[at[:-1]].astype(np.int32)),
                     pa.array([packed[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                    names=["row", "shard", "cells"])
        release()

    def merge(batches):
        sums: dict = {}
        for b in batches:
            for r in b.to_pylist():
                packed = np.frombuffer(r["cells"], dtype=np.uint32)
                total = sums.setdefault((r["row"], r["shard"]), np.zeros(1 << shard_bits, dtype=np.uint8))
                cell, n = packed & np.uint32((1 << shard_bits) - 1), packed >> np.uint32(shard_bits)
                total[cell] = np.minimum(total[cell] + n, FREQUENT)          # cells of one payload are distinct
        for (row, shard), total in sums.items():
            yield pa.RecordBatch.from_pydict({
                "row": pa.array([row], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "bits": [np.packbits(total >= 2, bitorder="little").tobytes()],
                "often": [np.flatnonzero(total >= FREQUENT).astype(np.uint32).tobytes()]})

    merged = (docs.mapInArrow(partial, "row int, shard int, cells binary").repartition("row", "shard")
              .mapInArrow(merge, "row int, shard int, bits binary, often binary"))
    repeated = [np.zeros(max(1, (1 << bits) // 8), dtype=np.uint8) for _ in range(ROWS)]
    frequent: list[list] = [[] for _ in range(ROWS)]
    step = max(1, (1 << shard_bits) // 8)
    for r in merged.toLocalIterator():                       # ROWS * 2^bits bits in all: bounded by MAX_CELLS
        at = r["shard"] * step
        repeated[r["row"]][at:at + step] = np.frombuffer(r["bits"], dtype=np.uint8)
        often = np.frombuffer(r["often"], dtype=np.uint32).astype(np.uint64)
        frequent[r["row"]].append(often + np.uint64(r["shard"] << shard_bits))
    none = np.zeros(0, np.uint64)
    return Sketch(bits, repeated, [np.concatenate([none, *f]) for f in frequent])


_RUNS = "anchor bigint, digests binary, refs binary"
_REF = np.dtype([("doc", "<i8"), ("null", "<i8"), ("text", "<i8"), ("word", "<i8")])


def _runs(chunk: Chunk, keys: list, sketch: Sketch):
    """Arrow columns (anchor, digests, refs) of a chunk's candidate runs."""
    if not len(chunk.start):
        return None
    # neighbouring windows of one document under one anchor
    new = np.ones(len(chunk.start), bool)
    new[1:] = (chunk.least[1:] != chunk.least[:-1]) | (np.diff(chunk.start) != 1) | (np.diff(chunk.doc) != 0)
    run = np.cumsum(new) - 1
    twice, often = sketch.least(chunk.least[new])
    keep, alone = twice[run], (twice & often)[run]
    if not keep.any():
        return None
    digest = chunk.digests()[keep]
    new = (new | alone)[keep]                                # frequent anchors: one window per run
    at = np.flatnonzero(new)
    size = np.diff(np.concatenate([at, [len(new)]]))
    anchor = np.where(alone[keep][at], digest[at, 0], chunk.least[keep][at])
    refs = np.zeros(len(at), dtype=_REF)
    doc = chunk.doc[keep][at]
    ids = [keys[d] for d in range(len(keys))]
    refs["doc"] = np.array([0 if i is None else i for i, _ in ids], dtype=np.int64)[doc]
    refs["null"] = np.array([i is None for i, _ in ids], dtype=np.int64)[doc]
    refs["text"] = np.array([t for _, t in ids], dtype=np.int64)[doc]
    refs["word"] = chunk.word[keep][at]
    # equal runs of the chunk become one row with several references
    sign = [np.add.reduceat(_mixed(digest[:, k]), at) + size.astype(np.uint64) for k in (0, 1)]
    order = np.lexsort((digest[at, 0], sign[1], sign[0], anchor))
    same = np.ones(len(order), bool)
    cols = (anchor, sign[0], sign[1], digest[at, 0])
    same[1:] = np.any([c[order][1:] != c[order][:-1] for c in cols], axis=0)
    head = order[same]
    bounds = np.concatenate([np.flatnonzero(same), [len(order)]])
    held = refs[order]
    spans = size[head]
    offsets = np.concatenate([[0], np.cumsum(spans)])
    take = np.repeat(at[head] - offsets[:-1], spans) + np.arange(offsets[-1])
    binary = lambda off, raw: pa.Array.from_buffers(
        pa.binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor[head].view(np.int64)), binary(offsets * 16, digest[take].tobytes()),
         binary(bounds * _REF.itemsize, held.tobytes())], names=["anchor", "digests", "refs"])


def _ranges(batch, window: int):
    """Covered word ranges of the repeated windows among whole anchor groups."""
    digests = [np.frombuffer(d, dtype=np.uint64).reshape(-1, 2) for d in batch.column(1).to_pylist()]
    refs = [np.frombuffer(r, dtype=_REF) for r in batch.column(2).to_pylist()]
    size = np.array([len(d) for d in digests])
    times = np.array([len(r) for r in refs])
    flat = np.concatenate(digests)
    order = np.lexsort((flat[:, 1], flat[:, 0]))
    sorted_ = flat[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
    kind = np.cumsum(new) - 1
    total = np.bincount(kind, weights=np.repeat(times, size)[order])
    hit = np.zeros(len(order), bool)
    hit[order] = total[kind] >= 2
    # runs of hits inside each row become one range
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    begin = hit.copy()
    begin[1:] &= ~(hit[:-1] & (owner[1:] == owner[:-1]))
    end = hit.copy()
    end[:-1] &= ~(hit[1:] & (owner[1:] == owner[:-1]))
    lo, hi = np.flatnonzero(begin), np.flatnonzero(end)
    if not len(lo):
        return None
    row = owner[lo]
    lo, hi = lo - first[row], hi - first[row] + window
    n = times[row]
    which = np.repeat(np.arange(len(row)), n)
    ref = np.concatenate([refs[r] for r in row])
    return pa.RecordBatch.from_arrays(
        [pa.array(ref["doc"], mask=ref["null"] == 1), pa.array(ref["text"]),
         pa.array((ref["word"] + lo[which]).astype(np.int32)), pa.array((ref["word"] + hi[which]).astype(np.int32))],
        names=["doc_id", "text_hash", "lo", "hi"])


def repeated_ranges(docs: DataFrame, window: int = WINDOW, max_cells: int = MAX_CELLS) -> DataFrame:
    """(doc_id, text_hash, ranges) of (doc_id, text_hash, text) rows that hold
    repeated windows; ranges are word positions [lo, hi)."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    anchors = max(1, int(chars / 5 / (window - GRAM + 2) * 2))
    bits = int(min(max_cells, max(1 << 10, CELLS_PER_ANCHOR * anchors)) - 1).bit_length()
    spark = docs.sparkSession
    sketch = build_sketch(docs.select("text"), window, bits)
    held = spark.sparkContext.broadcast((sketch.bits, sketch.repeated, sketch.frequent))

    def emit(batches):
        known = Sketch(*held.value)
        rows = (((i, h), t.split()) for b in batches for x in slices(b) for i, h, t in
                zip(x.column(0).to_pylist(), x.column(1).to_pylist(), byte_texts(x.column(2))))
        for keys, chunk in _chunks(rows, window):
            out = _runs(chunk, keys, known)
            if out is not None:
                yield out
        release()

    def group(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if kept is None else [kept, batch]).combine_chunks()
            batch = table.to_batches()[0]
            anchor = batch.column(0).to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1], side="left"))   # the last anchor may go on
            kept = batch.slice(whole)
            if whole:
                out = _ranges(batch.slice(0, whole), window)
                if out is not None:
                    yield out
        if kept is not None:
            out = _ranges(kept, window)
            if out is not None:
                yield out

    runs = docs.select("doc_id", "text_hash", "text").mapInArrow(emit, _RUNS)
    found = (runs.repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(group, "doc_id bigint, text_hash bigint, lo int, hi int"))
    # ranges of one document: bounded by its words.  Written here, so that the
    # sketch can leave the executors and their workers.
    out = stash(found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")),
                "repeated-ranges")
    held.destroy()
    return out


def _cut(n: int, ranges) -> np.ndarray:
    """True for each of n words that stays."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for r in ranges or ():
        edge[r["lo"]] += 1
        edge[r["hi"]] -= 1
    return np.cumsum(edge[:n]) == 0


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``docs`` plus __ranges (null where nothing repeats)."""
    text, key = F.col(text_col).cast("string"), F.col(id_col).cast("bigint")
    hashed = F.xxhash64(text)
    slim = docs.select(key.alias("doc_id"), hashed.alias("text_hash"), text.alias("text"))
    found = repeated_ranges(slim, window).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("ranges").alias("__ranges"))
    return docs.join(found, key.eqNullSafe(F.col("__id")) & (hashed == F.col("__hash")), "left").drop("__id", "__hash")


def removal_rows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in (x for whole in batches for x in slices(whole)):
            n_words, n_removed, sha = [], [], []
            for t, ranges in zip(byte_texts(b.column(1)), b.column(2).to_pylist()):
                words = t.split()
                stays = _cut(len(words), ranges) if ranges else None
                kept = words if stays is None else [w for w, s in zip(words, stays.tolist()) if s]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return (_with_ranges(slim, "doc_id", "text", window).select("doc_id", "text", "__ranges")
            .mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"))


_TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


def without_ranges(text: str | None, ranges) -> str | None:
    """The text without the words in ``ranges``; white space between words
    that stay neighbours is kept, a removed stretch leaves one line feed if it
    held one, else one space."""
    if text is None or not ranges:
        return text
    raw = text.encode()
    spans = [m.span() for m in _TOKEN.finditer(raw)]
    stays = _cut(len(spans), ranges)
    out, last = [], None
    for k in np.flatnonzero(stays).tolist():
        if last is not None:
            gap = raw[spans[last][1]:spans[k][0]]
            out.append(gap if k == last + 1 else b"\n" if b"\n" in gap else b" ")
        out.append(raw[slice(*spans[k])])
        last = k
    return b"".join(out).decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut out of the text (and the character
    count, if there is such a column, brought up to date).  Documents that had
    words and keep none are dropped."""
    @F.arrow_udf("string")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        out = [pa.array([without_ranges(t, r) for t, r in zip(a.to_pylist(), b.to_pylist())], pa.string())
               for a, b in zip(slices(texts), slices(ranges))]
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    text = F.col(text_col).cast("string")
    held = _with_ranges(docs, id_col, text_col, window).withColumn(
        "__text", F.when(F.col("__ranges").isNull(), text).otherwise(cut(text, F.col("__ranges"))))
    held = held.where(F.col("__ranges").isNull() | (F.col("__text") != ""))
    new = {text_col: F.col("__text")}
    if n_chars_col and n_chars_col in docs.columns:
        new[n_chars_col] = F.when(F.col("__ranges").isNull(), F.col(n_chars_col)).otherwise(
            F.length("__text")).cast(docs.schema[n_chars_col].dataType)
    return held.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def oracle_sql(window: int = WINDOW, docs: str = "documents") -> str:
    """DuckDB SQL for ``removal_rows``."""
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM {docs}),
win AS (
  SELECT rid, i, md5(array_to_string(ws[i:i + {window - 1}], ' ')) AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {window - 2})) AS i FROM base)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n >= 2),
gone AS (SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(i, i + {window})) AS p FROM rep)),
word AS (SELECT rid, p, ws[p] AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS p FROM base)),
kept AS (
  SELECT rid, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS t
  FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT b.doc_id, CAST(len(b.ws) AS BIGINT) AS n_words, CAST(len(b.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256
FROM base b LEFT JOIN kept k USING (rid)"""
