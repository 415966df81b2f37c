"""Best-fit packing of tokenised documents by exact-complement hashing.

Only the *histogram* of piece lengths (at most ``seq_len`` counts) decides
how sequences are filled, so the plan is made from a table of bounded size
whatever the corpus holds:

1. index single, pair and triple sums of the lengths still available; going
   from the longest length down, consume the combinations that exactly fill
   its gap, as often as the availability counts allow;
2. best-fit the residual lengths, longest first, into the open bin with the
   least sufficient room.

Exact combinations can spend the short pieces that longer ones need, so the
histogram is also packed by best fit alone and the plan of fewer sequences is
taken.

Each piece then finds its place from its rank among the pieces of equal
length.  Ranks come from per-task counters plus per-(task, length) offsets,
so no length, however frequent, is gathered in one place.

Defined cases: null text counts as empty and gives one piece holding only the
end id; repeated rows are packed separately; an empty table gives no rows;
null ids are kept; further columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, slices, stash

SEQ_LEN = 2048
CACHE_CHUNKS = 200_000      # tokenised chunks a worker remembers (speed only)

_PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
           "task int, task_rank bigint")


# Fixed value: the pattern by which byte-level BPE vocabularies of this family
# split text before merging.
SPLIT_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


@lru_cache(maxsize=1)
def _whole(path: str):
    """The tokenizer itself, for texts that are encoded whole."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """(special texts, chunks remembered by tiktoken running the same merges).

    tiktoken gives the same ids several times faster for single chunks; the
    tests hold both against each other.
    """
    import json

    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    # byte-level vocabularies write each byte as a printable character
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of.update({chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))})
    specials = [t["content"] for t in spec["added_tokens"]]
    ranks = {bytes(byte_of[c] for c in word): i for word, i in vocab.items() if word not in specials}
    fast = tiktoken.Encoding("chunks", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return specials, _Chunks(fast.encode_ordinary)


class _Chunks(dict):
    """Id bytes of chunks, encoded on first use."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if chunk[-1:] in (",", ".") and chunk[-2:-1].isalnum():      # the mark is a token of its own
            got = self[chunk[:-1]] + self[chunk[-1]]
        else:
            got = _id_bytes(self.encode(chunk))
        self[chunk] = got
        return got


# White space (or runs of it) next to which a cut could change the tokens.
_NO_CUT = ["\0", "  ", "\n\n", "\n ", " \n", *(chr(i) for i in range(sys.maxunicode + 1)
                                               if chr(i).isspace() and chr(i) not in " \n")]


def _id_bytes(ids) -> bytes:
    return array("I", ids).tobytes()


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Token ids of each text as little-endian u32 bytes.

    In byte-level BPE a lone space between two words always starts a token
    and a lone line feed is one token, so the chunks between them are encoded
    independently and remembered.  Texts with other white space, or with the
    text of a special token, are encoded whole.
    """
    specials, cache = _tokenizer(path)
    if len(cache) > CACHE_CHUNKS:
        cache.clear()
    chunk_ids, feed = cache.__getitem__, cache["\n"]
    out = []
    for text in texts:
        if not text:
            out.append(b"")
        elif any(s in text for s in _NO_CUT) or text[0] in " \n" or text[-1] in " \n" \
                or any(s in text for s in specials):
            out.append(_id_bytes(_whole(path).encode(text, add_special_tokens=False).ids))
        else:
            out.append(feed.join([b"".join(map(chunk_ids, line.replace(" ", "\0 ").split("\0")))
                                  for line in text.split("\n")]))
    return out


def cut(n_ids: int, seq_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter."""
    first = n_ids % seq_len or seq_len
    return [(0, first)] + [(s, seq_len) for s in range(first, n_ids, seq_len)]


def token_pieces(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with its rank among equal lengths in its task."""
    tail = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        seen = [0] * (seq_len + 1)
        for batch in (x for whole in batches for x in slices(whole)):
            cols: list[list] = [[] for _ in range(7)]
            ids = batch.column(0).to_pylist()
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for doc_id, buf in zip(ids, encode_texts(texts, tokenizer_path)):
                buf += tail
                view = memoryview(buf)
                for k, (start, length) in enumerate(cut(len(buf) // 4, seq_len)):
                    row = (doc_id, k, start, length, zlib.crc32(view[4 * start:4 * (start + length)]),
                           task, seen[length])
                    seen[length] += 1
                    for c, v in zip(cols, row):
                        c.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"])
        _tokenizer(tokenizer_path)[1].clear()
        release()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, _PIECES)


class _Fill:
    """Availability counts of lengths and the bins made from them."""

    def __init__(self, counts: dict[int, int], seq_len: int):
        self.cap = seq_len
        self.left = np.zeros(seq_len + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.bins: list[tuple[dict[int, int], int]] = []       # ({length: times}, number of bins)
        # index of the sums that two and three available lengths can make
        have = (self.left > 0).astype(float)
        self.pair_sums = np.convolve(have, have)[:seq_len + 1] > 0.5
        self.triple_sums = np.convolve(self.pair_sums.astype(float), have)[:seq_len + 1] > 0.5

    def consume(self, *lengths: int) -> bool:
        """Make as many bins of this combination as the counts allow."""
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        n = min(int(self.left[x]) // k for x, k in need.items())
        if n <= 0:
            return False
        for x, k in need.items():
            self.left[x] -= n * k
        self.bins.append((need, n))
        return True

    def pair(self, total: int, most: int):
        """Available (b, c) with b + c == total, most >= b >= c; longest b first."""
        hi = min(most, total - 1)
        lo = (total + 1) // 2
        if hi < lo:
            return
        b = np.arange(hi, lo - 1, -1)
        for x in b[(self.left[b] > 0) & (self.left[total - b] > 0)].tolist():
            yield x, total - x

    def exact(self) -> None:
        for a in range(self.cap, 0, -1):
            if not self.left[a]:
                continue
            gap = self.cap - a
            if not gap:
                self.consume(a)
                continue
            if gap <= a:
                self.consume(a, gap)                                  # single fills the gap
            if self.left[a] and self.pair_sums[gap]:
                for b, c in self.pair(gap, a):                        # a pair fills it
                    self.consume(a, b, c)
                    if not self.left[a]:
                        break
            if self.left[a] and self.triple_sums[gap]:
                for b in range(min(a, gap - 2), (gap + 2) // 3 - 1, -1):   # a triple fills it
                    if not self.left[b] or not self.pair_sums[gap - b]:
                        continue
                    for c, d in self.pair(gap - b, b):
                        self.consume(a, b, c, d)
                        if not self.left[b] or not self.left[a]:
                            break
                    if not self.left[a]:
                        break

    def best_fit(self) -> None:
        open_bins: dict[int, list] = {}                               # room -> [[pattern, n], ...]
        for x in range(self.cap, 0, -1):
            n = int(self.left[x])
            self.left[x] = 0
            while n:
                room = min((r for r in open_bins if r >= x), default=None)
                if room is None:
                    per = self.cap // x
                    if n >= per:
                        made, per_bin = n // per, per
                    else:
                        made, per_bin = 1, n
                    open_bins.setdefault(self.cap - x * per_bin, []).append([{x: per_bin}, made])
                    n -= made * per_bin
                    continue
                pattern, have = open_bins[room][-1]
                per = min(room // x, n)
                take = min(have, n // per)
                if take == have:
                    open_bins[room].pop()
                    if not open_bins[room]:
                        del open_bins[room]
                else:
                    open_bins[room][-1][1] = have - take
                grown = dict(pattern)
                grown[x] = grown.get(x, 0) + per
                open_bins.setdefault(room - x * per, []).append([grown, take])
                n -= take * per
        self.bins.extend((p, n) for groups in open_bins.values() for p, n in groups)


def plan_bins(counts: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[dict[int, int], int]]:
    """``[({length: times}, number of equal bins), ...]`` using every piece once."""
    plans = []
    for combine in (True, False):
        fill = _Fill(counts, seq_len)
        if combine:
            fill.exact()
        fill.best_fit()
        plans.append(fill.bins)
    return min(plans, key=lambda bins: sum(n for _, n in bins))         # the first of equals


def _slots(bins) -> np.ndarray:
    """Rows (length, first rank, times per bin, first sequence, offset), sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in bins:
        offset = 0
        for length in sorted(pattern, reverse=True):
            times = pattern[length]
            rows.append((length, used.get(length, 0), times, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += length * times
        sequence += n
    rows.sort()
    return np.asarray(rows, dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``."""
    pieces = stash(token_pieces(docs, tokenizer_path, seq_len, end_id, id_col, text_col), "pack-pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # at most seq_len rows reach the driver
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(plan_bins(counts, seq_len))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(offsets, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("task_rank")).alias("rank"))
    shift = 1 << 48                                                   # ranks of one length stay below
    keys = slots[:, 0] * shift + slots[:, 1]

    def place(batches):
        import pyarrow as pa
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            s = slots[np.searchsorted(keys, length * shift + rank, side="right") - 1]
            q = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(s[:, 3] + q // s[:, 2]),
                 pa.array(s[:, 4] + (q % s[:, 2]) * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, "
                                    "ids_crc32 bigint, sequence_id bigint, offset bigint")
