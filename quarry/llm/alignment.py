"""Alignment of the tokens of two tokenizers over the same text.

Both token sequences of a text cover the same bytes.  Interval coalescing
finds the smallest groups of A and B tokens that cover equal byte ranges: all
tokens are sorted by start (``lexsort``), ``maximum.accumulate`` gives the
furthest end so far, and a group starts where a token's start reaches it.
Inside a group the overlapping pairs are expanded from the sorted ends.

A lone space or line break between two characters that are not white space
starts a token in both vocabularies, and so does a comma or full stop between
a Latin letter and white space (checked on the vocabulary: no piece holds a line
break, or a letter before such a mark), so no group crosses one.  Texts are
cut there and the distinct chunks of a block of texts are encoded and
coalesced together, once.

Links are the A-B token pairs whose byte ranges end together
(``links="end"``) or overlap (``links="overlap"``).  Corpus-wide counts of
id pairs come from per-document distinct pairs.  Pairs that hold at least one
in ``HEAD`` of all links (so at most ``HEAD`` of them) are broadcast with
their counts; the rest, none of which is frequent, meets its counts in a
shuffle join.

Defined cases: null and empty texts, texts that are not valid UTF-8 and texts
whose joined A or B bytes differ from space + text have no tokens: zeros and
an empty string; special-token strings in a text are ordinary text; repeated
rows count as often as they occur; null ids are kept; an empty table gives no
rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, release, slices, stash

HEAD = 1 << 18              # broadcast pairs hold at least 1/HEAD of all links each
CACHE_CHUNKS = 300_000      # aligned chunks a worker remembers (speed only)

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_COLUMNS = ("doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "groups string, groups_sha256 string, pairs array<bigint>, times array<int>")


# ---- interval coalescing ----------------------------------------------------

def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): tokens sorted by start (ties by place) and the group of
    each sorted token.  A group starts where a start reaches the furthest end
    before it."""
    order = np.lexsort((np.arange(len(starts)), starts))
    furthest = np.maximum.accumulate(ends[order]) if len(order) else ends
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = starts[order][1:] >= furthest[:-1]
    return order, np.cumsum(opens) - 1


def end_pairs(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the A and B tokens that end together."""
    _, a_at, b_at = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    return a_at, b_at


def overlap_pairs(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all overlapping A and B tokens; each sequence is gapless
    from the same start, so a token's partners are one run."""
    a_starts = np.concatenate([np.zeros(1, a_ends.dtype), a_ends[:-1]])[:len(a_ends)]
    first = np.searchsorted(b_ends, a_starts, side="right")
    last = np.searchsorted(b_ends, a_ends, side="left")
    n = last - first + 1
    a_at = np.repeat(np.arange(len(a_ends)), n)
    run_start = np.repeat(np.cumsum(n) - n, n)
    return a_at, np.arange(len(a_at)) - run_start + np.repeat(first, n)


_PAIRS = {"end": end_pairs, "overlap": overlap_pairs}


# ---- the two vocabularies ---------------------------------------------------

class _Vocabularies:
    """Ids and token bytes of both tokenizers, for whole chunks of text."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        from .packing import SPLIT_PATTERN
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        # byte-level vocabularies write each byte as a printable character
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(x): x for x in plain}
        shown.update({chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(plain)))})
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if token in special else bytes(map(shown.__getitem__, token))
        # the same merges, faster for single chunks; used where both engines know every letter
        ranks = {self.a_bytes[i]: i for token, i in self.a.get_vocab().items() if token not in special}
        self.fast = tiktoken.Encoding("chunks", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(n[1:-1], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                        for i, n in enumerate(names)]
        whole = [n for i, n in enumerate(names) if not self.b.is_byte(i)]
        # where no token of either vocabulary crosses: see the module's text
        marks = [m for m in ",." if not any(re.search(f"[{_LETTERS}]{re.escape(m)}", n) for n in whole)]
        cuts = [r"(?<=\S)(?= \S)"]
        self.breaks = not any("\n" in n for n in whole)
        if self.breaks:
            cuts.append(r"(?<=\S)(?=\n\S)")
            if marks:
                cuts.append(f"(?<=[{_LETTERS}])(?=[{''.join(marks)}](?:[ \\n]|$))")
        self.cut = re.compile("|".join(cuts))

    def split(self, text: str) -> list[str]:
        return self.cut.split(" " + text)

    def a_ids(self, chunks: list[str]) -> list[list[int]]:
        out = [self.fast(c) if c.isascii() or max(c) < "\u0250" else None for c in chunks]
        odd = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(odd, self.a.encode_batch([chunks[i] for i in odd], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def b_ids(self, chunks: list[str]) -> list[list[int]]:
        """The encoder puts a space before every text: chunks that begin with
        one are given without it, others behind a line break, which is always a
        token of its own."""
        drop = [0 if c[0] == " " else 1 if c[0] == "\n" else 2 for c in chunks]
        given = [c[1:] if d == 0 else c if d == 1 else "\n" + c for c, d in zip(chunks, drop)]
        return [ids[d:] if d else ids for ids, d in zip(self.b.encode(given, num_threads=1), drop)]


@lru_cache(maxsize=1)
def _vocabularies(a_path: str, b_path: str) -> _Vocabularies:
    return _Vocabularies(a_path, b_path)


class _Aligner:
    """Aligned chunks of text, remembered by number.

    ``counts`` holds a chunk's A tokens, B tokens and groups; its links are the
    run ``first`` .. of ``keys``; ``shown`` is its groups as text, each with a
    closing ``;`` (None: the bytes do not agree).
    """

    def __init__(self, a_path: str, b_path: str, links: str):
        self.v, self.pairs = _vocabularies(a_path, b_path), _PAIRS[links]
        # texts of ids by (side, last of its group's side)
        n_a, n_b = len(self.v.a_bytes), len(self.v.b_bytes)
        self.texts_of = [f"{i}{sep}" for n, seps in ((n_a, ",|"), (n_b, ",;")) for sep in seps for i in range(n)]
        self.offsets = np.asarray([0, n_a, 2 * n_a, 2 * n_a + n_b])
        self.text_len = np.asarray([len(x) for x in self.texts_of])
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.shown: list = []
        self.counts = np.zeros((0, 3), dtype=np.int64)
        self.first = np.zeros(1, dtype=np.int64)
        self.keys = np.zeros(0, dtype=np.int64)

    def _fitting(self, chunks, a, b):
        """Chunks whose joined A and B bytes are the chunk itself."""
        whole = "".join(chunks).encode()
        if b"".join([self.v.a_bytes[i] for ids in a for i in ids]) == whole \
                and b"".join([self.v.b_bytes[i] for ids in b for i in ids]) == whole:
            return [True] * len(chunks)
        return [b"".join([self.v.a_bytes[i] for i in x]) == b"".join([self.v.b_bytes[i] for i in y]) == c.encode()
                for c, x, y in zip(chunks, a, b)]

    def learn(self, chunks: list[str]) -> None:
        """Align new chunks together: one line of bytes over all of them."""
        a, b = self.v.a_ids(chunks), self.v.b_ids(chunks)
        fits = self._fitting(chunks, a, b)
        if not all(fits):
            a = [x if f else [] for x, f in zip(a, fits)]
            b = [x if f else [] for x, f in zip(b, fits)]
        n_a = np.fromiter(map(len, a), np.int64, len(a))
        n_b = np.fromiter(map(len, b), np.int64, len(b))
        a_ids = np.fromiter(chain.from_iterable(a), np.int64, int(n_a.sum()))
        b_ids = np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum()))
        a_ends = np.cumsum(np.asarray([len(x) for x in self.v.a_bytes])[a_ids])
        b_ends = np.cumsum(np.asarray([len(x) for x in self.v.b_bytes])[b_ids])
        starts = np.concatenate([[0], a_ends[:-1], [0], b_ends[:-1]]) if len(a_ids) else np.zeros(0, np.int64)
        order, sorted_group = coalesce(starts, np.concatenate([a_ends, b_ends]))
        group = np.empty(len(order), dtype=np.int64)
        group[order] = sorted_group
        side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
        # groups as text: A's tokens, then B's, a separator behind each
        line = np.lexsort((np.arange(len(group)), side, group))
        last = np.ones(len(line), dtype=np.int64)
        last[:-1] = (group[line][1:] != group[line][:-1]) | (side[line][1:] != side[line][:-1])
        code = np.concatenate([a_ids, b_ids])[line] + self.offsets[side[line] * 2 + last]
        text = "".join([self.texts_of[c] for c in code.tolist()])
        text_end = np.cumsum(self.text_len[code])
        done = np.cumsum(n_a + n_b)                         # tokens up to each chunk's end, in `line` too
        cut = np.concatenate([[0], text_end])[np.concatenate([[0], done])].tolist()
        self.shown += [text[p:q] if f else None for p, q, f in zip(cut, cut[1:], fits)]
        a_done = np.concatenate([[0], np.cumsum(n_a)])
        opens = np.concatenate([group[:len(a_ids)], [sorted_group[-1] + 1 if len(order) else 0]])
        n_groups = np.diff(opens[a_done])                   # groups begin with an A token each
        a_at, b_at = self.pairs(a_ends, b_ends)
        first = np.searchsorted(a_at, a_done)
        known = len(self.number)
        self.number.update(zip(chunks, range(known, known + len(chunks))))
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups], 1)])
        self.first = np.concatenate([self.first, self.first[-1] + first[1:]])
        self.keys = np.concatenate([self.keys, (a_ids[a_at] << 32) | b_ids[b_at]])

    def texts(self, texts: list[bytes]):
        """Per text None (no tokens) or (A tokens, B tokens, groups, links,
        groups as text, id pairs, times of each)."""
        split = []
        for raw in texts:
            try:
                split.append(self.v.split(raw.decode()) if raw else None)
            except UnicodeDecodeError:
                split.append(None)
        if len(self.number) > CACHE_CHUNKS or len(self.keys) > 8 * CACHE_CHUNKS:
            self.forget()
        new = list(dict.fromkeys(c for cs in split if cs for c in cs if c not in self.number))
        for lo in range(0, len(new), 50_000):
            self.learn(new[lo:lo + 50_000])
        out = []
        for cs in split:
            if cs is None:
                out.append(None)
                continue
            numbers = list(map(self.number.__getitem__, cs))
            shown = list(map(self.shown.__getitem__, numbers))
            if None in shown:
                out.append(None)
                continue
            at = np.asarray(numbers)
            lo, n = self.first[at], self.first[at + 1] - self.first[at]
            total = int(n.sum())
            keys = self.keys[np.arange(total) + np.repeat(lo - (np.cumsum(n) - n), n)]
            out.append((*(int(x) for x in self.counts[at].sum(0)), total, "".join(shown)[:-1],
                        *np.unique(keys, return_counts=True)))
        return out


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
               links: str = "end", with_groups: bool = True) -> DataFrame:
    """Per document its token counts, the groups as text (``a1,a2|b1;a3|b2``;
    null unless ``with_groups``), their digest, and its distinct linked id
    pairs (A id x 2^32 + B id) with the times each occurs."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        aligner = _Aligner(a_path, b_path, links)
        for batch in (x for whole in batches for x in slices(whole, 128)):
            cols: list[list] = [[] for _ in range(8)]
            texts = byte_texts(batch.column(1))
            for got in aligner.texts(texts):
                if got is None:
                    got = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))
                *counts, groups, keys, times = got
                digest = sha256(groups.encode()).hexdigest() if groups else ""
                for col, v in zip(cols, (*counts, groups if with_groups else None, digest, keys, times)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(range(row, row + len(texts)), pa.int64()),
                 *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:6]),
                 pa.array(cols[6], pa.list_(pa.int64())), pa.array(cols[7], pa.list_(pa.int32()))],
                names=[c.split()[0] for c in _COLUMNS.split(", ")])
            row += len(texts)
        del aligner
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _COLUMNS)


def pair_counts(aligned: DataFrame, pairs: str = "pairs", times: str = "times") -> DataFrame:
    """(pair, a_id, b_id, count): the links of each id pair over all documents."""
    return (aligned.select(F.inline(F.arrays_zip(F.col(pairs).alias("pair"), F.col(times).alias("n"))))
            .groupBy("pair").agg(F.sum("n").alias("count"))
            .select("pair", F.shiftright("pair", 32).cast("int").alias("a_id"),
                    F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"), "count"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          links: str = "end", head: int = HEAD) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = stash(alignments(docs, a_path, b_path, id_col, text_col, links, with_groups=False), "alignments")
    counts = stash(pair_counts(aligned), "pair-counts")
    # one row per B id: bounded by the vocabulary
    top = counts.groupBy("b_id").agg(F.max("count").alias("top"))
    known = counts.join(F.broadcast(top), "b_id").select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = F.col("count") * head >= total               # at most `head` pairs reach total / head
    common = F.broadcast(known.where(frequent))
    found = aligned.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("n"))))
    rare = found.join(F.broadcast(known.where(frequent).select("pair")), "pair", "left_anti").join(known.where(~frequent), "pair")
    sums = (found.join(common, "pair").unionByName(rare)
            .groupBy("row").agg(F.sum(F.col("n") * F.col("best")).alias("n_best"),
                                F.sum(F.col("n") * F.col("count")).alias("count_sum")))
    return (aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
