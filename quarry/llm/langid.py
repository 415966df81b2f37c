"""Language identification with error-correcting output codes.

Each language gets a codeword; one binary classifier per bit tells, from
hashed character 1- to 3-grams, on which side of the bit a text lies.  A
bit's classifier is the log-odds of the n-grams under the two sides, every
language weighing the same, and its counts cover all training documents.
Decoding chooses the codeword with the least loss over all bits; a bit counts
by how often it was right on a bounded sample of training documents.  Wrong
bits are outvoted as long as fewer than half the code distance fail; a small
lead over the second codeword is flagged as ambiguous.

Defined cases: null texts and texts without a letter give ``und`` with score
0; without training rows every text does; rows whose lang is null are not
trained on; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

BUCKETS = 1 << 14
CHECK_ROWS = 4_000          # bound of the sample that weighs the bits
EXHAUSTIVE = 7              # up to this many languages all 2^(k-1) - 1 bits are used
AMBIGUOUS = 0.2             # least relative lead in loss
FULL_GRAMS = 64             # n-grams from which a margin counts in full
_CHUNK = 1 << 20            # characters handled at once


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself if it is a letter, else 0."""
    import sys
    return np.array([i if chr(i).isalpha() else 0 for i in range(sys.maxunicode + 1)], dtype=np.uint32)


def _grams(texts: list[str]):
    """(buckets, owner) of the n-grams of a list of texts."""
    pad = "\0\0\0"
    flat = pad + pad.join(texts) + pad
    x = _letters()[np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    lengths = np.array([len(t) + 3 for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    owner = np.concatenate([[0] * 3, owner])
    a = x.astype(np.uint64)
    one, two, three = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    out_b, out_o = [], []
    has = x != 0
    h1 = (a * one) >> shift
    out_b.append(h1[has])
    out_o.append(owner[has])
    m2 = has[:-1] | has[1:]
    h2 = (((a[:-1] * one) ^ (a[1:] + two) * three)) * two >> shift
    out_b.append(h2[m2])
    out_o.append(np.where(has[:-1], owner[:-1], owner[1:])[m2])     # the letter's text, not the padding's
    m3 = has[1:-1]
    h3 = (((a[:-2] * three) ^ (a[1:-1] + one) * two) + (a[2:] + three) * one) * three >> shift
    out_b.append(h3[m3])
    out_o.append(owner[1:-1][m3])
    return out_b, out_o


def _chunks(texts: list[str]):
    """(first, last) index ranges of about _CHUNK characters each."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _CHUNK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def codewords(n: int) -> np.ndarray:
    """(n, bits) matrix of +1/-1; distinct rows, no constant column."""
    if n == 1:
        return np.ones((1, 1))
    if n <= EXHAUSTIVE:
        bits = [[1 if (m >> j) & 1 else -1 for j in range(n)] for m in range(1, 1 << (n - 1))]
        return np.array(bits, dtype=np.float64).T
    width = int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for seed in range(50):                                       # best of a fixed series of random codes
        c = np.random.default_rng(seed).choice([-1.0, 1.0], (n, width))
        gap = (width - np.max(c @ c.T - 2 * width * np.eye(n))) / 2
        if gap > far and (np.abs(c.sum(0)) < n).all():
            best, far = c, gap
    return best


class Decoder:
    """Codewords, one n-gram table per bit, and the weights of the bits."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.code = codewords(len(langs))
        p = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        on, off = (self.code > 0).astype(float), (self.code < 0).astype(float)
        side1 = on.T @ p / np.maximum(on.sum(0), 1)[:, None]
        side0 = off.T @ p / np.maximum(off.sum(0), 1)[:, None]
        if len(langs) == 1:
            side0 = side1
        self.table = np.log(side1 / side0).T.astype(np.float32)          # (buckets, bits)
        self.weight = np.ones(self.code.shape[1])

    def margins(self, texts: list[str]):
        """(texts, bits) mean log-odds per n-gram, and the number of n-grams."""
        f = np.zeros((len(texts), self.code.shape[1]))
        n = np.zeros(len(texts))
        for lo, hi in _chunks(texts):
            for b, o in zip(*_grams(texts[lo:hi])):
                n[lo:hi] += np.bincount(o, minlength=hi - lo)
                for bit in range(f.shape[1]):
                    f[lo:hi, bit] += np.bincount(o, weights=self.table[b, bit], minlength=hi - lo)
        return f / np.maximum(n, 1)[:, None], n

    def decode(self, texts: list[str]):
        """(language, score, ambiguous) lists."""
        f, n = self.margins(texts)
        steep = np.clip(f * np.minimum(n, FULL_GRAMS)[:, None] / 8, -30, 30)   # short texts say less
        loss = np.stack([(self.weight * np.log1p(np.exp(-c * steep))).sum(1) for c in self.code], axis=1)
        like = np.exp(-(loss - loss.min(1, keepdims=True)))
        best = loss.argmin(1)
        score = like[np.arange(len(best)), best] / like.sum(1)
        part = np.sort(loss, axis=1)
        close = (part[:, 1] - part[:, 0] < AMBIGUOUS * part[:, 1]) if part.shape[1] > 1 else np.zeros(len(n), bool)
        lang = [self.langs[j] if k else "und" for j, k in zip(best, n)]
        return lang, np.where(n > 0, score, 0.0), close | (n == 0)


def fit(train: DataFrame, check_rows: int = CHECK_ROWS) -> Decoder | None:
    """From (doc_id, text, lang).  Counts cover all rows; what reaches the
    driver is languages x buckets counts."""
    def run(batches):
        import pyarrow as pa
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_pylist()
            texts = [(t or "").lower() for t in b.column(0).to_pylist()]
            for x in set(langs):
                own = [t for t, y in zip(texts, langs) if y == x]
                total = sums.setdefault(x, np.zeros(BUCKETS, dtype=np.int64))
                for lo, hi in _chunks(own):
                    for g in _grams(own[lo:hi])[0]:
                        total += np.bincount(g.astype(np.int64), minlength=BUCKETS)
        for x, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["lang", "bucket", "n"])

    rows = (train.select("text", "lang").mapInArrow(run, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())
    if not rows:
        return None
    langs = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(langs), BUCKETS))
    for r in rows:
        counts[langs.index(r["lang"]), r["bucket"]] = r["n"]
    model = Decoder(langs, counts)
    sample = (train.where(F.col("lang").isin(langs)).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
              .limit(check_rows))                                 # bounded: broadcast below

    def margins(batches):                                         # per bit: right and seen
        import pyarrow as pa
        for b in batches:
            truth = b.column(1).to_pylist()
            f, n = model.margins([(t or "").lower() for t in b.column(0).to_pylist()])
            keep = n > 0
            code = model.code[[langs.index(x) for x in truth]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([((f * code)[keep] > 0).sum(0).tolist()], pa.list_(pa.int64())),
                 pa.array([int(keep.sum())], pa.int64())], names=["right", "seen"])

    got = (train.join(F.broadcast(sample.distinct()), "doc_id", "left_semi").where(F.col("lang").isin(langs))
           .select("text", "lang").mapInArrow(margins, "right array<bigint>, seen bigint").collect())
    seen = sum(r["seen"] for r in got)
    if seen:
        right = (np.sum([r["right"] for r in got], axis=0) + 1) / (seen + 2)
        model.weight = np.maximum(np.log(right / (1 - right)), 0.05)
    return model


def predict(docs: DataFrame, check_rows: int = CHECK_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), (fold("doc_id", 3) == 1).alias("held_out"))
    model = fit(slim.where(~F.col("held_out") & F.col("lang").isNotNull()), check_rows)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = [(t or "").lower() for t in b.column(2).to_pylist()]
            lang, score, close = model.decode(texts) if model and texts else (
                ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(close)],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return slim.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean")
