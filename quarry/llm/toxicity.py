"""Toxicity scoring with a factorization machine over hashed terms.

A document is the set of its hashed words.  The machine adds a linear weight
per term and, through a short factor per term, an interaction for every pair
of terms present: an insult next to a group mention may count for more than
both weights together.  It is trained in numpy with Adam on a bounded,
documented sample of labelled rows (``TRAIN_ROWS``, chosen by a hash of the
id); scoring reads every whole text.

Defined cases: a null or empty text has no terms and gets the score of the
bias alone; labels that are null or neither 0 nor 1 are ignored, repeated
labels of an id count once (toxic wins); without usable labels every score is
0; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, stash

BUCKET_BITS = 22
TRAIN_ROWS = 20_000         # bound of the labelled sample
TERMS = 1_024               # terms the machine keeps at most for their evidence
FREQUENT_TERMS = 512        # terms it keeps for their frequency
LEAST_Z = 5.0               # least evidence (z of the classes' document shares)
SURE_Z = 8.0                # evidence from which a term starts with its log-odds as weight
FACTORS = 8
EPOCHS = 12
MIN_STEPS = 1_000           # small samples get more epochs
BATCH = 128
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_MASK = (1 << BUCKET_BITS) - 1


def word_terms(word: str) -> list[int]:
    """Hash buckets of a word and of its 4- and 5-letter beginnings, so that
    inflected forms share a term."""
    out = [zlib.crc32(word.encode()) & _MASK]
    return out + [zlib.crc32(f"{word[:k]}*".encode()) & _MASK for k in (4, 5) if len(word) >= k]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def terms(text: str | None) -> set[int]:
    return {b for w in words(text) for b in word_terms(w)}


class Machine:
    """bias + sum of weights + pairwise interactions of the present terms."""

    def __init__(self, vocab, bias, w, v):
        self.vocab, self.bias, self.w, self.v = vocab, bias, w, v
        self.index = {int(b): j for j, b in enumerate(vocab)}
        self.seen: dict = {}

    def known(self, word: str) -> tuple:
        """Kept terms of a word (remembered: most words have none)."""
        got = self.seen.get(word)
        if got is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            got = self.seen[word] = tuple(self.index[b] for b in word_terms(word) if b in self.index)
        return got

    def margin(self, text: str | None) -> float:
        j = sorted({i for w in words(text) for i in self.known(w)})
        if not j:
            return float(self.bias)
        v = self.v[j]
        total = v.sum(axis=0)
        return float(self.bias + self.w[j].sum() + 0.5 * (total @ total - (v * v).sum()))


def train(rows: list[np.ndarray], labels: list[int], vocab: np.ndarray, odds: np.ndarray,
          seed: int = 7) -> Machine:
    """Adam with decoupled weight decay on the logistic loss; the rarer class
    is weighted up to a quarter of the total.  ``rows`` hold positions in
    ``vocab``; ``odds`` are the weights to start from."""
    y = np.asarray(labels, dtype=np.float64)
    rng = np.random.default_rng(seed)
    n = len(vocab)
    prior = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
    if not len(y):
        return Machine(vocab, -np.inf, np.zeros(0), np.zeros((0, FACTORS)))
    bias = np.log(prior / (1 - prior))
    params = [np.array([bias]), np.array(odds, dtype=np.float64), rng.normal(0, 0.05, (n, FACTORS))]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    decay = (0.0, 2e-2, 5e-2)
    heavy = max(1.0, (len(y) - y.sum()) / max(y.sum(), 1) / 3)
    step = 0
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // len(y)))
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(y))
        for k in range(0, len(order), BATCH):
            take = order[k:k + BATCH]
            x = np.zeros((len(take), n))
            for i, r in enumerate(take):
                x[i, rows[r]] = 1.0
            _, w, v = params
            total = x @ v
            margin = params[0][0] + x @ w + 0.5 * ((total ** 2).sum(1) - x @ (v * v).sum(1))
            err = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[take]
            err *= np.where(y[take] > 0, heavy, 1.0) / len(take)
            xe = x.T @ err
            grads = [np.array([err.sum()]), xe, x.T @ (err[:, None] * total) - v * xe[:, None]]
            step += 1
            for p, g, m, s, d in zip(params, grads, first, second, decay):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9 ** step) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8) + d * p)
    return Machine(vocab, params[0][0], params[1], params[2])


def labelled_sample(docs: DataFrame, labels: DataFrame, n_rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most ``n_rows`` training documents (fold not 1)."""
    chosen = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .where(fold("doc_id", 3) != 1)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n_rows))       # bounded: broadcast below
    return docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def select_terms(sample: DataFrame):
    """(buckets, start weights) of the terms that the classes use most
    unevenly, and of the most frequent ones (interaction partners may be
    neutral alone).  Only the chosen terms reach the driver."""
    def run(batches):
        import pyarrow as pa
        neg = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
        pos = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = np.fromiter(terms(t), dtype=np.int64)
                (pos if y else neg)[got] += 1
        at = np.flatnonzero(pos + neg)
        for k in range(0, len(at), 50_000):
            i = at[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(pos[i]), pa.array(neg[i])],
                                             names=["bucket", "pos", "neg"])

    size = sample.groupBy("toxic").count().collect()                        # two rows
    n1 = max(sum(r["count"] for r in size if r["toxic"]), 1)
    n0 = max(sum(r["count"] for r in size if not r["toxic"]), 1)
    p1, p0 = F.col("pos") / n1, F.col("neg") / n0
    both = (F.col("pos") + F.col("neg")) / (n1 + n0)
    z = F.abs(p1 - p0) / F.sqrt(both * (1 - both) * (1 / n1 + 1 / n0) + 1e-9)
    odds = F.log((F.col("pos") + 0.5) / (n1 + 1)) - F.log((F.col("neg") + 0.5) / (n0 + 1))
    counted = (sample.mapInArrow(run, "bucket int, pos int, neg int").groupBy("bucket")
               .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
               .where(F.col("pos") + F.col("neg") >= 3)
               .select("bucket", (F.col("pos") + F.col("neg")).alias("df"), z.alias("z"), odds.alias("odds")))
    counted = stash(counted, "toxic-terms")
    top = lambda rows, c, n: rows.orderBy(F.desc(c), "bucket").limit(n).collect()
    chosen = {r["bucket"]: r for r in [*top(counted.where(F.col("z") >= LEAST_Z), "z", TERMS),
                                       *top(counted, "df", FREQUENT_TERMS)]}
    vocab = np.array(sorted(chosen), dtype=np.int64)
    sure = [chosen[b] for b in vocab.tolist()]
    return vocab, np.array([r["odds"] if r["z"] >= SURE_Z else 0.0 for r in sure])


def fit(docs: DataFrame, labels: DataFrame, n_rows: int = TRAIN_ROWS) -> Machine:
    sample = stash(labelled_sample(docs, labels, n_rows).select("text", F.col("toxic").cast("int").alias("toxic")),
                   "toxic-sample")
    vocab, odds = select_terms(sample)
    index = {int(b): j for j, b in enumerate(vocab)}

    def run(batches):
        import pyarrow as pa
        for b in batches:
            got = [np.array(sorted(index[x] for x in terms(t) if x in index), dtype=np.int32).tobytes()
                   for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary()), b.column(1)], names=["ids", "toxic"])

    got = sample.mapInArrow(run, "ids binary, toxic int").collect()         # n_rows x TERMS small ints at most
    got.sort(key=lambda r: (r["toxic"], bytes(r["ids"])))                   # order of tasks must not matter
    return train([np.frombuffer(r["ids"], dtype=np.int32) for r in got], [r["toxic"] for r in got], vocab, odds)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
          n_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    machine = fit(slim, labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic"), n_rows)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            margin = np.array([machine.margin(t) for t in b.column(2).to_pylist()], dtype=np.float64)
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-margin))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return (slim.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text")
            .mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int"))
