"""Text scoring with a small causal self-attention model over subword ids.

The model is trained in numpy.  A word is written as the ids of its subwords,
the last one flagged, so that no word's code starts another's; a document is
its words and one end.  One attention head with learned position biases reads
a window of ``CONTEXT + STRIDE`` symbols and predicts the class of each next
symbol; the symbol inside its class follows the counts of the whole training
corpus.  Windows overlap by ``CONTEXT`` symbols and each symbol is scored in
exactly one of them, all windows of a block in batched masked attention.  The
probability of a word is a mixture of the attention model and the word's
share of the training tokens.

Everything is learned from all training documents: word, subword and class
counts; the classes, by neighbour counts summed per symbol; the network, whose
copies are trained inside the tasks and averaged after each of ``ROUNDS``
rounds, so that steps grow with the corpus and every window is used (small
corpora several times, up to ``STEPS`` steps); and the mixture weights, by EM on
the last round's documents before the network is trained on them.  Averages
depend slightly on how the documents are dealt to tasks.

Documents travel as blocks of about ``BLOCK_WORDS`` words, as compressed
arrays.  The distinct words of a block are dealt to buckets by their hash, one
row per block and bucket; a bucket sums the counts, spells each word once and
sends both back to the blocks, which are shuffled once, without their words.  So
neither a text nor a row per word is ever shuffled, and a word used everywhere
is one entry per block.

Defined cases: null and wordless texts are just the end; repeated rows count
repeatedly; without training documents N is 0, base_score is 0 per token and
only the (untrained) model speaks; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, slices, stash

HELD_OUT = (7, 2)           # crc32(id) mod 7 == 2 is held out
BLOCK_WORDS = 400_000
BUCKETS = 48                # of words, or one for so many blocks if that is more
CONTEXT, STRIDE = 8, 24
WIDTH = 16                  # model dimension
CLASSES = 64
SINGLE = 24                 # classes of one frequent symbol each
ROWS = 8192                 # embedding rows; rarer symbols share rows by hash
STEPS, BATCH = 1500, 48    # least steps, and the least a task gets before another one trains beside it
ROUNDS = 4                  # averages of the tasks' networks; the last round's documents set the mixture first
SALT = 16                   # groups in which the tasks' networks are summed first
_WINDOWS = 64              # windows scored at once


class Subwords:
    """Words (A-Z lower-cased bytes) -> symbols 2 * id + (1 for the last)."""

    def __init__(self, tokenizer_path: str):
        from .packing import _tokenizer
        chunks = _tokenizer(tokenizer_path)[1]
        self.encode = chunks.encode
        self.end = 2 * 50_000_000                                # no subword id is that large

    def flat(self, words: list[bytes]):
        """(symbols, number of symbols per word); b"" is the end."""
        parts = [self.encode(w.decode("utf-8", "replace")) if w else None for w in words]
        size = np.array([1 if p is None else max(len(p), 1) for p in parts], dtype=np.int64)
        out = np.array([x for p in parts for x in (p if p else (self.end // 2,))], dtype=np.int64) * 2
        ends = np.cumsum(size) - 1
        out[ends] += 1
        return np.where(out > self.end, self.end, out), size


def _softmax_loss(z, target):
    m = z.max(-1, keepdims=True)
    e = np.exp(z - m)
    total = e.sum(-1, keepdims=True)
    return (z - m)[np.arange(len(target)), target] - np.log(total[:, 0]), e / total


class Network:
    """x + attention + feed-forward -> class logits; tables per embedding row."""

    NAMES = ("emb", "q", "k", "v", "o", "bias", "up", "down", "out", "prior")

    def __init__(self, rows: int, classes: int, seed: int = 11):
        r = np.random.default_rng(seed)
        f = lambda *s: (r.normal(0, 0.3, s)).astype(np.float32)
        d, w = WIDTH, CONTEXT + STRIDE
        self.p = {"emb": f(rows, d), "q": f(d, d), "k": f(d, d), "v": f(d, d), "o": f(d, d),
                  "bias": np.zeros(w, np.float32), "up": f(d, 2 * d), "down": f(2 * d, d),
                  "out": f(d, classes), "prior": np.zeros(classes, np.float32)}
        # scored positions against all positions of a window: distance, or hidden
        gap = (np.arange(CONTEXT, w)[:, None] - np.arange(w)[None, :])
        self.gap, self.hidden = np.maximum(gap, 0), gap < 0

    def tables(self):
        p = self.p
        return p["emb"], p["emb"] @ p["q"], p["emb"] @ p["k"], p["emb"] @ p["v"]

    def scoring_tables(self):
        """Tables for ``class_log_probs``: the values with a column of ones
        (their weighted sum is the softmax denominator), and the position
        biases with hidden positions masked."""
        emb, q, k, v = self.tables()
        return (emb, q, k, np.concatenate([v, np.ones((len(v), 1), v.dtype)], axis=1),
                np.where(self.hidden, np.float32(-1e9), self.p["bias"][self.gap]))

    def forward(self, rows: np.ndarray, tables, keep: bool = False):
        """Class logits (windows * STRIDE, classes) of (windows, width) rows."""
        p, (emb, tq, tk, tv) = self.p, tables
        x, q, k, v = emb[rows[:, CONTEXT:]], tq[rows[:, CONTEXT:]], tk[rows], tv[rows]
        s = q @ k.transpose(0, 2, 1)
        s += np.where(self.hidden, np.float32(-1e9), p["bias"][self.gap])
        s -= s.max(-1, keepdims=True)
        a = np.exp(s, out=s)
        a /= a.sum(-1, keepdims=True)
        mix = (a @ v).reshape(-1, WIDTH)
        h = x.reshape(-1, WIDTH) + mix @ p["o"]
        u = np.maximum(h @ p["up"], 0)
        g = h + u @ p["down"]
        z = g @ p["out"] + p["prior"]
        return (z, (x, q, k, v, a, mix, h, u, g)) if keep else z

    def class_log_probs(self, rows: np.ndarray, kind: np.ndarray, tables) -> np.ndarray:
        """Log-probability of the class of each scored slot: ``forward`` with
        the sums of both softmaxes taken from matrix products, and without
        shifts where the logits are provably small."""
        p, (emb, tq, tk, tv1, shift) = self.p, tables
        part = rows[:, CONTEXT:]
        s = tq.take(part, axis=0) @ tk.take(rows, axis=0).transpose(0, 2, 1)
        s += shift
        if s.max() > 60 or s[:, -1].max(-1).min() < -60:
            s -= s.max(-1, keepdims=True)
        np.exp(s, out=s)
        mix = (s @ tv1.take(rows, axis=0)).reshape(-1, WIDTH + 1)
        h = (mix[:, :WIDTH] / mix[:, WIDTH:]) @ p["o"]
        h += emb.take(part, axis=0).reshape(-1, WIDTH)
        u = h @ p["up"]
        np.maximum(u, 0, out=u)
        h += u @ p["down"]
        z = h @ p["out"]
        z += p["prior"]
        own = z[np.arange(len(z)), kind]
        if z.max() > 60 or z.min() < -60:
            top = z.max(-1)
            z -= top[:, None]
            own = own - top
        np.exp(z, out=z)
        return own - np.log(z @ np.ones(z.shape[1], z.dtype))

    def step(self, rows, target, weight):
        """Gradients of the weighted mean log-loss of one batch of windows."""
        p = self.p
        z, (x, q, k, v, a, mix, h, u, g) = self.forward(rows, self.tables(), keep=True)
        log_p, prob = _softmax_loss(z, target)
        n = max(float(weight.sum()), 1.0)
        dz = prob
        dz[np.arange(len(target)), target] -= 1
        dz *= (weight / n)[:, None].astype(np.float32)
        grad = {"out": g.T @ dz, "prior": dz.sum(0)}
        dg = dz @ p["out"].T
        du = (dg @ p["down"].T) * (u > 0)
        grad["down"], grad["up"] = u.T @ dg, h.T @ du
        dh = dg + du @ p["up"].T
        grad["o"] = mix.T @ dh
        dm = (dh @ p["o"].T).reshape(len(rows), STRIDE, WIDTH)
        da = dm @ v.transpose(0, 2, 1)
        ds = a * (da - (da * a).sum(-1, keepdims=True))
        dq, dk, dv = ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dm
        grad["bias"] = np.bincount(self.gap[~self.hidden], weights=ds.sum(0)[~self.hidden],
                                   minlength=len(p["bias"])).astype(np.float32)
        full, part = p["emb"][rows].reshape(-1, WIDTH), x.reshape(-1, WIDTH)
        dq, dk, dv = dq.reshape(-1, WIDTH), dk.reshape(-1, WIDTH), dv.reshape(-1, WIDTH)
        grad["q"], grad["k"], grad["v"] = part.T @ dq, full.T @ dk, full.T @ dv
        de = dk @ p["k"].T + dv @ p["v"].T
        scored = dh + dq @ p["q"].T
        flat = rows.reshape(-1)
        emb = np.zeros_like(p["emb"])
        for j in range(WIDTH):
            emb[:, j] = (np.bincount(flat, weights=de[:, j], minlength=len(emb))
                         + np.bincount(rows[:, CONTEXT:].reshape(-1), weights=scored[:, j], minlength=len(emb)))
        grad["emb"] = emb
        return float(-(log_p * weight).sum() / n), grad


class Model:
    """Network, symbol classes and the corpus counts inside the classes."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray, starts: np.ndarray, end: int, seed: int = 11):
        order = np.lexsort((symbols, -counts))
        self.symbols = np.sort(symbols)
        self.counts = np.zeros(len(symbols))
        self.starts = np.zeros(len(symbols))                 # tokens whose first symbol this is
        rank = np.empty(len(symbols), dtype=np.int64)
        at = np.searchsorted(self.symbols, symbols)
        self.counts[at] = counts
        self.starts[at] = starts
        rank[at[order]] = np.arange(len(symbols))
        # row 0 starts documents; frequent symbols own a row, others share
        own = ROWS - 1025
        shared = (self.symbols * 2654435761 >> 7) % 1024
        self.row = np.where(rank < own, rank + 1, own + 1 + shared).astype(np.int32)
        self.rank, self.end = rank, end
        self.kind = np.zeros(len(symbols), dtype=np.int64)
        self.net = Network(ROWS, CLASSES + 2, seed)
        self.mixture = np.array([0.4, 0.5, 0.1])             # class and share, share, subwords

    def positions(self, symbols: np.ndarray) -> np.ndarray:
        """Index of known symbols, -1 for symbols the training corpus lacks."""
        if not hasattr(self, "place"):                       # by symbol; the end and unknown ones come last
            plain = self.symbols[self.symbols < self.end]
            self.place = np.full((int(plain[-1]) if len(plain) else 0) + 3, -1)
            self.place[plain] = np.arange(len(plain))
            if len(plain) < len(self.symbols):
                self.place[-1] = len(plain)
        return self.place[np.where(symbols >= self.end, len(self.place) - 1, np.minimum(symbols, len(self.place) - 2))]

    def set_classes(self, feats: np.ndarray, total: np.ndarray, seed: int = 5) -> None:
        """The most frequent symbols alone; the rest by k-means over their
        neighbours in the training documents (``feats``: roots of the shares,
        ``total``: their number).  Class CLASSES holds what the corpus lacks,
        CLASSES + 1 symbols without neighbours."""
        rng = np.random.default_rng(seed)
        free = np.flatnonzero((self.rank >= SINGLE) & (total > 0))
        self.kind = np.where(self.rank < SINGLE, self.rank, CLASSES + 1)
        groups = CLASSES - SINGLE
        if len(free) > groups:
            f = feats[free]
            weight = np.minimum(total[free], 50)
            centre = f[rng.choice(len(free), groups, replace=False, p=weight / weight.sum())]
            for _ in range(8):
                near = (centre @ f.T).argmax(0)
                for c in range(groups):
                    mine = near == c
                    if mine.any():
                        m = weight[mine].astype(f.dtype) @ f[mine]
                        centre[c] = m / max(np.linalg.norm(m), 1e-9)
            self.kind[free] = SINGLE + near
        else:
            self.kind[free] = SINGLE + np.arange(len(free))
        self.finish()
        share = np.bincount(self.kind, weights=self.counts, minlength=CLASSES + 2) + 0.5
        self.net.p["prior"][:] = np.log(share / share.sum())

    def finish(self) -> None:
        """log P(symbol | class) from the corpus counts, and the number of
        training tokens that start with a symbol of the class."""
        self.class_tokens = np.bincount(self.kind, weights=self.starts, minlength=CLASSES + 2)
        size = np.bincount(self.kind, weights=self.counts, minlength=CLASSES + 2)
        self.inside = np.log(np.maximum(self.counts, 1e-9)) - np.log(np.maximum(size[self.kind], 1e-9))

    def windows(self, at: np.ndarray, first: np.ndarray, size: np.ndarray):
        """(input rows, slots) of the windows of documents' positions.  Slot
        s of a window predicts symbol s of its stride; documents start on a
        fresh window behind CONTEXT + 1 start rows."""
        rows = np.where(at >= 0, self.row[np.maximum(at, 0)], 0) if len(self.symbols) else np.zeros(len(at), np.int32)
        per = -(-size // STRIDE)
        base = np.cumsum(per) - per
        n = int(per.sum())
        inputs = np.zeros(n * STRIDE + 1, dtype=np.int32)
        place = np.repeat(base * STRIDE - first, size) + np.arange(len(at))
        inputs[place + 1] = rows
        starts = np.zeros(n, bool)
        starts[base] = True
        inputs[base * STRIDE] = 0
        # documents do not see what precedes them
        lead = np.concatenate([np.zeros(CONTEXT, np.int32), inputs])
        idx = np.arange(n)[:, None] * STRIDE + np.arange(CONTEXT + STRIDE)[None, :]
        out = lead[idx]
        out[starts, :CONTEXT] = 0
        return out, place

    def log_probs(self, symbols: np.ndarray, first: np.ndarray, size: np.ndarray):
        """Natural log-probabilities of each symbol and of its class, and the
        class; each symbol is scored once."""
        return self.log_probs_at(self.positions(symbols), first, size)

    def log_probs_at(self, at: np.ndarray, first: np.ndarray, size: np.ndarray):
        """``log_probs`` of symbols given by their positions."""
        rows, place = self.windows(at, first, size)
        own = np.where(at >= 0, self.kind[np.maximum(at, 0)], CLASSES) if len(self.symbols) else np.full(len(at), CLASSES)
        kind = np.zeros(len(rows) * STRIDE, dtype=np.int64)
        kind[place] = own
        got = np.zeros(len(kind))
        tables = self.net.scoring_tables()
        for lo in range(0, len(rows), _WINDOWS):
            span = slice(lo * STRIDE, min(lo + _WINDOWS, len(rows)) * STRIDE)
            got[span] = self.net.class_log_probs(rows[lo:lo + _WINDOWS], kind[span], tables)
        # symbols the corpus lacks share their class evenly (ids of the vocabulary, either flag)
        inside = self.inside[np.maximum(at, 0)] if len(self.symbols) else 0.0
        of_class = got[place]
        return of_class + np.where(at >= 0, inside, -np.log(2.0 * 65536)), of_class, own

    def ways(self, at, first, size, word_first, total, n_all: int) -> np.ndarray:
        """(3, words): probabilities of each word, whose symbols start at
        ``word_first``, in the three ways; ``total`` are training counts."""
        lp, of_class, kind = self.log_probs_at(at, first, size)
        tokens = np.maximum(self.class_tokens[kind[word_first]], 1)
        return np.stack([np.exp(of_class[word_first]) * np.minimum(total / tokens, 1.0), total / max(n_all, 1),
                         np.exp(np.add.reduceat(lp, word_first))])

    def train(self, at: np.ndarray, size: np.ndarray, state: "Adam", repeat: int, rate: float) -> None:
        """Adam over the windows of documents, ``repeat`` times in random order."""
        rows, place = self.windows(at, np.cumsum(size) - size, size)
        target = np.zeros(len(rows) * STRIDE, dtype=np.int64)
        weight = np.zeros(len(rows) * STRIDE, dtype=np.float32)
        target[place] = np.where(at >= 0, self.kind[np.maximum(at, 0)], CLASSES)
        weight[place] = 1
        for _ in range(repeat):
            order = state.rng.permutation(len(rows))
            for lo in range(0, len(order), BATCH):
                pick = order[lo:lo + BATCH]
                slots = (pick[:, None] * STRIDE + np.arange(STRIDE)).reshape(-1)
                _, grad = self.net.step(rows[pick], target[slots], weight[slots])
                state.update(self.net.p, grad, rate)
        state.windows += len(rows)
        state.used += np.bincount(rows.reshape(-1), minlength=ROWS)


class Adam:
    """Moments of a task's training, and what it was trained on."""

    def __init__(self, p: dict, seed: int):
        self.m = {k: np.zeros_like(x) for k, x in p.items()}
        self.s = {k: np.zeros_like(x) for k, x in p.items()}
        self.t, self.windows, self.used = 0, 0, np.zeros(ROWS)
        self.rng = np.random.default_rng(seed)

    def update(self, p: dict, grad: dict, rate: float) -> None:
        self.t += 1
        rate, t = rate * min(1.0, self.t / 20), self.t
        for k, g in grad.items():
            g = np.clip(g, -1, 1)
            m, s = self.m[k], self.s[k]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p[k] -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)


def _pack(x: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes, behind their number."""
    import pyarrow as pa
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(x).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(x) else b"")


def _unpack(data: bytes, kind) -> np.ndarray:
    import pyarrow as pa
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, dtype=kind)
    planes = np.frombuffer(pa.decompress(data[8:], n * width, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).reshape(-1).view(kind)


def _pack_words(words) -> tuple[bytes, bytes]:
    """(bytes, lengths) of an Arrow array of words."""
    import pyarrow as pa
    words = pa.concat_arrays([words.cast(pa.large_binary())])
    at = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None and len(words) else np.zeros(0, np.uint8)
    return _pack(flat), _pack(np.diff(at).astype(np.int32))


def _unpack_words(data: list, lengths: list):
    """(Arrow array of words, number of words of each pair)."""
    import pyarrow as pa
    size = [_unpack(x, np.int32) for x in lengths]
    flat = np.concatenate([_unpack(x, np.uint8) for x in data])
    at = np.concatenate([[0], np.cumsum(np.concatenate(size), dtype=np.int64)]).astype(np.int64)
    return (pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(flat)]),
            [len(x) for x in size])


def _blocks(docs: DataFrame) -> DataFrame:
    """(block, ids, nulls, held, sizes, locals, words, lengths, counts, slots,
    uses): documents as indexes into the block's distinct words, how often
    training documents of the block use each (uses: all), and the words'
    hashes, which deal them to buckets."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        task, made = TaskContext.get().partitionId(), 0
        ids, nulls, held, sizes, flat, n_flat = [], [], [], [], [], 0

        def flush():
            nonlocal made, ids, nulls, held, sizes, flat, n_flat
            coded = pa.concat_arrays(flat).dictionary_encode()
            codes, vocab = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            blank = np.flatnonzero(pc.binary_length(vocab).to_numpy() == 0)
            if not len(blank):
                vocab, blank = pa.concat_arrays([vocab, pa.array([""], vocab.type)]), [len(vocab)]
            keep = codes != blank[0]                                 # outside the outer words there is nothing
            doc = np.repeat(np.arange(sum(map(len, sizes))), np.concatenate(sizes))[keep]
            size = np.bincount(doc, minlength=sum(map(len, sizes))) + 1
            out = np.full(int(size.sum()), blank[0])                 # the ends
            out[np.arange(len(doc)) + doc] = codes[keep]
            hold = np.concatenate(held)
            counts = np.bincount(out[np.repeat(~hold, size)], minlength=len(vocab))
            order = np.argsort(-np.bincount(out, minlength=len(vocab)), kind="stable")   # small numbers: frequent words
            rank = np.empty(len(order), dtype=np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            words = vocab.cast(pa.large_binary()).take(pa.array(order))
            data, lengths = _pack_words(words)
            row = pa.RecordBatch.from_pydict({
                "block": pa.array([(task << 24) + made], pa.int64()),
                "ids": [_pack(np.concatenate(ids))], "nulls": [_pack(np.concatenate(nulls))], "held": [_pack(hold)],
                "sizes": [_pack(size.astype(np.int32))], "locals": [_pack(rank[out])],
                "words": [data], "lengths": [lengths], "counts": [_pack(counts[order].astype(np.int32))],
                "slots": [_pack(np.array([crc32(w) & 0xffff for w in words.to_pylist()], dtype=np.uint16))],
                "uses": pa.array([int(counts.sum())], pa.int64())})
            made += 1
            ids, nulls, held, sizes, flat, n_flat = [], [], [], [], [], 0
            return row

        for b in batches:
            for x in slices(b, 64):
                i = x.column(0)
                split = pc.ascii_split_whitespace(pc.ascii_lower(x.column(2).fill_null("")))
                words, at = split.flatten().cast(pa.large_string()), split.offsets.to_numpy()
                real = np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy() > 0)])[at]
                hold, none = x.column(1).to_numpy(zero_copy_only=False).astype(bool), i.is_null().to_numpy(zero_copy_only=False)
                i, done, lo = i.fill_null(0).to_numpy(), real + np.arange(len(at)), 0       # done: words and ends so far
                while lo < len(x):
                    hi = min(int(np.searchsorted(done, done[lo] + BLOCK_WORDS - n_flat)), len(x))
                    for to, y in ((ids, i), (nulls, none), (held, hold), (sizes, np.diff(at))):
                        to.append(y[lo:hi])
                    flat.append(words.slice(at[lo], at[hi] - at[lo]))
                    n_flat += int(done[hi] - done[lo])
                    lo = hi
                    if n_flat >= BLOCK_WORDS:
                        yield flush()
        if ids:
            yield flush()

    return docs.mapInArrow(run, "block bigint, ids binary, nulls binary, held binary, sizes binary, locals binary, "
                                "words binary, lengths binary, counts binary, slots binary, uses bigint")


def _totals(blocks: DataFrame, buckets: int, tokenizer_path: str) -> DataFrame:
    """(block, bucket, totals, per, symbols, fresh): corpus-wide training
    counts and symbols of the distinct words of a block that fall into a
    bucket; the sum of fresh is the number of distinct training words."""
    def send(batches):
        import pyarrow as pa
        for b in batches:
            for j in range(len(b)):
                r = b.slice(j, 1).to_pylist()[0]
                words, counts = _unpack_words([r["words"]], [r["lengths"]])[0], _unpack(r["counts"], np.int32)
                bucket = _unpack(r["slots"], np.uint16) % buckets
                order = np.argsort(bucket, kind="stable")
                words, counts = words.take(pa.array(order)), counts[order]
                start = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
                rows = []
                for k in np.flatnonzero(np.diff(start)).tolist():
                    lo, hi = int(start[k]), int(start[k + 1])
                    rows.append((k, r["block"], *_pack_words(words.slice(lo, hi - lo)), _pack(counts[lo:hi])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                    names=["bucket", "block", "words", "lengths", "counts"])

    def add(table):
        import pyarrow as pa
        words, size = _unpack_words(table.column("words").to_pylist(), table.column("lengths").to_pylist())
        coded = words.dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary
        counts = np.concatenate([_unpack(x, np.int32) for x in table.column("counts").to_pylist()])
        total = np.bincount(codes, weights=counts, minlength=len(words)).astype(np.int64)
        sub = Subwords(tokenizer_path)
        got = [sub.flat(words.slice(lo, 50_000).to_pylist()) for lo in range(0, len(words), 50_000)]
        symbols, per = (np.concatenate(x) for x in zip(*got))
        symbols, first = symbols.astype(np.int32), np.cumsum(per) - per
        out, at = [], 0
        for n in size:
            c = codes[at:at + n]
            at += n
            out.append((_pack(total[c]), _pack(per[c].astype(np.int32)), _pack(symbols[_runs(first[c], per[c])])))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         **{c: pa.array(x, pa.binary()) for c, x in zip(("totals", "per", "symbols"), zip(*out))},
                         "fresh": pa.array([int((total > 0).sum())] + [0] * (len(out) - 1), pa.int64())})

    return (blocks.select("block", "words", "lengths", "counts", "slots")
            .mapInArrow(send, "bucket int, block bigint, words binary, lengths binary, counts binary")
            .groupBy("bucket").applyInArrow(add, "block bigint, bucket int, totals binary, per binary, "
                                                 "symbols binary, fresh bigint"))


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], ..."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _symbol_counts(counted: DataFrame):
    """Corpus-wide counts of subword symbols in the training documents, and
    of those that start a token."""
    def run(batches):
        import pyarrow as pa
        for block in _each(batches):
            uses = np.bincount(block.locals[np.repeat(~block.held, block.sizes)], minlength=len(block.per))
            lead = np.zeros(len(block.symbols))
            lead[block.off] = uses
            u, back = np.unique(block.symbols, return_inverse=True)
            n = np.bincount(back, weights=np.repeat(uses, block.per)).astype(np.int64)
            f = np.bincount(back, weights=lead).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u[n > 0]), pa.array(n[n > 0]), pa.array(f[n > 0])],
                                             names=["symbol", "n", "f"])

    got = (counted.mapInArrow(run, "symbol bigint, n bigint, f bigint")
           .groupBy("symbol").agg(F.sum("n").alias("n"), F.sum("f").alias("f")).orderBy("symbol").collect())
    # vocabulary x 2 rows at most
    return (np.array([r["symbol"] for r in got], dtype=np.int64), np.array([r["n"] for r in got], dtype=np.float64),
            np.array([r["f"] for r in got], dtype=np.float64))


def _counted(blocks: DataFrame, totals: DataFrame, buckets: int) -> DataFrame:
    """The blocks with their words' training counts (totals) and symbols
    (symbols, per) in place of the words."""
    def run(key, left, right):
        import pyarrow as pa
        right = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        order = np.argsort(_unpack(left.column("slots")[0].as_py(), np.uint16) % buckets, kind="stable")
        read = lambda c, kind: np.concatenate([_unpack(r[c], kind) for r in right])
        total, per = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        first, got = np.empty(len(order), np.int64), read("per", np.int32).astype(np.int64)
        total[order], per[order], first[order] = read("totals", np.int64), got, np.cumsum(got) - got
        same = {c: left.column(c) for c in ("block", "ids", "nulls", "held", "sizes", "locals", "uses")}
        return pa.table({**same, "totals": [_pack(total)], "symbols": [_pack(read("symbols", np.int32)[_runs(first, per)])],
                         "per": [_pack(per.astype(np.int32))],
                         "fresh": pa.array([sum(r["fresh"] for r in right)], pa.int64())})

    return (blocks.select("block", "ids", "nulls", "held", "sizes", "locals", "slots", "uses").groupBy("block")
            .cogroup(totals.groupBy("block")).applyInArrow(
                run, "block bigint, ids binary, nulls binary, held binary, sizes binary, locals binary, uses bigint, "
                     "totals binary, symbols binary, per binary, fresh bigint"))


class _Block:
    """A row of ``_counted``."""

    def __init__(self, r: dict):
        read = lambda c, kind: _unpack(r[c], kind)
        self.number, self.ids, self.nulls = r["block"], read("ids", np.int64), read("nulls", bool)
        self.held, self.locals = read("held", bool), read("locals", np.int32)
        self.sizes = read("sizes", np.int32).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.total, self.symbols = read("totals", np.int64), read("symbols", np.int32).astype(np.int64)
        self.per = read("per", np.int32).astype(np.int64)
        self.off = np.cumsum(self.per) - self.per
        self.spelled = np.add.reduceat(self.per[self.locals], self.first)

    def round(self) -> np.ndarray:
        """The round of each document; -1 where it is held out."""
        k = (self.number + (self.number >> 24) + np.arange(len(self.sizes))) % ROUNDS
        return np.where(self.held, -1, k)

    def parts(self, which: np.ndarray, model: Model, most: int = 400_000):
        """(documents, words, the model's positions of their symbols, symbols
        per word) of whole documents."""
        docs, known = np.flatnonzero(which), model.positions(self.symbols)
        done = np.cumsum(self.spelled[docs])
        lo = 0
        while lo < len(docs):
            hi = max(lo + 1, int(np.searchsorted(done, most + (done[lo - 1] if lo else 0))))
            d = docs[lo:hi]
            w = self.locals[_runs(self.first[d], self.sizes[d])]
            k = self.per[w]
            yield d, w, known[_runs(self.off[w], k)], k
            lo = hi


def _each(batches):
    for b in batches:
        for k in range(len(b)):
            yield _Block(b.slice(k, 1).to_pylist()[0])


_GROUP = 64                 # symbols of one row of neighbour counts


def _neighbours(counted: DataFrame, model: Model):
    """(roots of neighbour shares, number of neighbours) of each symbol over
    all training documents, summed per symbol in Spark."""
    n = len(model.symbols)

    def run(batches):
        import pyarrow as pa
        feats = np.zeros(-(-n // _GROUP) * _GROUP * 256, dtype=np.int32)
        for block in _each(batches):
            for d, _, at, _ in block.parts(~block.held, model):
                size = block.spelled[d]
                inner = np.ones(len(at), dtype=bool)
                inner[np.cumsum(size) - size] = False                # its left neighbour is another document's
                inner = np.flatnonzero(inner)
                a, b = at[inner - 1], at[inner]
                np.add.at(feats, b * 256 + model.rank[a] % 128, 1)
                np.add.at(feats, a * 256 + 128 + model.rank[b] % 128, 1)
        feats = feats.reshape(-1, _GROUP * 256)
        for g in np.flatnonzero(feats.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([feats[g].tobytes()], pa.binary())],
                                             names=["g", "counts"])

    def add(table):
        import pyarrow as pa
        total = np.zeros(_GROUP * 256, dtype=np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(x.as_py(), dtype=np.int32)
        total = total.reshape(_GROUP, 256)
        size = total.sum(axis=1)
        root = np.sqrt(total / np.maximum(size, 1)[:, None]).astype(np.float16)
        return pa.table({"g": table.column("g")[:1], "size": [size.tobytes()], "root": [root.tobytes()]})

    rows = (counted.mapInArrow(run, "g int, counts binary").groupBy("g")
            .applyInArrow(add, "g int, size binary, root binary").collect())     # 512 bytes a symbol of the vocabulary
    feats = np.zeros((-(-n // _GROUP) * _GROUP, 256), dtype=np.float32)
    total = np.zeros(len(feats))
    for r in rows:
        span = slice(r["g"] * _GROUP, (r["g"] + 1) * _GROUP)
        feats[span] = np.frombuffer(r["root"], dtype=np.float16).reshape(_GROUP, 256)
        total[span] = np.frombuffer(r["size"], dtype=np.int64)
    return feats[:n], total[:n]


def _train_round(counted: DataFrame, model: Model, k: int, repeat: int) -> int:
    """One round: every task trains a copy on its documents of the round, the
    copies are averaged (embedding rows by how often a task used them, the
    rest by windows).  Returns the windows used."""
    names = Network.NAMES

    def run(batches):
        import copy

        import pyarrow as pa
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        own = copy.deepcopy(model)
        state = Adam(own.net.p, 1000 * k + task)
        rate = 0.02 * (1 - 0.9 * k / ROUNDS)
        for block in _each(batches):
            when = block.round()
            # small corpora: all but the last round's documents again and again, then all
            which = when == k if repeat == 1 else (when >= 0) & ((when < ROUNDS - 1) | (k == ROUNDS - 1))
            for d, _, flat, _ in block.parts(which, own):
                own.train(flat, block.spelled[d], state, -(-repeat // ROUNDS), rate)
        if state.windows:
            p = own.net.p
            sums = [(p[c] * (state.used[:, None] if c == "emb" else state.windows)).reshape(-1) for c in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task % SALT], pa.int32()),
                 pa.array([np.concatenate([[state.windows], state.used, *sums]).astype(np.float64).tobytes()],
                          pa.binary())], names=["salt", "sums"])

    def add(table):
        import pyarrow as pa
        total = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
        return pa.table({"salt": table.column("salt")[:1], "sums": [total.tobytes()]})

    kind = "salt int, sums binary"
    rows = counted.mapInArrow(run, kind).groupBy("salt").applyInArrow(add, kind).collect()   # at most SALT rows
    if not rows:
        return 0
    total = sum(np.frombuffer(r["sums"]) for r in sorted(rows, key=lambda r: r["salt"]))
    windows, used, at = total[0], total[1:1 + ROWS], 1 + ROWS
    for c in names:
        p = model.net.p[c]
        x = total[at:at + p.size].reshape(p.shape)
        at += p.size
        if c == "emb":
            p[used > 0] = (x[used > 0] / used[used > 0, None]).astype(np.float32)
        else:
            p[...] = (x / windows).astype(np.float32)
    return int(windows)


def _fit_mixture(counted: DataFrame, model: Model, n_tokens: int) -> None:
    """Mixture weights by EM per block over the last round's documents,
    leaving each token out of its count; averaged by tokens."""
    def run(batches):
        import pyarrow as pa
        total, n = np.zeros(3), 0
        for block in _each(batches):
            ways = [model.ways(flat, np.cumsum(block.spelled[d]) - block.spelled[d], block.spelled[d],
                               np.cumsum(k) - k, np.maximum(block.total[w] - 1, 0), n_tokens - 1)
                    for d, w, flat, k in block.parts(block.round() == ROUNDS - 1, model)]
            if ways:
                p = np.maximum(np.concatenate(ways, axis=1), 1e-300)
                mixture = model.mixture
                for _ in range(30):
                    part = mixture[:, None] * p
                    mixture = np.maximum((part / part.sum(0)).mean(1), 1e-4)
                    mixture = mixture / mixture.sum()
                total += mixture * p.shape[1]
                n += p.shape[1]
        yield pa.RecordBatch.from_pydict({"a": [total[0]], "b": [total[1]], "c": [total[2]],
                                          "n": pa.array([n], pa.int64())})

    got = (counted.mapInArrow(run, "a double, b double, c double, n bigint")
           .agg(F.sum("a"), F.sum("b"), F.sum("c"), F.sum("n")).first())
    if got[3]:
        model.mixture = np.array(got[:3]) / sum(got[:3])


def fit(counted: DataFrame, n_tokens: int) -> Model:
    """Train on the blocks of ``_counted``."""
    model = Model(*_symbol_counts(counted), 2 * 50_000_000)
    model.learned = 0                                                # windows the network was trained on
    if not n_tokens:
        model.set_classes(np.zeros((0, 256), np.float32), np.zeros(0))
        return model
    model.set_classes(*_neighbours(counted, model))
    about = model.counts.sum() / STRIDE
    repeat = max(1, -(-STEPS * BATCH // max(int(about), 1)))
    few = counted.coalesce(max(1, int(about) // (STEPS * BATCH)))
    for k in range(ROUNDS):
        if k == ROUNDS - 1 and n_tokens > 1:
            _fit_mixture(counted, model, n_tokens)
        windows = _train_round(few, model, k, repeat)
        model.learned = model.learned + windows if repeat == 1 else windows
    return model


def score(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    every, rest = HELD_OUT
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       (fold(id_col, every) == rest).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    blocks = stash(_blocks(slim), "lm-blocks")
    buckets = min(max(BUCKETS, blocks.count() // 16), 1 << 16)
    counted = stash(_counted(blocks, _totals(blocks, buckets, tokenizer_path), buckets), "lm-counted")
    size = counted.agg(F.sum("uses").alias("n"), F.sum("fresh").alias("v")).first()
    n_all, n_kinds = int(size["n"] or 0), int(size["v"] or 0)
    model = fit(counted, n_all)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for block in _each([b]):
                total, loc, first = block.total, block.locals, block.first
                base = np.log10((total + 1) / (n_all + n_kinds + 1))
                mixture = model.mixture if n_all else np.array([0.0, 0.0, 1.0])  # no training tokens: the model alone
                # spell the documents out and score them in slices of whole documents
                lm = [np.log10(np.maximum(mixture @ model.ways(
                    flat, np.cumsum(block.spelled[d]) - block.spelled[d], block.spelled[d], np.cumsum(k) - k,
                    total[w], n_all), 1e-300)) for d, w, flat, k in block.parts(np.ones(len(first), dtype=bool), model)]
                sums = lambda x: np.add.reduceat(x, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids, mask=block.nulls), pa.array(block.held),
                     pa.array(block.sizes), pa.array(sums((total[loc] > 0).astype(np.int64))),
                     pa.array(np.full(len(first), n_all)), pa.array(sums(base[loc])), pa.array(sums(np.concatenate(lm)))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return counted.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                   "train_tokens bigint, base_score double, score double")
