"""Personal data in texts: fixed patterns, and a skip-chain conditional random
field that adds what the patterns miss.

Base spans come from one pattern and one check per kind.  The random field
has a node for every word with a digit or an ``@`` (other words are clamped to
"no personal data" and enter as context features), chain edges between
neighbouring nodes, and skip edges between distant words of a document that
are equal, hold the same digits, or share the last seven digits (of 7 to 13, from
10 also the first seven) or the first or last eight (of 14 or more).  Occurrences of one such key are linked to
the next one, so a key with n occurrences has n - 1 edges.

Learning is weakly supervised: base spans label the words they touch, other
words are negative, except those that share a skip key with a labelled word
or lie in a match with too many digits; those are left out.  Weights are fitted by pseudo-likelihood on a bounded
sample of documents (``SAMPLE_DOCS``, chosen by text hash; documents of more
than ``SAMPLE_NODES`` nodes are not sampled).  In each step a random half of
the nodes sees only neighbours' labels, and every edge is shown half of the
time, so that each kind of edge learns to carry labels to words whose own
form is unusual.  Decoding is loopy sum-product
message passing over whole documents, all graphs of a block of texts at once,
until no message moves by more than ``TOLERANCE`` (at most ``ROUNDS`` rounds).

Added spans are runs of neighbouring words of one predicted kind that no base
span touches and that hold what their kind needs (``_plausible``).

Defined cases: null and empty texts have no spans (digest of the empty
string); the patterns and word rules are linear in a text's length; repeated
rows are judged alike; null ids are kept; an empty table gives no rows and
learns nothing; without base spans anywhere nothing is added; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, slices

KINDS = ("email", "ip", "card", "phone")
FEATURES = 1 << 13          # hashed features
SAMPLE_DOCS = 4_000
SAMPLE_NODES = 2_000
STEPS = 150
ROUNDS, TOLERANCE = 100, 1e-4
BLOCK_NODES = 20_000        # graphs of a block of texts are decoded together from this many nodes
CHAIN, SAME, DIGITS, SIMILAR = range(4)         # edge types

_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*")
_ANCHOR = re.compile(r"[0-9@]")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")
_AT = re.compile(r"[\[({](?:at|@)[\])}]", re.I)
_DOT = re.compile(r"[\[({](?:dot|\.)[\])}]", re.I)
_NON_DIGIT = re.compile(r"[^0-9]+")
_EDGE = "\"'`.,;:!?*#$%&<>[]{}|=/\\~^"


# ---- base spans -------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) << (k & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str, too_long: list | None = None) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind; number matches with more digits
    than their kind may have (often two numbers side by side) are appended to
    ``too_long``.

    The email and address patterns are matched from their ``@`` and from whole
    dotted runs: the same leftmost matches in time linear in the text.
    """
    out, done = [], 0
    for m in _EMAIL_TAIL.finditer(text) if "@" in text else ():
        at = start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            out.append((start, done, 0))
    for m in _DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            parts, lo = m.group().split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i:i + 4]
                hi = lo + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out.append((lo, hi, 1))
                lo = hi + 1
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start():
            digits = _NON_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
            elif len(digits) > 19 and too_long is not None:
                too_long.append((m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        n = len(_NON_DIGIT.sub("", m.group()))
        if 10 <= n <= 15:
            out.append((m.start(), m.end(), 3))
        elif n > 15 and too_long is not None:
            too_long.append((m.start(), m.end()))
    out.sort(key=lambda s: (s[0], s[2]))
    return out


def show(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


# ---- graphs -----------------------------------------------------------------

class Graph:
    """Nodes of a block of texts: words, features, weak labels and edges."""

    def __init__(self):
        self.where: list[tuple[int, int, int]] = []     # text, start, end (trimmed word)
        self.digits: list[int] = []
        self.forms: list[str] = []
        self.features: list[list[int]] = []
        self.labels: list[int] = []                     # 0 none, 1 + kind; -1 left out of learning
        self.covered: list[bool] = []                   # touched by a base span
        self.after: list[bool] = []                     # follows the node before it, one space between
        self.edges: list[tuple[int, int, int]] = []


def _hash(feature: str) -> int:
    return crc32(feature.encode("utf-8", "surrogatepass")) % FEATURES


def _shape(form: str) -> str:
    return _RUNS.sub(lambda m: f"d{len(m.group())}" if m.group()[0] in "0123456789" else "a", form)


def _coarse(form: str) -> str:
    return _RUNS.sub(lambda m: "d" if m.group()[0] in "0123456789" else "a", form)


def add_text(g: Graph, number: int, text: str) -> list[tuple[int, int, int]]:
    """Append one text's nodes and edges; returns its base spans."""
    if not _ANCHOR.search(text):
        return []
    unsure: list[tuple[int, int]] = []
    base = base_spans(text, unsure)
    unsure.sort()
    first, words = len(g.where), []
    for m in _WORD.finditer(text):
        core = m.group().strip(_EDGE)
        if _ANCHOR.search(core):
            lead = m.group().index(core)
            words.append((m.start() + lead, m.start() + lead + len(core), m.start(), m.end(), core))
    forms = [_DOT.sub(".", _AT.sub("@", w[4])) for w in words]
    digits = [_NON_DIGIT.sub("", f) for f in forms]
    coarse = [_coarse(f) for f in forms]
    after = [i > 0 and words[i][2] == words[i - 1][3] + 1 for i in range(len(words))]
    # digits of the whole run of neighbours a word belongs to, and the run's last word
    joined, last = [""] * len(words), [False] * len(words)
    lo = 0
    for i in range(len(words)):
        if i + 1 == len(words) or not after[i + 1]:
            run = "".join(digits[lo:i + 1])
            joined[lo:i + 1] = [run] * (i + 1 - lo)
            last[i] = True
            lo = i + 1
    at, doubt, seen, edge_of = 0, 0, {}, {}
    keys_of = []
    for i, (start, end, raw_start, raw_end, _) in enumerate(words):
        form, d, run = forms[i], digits[i], joined[i]
        names = ["bias", "s:" + _shape(form), "c:" + coarse[i], f"n:{min(len(d), 20)}"]
        if 14 <= len(d) <= 19:
            names.append("luhn" if luhn(d) else "no luhn")
        if run != d and 14 <= len(run) <= 19:
            names.append("run luhn" if luhn(run) else "run no luhn")
        parts = form.split(".")
        if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
            names.append("address" if all(len(p) < 4 and int(p) <= 255 for p in parts) else "no address")
        if "@" in form[1:-1]:
            names.append("at")
        if form.startswith("+"):
            names.append("plus")
        names.append("p:" + (text[max(0, raw_start - 40):raw_start].lower().split() or [""])[-1].strip(_EDGE))
        names.append("q:" + (text[raw_end:raw_end + 40].lower().split() or [""])[0].strip(_EDGE))
        names.append("ps:" + (coarse[i - 1] if after[i] else ""))
        names.append("ns:" + (coarse[i + 1] if i + 1 < len(words) and after[i + 1] else ""))
        while at < len(base) and base[at][1] <= start:
            at += 1
        touching, j = [], at
        while j < len(base) and base[j][0] < end:
            if base[j][1] > start:
                touching.append(base[j][2])
            j += 1
        g.where.append((number, start, end))
        g.digits.append(len(d))
        g.forms.append(form)
        g.features.append(sorted({_hash(n) for n in names}))
        while doubt < len(unsure) and unsure[doubt][1] <= start:
            doubt += 1
        in_doubt = doubt < len(unsure) and unsure[doubt][0] < end
        g.labels.append(1 + min(touching) if touching else -1 if in_doubt else 0)
        g.covered.append(bool(touching))
        g.after.append(after[i])
        node = first + i
        if after[i]:
            g.edges.append((node - 1, node, CHAIN))
            edge_of[node - 1, node] = CHAIN
        keys = []
        if len(form) >= 5:
            keys.append((SAME, form.lower()))
        if len(d) >= 7:
            keys.append((DIGITS, d))
        whole = run if last[i] else d
        if len(whole) >= 10:
            n = 8 if len(whole) >= 14 else 7
            keys += [(SIMILAR, whole[-n:]), (SIMILAR, "^" + whole[:n])]
        elif len(whole) >= 7:
            keys.append((SIMILAR, whole[-7:]))
        for key in keys:
            other = seen.get(key)
            if other is not None and (other, node) not in edge_of:
                edge_of[other, node] = key[0]
                g.edges.append((other, node, key[0]))
            seen[key] = node
        keys_of.append(keys)
    labelled = {k for i, ks in enumerate(keys_of) if g.labels[first + i] > 0 for k in ks}
    for i, ks in enumerate(keys_of):
        if g.labels[first + i] == 0 and any(k in labelled for k in ks):
            g.labels[first + i] = -1
    return base


# ---- the random field -------------------------------------------------------

N_LABELS = 1 + len(KINDS)


def _padded(features: list[list[int]]) -> np.ndarray:
    """Feature ids as a matrix; FEATURES is an empty place (weight 0)."""
    out = np.full((len(features), max(map(len, features), default=0)), FEATURES, dtype=np.int64)
    for i, f in enumerate(features):
        out[i, :len(f)] = f
    return out


def _scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(features), N_LABELS))
    for j in range(features.shape[1]):
        out += weights[features[:, j]]
    return out


class Field:
    """Node weights (FEATURES + 1, labels) and edge weights (types, labels, labels)."""

    def __init__(self):
        self.node = np.zeros((FEATURES + 1, N_LABELS))
        self.edge = np.zeros((4, N_LABELS, N_LABELS))

    def fit(self, features: np.ndarray, labels: np.ndarray, edges: np.ndarray, steps: int = STEPS,
            rate: float = 0.1, l2: float = 1e-5, seed: int = 42) -> Field:
        """Pseudo-likelihood by Adam; ``edges`` is (n, 3): left, right, type."""
        known = np.flatnonzero(labels >= 0)
        if not len(known) or not (labels > 0).any():
            return self
        rng = np.random.default_rng(seed)
        # a labelled node's neighbours: (node, neighbour's label, type, which side)
        left, right, kind = edges[:, 0], edges[:, 1], edges[:, 2]
        into_right = (labels[left] >= 0) & (labels[right] >= 0)
        r_node, r_lab, r_type = right[into_right], labels[left[into_right]], kind[into_right]
        l_node, l_lab, l_type = left[into_right], labels[right[into_right]], kind[into_right]
        onehot = np.eye(N_LABELS)[np.maximum(labels, 0)]
        own_edge = np.zeros_like(self.edge)                 # DIGITS and SIMILAR: the SAME weights and a part of their own
        moments = [np.zeros_like(self.node), np.zeros_like(self.node), np.zeros_like(self.edge), np.zeros_like(self.edge)]
        for step in range(1, steps + 1):
            own = rng.random(len(labels)) < 0.5             # the others see their neighbours and the bias only
            own[np.bincount(np.concatenate([r_node, l_node]), minlength=len(labels)) == 0] = True
            shown = np.where(own[:, None], features, FEATURES)
            r_seen, l_seen = rng.random(len(r_node)) < 0.5, rng.random(len(l_node)) < 0.5
            logits = _scores(self.node, shown)
            np.add.at(logits, r_node, self.edge[r_type, r_lab] * r_seen[:, None])
            np.add.at(logits, l_node, self.edge[l_type, :, l_lab] * l_seen[:, None])
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            error = np.where(labels[:, None] >= 0, p - onehot, 0) / len(known)
            g_node, g_edge = l2 * self.node, np.zeros_like(self.edge)
            flat = shown.ravel()
            for c in range(N_LABELS):
                g_node[:, c] += np.bincount(flat, np.repeat(error[:, c], shown.shape[1]), FEATURES + 1)
            g_node[FEATURES] = 0
            np.add.at(g_edge, (r_type, r_lab), error[r_node] * r_seen[:, None])
            g_back = np.zeros((4, N_LABELS, N_LABELS))
            np.add.at(g_back, (l_type, l_lab), error[l_node] * l_seen[:, None])
            g_edge += g_back.transpose(0, 2, 1)
            g_edge[SAME:] = (g_edge[SAME:] + g_edge[SAME:].transpose(0, 2, 1)) / 2      # skip edges have no direction
            g_edge[SAME] += g_edge[DIGITS] + g_edge[SIMILAR]
            g_edge += l2 * own_edge
            for w, g, m, v in ((self.node, g_node, *moments[:2]), (own_edge, g_edge, *moments[2:])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
            self.edge = own_edge.copy()
            self.edge[DIGITS:] += own_edge[SAME]
        return self

    def beliefs(self, features: np.ndarray, edges: np.ndarray, owner: np.ndarray, known: np.ndarray, rounds: int = ROUNDS,
                tolerance: float = TOLERANCE) -> np.ndarray:
        """Marginals by damped loopy sum-product over all graphs at once; a
        graph (nodes of one owner) stops when its own messages have settled,
        so its marginals do not depend on its company.  Nodes with a label in
        ``known`` (others: 0) are held to it."""
        score = _scores(self.node, features)
        score[known > 0] = -1e3
        score[known > 0, known[known > 0]] = 0
        n, m = len(features), len(edges)
        if m:
            # messages 2e (left to right) and 2e + 1 (right to left)
            src, dst = np.empty(2 * m, np.int64), np.empty(2 * m, np.int64)
            src[0::2], dst[0::2] = edges[:, 0], edges[:, 1]
            src[1::2], dst[1::2] = edges[:, 1], edges[:, 0]
            pot = np.empty((2 * m, N_LABELS, N_LABELS))
            pot[0::2] = self.edge[edges[:, 2]]
            pot[1::2] = self.edge[edges[:, 2]].transpose(0, 2, 1)
            back = np.arange(2 * m) ^ 1
            message = np.zeros((2 * m, N_LABELS))
            _, owner = np.unique(owner[src], return_inverse=True)
            active = np.ones(owner.max() + 1, dtype=bool)
            for _ in range(rounds):
                total = score + np.stack([np.bincount(dst, message[:, c], n) for c in range(N_LABELS)], 1)
                raw = (total[src] - message[back])[:, :, None] + pot
                top = raw.max(1)
                new = top + np.log(np.exp(raw - top[:, None, :]).sum(1))
                new -= new.max(1, keepdims=True)
                step = np.where(active[owner, None], new - message, 0)
                message += 0.7 * step
                moved = np.zeros(len(active))
                np.maximum.at(moved, owner, np.abs(step).max(1))
                active &= moved >= tolerance
                if not active.any():
                    break
            score = score + np.stack([np.bincount(dst, message[:, c], n) for c in range(N_LABELS)], 1)
        p = np.exp(score - score.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def _edge_array(edges: list[tuple[int, int, int]]) -> np.ndarray:
    return np.asarray(edges, dtype=np.int64).reshape(-1, 3)


def _plausible(kind: int, text: str, forms: list[str], digits: int, linked: bool) -> bool:
    """What an added span must hold: an ``@`` inside a word; three separators
    and 4 to 12 digits; 14 to 19 digits (12 if it shares a skip key with a base
    span); 10 to 15 digits (7 with such a key)."""
    if kind == 0:
        return len(forms) == 1 and "@" in forms[0][1:-1]
    if kind == 1:
        return 4 <= digits <= 12 and len(_NON_DIGIT.findall(text.strip("()"))) >= 3
    return (12 if linked else 14) <= digits <= 19 if kind == 2 else (7 if linked else 10) <= digits <= 15


def added_spans(field: Field, g: Graph, texts: list[str]) -> dict[int, list[tuple[int, int, int]]]:
    """By text number, the spans that message passing adds to the base ones."""
    out: dict[int, list] = defaultdict(list)
    if not g.where:
        return out
    edges, covered = _edge_array(g.edges), np.asarray(g.covered)
    belief = field.beliefs(_padded(g.features), edges, np.asarray([w[0] for w in g.where]),
                           np.where(covered, np.asarray(g.labels), 0))
    best = belief.argmax(1)
    label = np.where((best > 0) & (belief.max(1) >= 0.5) & ~covered, best, 0).tolist()
    skips = edges[edges[:, 2] != CHAIN, :2]
    linked = np.zeros(len(label), dtype=bool)               # shares a skip key with a base span's word
    linked[skips[covered[skips[:, 1]], 0]] = True
    linked[skips[covered[skips[:, 0]], 1]] = True
    i = 0
    while i < len(label):
        j = i + 1
        if label[i]:
            while j < len(label) and label[j] == label[i] and g.after[j]:
                j += 1
            number, start, end = g.where[i][0], g.where[i][1], g.where[j - 1][2]
            if _plausible(label[i] - 1, texts[number][start:end], g.forms[i:j], sum(g.digits[i:j]), linked[i:j].any()):
                out[number].append((start, end, label[i] - 1))
        i = j
    return out


def learn(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_nodes: int = SAMPLE_NODES) -> Field:
    """Fit the field on distinct texts with a digit or an ``@``: those with
    the ``sample_docs`` least hashes.  Only node numbers reach the driver."""
    def run(batches):
        import pyarrow as pa
        for batch in (x for whole in batches for x in slices(whole)):
            rows = []
            for text in batch.column(0).to_pylist():
                g = Graph()
                add_text(g, 0, text)
                if 0 < len(g.where) <= sample_nodes:
                    rows.append((g.features, g.labels, [x for e in g.edges for x in e]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.list_(pa.int32()))),
                 pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["features", "labels", "edges"])
        release()

    hashed = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]")).withColumn(
        "text_hash", F.xxhash64("text"))
    chosen = hashed.select("text_hash").distinct().orderBy("text_hash").limit(sample_docs)
    sample = (hashed.join(F.broadcast(chosen), "text_hash").groupBy("text_hash").agg(F.min("text").alias("text"))
              .select("text"))
    features, labels, edges, n = [], [], [], 0
    for r in sample.mapInArrow(run, "features array<array<int>>, labels array<int>, edges array<int>").toLocalIterator():
        features += r["features"]
        labels += r["labels"]
        edges.append(np.asarray(r["edges"], dtype=np.int64).reshape(-1, 3) + [n, n, 0])
        n = len(labels)
    if not n:
        return Field()
    return Field().fit(_padded(features), np.asarray(labels), np.concatenate(edges))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of
    the base spans, and ``spans``: base and added ones."""
    field = field or learn(docs, text_col)
    schema = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string"

    def run(batches):
        import pyarrow as pa
        for batch in (x for whole in batches for x in slices(whole)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base, extra = [], [[] for _ in texts]
            g = Graph()
            for i, text in enumerate(texts):
                base.append(add_text(g, i, text))
                if len(g.where) >= BLOCK_NODES or i + 1 == len(texts):
                    for n, spans in added_spans(field, g, texts).items():
                        extra[n] = spans
                    g = Graph()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 *(pa.array([sum(s[2] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))),
                 pa.array([sha256(show(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([show(b + x) for b, x in zip(base, extra)], pa.string())],
                names=[c.split()[0] for c in schema.split(", ")])
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
