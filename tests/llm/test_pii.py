import itertools
import random
import re
import time
from hashlib import sha256

import numpy as np
import pytest
from helpers_llm import corpus, docs_frame

from quarry.llm import pii


def plain_spans(text):
    """The base patterns as they stand, by re.finditer."""
    text = text or ""
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        doubled = [x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


CASES = ["a.b@c-d.e.f@g.h", "x@y", "a@b@c.d", "@a.b x..@c.d", "1.2.3.4.5.6.7.8.9", "256.1.1.1 001.0.0.255", "1.2.3.", "é1.2.3.4é",
         "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "4111111111111112", "0" * 14, "0" * 20,
         "+1 (487) 555-7209.", "+49 30 1234567 12", "+1", "+1 2", "++12345678901", "+1 23456789012345678", "٣٤@x.y", "a@b.c١"]


@pytest.mark.parametrize("seed", range(40))
def test_base_spans_equal_the_patterns(seed):
    rng = random.Random(seed)
    for text in CASES if seed == 0 else ["".join(rng.choice("ab01259..@@+- ()é") for _ in range(rng.randint(0, 60))) for _ in range(300)]:
        assert pii.base_spans(text) == plain_spans(text), text


def test_linear_in_long_texts():
    began = time.time()
    for text in ("a." * 300_000, "1" * 500_000, "1." * 300_000, "+1 " * 200_000, "a" * 500_000, "@" * 300_000, "a1" * 200_000):
        g = pii.Graph()
        pii.add_text(g, 0, text)
    assert time.time() - began < 60


def field(node, edge):
    f = pii.Field()
    f.node[:len(node)], f.edge[:] = node, edge
    return f


@pytest.mark.parametrize("seed", range(8))
def test_messages_are_exact_on_trees(seed):
    """Marginals of forests equal the sum over all labellings; graphs decoded together do not disturb each other."""
    rng = np.random.default_rng(seed)
    n = 6
    f = field(rng.normal(size=(n, pii.N_LABELS)), rng.normal(size=(4, pii.N_LABELS, pii.N_LABELS)))
    edges = np.asarray([(int(rng.integers(0, i)), i, int(rng.integers(0, 4))) for i in range(1, n) if rng.random() < 0.8]).reshape(-1, 3)
    known = np.where(rng.random(n) < 0.2, 2, 0)
    want = np.zeros((n, pii.N_LABELS))
    for y in itertools.product(range(pii.N_LABELS), repeat=n):
        if all(k == 0 or k == v for k, v in zip(known, y)):
            w = np.exp(sum(f.node[i, v] * (known[i] == 0) for i, v in enumerate(y)) + sum(f.edge[t, y[a], y[b]] for a, b, t in edges))
            want[range(n), y] += w
    want /= want.sum(1, keepdims=True)
    features = np.arange(n)[:, None]
    got = f.beliefs(features, edges, np.zeros(n, int), known, tolerance=1e-9)
    assert np.allclose(got, want, atol=1e-6)
    both = f.beliefs(np.concatenate([features, features[:2]]), np.concatenate([edges, [[n, n + 1, 0]]]).astype(int),
                     np.repeat([0, 1], [n, 2]), np.concatenate([known, [0, 0]]), tolerance=1e-9)
    assert np.allclose(both[:n], got, atol=1e-12)


def test_pseudo_likelihood_gradient():
    """One step moves every weight against the gradient found by differences (all nodes and edges shown)."""
    rng = np.random.default_rng(1)
    features = rng.integers(0, 6, size=(12, 2))
    labels = rng.integers(-1, 3, size=12)
    edges = np.asarray([(i, i + 1, int(rng.integers(0, 4))) for i in range(11)])

    class Shown:
        random = staticmethod(lambda n: np.zeros(n))

    f = pii.Field()
    np_rng, np.random.default_rng = np.random.default_rng, lambda seed: Shown
    try:
        f.fit(features, labels, edges, steps=1, rate=1e-3, l2=0)
    finally:
        np.random.default_rng = np_rng

    def loss(node, own):
        edge = own.copy()
        edge[pii.DIGITS:] += own[pii.SAME]
        total = 0
        for i in np.flatnonzero(labels >= 0):
            s = node[features[i]].sum(0)
            for a, b, t in edges:
                if labels[a] >= 0 and labels[b] >= 0:
                    s = s + (edge[t, labels[a]] if b == i else 0) + (edge[t, :, labels[b]] if a == i else 0)
            total -= s[labels[i]] - np.log(np.exp(s).sum())
        return total

    node, own = np.zeros((6, pii.N_LABELS)), np.zeros((4, pii.N_LABELS, pii.N_LABELS))
    for x, moved in ((node, f.node[:6]), (own[:pii.SAME], f.edge[:pii.SAME])):
        for at in np.ndindex(x.shape):
            x[at] = 1e-5
            up = loss(node, own)
            x[at] = -1e-5
            slope = (up - loss(node, own)) / 2e-5
            x[at] = 0
            if abs(slope) > 1e-6:
                assert np.sign(moved[at]) == -np.sign(slope), at


def card(rng):
    d = [rng.randint(0, 9) for _ in range(15)]
    body = "4" + "".join(map(str, d[1:]))
    return next(body + str(c) for c in range(10) if pii.luhn(body + str(c)))


def training_rows(seed=5, n=500):
    """Documents with an email, address, card, phone, a false card, plain numbers or none; some values repeat."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(n):
        entity = ["", f"{word()}.{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com",
                  ".".join(str(rng.randint(10, 250)) for _ in range(4)), card(rng),
                  f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
                  str(int(card(rng)) ^ 1), f"{rng.randint(1, 9)}.0.", f"{rng.randint(1900, 2030)}"][i % 8]
        words = [word() for _ in range(30)]
        for _ in range(2 if i % 3 == 0 else 1):
            words.insert(rng.randint(1, 28), entity)
        rows.append((i, " ".join(words), "en", "s", 1))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return pii.learn(docs_frame(spark, training_rows()))


def test_rows_and_digest(spark, model):
    rows = corpus(30) + training_rows(seed=9, n=60) + [(500 + i, c, "en", "s", 1) for i, c in enumerate(CASES)]
    got = pii.find(docs_frame(spark, rows, extra=True), field=model)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for r in rows:
        base = plain_spans(r[1])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in base)
        want.append((r[0], *(sum(b[2] == k for b in base) for k in range(4)), sha256(text.encode()).hexdigest(), text))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    found = sorted(map(tuple, got.collect()), key=key)
    want.sort(key=key)
    assert [f[:6] for f in found] == [w[:6] for w in want]
    for f, w in zip(found, want):                               # base spans stay
        assert set(w[6].split(",")) <= set(f[6].split(",")) or not w[6]


def added(model, text):
    g = pii.Graph()
    base = pii.add_text(g, 0, text)
    return [(pii.KINDS[k], text[s:e]) for s, e, k in pii.added_spans(model, g, [text]).get(0, [])], base


def test_the_field_adds_what_the_patterns_miss(model):
    c = card(random.Random(3))
    dotted, typo = f"{c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]}", c[:15] + str((int(c[15]) + 1) % 10)
    assert added(model, "call (487) 555-7209 now")[0] == [("phone", "(487) 555-7209")]
    assert added(model, "write to ab.34[at]mail7.example.com soon")[0] == [("email", "ab.34[at]mail7.example.com")]
    # distant words that are similar to a known one take its label
    far = " and more words follow here " * 20
    assert ("card", dotted) in added(model, f"pay {c}{far}or {dotted} is")[0]
    assert ("card", typo) in added(model, f"pay {c}{far}or {typo} is")[0]
    assert added(model, f"pay nothing{far}or {typo} is")[0] == []
    assert ("ip", "97-51-17-173") in added(model, f"at 97.51.17.173{far}or 97-51-17-173 too")[0]


def test_plain_numbers_are_left_alone(model):
    for text in ("in 2019 version 4.0. and 3.", "order 4111111111111112 of 12 items", "2020-01-02 12:30:45", "no digits at all",
                 "ISBN 978-3-16-148410-0 costs 12.50", 'token = "6df57b16f87eabefefcab67b433efd90"', "page 4111111111111112 " * 5):
        assert added(model, text)[0] == []


def test_repeated_rows_and_empty(spark, model):
    rows = training_rows(seed=11, n=40)
    one = sorted(map(tuple, pii.find(docs_frame(spark, rows), field=model).collect()))
    twice = sorted(map(tuple, pii.find(docs_frame(spark, rows * 2).repartition(5), field=model).collect()))
    assert twice == sorted(one * 2)
    assert pii.find(docs_frame(spark, [])).count() == 0
    none = pii.find(docs_frame(spark, [(1, "plain 12 words", "en", "s", 1), (2, None, None, None, None)])).collect()
    assert [(r["doc_id"], r["spans"], r["n_email"]) for r in none] == [(1, "", 0), (2, "", 0)]
