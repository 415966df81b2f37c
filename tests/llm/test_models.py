"""Language identification, toxicity and text scoring."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers_llm import corpus, docs_frame, prose

from quarry.llm import attention, langid, toxicity
from quarry.llm.common import fold_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12])
def test_codewords_are_apart(n):
    c = langid.codewords(n)
    gap = min(int((c[i] != c[j]).sum()) for i in range(n) for j in range(i))
    assert c.shape[0] == n and gap >= (2 ** (n - 2) if n <= 7 else 8)


def test_wrong_bits_are_outvoted():
    rng = random.Random(1)
    langs = ["a", "b", "c", "d"]
    counts = np.zeros((4, langid.BUCKETS))
    for k, stem in enumerate(["th", "sch", "é", "ñ"]):
        for g in langid._grams([prose(rng, 400, stem)])[0]:
            counts[k] += np.bincount(g.astype(np.int64), minlength=langid.BUCKETS)
    model = langid.Decoder(langs, counts)
    text = [prose(rng, 30, "sch")]
    assert model.decode(text)[0] == ["b"]
    model.table[:, 2] *= -1                                              # one classifier always wrong
    assert model.decode(text)[0] == ["b"]


def lang_rows():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, prose(rng, rng.randint(3, 60), {"en": "th", "de": "sch", "fr": "é"}[lang]), lang, "s", 1))
    return rows + [(400, None, "en", None, 1), (401, "12 34 !", "en", None, 1), (402, "", None, None, 1),
                   (None, rows[0][1], None, None, 1), rows[5], (403, rows[1][1] * 300, None, None, 1)]


def test_language_on_held_out(spark):
    rows = lang_rows()
    got = langid.predict(docs_frame(spark, rows, extra=True).repartition(3)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    truth = {r[0]: r[2] for r in rows[:300]}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all(r.held_out == (fold_of(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[400].lang_pred == by[401].lang_pred == by[402].lang_pred == "und" and by[403].lang_pred == "de"


def test_language_without_training_rows(spark):
    got = langid.predict(docs_frame(spark, [(1, "abc", None, None, 1)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert langid.predict(docs_frame(spark, [])).count() == 0


def tox_frames(spark, interact: bool):
    """Toxic: an insult (or, with ``interact``, only insult and group together)."""
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(3000):
        words = prose(rng, rng.randint(20, 120)).split()
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        if insult:
            words[3] = rng.choice(["Dreckig", "dreckiger", "dreckigen"])
        if group:
            words[7] = "nachbarn"
        docs.append((i, " ".join(words), "de", "s", 1))
        labels.append((i, 1, int(insult and (group or not interact))))
    docs += [(4000, None, None, None, 1), (4001, "", "de", None, 1), (None, "dreckig " * 5000, None, None, 1), docs[0]]
    labels += [(None, 1, 1), (0, 1, None), (5, 1, 7), (1, 1, labels[1][2]), (99999, 1, 1)]
    return docs_frame(spark, docs, extra=True), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), docs, labels


@pytest.mark.parametrize("interact", [False, True])
def test_toxicity_on_held_out(spark, interact):
    df, lab, docs, labels = tox_frames(spark, interact)
    got = toxicity.score(df.repartition(3), lab).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in docs)
    truth = {i: t for i, _, t in labels[:3000]}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200
    wrong = sum(r.predicted != truth[r.doc_id] for r in held)
    assert wrong <= 0.03 * len(held)                                     # pairs are learned, not only terms
    assert all(r.held_out == (fold_of(r.doc_id, 3) == 1) and 0 <= r.score <= 1
               and r.predicted == int(r.score >= 0.7) for r in got)


def test_machine_equals_pair_sum():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(np.arange(5), 0.3, rng.normal(size=5), rng.normal(size=(5, 8)))
    m.known = lambda w: (int(w[1:]),) if w[0] == "t" and len(w) > 1 else ()
    toxicity_words = toxicity.words
    try:
        toxicity.words = lambda t: set(t.split())
        want = 0.3 + m.w[[0, 2, 4]].sum() + m.v[0] @ m.v[2] + m.v[0] @ m.v[4] + m.v[2] @ m.v[4]
        assert math.isclose(m.margin("t0 t2 t4 x t4"), want)
    finally:
        toxicity.words = toxicity_words


def test_toxicity_without_labels(spark):
    df, lab, _, _ = tox_frames(spark, False)
    assert {(r.score, r.predicted) for r in toxicity.score(df, lab.limit(0)).collect()} == {(0.0, 0)}
    assert toxicity.score(df.limit(0), lab).count() == 0


def test_gradients_are_right():
    rng = np.random.default_rng(2)
    net = attention.Network(30, 5)
    rows = rng.integers(0, 30, (3, attention.CONTEXT + attention.STRIDE))
    target = rng.integers(0, 5, 3 * attention.STRIDE)
    weight = rng.integers(0, 2, 3 * attention.STRIDE).astype(np.float32)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    _, grad = net.step(rows, target, weight)
    for name, g in grad.items():
        at = tuple(int(rng.integers(0, n)) for n in g.shape)
        if name == "emb":
            at = (int(rows[0, 20]), 3)
        held, eps = net.p[name][at], 1e-5
        net.p[name][at] = held + eps
        up = net.step(rows, target, weight)[0]
        net.p[name][at] = held - eps
        down = net.step(rows, target, weight)[0]
        net.p[name][at] = held
        assert math.isclose((up - down) / (2 * eps), g[at], rel_tol=1e-3, abs_tol=1e-6), name


@pytest.mark.parametrize("scale", [1, 30])
def test_fast_scoring_equals_forward(scale):
    rng = np.random.default_rng(4)
    net = attention.Network(50, 9)
    net.p["emb"] *= scale                                                # large logits take the shifted path
    rows = rng.integers(0, 50, (7, attention.CONTEXT + attention.STRIDE))
    kind = rng.integers(0, 9, 7 * attention.STRIDE)
    want = attention._softmax_loss(net.forward(rows, net.tables()).astype(np.float64), kind)[0]
    got = net.class_log_probs(rows, kind, net.scoring_tables())
    assert np.allclose(got, want, rtol=1e-3, atol=1e-2 * scale)


def test_windows_score_each_symbol_once_and_causally():
    syms = np.arange(40) * 2
    model = attention.Model(syms, np.ones(40), np.ones(40), 10 ** 8)
    model.kind = model.rank % attention.CLASSES
    model.finish()
    rng = np.random.default_rng(3)
    docs = [rng.choice(syms, n) for n in (1, 24, 25, 70, 3)]
    flat = np.concatenate(docs)
    size = np.array([len(d) for d in docs])
    first = np.cumsum(size) - size
    lp = model.log_probs(flat, first, size)[0]
    for d, f in zip(docs, first):                                        # documents do not see each other
        alone = model.log_probs(d, np.zeros(1, np.int64), np.array([len(d)]))[0]
        assert np.allclose(alone, lp[f:f + len(d)], atol=1e-4)
    changed = flat.copy()
    changed[-4] = syms[(np.flatnonzero(syms == flat[-4])[0] + 1) % 40]   # a later symbol changes nothing before
    assert np.allclose(model.log_probs(changed, first, size)[0][:-4], lp[:-4], atol=1e-4)


def test_scores_and_counts(spark, monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 200)
    monkeypatch.setattr(attention, "BLOCK_WORDS", 1500)
    rows = corpus() + [(1000 + i, prose(random.Random(i), 80), "en", "s", 1) for i in range(60)]
    got = attention.score(docs_frame(spark, rows, extra=True).repartition(3), PATH).collect()
    train = Counter()
    toks = lambda t: (t or "").encode().lower().split() + [b""]
    for r in rows:
        if fold_of(r[0], 7) != 2:
            train.update(toks(r[1]))
    n, v = sum(train.values()), len(train)
    want = Counter()
    for r in rows:
        t = toks(r[1])
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t)
        want[(r[0], fold_of(r[0], 7) == 2, len(t), sum(train[w] > 0 for w in t), n, round(base, 6))] += 1
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_without_training_rows(spark):
    held = next(i for i in range(100) if fold_of(i, 7) == 2)
    got = attention.score(docs_frame(spark, [(held, "a b", "en", "s", 1)]), PATH).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)]
    assert math.isfinite(got[0].score)
    assert attention.score(docs_frame(spark, []), PATH).count() == 0


def test_all_training_documents_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 1)
    held = {}
    fit = attention.fit
    monkeypatch.setattr(attention, "fit", lambda *a: held.setdefault("m", fit(*a)))
    rows = [(i, prose(random.Random(i), 30), "en", "s", 1) for i in range(900)]
    attention.score(docs_frame(spark, rows).repartition(3), PATH)
    model, sub = held["m"], attention.Subwords(PATH)
    docs = [sub.flat(r[1].encode().lower().split() + [b""])[0] for r in rows if fold_of(r[0], 7) != 2]
    assert len(docs) > 700 and model.learned == sum(-(-len(d) // attention.STRIDE) for d in docs)
    asked = set(np.concatenate(docs).tolist())                           # each has neighbours, so a class of its kind
    assert asked == set(model.symbols.tolist()) and (model.kind < attention.CLASSES).all()
    assert len(set(model.kind.tolist())) > attention.SINGLE + 10


def test_words_travel_packed(spark, monkeypatch):
    monkeypatch.setattr(attention, "BLOCK_WORDS", 2000)
    odd = ["", None, " \t ", "A\x0bb\x1cc\x85d\x00 İX e f\r\n  a", "a " * 70]
    rows = [(i, odd[i] if i < len(odd) else prose(random.Random(i), i % 90), "en", "s", 1) for i in range(400)]
    docs = docs_frame(spark, rows + rows[:3]).repartition(2).selectExpr("doc_id", "crc32(cast(doc_id as string)) % 7 = 2 AS held", "text")
    blocks = attention.stash(attention._blocks(docs), "test-blocks")
    totals = attention._totals(blocks, 5, PATH)
    kinds = len({w for r in rows for w in (r[1] or "").encode().lower().split() + [b""]})
    n_blocks = blocks.count()
    assert n_blocks > 3 and totals.count() <= 5 * n_blocks < kinds       # not a row for each block and word
    train, seen, fresh, uses, sub = Counter(), Counter(), 0, 0, attention.Subwords(PATH)
    for r in rows + rows[:3]:
        if fold_of(r[0], 7) != 2:
            train.update((r[1] or "").encode().lower().split() + [b""])
    text = {r[0]: r[1] for r in rows}
    for r in attention._counted(blocks, totals, 5).collect():
        block, fresh, uses = attention._Block(r.asDict()), fresh + r.fresh, uses + r.uses
        for k, i in enumerate(block.ids.tolist()):
            words = (text[i] or "").encode().lower().split() + [b""]
            at = block.locals[block.first[k]:block.first[k] + block.sizes[k]]
            assert block.total[at].tolist() == [train[w] for w in words]
            symbols = np.concatenate([block.symbols[block.off[x]:block.off[x] + block.per[x]] for x in at])
            assert symbols.tolist() == sub.flat(words)[0].tolist()
            seen[i] += 1
    assert seen == Counter(r[0] for r in rows + rows[:3]) and (fresh, uses) == (len(train), sum(train.values()))
