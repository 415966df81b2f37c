import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from helpers_llm import corpus, docs_frame

from quarry.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b ", " a", "\ta\nb", "ﬁ é é", "x\x00y", "<s> a</s> <|endoftext|> z", "▁a", "a <0x41>", "　a b", "it's don't",
       "\U0001F600 \U0001F469‍\U0001F469 x", "naïve façade", " ", "\n\n", "a\x1cb c\x85 d", "1234567 8.9.10", "a\r\n b  c\t d",
       "word" * 300, "़ा ा", "‏ ا", "<unk> ok"]


def tokens(text):
    """[(id, bytes)] of both tokenizers by their plain use on the whole text; None if they do not rebuild it."""
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)})
    if not text:
        return None
    e = tok.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(table[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
    b = []
    for i in sp.encode(text):
        piece = sp.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == whole else None


def ends(seq):
    at, out = 0, []
    for _, x in seq:
        at += len(x)
        out.append(at)
    return out


def plain(texts, links="end"):
    """The contract by the plainest code: rows without doc_id."""
    docs, count = [], Counter()
    for text in texts:
        got = tokens(text)
        if got is None:
            docs.append(None)
            continue
        a, b = got
        ea, eb = ends(a), ends(b)
        shared = sorted(set(ea) & set(eb))
        groups, lo = [], 0
        for hi in shared:
            groups.append(",".join(str(i) for (i, _), e in zip(a, ea) if lo < e <= hi) + "|"
                          + ",".join(str(i) for (i, _), e in zip(b, eb) if lo < e <= hi))
            lo = hi
        if links == "end":
            pairs = [(i, j) for (i, _), x in zip(a, ea) for (j, _), y in zip(b, eb) if x == y]
        else:
            pairs = [(i, j) for (i, u), x in zip(a, ea) for (j, v), y in zip(b, eb) if max(x - len(u), y - len(v)) < min(x, y)]
        count.update(pairs)
        docs.append((len(a), len(b), groups, pairs))
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((d[0], d[1], len(d[2]), len(d[3]), sum(count[p] == top[p[1]] for p in d[3]),
                        sum(count[p] for p in d[3]), sha256(";".join(d[2]).encode()).hexdigest()))
    return out


def fixture():
    rng = random.Random(3)
    texts = [r[1] and r[1][:400] for r in corpus(25, seed=6)] + ODD + [None, "", ODD[0]]
    texts += ["".join(rng.choice("abé 1,.'\n ßx") for _ in range(80)) for _ in range(40)]
    return [(i if i % 9 else None, t, "en", "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("links,head", [("end", al.HEAD), ("end", 3), ("overlap", 40)])
def test_equals_brute_force(spark, links, head):
    rows = fixture()
    got = al.align(docs_frame(spark, rows, extra=True), A, B, links=links, head=head)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows], links))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_groups_are_given_as_text(spark):
    row = al.alignments(docs_frame(spark, [(1, "unbelievable façades", "en", "s", 1)]), A, B).first()
    groups = [[[int(x) for x in side.split(",")] for side in g.split("|")] for g in row["groups"].split(";")]
    a, b = tokens("unbelievable façades")
    assert [i for g in groups for i in g[0]] == [i for i, _ in a] and [i for g in groups for i in g[1]] == [i for i, _ in b]
    assert row["groups_sha256"] == sha256(row["groups"].encode()).hexdigest()


@pytest.mark.parametrize("seed", range(30))
def test_coalescing_random_cuts(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 60)
    a = sorted({n, *(rng.randint(1, n) for _ in range(rng.randint(0, 30)))})
    b = sorted({n, *(rng.randint(1, n) for _ in range(rng.randint(0, 30)))})
    starts, ends_ = np.asarray([0, *a[:-1], 0, *b[:-1]]), np.asarray(a + b)
    order, group = al.coalesce(starts, ends_)
    cuts = sorted(set(a) & set(b))
    assert [int(g) for g in group] == [sum(c <= starts[i] for c in cuts) for i in order]
    pairs = lambda f: list(zip(*(x.tolist() for x in f(np.asarray(a), np.asarray(b)))))
    assert pairs(al.end_pairs) == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x == y]
    assert pairs(al.overlap_pairs) == [(i, j) for i in range(len(a)) for j in range(len(b))
                                       if max(starts[i], starts[len(a) + j]) < min(a[i], b[j])]


def test_empty_table(spark):
    assert al.align(docs_frame(spark, []), A, B).count() == 0
