import hashlib
from collections import Counter

import pytest
from helpers_llm import corpus, docs_frame

from quarry.llm import substring


def brute(rows, w):
    texts = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(t[i:i + w]) for t in texts for i in range(len(t) - w + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = {j for i in range(len(t) - w + 1) if seen[tuple(t[i:i + w])] > 1 for j in range(i, i + w)}
        kept = b" ".join(x for j, x in enumerate(t) if j not in gone)
        out.append((r[0], len(t), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window,frequent,chunk,cells", [
    (35, 64, 1 << 19, 1 << 30), (35, 2, 300, 1 << 30), (12, 3, 900, 1 << 10), (9, 64, 1 << 19, 1 << 12)])
def test_rows_equal_brute_force(spark, monkeypatch, window, frequent, chunk, cells):
    monkeypatch.setattr(substring, "FREQUENT", frequent)
    monkeypatch.setattr(substring, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(substring, "MAX_CELLS", cells)
    rows = corpus()
    got = substring.removal_rows(docs_frame(spark, rows, extra=True).repartition(3), window).collect()
    assert Counter(map(tuple, got)) == brute(rows, window)
    assert sum(r.n_removed for r in got) > 500


def test_text_without_ranges():
    r = lambda lo, hi: {"lo": lo, "hi": hi}
    assert substring.without_ranges("a  b\nc d", [r(1, 2)]) == "a\nc d"
    assert substring.without_ranges("a b c", [r(0, 2), r(1, 3)]) == ""
    assert substring.without_ranges(None, [r(0, 1)]) is None
    assert substring.without_ranges(" a b ", None) == " a b "


def test_remove_repeats_keeps_columns(spark):
    rows = corpus()
    df = docs_frame(spark, rows, extra=True)
    out = substring.remove_repeats(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    want = Counter((i, n - gone) for (i, n, gone, _), k in brute(rows, 35).items() for _ in range(k)
                   if n == gone == 0 or n > gone)
    got = out.collect()
    assert Counter((r.doc_id, len((r.text or "").encode().split())) for r in got) == want
    before = {r[0]: r[1] for r in rows}
    for r in got:
        if r.text != before[r.doc_id]:
            assert r.n_chars == len(r.text)


def test_empty(spark):
    assert substring.removal_rows(docs_frame(spark, [])).count() == 0
    assert substring.remove_repeats(docs_frame(spark, [])).count() == 0
