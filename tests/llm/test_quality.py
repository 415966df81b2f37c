import re
from collections import Counter

from helpers_llm import corpus, docs_frame
from pyspark.sql import functions as F

from quarry.llm import quality


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    rows = corpus() + [(900, "a b c a b c", "en", "s", 1), (901, "x\nx\n \ny\nx", "en", "s", 1),
                       (902, "#a *b $ | <c>", "en", "s", 1), (903, "a b", "en", "s", 1), (904, "a a a a a", "en", "s", 1),
                       (905, "a\x0bb\x0cc\rd", "en", "s", 1), (906, "\na b\n\na b\n", "en", "s", 1)]
    got = quality.quality_rows(docs_frame(spark, rows, extra=True)).collect()
    want = Counter((r[0], *brute(r[1])) for r in rows)
    assert want == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_bad_host_turns_soft_rules_on(spark):
    from helpers_llm import prose
    import random
    rng = random.Random(3)
    rows = [(i, "bad", "en", "farm", 1) for i in range(40)]
    rows += [(100 + i, prose(rng, 80), "en", "fine", 1) for i in range(40)]
    rows += [(200, prose(rng, 80), "en", "farm", 1), (201, prose(rng, 80) + " #" * 30 + " " + prose(rng, 10), "en", "farm", 1),
             (202, prose(rng, 80) + " " + " ".join(f"#{i}" for i in range(30)), "en", "fine", 1)]
    kept = {r.doc_id: r.kept for r in quality.quality_rows(docs_frame(spark, rows)).collect()}
    assert kept[200] and not kept[201] and kept[202]                     # clean stays anywhere
    assert not kept[0] and kept[100]


def test_filter_keeps_rows_and_columns(spark):
    df = docs_frame(spark, corpus(), extra=True)
    out = quality.filter_documents(df)
    assert out.columns == df.columns
    assert 55 < out.count() < df.count()
    assert quality.filter_documents(docs_frame(spark, [])).count() == 0


def test_plan_is_native(spark):
    df = quality.quality_rows(docs_frame(spark, corpus()))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_columns_named_like_helpers_stay(spark):
    rows = corpus(20)
    df = docs_frame(spark, rows)
    for c in ("strict", "host_rate", "docs", "failed", "n_words", "kept"):
        df = df.withColumn(c, F.lit(c))
    out = quality.filter_documents(df)
    assert out.columns == df.columns
    plain = sorted(str(r["doc_id"]) for r in quality.filter_documents(docs_frame(spark, rows)).collect())
    assert sorted(str(r["doc_id"]) for r in out.where("strict = 'strict' AND host_rate = 'host_rate'").collect()) == plain
