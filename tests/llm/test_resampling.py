import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from helpers_llm import corpus, docs_frame
from pyspark.sql import functions as F

from quarry.llm import resampling as rs


def plain(docs, target, share=(5, 100)):
    """The contract by the plainest code: [(doc_id, n_features, weight, score, rank)]."""
    def features(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return words, [zlib.crc32(r.encode()) % 10000 for r in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))),
                     len(words)])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = share[0] * len(able) // share[1]
    order = {id(r): n for n, r in enumerate(able[:k], 1)}
    return [(*r[:4], order.get(id(r))) for r in rows]


def by_all(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("share", [(5, 100), (60, 100), (100, 100)])
def test_equals_brute_force(spark, share):
    rows = corpus(80, seed=4) + [(900, "Same WORDS-here " * 30, "en", "s", 1)] * 7 + [(None, "no id " * 30, "en", "s", 1)] * 3
    target = [rows[2][1], None, "", rows[9][1], "Éa ßb 12"]
    got = rs.resample(docs_frame(spark, rows, extra=True), spark.createDataFrame([(t,) for t in target], "text string"),
                      share=share)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert by_all(map(tuple, got.collect())) == by_all(plain([r[:2] for r in rows], target, share))


def test_words_keep_all_but_ascii_punctuation():
    for text in ["AbC'd é_x1\x7f\x80ß", "\x00\n", "a" * 3000 + "-ÀB", "١ 2.3 _"]:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        assert [w.decode() for w in rs.words_of(text.encode())] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_empty_tables(spark):
    docs, target = docs_frame(spark, []), spark.createDataFrame([], "text string")
    assert rs.resample(docs, target).count() == 0
    short = rs.resample(docs_frame(spark, [(1, "a b", "en", "s", 3), (2, None, None, None, None)]), target).collect()
    assert sorted((r["doc_id"], r["n_features"], r["rank"]) for r in short) == [(1, 3, None), (2, 0, None)]


@pytest.mark.parametrize("seed", range(6))
def test_quickselect_is_exact_for_every_k(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 5, 40, 300])
    keys = [(rng.choice([0, 0, 1, 7, rng.randint(-10 ** 12, 10 ** 12)]), i) for i in range(n)]      # heavy ties, split by i
    df = spark.createDataFrame(keys, "a bigint, b bigint").select(F.struct("a", "b").alias("key")).repartition(3).cache()
    for k in {1, n, (n + 1) // 2}:
        assert rs.kth_key(df, k, pivots=4, seed=seed) == sorted(keys)[k - 1]
    assert rs.kth_key(df, n + 1, pivots=4) is None and rs.kth_key(df, 0) is None
    df.unpersist()


def test_target_like_documents_are_drawn(spark):
    """The draw prefers documents made of the target's words."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(vocab[:30] if i % 10 else vocab[30:]) for _ in range(40))) for i in range(400)]
    target = [(" ".join(rng.choice(vocab[30:]) for _ in range(40)),) for _ in range(20)]
    got = rs.resample(spark.createDataFrame(docs, "doc_id bigint, text string"),
                      spark.createDataFrame(target, "text string")).where("rank is not null").collect()
    assert len(got) == 20 and all(r["doc_id"] % 10 == 0 for r in got)
