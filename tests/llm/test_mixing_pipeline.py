from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import corpus, docs_frame

from quarry.llm import mixing


def brute_rake(cells, goals, rounds=4000):
    """Plain proportional fitting over the whole table."""
    w = {k: float(t) for k, t in cells.items() if t > 0}
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            sums = defaultdict(float)
            for k, x in w.items():
                sums[k[axis]] += x
            w = {k: x * goal.get(k[axis], 0) / sums[k[axis]] if sums[k[axis]] else 0.0 for k, x in w.items()}
    return w


def cells_of(seed=1, n=40):
    rng = np.random.default_rng(seed)
    return {(f"s{i}", x, y): int(rng.integers(1, 5000)) for i in range(n) for x in ("en", "de", "fr")
            for y in ("prose", "table") if rng.random() < 0.8 or x == "en"}


def test_rake_equals_plain_fitting(spark):
    cells = cells_of()
    df = spark.createDataFrame([(*k, t) for k, t in cells.items()], "source string, lang string, topic string, tokens bigint")
    goal_l, goal_t = {"en": 0.5, "de": 0.3, "fr": 0.2}, {"prose": 0.9, "table": 0.1}
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(df, goal_l, goal_t).collect()}
    sums = defaultdict(float)
    for k, t in cells.items():
        sums[k[0]] += t
    want = brute_rake(cells, [mixing.tempered(sums), goal_l, goal_t])
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)
    for x, g in goal_l.items():
        assert abs(sum(w for k, w in got.items() if k[1] == x) - g) < 1e-5


def test_probabilities_meet_the_budget(spark):
    cells = cells_of(2)
    df = spark.createDataFrame([(*k, t) for k, t in cells.items()], "source string, lang string, topic string, tokens bigint")
    got = mixing.probabilities(mixing.rake(df), 0.6).collect()
    assert all(0 <= r.probability <= 1 for r in got)
    assert abs(sum(r.tokens * r.probability for r in got) / sum(cells.values()) - 0.6) < 1e-4


@pytest.mark.parametrize("local, keep", [(20_000, 0.4), (0, 0.3)])
def test_probabilities_meet_the_margins(spark, monkeypatch, local, keep):
    monkeypatch.setattr(mixing, "LOCAL_CELLS", local)
    rng = np.random.default_rng(5)
    # a hot source and many small ones; cells of one size apart, so that the bound acts on many
    cells = {(f"s{i}", x, y): int(n * rng.integers(1, 40)) for i in range(30) for x, n in (("en", 50), ("de", 20), ("fr", 9))
             for y in ("prose", "table")}
    cells |= {("hot", x, y): 20_000 for x in ("en", "de", "fr") for y in ("prose", "table")}
    df = spark.createDataFrame([(*k, t) for k, t in cells.items()], "source string, lang string, topic string, tokens bigint")
    got = mixing.probabilities(mixing.rake(df, {"en": 0.35, "de": 0.35, "fr": 0.3}, {"prose": 0.6, "table": 0.4}), keep)
    rows = got.collect()
    whole = sum(cells.values())
    assert sum(r.probability > 1 - 1e-9 for r in rows) > 20              # the bound acts
    assert abs(sum(r.tokens * r.probability for r in rows) / whole - keep) < 1e-5
    report = {(r.margin, r.value): r for r in mixing.attained(got).collect()}
    for axis, name in enumerate(("source", "lang", "topic")):
        room, want = defaultdict(int), defaultdict(float)
        for k, t in cells.items():
            room[k[axis]] += t
        for r in rows:
            want[r[name]] += r.weight
        names = sorted(room)
        goal = mixing.fill(np.array([want[v] for v in names]), np.array([room[v] for v in names], float), keep * whole)
        assert abs(goal.sum() - keep * whole) < 1e-3
        for v, g in zip(names, goal):
            assert abs(report[name, v].share - g / (keep * whole)) < 1e-4 and abs(report[name, v].target - want[v]) < 1e-9
            if name != "source":                                         # within reach here: the targets themselves
                assert abs(report[name, v].share - want[v]) < 1e-4


def test_rows_and_draws(spark):
    rows = corpus(200)
    df = docs_frame(spark, rows, extra=True)
    got = mixing.mixture_rows(df.drop("topic").repartition(3)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r.probability <= 1 and r.n_tokens >= 0 for r in got)
    again = {(r.doc_id, r.sampled) for r in mixing.mixture_rows(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.sampled) for r in got}                 # the draw does not depend on the layout
    out = mixing.sample(df)
    assert out.columns == df.columns and out.count() == sum(r.sampled for r in got)


def test_zero_targets_and_empty(spark):
    df = docs_frame(spark, corpus())
    kept = mixing.sample(df, lang_target={"en": 1.0}, keep=0.2).collect()
    assert kept and {r.lang for r in kept if (r.text or "").split()} == {"en"}
    assert mixing.mixture_rows(docs_frame(spark, [])).count() == 0
    assert mixing.mixture_rows(docs_frame(spark, [(1, None, None, None, None)])).count() == 1


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output over a small corpus."""
    import corpus_pipeline
    folder = tmp_path_factory.mktemp("sf")
    docs_frame(spark, corpus(120)).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(folder))
        path = f"{folder}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        held.append((docs, spark.read.parquet(path)))
        docs = held[-1][1]
    return str(folder), held


def test_stages_equal_their_operators(spark, stages):
    from quarry.llm import quality, simhash, substring
    folder, held = stages
    columns = held[0][0].columns
    assert [o.columns for _, o in held[:-1]] == [columns] * 4
    (a, b), (_, c), (_, d), (_, e), (_, f) = held
    key = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    verdict = {(r.doc_id, r.n_words): r.kept for r in quality.quality_rows(a).collect()}
    n = lambda t: len((t or "").encode().split())
    assert key(b) == Counter({k: v for k, v in key(a).items() if verdict[(k[0], n(k[1]))]})
    groups = {r.component_id for r in simhash.near_duplicates(b).collect()}
    assert Counter(r.doc_id for r in c.collect()) == Counter(groups)
    left = {r.doc_id: r.n_words - r.n_removed for r in substring.removal_rows(c).collect()}
    assert {r.doc_id: n(r.text) for r in d.collect()} == {i: k for i, k in left.items() if k}
    drawn = {r.doc_id for r in mixing.mixture_rows(d).collect() if r.sampled}
    assert {r.doc_id for r in e.collect()} == drawn
    assert {r.doc_id for r in f.collect()} == drawn


def test_run_equals_the_stages(spark, stages):
    import corpus_pipeline
    folder, held = stages
    pieces = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert pieces(corpus_pipeline.run(spark, folder)) == pieces(held[-1][1])


def test_empty_corpus_runs(spark, tmp_path):
    import corpus_pipeline
    docs_frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_queries():
    import __spark_entry__ as entry
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)} and "pipeline" in names
    assert {"op7_host_quality_rules", "op8_count_min_substring_dedup", "op9_branch_and_bound_topk"} <= set(entry.oracle_sql())
