"""A batch of a job's events is thinned by segments (W5's rule)."""

import random

import numpy as np

from quarry.operators import windows as wn


def log(n, seed):
    rng = random.Random(seed)
    at, rows = 0, []
    for _ in range(n):
        at += rng.choice([0, 1, 3, 3, 3, 12]) * 1_000_000
        rows.append((at, rng.choice(["search"] * 6 + ["fetch", "write", None]), rng.choice(["RUNNING"] * 9 + ["PAUSED"]),
                     rng.randint(0, 110), rng.choice([0, 5, 10]), rng.choice([0, 5, 10]), rng.choice([0, 10])))
    return [list(c) for c in zip(*rows)]


def test_segments_of_a_batch_equal_the_rule():
    for seed in range(40):
        rule = wn.ProgressRule(*log(300, seed))
        for last in (None, rule.event(150), (10 ** 15, "search", "RUNNING", 0.0, 0.0, 0.0, 0.0)):      # the last one is newer than all
            want, want_last = rule.keep(0, 300, last)
            got, got_last = rule.keep_each(wn.progress_cuts(rule), last)
            assert np.array_equal(got, want) and got_last == want_last


def test_many_segments_are_judged_at_once(monkeypatch):
    """One step for each event of the longest segment, not for each kept event."""
    n = 10_000
    at = [i * 3_000_000 for i in range(n)]
    rule = wn.ProgressRule(at, [("search", "fetch", "write")[i // 20 % 3] for i in range(n)], ["RUNNING"] * n, *[[0] * n] * 4)
    calls = []
    plain = wn.ProgressRule._kept
    monkeypatch.setattr(wn.ProgressRule, "_kept", lambda *a: calls.append(1) or plain(*a))
    flags, _ = rule.keep_each(wn.progress_cuts(rule), None)
    assert flags.sum() == 2500 and len(calls) < 100
