import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from msgflow import BreakerPolicy, CircuitBreaker, RetryPolicy
from msgflow.operators import breaker as K
from msgflow.operators.strategies import apply_strategy, merge_routes

SCHEMA = "ok boolean, error string"


def outcomes(make, pattern, times=None):
    """'F' fails, 'S' succeeds; one second apart unless ``times`` says otherwise."""
    rows = [
        {"ok": c == "S", "error": None if c == "S" else f"e{i}", "at": times[i] if times else i}
        for i, c in enumerate(pattern)
    ]
    return make(rows, SCHEMA)


def replay(make, pattern, policy, times=None, span=3):
    out = K.circuit_breaker(outcomes(make, pattern, times), policy, span=span).orderBy("offset")
    return [(r.action, r.state_after) for r in out.collect()]


def test_trips_at_the_threshold(make):
    policy = BreakerPolicy(threshold=3, cooldown_ms=60_000)
    assert replay(make, "FFF", policy) == [
        ("continue", "closed"), ("continue", "closed"), ("tripped", "open"),
    ]


def test_success_resets_the_count(make):
    policy = BreakerPolicy(threshold=3, cooldown_ms=60_000)
    actions = [a for a, _ in replay(make, "FFSFFF", policy)]
    assert actions == ["continue", "continue", "ok", "continue", "continue", "tripped"]


def test_probe_after_the_cooldown(make):
    policy = BreakerPolicy(threshold=1, cooldown_ms=5_000)
    assert replay(make, "FFF", policy, [0, 4, 5]) == [
        ("tripped", "open"), ("rejected", "open"), ("probe", "half-open"),
    ]


def test_recovery_needs_enough_successes(make):
    policy = BreakerPolicy(threshold=1, cooldown_ms=5_000, half_open_attempts=2)
    assert replay(make, "FFSS", policy, [0, 6, 7, 8])[-2:] == [("ok", "half-open"), ("closed", "closed")]


def test_relapse_reopens(make):
    policy = BreakerPolicy(threshold=1, cooldown_ms=5_000, half_open_attempts=2)
    assert replay(make, "FFSF", policy, [0, 6, 7, 8])[-1] == ("reopened", "open")


def test_success_while_open_changes_nothing(make):
    policy = BreakerPolicy(threshold=1, cooldown_ms=5_000)
    assert replay(make, "FSS", policy, [0, 9, 10])[1:] == [("ok", "open"), ("ok", "open")]


def loop(rows, policy, start=K.Breaker()):
    b, out = start, []
    for ok, us in rows:
        before = b.state
        b, action = K.breaker_step(b, ok, us, policy)
        out.append((before, b.state, b.failures, b.successes, action))
    return out, b


def random_outcomes(seed, n, fail, step, late):
    rng = random.Random(seed)
    rows, at, offset = [], {}, {}
    for _ in range(n):
        p = 0 if rng.random() < 0.7 else rng.choice([1, 2])
        at[p] = at.get(p, 0) + rng.randint(0, step)
        offset[p] = offset.get(p, -1) + rng.choice([1, 1, 2])
        ok = rng.random() >= fail
        rows.append(
            {"partition": p, "offset": offset[p], "at": at[p] + rng.randint(-late, late), "ok": ok,
             "error": None if ok else "e"}
        )
    return rows


def key_rows(rows, p):
    mine = sorted((r for r in rows if r.partition == p), key=lambda r: r.offset)
    return mine, [
        (r.ok, int(r.timestamp.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)) for r in mine
    ]


CASES = [
    # seed, failing share, time step, lateness, threshold, cooldown s, half-open, span
    (1, 0.3, 3, 0, 2, 20, 2, 7), (2, 0.6, 3, 0, 3, 10, 1, 5), (3, 0.9, 2, 0, 4, 30, 3, 11),
    (4, 0.5, 4, 6, 2, 15, 2, 6), (5, 0.95, 1, 3, 10, 5, 2, 4), (6, 0.1, 3, 0, 1, 40, 4, 9),
    (7, 0.5, 1, 0, 1, 500, 1, 3), (8, 0.4, 3, 0, 2, 20, 2, 100000), (9, 0.7, 2, 2, 3, 6, 5, 1),
]


@pytest.mark.parametrize("seed, fail, step, late, threshold, cooldown, attempts, span", CASES)
def test_replay_equals_a_loop(make, seed, fail, step, late, threshold, cooldown, attempts, span):
    policy = BreakerPolicy(threshold, cooldown * 1000, attempts)
    df = make(random_outcomes(seed, 500, fail, step, late), SCHEMA).repartition(5)
    log = K.circuit_breaker(df, policy, span=span)
    rows = log.collect()
    final = {r.partition: r for r in K.breaker_state(df, policy, span=span).collect()}
    assert len(rows) == 500
    for p in (0, 1, 2):
        mine, plain = key_rows(rows, p)
        expected, end = loop(plain, policy)
        got = [
            (r.state_before, r.state_after, r.failure_count, r.success_count, r.action) for r in mine
        ]
        assert got == expected
        assert K.Breaker(*(final[p][c] for c in K.Breaker._fields)) == end


@pytest.mark.parametrize("cut", [1, 60, 150])
def test_state_carries_over(make, cut):
    policy = BreakerPolicy(2, 15_000, 2)
    rows = random_outcomes(12, 300, 0.5, 3, 2)
    df = make(rows, SCHEMA)
    early, late = df.filter(F.col("offset") < cut), df.filter(F.col("offset") >= cut)
    state = K.breaker_state(early, policy, span=8)
    again = K.circuit_breaker(late, policy, span=8, initial=state)
    whole = K.circuit_breaker(df, policy, span=8).filter(F.col("offset") >= cut)
    columns = ["partition", "offset", "state_before", "state_after", "failure_count", "success_count", "action"]
    assert sorted(again.select(*columns).collect()) == sorted(whole.select(*columns).collect())


@pytest.mark.parametrize("span", [1, 5, 1000])
def test_failure_runs_equal_a_loop(make, span):
    df = make(random_outcomes(3, 400, 0.6, 1, 0), SCHEMA)
    rows = K.failure_runs(df, span=span).collect()
    for p in (0, 1, 2):
        run = 0
        for r in sorted((r for r in rows if r.partition == p), key=lambda r: r.offset):
            run = 0 if r.ok else run + 1
            assert r.failure_run == run


def test_summary(make):
    policy = BreakerPolicy(threshold=1, cooldown_ms=5_000, half_open_attempts=1)
    log = K.circuit_breaker(outcomes(make, "FFFSFS", [0, 2, 6, 7, 8, 20]), policy)
    r = K.breaker_summary(log).first()
    assert (r.trips, r.reopenings, r.probes, r.closings, r.rejected) == (2, 0, 1, 1, 1)
    assert r.open_ms == 6_000 + 12_000


def test_routes_with_retry(make):
    policy = BreakerPolicy(2, 5_000, 2, retry=RetryPolicy("r", "d"))
    out = apply_strategy(
        outcomes(make, "FFFFSF", [0, 1, 2, 7, 8, 9]), CircuitBreaker(policy)
    ).orderBy("offset")
    assert [(r.action, r.route, r.fatal) for r in out.collect()] == [
        ("continue", "retry", False), ("tripped", "retry", True), ("rejected", "stop", True),
        ("probe", "commit", False), ("ok", "commit", False), ("reopened", "retry", False),
    ]
    assert [r.offset for r in merge_routes(out).orderBy("offset").collect()] == [0, 3, 4, 5]


def test_routes_without_retry(make):
    out = apply_strategy(
        outcomes(make, "FFFSF", [0, 1, 7, 8, 9]), CircuitBreaker(BreakerPolicy(2, 5_000, 2))
    ).orderBy("offset")
    rows = out.collect()
    assert [(r.action, r.route) for r in rows] == [
        ("continue", "commit"), ("tripped", "stop"), ("probe", "commit"), ("ok", "commit"),
        ("reopened", "stop"),
    ]
    assert rows[1].stop_error == "circuit breaker opened after 2 consecutive failures"
    assert rows[4].stop_error == "circuit breaker reopened after half-open failure: e4"


def arrays(rng, n, fail, policy):
    import numpy as np

    ok = np.array([rng.random() >= fail for _ in range(n)], bool)
    us = np.cumsum([rng.randint(0, 4) for _ in range(n)]) * 1000 + np.array([rng.randint(-2000, 2000) for _ in range(n)])
    if n and rng.random() < 0.2:
        us[rng.randrange(n)] = K.NO_TIME
    state = rng.choice([
        K.Breaker("closed", rng.randrange(policy.threshold)),
        K.Breaker("half-open", rng.choice([0, policy.threshold]), rng.randrange(policy.half_open_attempts)),
        K.Breaker("open", rng.choice([0, policy.threshold]), 0, rng.randint(-20_000, 20_000)),
    ])
    return ok, us.astype(np.int64), state


class Cell:
    """A list element as a fold sees it."""

    def __init__(self, value):
        self.value = value

    def as_py(self):
        return self.value


def summary_row(ends):
    import numpy as np

    row = {**ends, **{k: [Cell(v) for v in ends[k]] for k in ("_trips", "_closes", "_probes")}}
    times = np.array(ends["_probe_us"], np.int64)
    row["_probe_us"] = type("Times", (), {"to_numpy": lambda self: times})()
    return row


@pytest.mark.parametrize("inline", [0, 2, 64])
def test_arrays_equal_the_steps(tmp_path, monkeypatch, inline):
    monkeypatch.setattr(K, "INLINE_PROBES", inline)
    rng = random.Random(inline)
    for _ in range(1500):
        policy = BreakerPolicy(rng.randint(1, 4), rng.randint(1, 20), rng.randint(1, 3))
        ok, us, start = arrays(rng, rng.randint(1, 40), rng.random(), policy)
        expected, end = loop(list(zip(ok.tolist(), us.tolist())), policy, start)
        got = K._replayed(start, ok, us, policy)
        assert expected == [
            (K.STATES[a], K.STATES[b], f, s, K.ACTIONS[x])
            for a, b, f, s, x in zip(*(got[k].tolist() for k in ("before", "after", "failures", "successes", "action")))
        ]
        ends = K._segment_ends(ok, us, policy, str(tmp_path))
        assert K._inherit_breaker(start, summary_row(ends), policy) == end


def test_summary_of_many_failures_inside_one_cooldown_is_small(tmp_path):
    """Every failure could be the probe and ends in a state of its own; the summary does not grow with them."""
    import numpy as np

    n = 200_000
    policy = BreakerPolicy(2, 1_000_000, 2)
    us = np.arange(n, dtype=np.int64) * 1000
    ends = K._segment_ends(np.zeros(n, bool), us, policy, str(tmp_path))
    assert len(ends["_probes"]) == len(ends["_probe_us"]) == 0 and ends["_probe_file"]
    assert len(ends["_trips"]) <= policy.threshold and len(ends["_closes"]) <= policy.half_open_attempts
    for late in (0, 5, 150_000, n - 2):
        start = K.Breaker("open", 2, 0, int(us[late]) - policy.cooldown_ms * 1000)
        _, end = loop(zip([False] * (n - late), us[late:].tolist()), policy, start)
        assert K._inherit_breaker(start, summary_row(ends), policy) == end


def test_lookup_files_find_the_first_key(tmp_path):
    import numpy as np

    from msgflow.operators import lookup_files as L

    rng = np.random.default_rng(1)
    for n in (1, 3, L.PAGE - 1, L.PAGE, L.PAGE + 1, 3 * L.PAGE):
        keys = np.sort(rng.integers(0, 2 * n, n))
        L.write_lookup(f"{tmp_path}/{n}", keys, np.stack([keys, np.arange(n)], axis=1))
        for key in (-1, 0, n, int(keys[n // 2]), int(keys[-1]), int(keys[-1]) + 1):
            at = int(np.searchsorted(keys, key))
            assert L.first_at_least(f"{tmp_path}/{n}", key) == ([int(keys[at]), at] if at < n else None)


def test_long_cooldowns_go_through_files(make, monkeypatch):
    monkeypatch.setattr(K, "INLINE_PROBES", 0)
    policy = BreakerPolicy(2, 60_000, 2)
    df = make(random_outcomes(21, 600, 0.8, 3, 2), SCHEMA).repartition(4)
    rows = K.circuit_breaker(df, policy, span=9).collect()
    for p in (0, 1, 2):
        mine, plain = key_rows(rows, p)
        expected, _ = loop(plain, policy)
        assert expected == [(r.state_before, r.state_after, r.failure_count, r.success_count, r.action) for r in mine]


def test_short_errors_go_along_and_long_ones_join(make):
    rng = random.Random(4)
    pattern = [rng.choice("FFS") for _ in range(300)]
    short = outcomes(make, pattern).select("topic", "partition", "offset", "timestamp", "ok", "error")
    long = short.withColumn("error", F.when(F.col("offset") == 0, F.expr("repeat('e', 3000000)")).otherwise(F.col("error")))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    policy = BreakerPolicy(threshold=3, cooldown_ms=5_000)
    taken, joined = (K.circuit_breaker(df, policy, span=64) for df in (short, long))
    assert "Window" not in plan(taken) and "Window" in plan(joined)
    added = [*K.ADDED]
    assert taken.columns == [*short.columns, *added]
    seen = lambda df: df.select("offset", "ok", F.col("timestamp"), *added).orderBy("offset").collect()
    assert seen(taken) == seen(joined)
    assert [r.error for r in taken.orderBy("offset").collect()] == [None if c == "S" else f"e{i}" for i, c in enumerate(pattern)]
