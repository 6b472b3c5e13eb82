"""Ordered operators keep every row exactly once: null times, repeated deliveries, all spans."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from msgflow.config import BatchPolicy, BreakerPolicy
from msgflow.operators.batching import assign_batches, batch_by_count
from msgflow.operators.breaker import Breaker, breaker_step, circuit_breaker
from msgflow.operators.handler import apply_handler, split_outcomes
from msgflow.operators.segments import NO_TIME
from msgflow.operators.strategies import fail_fast

START = dt.datetime(2024, 1, 1)
SPANS = [3, 8, 1 << 20]


def rows_with_gaps():
    """Twenty messages of two partitions, some without a time, a third delivered twice."""
    rows = []
    for i in range(20):
        row = {"partition": i % 2, "offset": i, "timestamp": None if i % 4 == 1 else START + dt.timedelta(seconds=i)}
        rows += [row] * (2 if i % 3 == 0 else 1)
    return rows


def key(row):
    return (row["partition"], row["offset"])


@pytest.fixture
def log(make):
    rows = rows_with_gaps()
    df = make([{**r, "payload": b"x", "headers": {"a": "b"}} for r in rows]).withColumn("ok", F.col("offset") % 5 < 2)
    return df.withColumn("error", F.when(~F.col("ok"), "bad"))


def counted(df):
    return Counter(key(r) for r in df.collect())


EXPECTED = Counter(key(r) for r in rows_with_gaps())


@pytest.mark.parametrize("span", SPANS)
@pytest.mark.parametrize("by", [["topic"], ["topic", "partition"]])
def test_no_row_is_lost_or_multiplied(log, by, span):
    assert counted(batch_by_count(log, 7, by=by, span=span)) == EXPECTED
    assert counted(assign_batches(log, BatchPolicy(4, 6000), by=by, span=span)) == EXPECTED
    assert counted(circuit_breaker(log, BreakerPolicy(2, 4000, 2), by=by, span=span)) == EXPECTED


@pytest.mark.parametrize("span", SPANS)
def test_count_batches_hold_their_size(log, span):
    sizes = Counter(r.batch_id for r in batch_by_count(log, 7, by=["topic"], span=span).collect())
    n = sum(EXPECTED.values())
    assert sorted(sizes.values(), reverse=True) == [7] * (n // 7) + ([n % 7] if n % 7 else [])


@pytest.mark.parametrize("span", SPANS)
def test_time_batches_equal_a_plain_loop(log, span):
    rows = sorted((r.partition, r.offset, r.timestamp) for r in log.collect())
    expected, open_batch = [], {}
    for p, o, t in rows:
        n, held, first = open_batch.get(p, (-1, 9, None))
        late = t is not None and first is not None and t - first >= dt.timedelta(seconds=6)
        n, held, first = (n + 1, 1, t) if held >= 4 or late else (n, held + 1, first)
        open_batch[p] = (n, held, first)
        expected.append((p, o, n))
    got = assign_batches(log, BatchPolicy(4, 6000), span=span)
    assert sorted((r.partition, r.offset, r.batch_id) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("span", SPANS)
def test_breaker_equals_a_plain_loop(log, span):
    policy = BreakerPolicy(2, 4000, 2)
    # Copies of a message have one outcome, so their order among each other does not matter.
    rows = sorted((r.partition, r.offset, r.timestamp or dt.datetime.min, r.ok) for r in log.collect())
    expected, breakers = [], {}
    for p, o, t, ok in rows:
        now = NO_TIME if t == dt.datetime.min else int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 10**6)
        breakers[p], action = breaker_step(breakers.get(p, Breaker()), ok, now, policy)
        expected.append((p, o, action, breakers[p].state))
    got = circuit_breaker(log, policy, span=span)
    assert sorted((r.partition, r.offset, r.action, r.state_after) for r in got.collect()) == sorted(expected)


def test_a_python_handler_runs_once_per_row(spark, make):
    calls = spark.sparkContext.accumulator(0)

    def handler(message):
        calls.add(1)
        return "bad" if message.offset % 3 == 0 else None

    outcomes = apply_handler(make([{"offset": i} for i in range(50)]), handler)
    for use in (
        lambda o: circuit_breaker(o, BreakerPolicy(2, 4000, 2)).count(),
        lambda o: [side.count() for side in split_outcomes(o)], lambda o: fail_fast(o).count(),
        lambda o: assign_batches(o, BatchPolicy(4, 6000), by=["topic"]).count(),
    ):
        before = calls.value
        use(outcomes)
        assert calls.value - before == 50


def test_positions_reach_the_scan(spark, make):
    from msgflow.operators.offsets import resume_from
    from msgflow.session import run_dir
    from msgflow.sources.topics import read_log

    path = run_dir(spark, "log")
    make([{"offset": i, "partition": i % 2} for i in range(40)]).write.parquet(path)
    commits = spark.createDataFrame([("orders", 0, 30)], "topic string, partition int, next_offset long")
    resumed = resume_from(read_log(spark, path), commits)
    assert sorted(r.offset for r in resumed.collect()) == sorted([i for i in range(40) if i % 2 or i >= 30])
    pushed = resumed._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert "GreaterThanOrEqual(offset,30)" in pushed
