import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from msgflow import BatchPolicy, apply_batch_handler
from msgflow.operators import batching as B
from msgflow.operators import offsets
from msgflow.operators.segments import first_reaching, with_position

import numpy as np


def greedy(rows, size, timeout_us):
    """Reference result: one loop over the rows of a key."""
    ids, batch, held, first = [], -1, 0, None
    for us in rows:
        if held == 0 or held >= size or us - first >= timeout_us:
            batch, held, first = batch + 1, 0, us
        held += 1
        ids.append(batch)
    return ids


def random_log(seed, n, gap_s, shuffled=False):
    rng = random.Random(seed)
    rows, at, offset = [], {}, {}
    for _ in range(n):
        # One hot partition with most of the rows.
        p = 0 if rng.random() < 0.7 else rng.choice([1, 2])
        at[p] = at.get(p, 0) + rng.choice([0, 1, rng.randint(0, gap_s)])
        offset[p] = offset.get(p, -1) + rng.choice([1, 1, 3])
        late = rng.randint(-5, 5) if shuffled else 0
        rows.append({"partition": p, "offset": offset[p], "at": at[p] + late})
    return rows


@pytest.mark.parametrize(
    "seed, size, timeout_s, span, shuffled",
    [
        (1, 5, 10, 7, False), (2, 5, 10, 1000, False), (3, 100, 10, 13, False),
        (4, 3, 100000, 5, False), (5, 1, 10, 3, False), (6, 8, 12, 11, True), (7, 50, 1, 2, True),
    ],
)
def test_greedy_batches_equal_a_loop(make, seed, size, timeout_s, span, shuffled):
    rows = random_log(seed, 600, 8, shuffled)
    df = make(rows).repartition(5)
    out = B.assign_batches(df, BatchPolicy(size, timeout_s * 1000), span=span).collect()
    assert len(out) == len(rows)
    for p in (0, 1, 2):
        mine = sorted((r for r in out if r.partition == p), key=lambda r: r.offset)
        us = [int(r.timestamp.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) for r in mine]
        assert [r.batch_id for r in mine] == greedy(us, size, timeout_s * 1_000_000)


def test_count_batches(make):
    rows = B.batch_by_count(make([{"payload": c.encode()} for c in "abcdef"]), 3)
    batches = B.batch_payloads(rows).orderBy("batch_id").collect()
    assert [[bytes(p) for p in b.payloads] for b in batches] == [[b"a", b"b", b"c"], [b"d", b"e", b"f"]]
    commits = offsets.commit_positions(rows, by=["batch_id"]).orderBy("batch_id").collect()
    assert [c.next_offset for c in commits] == [3, 6]


def test_time_closes_a_partial_batch(make):
    rows = [{"at": 0}, {"at": 1}, {"at": 10}]
    out = B.assign_batches(make(rows), BatchPolicy(10, 10_000)).orderBy("offset").collect()
    assert [r.batch_id for r in out] == [0, 0, 1]


def test_time_going_back_never_closes_a_batch(make):
    rows = [{"at": 100}, {"at": 0}, {"at": 50}, {"at": 109}, {"at": 110}]
    out = B.assign_batches(make(rows), BatchPolicy(10, 10_000), span=2).orderBy("offset").collect()
    assert [r.batch_id for r in out] == [0, 0, 0, 0, 1]


@pytest.mark.parametrize("span", [1, 4, 1 << 20])
@pytest.mark.parametrize("inputs", [1, 4, 13])
def test_count_batches_do_not_depend_on_partitioning(make, span, inputs):
    rows = random_log(11, 300, 3)
    out = B.batch_by_count(make(rows).repartition(inputs), 7, span=span).collect()
    for p in (0, 1, 2):
        mine = sorted((r.offset, r.batch_id) for r in out if r.partition == p)
        assert [b for _, b in mine] == [i // 7 for i in range(len(mine))]


def test_dense_offsets_need_no_order(make):
    df = make([{"offset": 40 + i} for i in range(23)])
    out = B.batch_by_count(df, 5, dense=True).orderBy("offset").collect()
    assert [r.batch_id for r in out] == [i // 5 for i in range(23)]
    plan = B.batch_by_count(df, 5, dense=True)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_tail_is_delivered_and_marked(make):
    df = B.batch_by_count(make([{}] * 5), 100)
    out = B.tail_batch(df, 100)
    assert out.count() == 5 and out.filter("is_partial").count() == 5
    exact = B.tail_batch(B.batch_by_count(make([{}] * 6), 3), 3)
    assert exact.filter("is_partial").count() == 0


def test_one_batch_over_partitions_commits_each(make):
    rows = [{"partition": p, "offset": o} for p, o in ((0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0))]
    batched = B.batch_by_count(make(rows), 6, by=["topic"])
    assert {r.batch_id for r in batched.collect()} == {0}
    commits = offsets.commit_positions(batched, by=["batch_id"]).collect()
    assert {(c.partition, c.next_offset) for c in commits} == {(0, 3), (1, 2), (2, 1)}


def test_greedy_batches_over_partitions(make):
    rows = random_log(21, 200, 4)
    out = B.assign_batches(make(rows), BatchPolicy(6, 9_000), by=["topic"]).collect()
    mine = sorted(out, key=lambda r: (r.timestamp, r.partition, r.offset))
    us = [int(r.timestamp.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) for r in mine]
    assert [r.batch_id for r in mine] == greedy(us, 6, 9_000_000)


def test_position_in_any_order(make):
    rows = random_log(31, 200, 2)
    order = ["timestamp", "partition", "offset"]
    out = with_position(make(rows), by=["topic"], order=order).collect()
    mine = sorted(out, key=lambda r: (r.timestamp, r.partition, r.offset))
    assert [r.position for r in mine] == list(range(200))


def test_one_failure_fails_the_batch(make):
    rows = [{"ok": i not in (1, 4), "error": f"e{i}" if i in (1, 4) else None} for i in range(9)]
    batched = B.batch_by_count(make(rows, "ok boolean, error string"), 3)
    out = B.atomic_batch_outcome(batched).orderBy("offset").collect()
    assert [(r.ok, r.error) for r in out] == [(False, "e1")] * 3 + [(False, "e4")] * 3 + [(True, None)] * 3


def test_batch_handler_sees_payloads_in_order(make):
    batched = B.batch_by_count(make([{"headers": {"n": str(i)}} for i in range(10)]).repartition(4), 4)
    out = apply_batch_handler(batched, lambda payloads: b",".join(payloads).decode()).collect()
    assert len(out) == 10
    for r in out:
        first = r.batch_id * 4
        assert r.error == ",".join(f"p{i}" for i in range(first, min(first + 4, 10)))
        assert not r.ok and r.headers == {"n": str(r.offset)} and bytes(r.payload) == b"p%d" % r.offset


def test_batch_handler_crash_fails_its_batch_only(make):
    def handler(payloads):
        if b"p2" in payloads:
            raise RuntimeError("no database")

    batched = B.batch_by_count(make([{}] * 6), 3)
    out = apply_batch_handler(batched, handler).orderBy("offset").collect()
    assert [(r.ok, r.error) for r in out] == [(False, "handler panic: no database")] * 3 + [(True, None)] * 3


def test_log_order_inside_every_task(make):
    rows = random_log(41, 300, 2)
    ordered = B.in_log_order(make(rows).repartition(6))
    seen = ordered.withColumn("task", F.spark_partition_id()).withColumn(
        "n", F.monotonically_increasing_id()
    ).orderBy("n").collect()
    keys = [(r.topic, r.partition, r.offset) for r in seen]
    assert keys == sorted(keys)


def test_first_reaching_in_unsorted_values():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.integers(0, 20, n)
        start = rng.integers(0, n + 1, n)
        bound = rng.integers(0, 22, n)
        expected = [next((j for j in range(s, n) if values[j] >= b), n) for s, b in zip(start, bound)]
        assert list(first_reaching(values, start, bound)) == expected


def test_short_payloads_go_along_and_long_ones_join(make):
    rows = [{**r, "payload": b"x" * (i % 5)} for i, r in enumerate(random_log(5, 300, 4))]
    rows += rows[:20]  # delivered twice
    short = make(rows).drop("headers")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    taken = B.assign_batches(short, BatchPolicy(size=7, timeout_ms=9_000), span=64)
    long = short.withColumn("payload", F.when(F.col("offset") == 3, F.expr("cast(repeat('y', 3000000) as binary)")).otherwise(F.col("payload")))
    joined = B.assign_batches(long, BatchPolicy(size=7, timeout_ms=9_000), span=64)
    # Rows are not moved, sorted and joined a second time where a segment of them is small.
    assert "Join" not in plan(taken) and "Window" not in plan(taken)
    assert "Join" in plan(joined)
    seen = lambda df: sorted(tuple(r) for r in df.select("partition", "offset", "timestamp", "batch_id").collect())
    assert taken.columns == [*short.columns, "batch_id"] and len(seen(taken)) == 320
    assert seen(taken) == seen(joined)
    assert sorted(bytes(r.payload) for r in taken.collect()) == sorted(r["payload"] for r in rows)
