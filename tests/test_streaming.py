import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from msgflow import (
    BatchPolicy, BreakerPolicy, CircuitBreaker, FailFast, Retry, RetryPolicy, Skip, StreamPolicy,
    column_handler,
)
from msgflow.operators import audit, batching, breaker
from msgflow.session import run_dir
from msgflow.sources.sinks import kafka_rows, sink_options, write_dlq, write_retry, write_rows
from msgflow.sources.topics import read_log, stream_log
from msgflow.streaming.runner import RunFolders, read_results, run_stream
from msgflow.streaming.stateful import hold_until_due
from msgflow import TopicConfig



def fails():
    text = F.concat(F.lit("bad "), F.col("offset").cast("string"))
    return column_handler(F.col("payload") == F.lit(b"bad"), text)


def log_rows(n=60):
    return [
        {"partition": i % 3, "offset": i // 3, "at": i, "payload": b"bad" if i % 4 == 1 or i % 7 == 0 else b"ok"}
        for i in range(n)
    ]


@pytest.fixture
def sliced(spark, make):
    """A folder of message files in log order; returns (folder, all messages)."""
    folder = run_dir(spark, "source")
    rows = log_rows()
    for start in range(0, len(rows), 15):
        make(rows[start : start + 15]).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    return folder, read_log(spark, folder)


def outcomes_of(spark, folder):
    return read_results(spark, RunFolders(folder).outcomes)


def test_micro_batches_give_the_batch_result(spark, sliced):
    source, messages = sliced
    folder = run_dir(spark, "run")
    policy = RetryPolicy("orders.retry", "orders.dlq")
    run_stream(stream_log(spark, source, 1), folder, fails(), strategy=Retry(policy)).start().drain()
    out = outcomes_of(spark, folder)
    assert out.select("micro_batch").distinct().count() == 4
    assert audit.missing_messages(messages, out).count() == 0
    assert audit.duplicate_deliveries(out).count() == 0
    bad = messages.filter("payload = cast('bad' as binary)").count()
    retries = read_results(spark, RunFolders(folder).retry)
    assert retries.count() == bad == out.filter("route = 'retry'").count()
    assert {r.topic for r in retries.collect()} == {"orders.retry"}
    positions = read_results(spark, RunFolders(folder).commits).groupBy("partition").agg(F.max("next_offset").alias("n"))
    assert {(r.partition, r.n) for r in positions.collect()} == {(0, 20), (1, 20), (2, 20)}


def test_fatal_outcome_stops_and_restart_loses_nothing(spark, sliced):
    source, messages = sliced
    folder = run_dir(spark, "run")
    late = column_handler(F.col("offset") == 12, F.lit("broken"))
    stopped = run_stream(stream_log(spark, source, 1), folder, late, strategy=FailFast()).start()
    with pytest.raises(Exception, match="fail-fast"):
        stopped.query.awaitTermination()
    before = read_results(spark, RunFolders(folder).commits)
    assert before.agg(F.max("micro_batch")).first()[0] == 2
    tops = {r.partition: r.n for r in before.groupBy("partition").agg(F.max("next_offset").alias("n")).collect()}
    assert tops == {0: 12, 1: 12, 2: 12}
    run_stream(stream_log(spark, source, 1), folder, late, strategy=Skip()).start().drain()
    out = outcomes_of(spark, folder)
    # The stopped micro-batch was replayed into the same folder: nothing lost, nothing twice.
    assert audit.missing_messages(messages, out).count() == 0
    assert audit.duplicate_deliveries(out).count() == 0
    assert out.filter("NOT ok").count() == 3


def test_raise_mode_writes_nothing_for_the_batch(spark, sliced):
    source, _ = sliced
    folder = run_dir(spark, "run")
    late = column_handler(F.col("offset") == 12, F.lit("broken"))
    run = run_stream(stream_log(spark, source, 1), folder, late, strategy=FailFast(mode="raise")).start()
    with pytest.raises(Exception, match="fail-fast"):
        run.query.awaitTermination()
    commits = read_results(spark, RunFolders(folder).commits)
    assert commits.agg(F.max("next_offset")).first()[0] == 10


@pytest.mark.parametrize("size, timeout_ms", [(4, 6_000), (7, 1_000_000)])
def test_stream_batches_equal_batches_of_the_log(spark, sliced, size, timeout_ms):
    source, messages = sliced
    folder = run_dir(spark, "run")
    policy = BatchPolicy(size, timeout_ms)
    run = run_stream(
        stream_log(spark, source, 1), folder, batch_handler=lambda p: None, batch_policy=policy, span=3
    ).start()
    run.query.awaitTermination()
    held = messages.count() - outcomes_of(spark, folder).count()
    run.drain()
    out = outcomes_of(spark, folder)
    columns = ["partition", "offset", "batch_id"]
    expected = batching.assign_batches(messages, policy).select(*columns)
    assert sorted(out.select(*columns).collect()) == sorted(expected.collect())
    sizes = expected.groupBy("partition", "batch_id").count().orderBy(F.desc("batch_id")).collect()
    last = {}
    for r in sizes:
        last.setdefault(r.partition, r["count"])
    # Without the drain only open batches were held back.
    assert held == sum(n for n in last.values() if n < size)


def test_stream_breaker_goes_on_over_micro_batches(spark, sliced):
    source, messages = sliced
    folder = run_dir(spark, "run")
    policy = BreakerPolicy(2, 7_000, 2)
    run_stream(
        stream_log(spark, source, 1), folder, fails(), strategy=CircuitBreaker(policy, span=2), on_fatal="hold"
    ).start().drain()
    columns = ["partition", "offset", "state_before", "state_after", "failure_count", "success_count", "action"]
    from msgflow import apply_handler

    whole = breaker.circuit_breaker(apply_handler(messages, fails()), policy).select(*columns)
    assert sorted(outcomes_of(spark, folder).select(*columns).collect()) == sorted(whole.collect())


def test_breaker_can_stop_the_stream(spark, sliced):
    source, _ = sliced
    run = run_stream(
        stream_log(spark, source, 1), run_dir(spark, "run"), fails(),
        strategy=CircuitBreaker(BreakerPolicy(1, 1_000_000)),
    ).start()
    with pytest.raises(Exception, match="circuit breaker opened after 1 consecutive failures"):
        run.query.awaitTermination()


def test_continuous_run_stops_cleanly(spark, sliced):
    source, messages = sliced
    folder = run_dir(spark, "run")
    run = run_stream(
        stream_log(spark, source), folder, fails(), stream_policy=StreamPolicy(trigger_interval_ms=100)
    ).start(available_now=False)
    run.query.processAllAvailable()
    assert run.stop() and not run.query.isActive
    assert outcomes_of(spark, folder).count() == messages.count()


def test_retries_wait_for_their_time(spark, make):
    source, folder = run_dir(spark, "retries"), run_dir(spark, "released")
    now = dt.datetime.now(dt.timezone.utc)

    def at(seconds):
        due = now + dt.timedelta(seconds=seconds)
        return {"headers": {"mq.retry.time": due.strftime("%Y-%m-%dT%H:%M:%SZ"), "app": "x"}}

    make([at(-60), at(12), at(3600), {"headers": {"app": "no time"}}]).write.parquet(source)
    query = (
        hold_until_due(stream_log(spark, source)).writeStream.format("parquet").option("path", folder)
        .option("checkpointLocation", folder + "-checkpoint")
        .trigger(processingTime="500 milliseconds").start()
    )
    try:
        seen, early, deadline = set(), None, time.time() + 60
        while len(seen) < 3 and time.time() < deadline:
            assert query.isActive, query.exception()
            time.sleep(0.5)
            try:
                seen = {r.offset for r in spark.read.parquet(folder).select("offset").collect()}
            except Exception:  # noqa: BLE001 - nothing written yet
                continue
            if 1 in seen and early is None:
                early = dt.datetime.now(dt.timezone.utc)
    finally:
        query.stop()
    assert seen == {0, 1, 3}
    assert early >= now + dt.timedelta(seconds=11)
    released = {r.offset: r for r in spark.read.parquet(folder).collect()}
    assert released[1].headers["app"] == "x" and bytes(released[1].payload) == b"p1"
    assert released[1].timestamp == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_replayed_write_does_not_duplicate(spark, make):
    from msgflow.operators.retry import retry

    df = make([{}, {"headers": {"mq.retry.attempt": "5"}}]).withColumn("error", F.lit("e"))
    retries, dead = retry(df, RetryPolicy("r", "d"))
    folder = run_dir(spark, "sinks")
    for _ in range(2):
        write_retry(retries, folder + "/r", batch_id=7)
        write_dlq(dead, folder + "/d", batch_id=7)
    assert spark.read.parquet(folder + "/r").count() == 1 and spark.read.parquet(folder + "/d").count() == 1
    write_retry(retries, folder + "/plain")
    write_retry(retries, folder + "/plain")
    assert spark.read.parquet(folder + "/plain").count() == 2


def test_connector_rows(make):
    from msgflow.operators.retry import retry

    retries, _ = retry(make([{}]).withColumn("error", F.lit("e")), RetryPolicy("r", "d"))
    row = kafka_rows(retries).first()
    assert {h.key: bytes(h.value) for h in row.headers}["mq.retry.attempt"] == b"1"
    assert (row.key, bytes(row.value), row.topic) == (None, b"p0", "r")
    options = sink_options(TopicConfig("t", ("a:1", "b:2"), "g"))
    assert options == {"kafka.bootstrap.servers": "a:1,b:2", "kafka.acks": "all"}


def until(reached, seconds=60):
    deadline = time.time() + seconds
    while time.time() < deadline:
        if reached():
            return True
        time.sleep(0.3)
    return False


def test_a_silent_key_is_delivered_by_the_clock(spark, make):
    """The open batch of a key without further messages goes out in a continuous run, once."""
    source, folder = run_dir(spark, "silent"), run_dir(spark, "run")
    make([{"offset": i} for i in range(3)]).coalesce(1).write.parquet(source)
    policy, pace = BatchPolicy(5, 3_000), StreamPolicy(trigger_interval_ms=500)

    def run():
        return run_stream(
            stream_log(spark, source), folder, batch_handler=lambda p: None, batch_policy=policy, stream_policy=pace
        ).start(available_now=False)

    def delivered():
        try:
            return sorted((r.offset, r.batch_id) for r in outcomes_of(spark, folder).select("offset", "batch_id").collect())
        except Exception:  # noqa: BLE001 - nothing written yet
            return []

    first = run()
    began = time.time()
    try:
        assert until(lambda: len(delivered()) == 3)
        assert time.time() - began >= 2
    finally:
        first.stop()
    # A restart delivers nothing again, and the key goes on with its next batch.
    second = run()
    try:
        time.sleep(3)
        make([{"offset": i} for i in range(3, 5)]).coalesce(1).write.mode("append").parquet(source)
        assert until(lambda: len(delivered()) == 5)
    finally:
        second.stop()
    assert delivered() == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]
    positions = read_results(spark, RunFolders(folder).commits).agg(F.max("next_offset")).first()[0]
    assert positions == 5


def test_a_batch_that_is_not_overdue_goes_on_over_the_clock(spark, make):
    source, folder = run_dir(spark, "waiting"), run_dir(spark, "run")
    make([{"offset": i} for i in range(2)]).coalesce(1).write.parquet(source)
    run = run_stream(
        stream_log(spark, source), folder, batch_handler=lambda p: None, batch_policy=BatchPolicy(4, 600_000),
        stream_policy=StreamPolicy(trigger_interval_ms=500),
    ).start(available_now=False)
    try:
        time.sleep(6)  # ticks without messages
        make([{"offset": i} for i in range(2, 5)]).coalesce(1).write.mode("append").parquet(source)
        assert until(lambda: run.query.lastProgress and _count(spark, folder) == 4)
    finally:
        run.stop()
    run.start().drain()
    rows = sorted((r.offset, r.batch_id) for r in outcomes_of(spark, folder).collect())
    assert rows == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1)]


def _count(spark, folder):
    try:
        return outcomes_of(spark, folder).count()
    except Exception:  # noqa: BLE001 - nothing written yet
        return 0


def test_state_and_log_stay_bounded(spark):
    """Fifty micro-batches leave what the last two of them need."""
    from msgflow.streaming.state import KEPT, OutcomeLog, RunState

    root = run_dir(spark, "bounded")
    state, log = RunState(spark, f"{root}/state"), OutcomeLog(spark, f"{root}/log")
    for number in range(50):
        one = spark.range(number, number + 1).coalesce(1)
        # Every third micro-batch changes nothing and points to what was there.
        before = state.load(number - 1)
        assert state.last() == number - 1 and (number == 0 or state.table("t", before).first()[0] == number - 1 - (number - 1) % 3)
        state.save(number, {"tables": {"t": state.put("t", one, number)}} if number % 3 == 0 else before)
        assert log.once("o", number, lambda: one).first()[0] == number
        assert log.once("o", number, lambda: 1 / 0).first()[0] == number  # a replay reads what is there
        assert log.number("clock", number, lambda: number) == log.number("clock", number, lambda: -1) == number
        log.trim(number)
    assert state.files.names(f"{root}/state/t") == ["micro_batch=48"]
    for place in ("state/pointers", "log/o", "log/clock"):
        assert len([n for n in state.files.names(f"{root}/{place}") if not n.startswith(".")]) <= KEPT, place
    log.forget(49)
    assert log.once("o", 49, lambda: spark.range(7, 8)).first()[0] == 7
    with pytest.raises(RuntimeError):
        state.load(50)


def test_breakers_of_a_stream_keep_two_generations(spark, make):
    from msgflow.streaming.state import KEPT, SharedFiles

    source, folder = run_dir(spark, "many"), run_dir(spark, "run")
    for i in range(5):
        make([{"offset": 2 * i}, {"offset": 2 * i + 1}]).coalesce(1).write.mode("append").parquet(source)
    run_stream(
        stream_log(spark, source, 1), folder, fails(), strategy=CircuitBreaker(BreakerPolicy(2, 1000), span=8), on_fatal="hold"
    ).start().drain()
    files, folders = SharedFiles(spark), RunFolders(folder)
    assert outcomes_of(spark, folder).count() == 10
    for place in (f"{folders.state}/breaker", f"{folders.log}/outcomes", f"{folders.log}/routed"):
        assert 1 <= len(files.names(place)) <= KEPT, place


def test_all_sinks_see_one_outcome_of_a_row(spark, make, monkeypatch):
    """A handler that answers differently each time; blocks that are lost, and a crash before the positions."""
    import random

    from msgflow.streaming import runner

    source, folder = run_dir(spark, "unsure"), run_dir(spark, "run")
    make([{"offset": i, "headers": {"mq.retry.attempt": str(i % 3)}} for i in range(200)]).repartition(4).write.parquet(source)
    real_dlq, real_commit, crashes = runner.write_dlq, runner.commit_positions, []

    def losing(df, target, batch_id):
        spark.catalog.clearCache()
        spark.sparkContext._jvm.System.gc()
        real_dlq(df, target, batch_id)

    def crashing(df):
        if not crashes:
            crashes.append(1)
            raise OSError("the driver is gone")
        return real_commit(df)

    monkeypatch.setattr(runner, "write_dlq", losing)
    monkeypatch.setattr(runner, "commit_positions", crashing)

    def unsure(message):
        return "bad" if random.random() < 0.5 else None

    def run():
        return run_stream(
            stream_log(spark, source), folder, unsure, strategy=Retry(RetryPolicy("r", "d", max_attempts=3))
        ).start()

    with pytest.raises(Exception, match="driver is gone"):
        run().query.awaitTermination()
    offset = F.element_at("headers", "mq.original.offset").cast("long")
    folders = RunFolders(folder)

    def failed():
        return {
            route: {r[0] for r in read_results(spark, path).select(offset).collect()}
            for route, path in (("retry", folders.retry), ("dlq", folders.dlq))
        }

    sent = failed()
    run().drain()
    out = outcomes_of(spark, folder).collect()
    assert len(out) == 200
    assert sent == failed() == {k: {r.offset for r in out if r.route == k} for k in ("retry", "dlq")}
    assert sent["retry"] and sent["dlq"]


def test_retry_path_in_one_run(spark, make):
    """Held, released, handled again: some succeed, the others end as dead letters; a replay repeats nothing."""
    from msgflow.functions import headers as H
    from msgflow.streaming.retry_path import run_retry_path

    source, folder = run_dir(spark, "path"), run_dir(spark, "run")
    make([{"partition": i % 2, "offset": i, "payload": b"bad" if i % 2 else b"ok"} for i in range(40)]).write.parquet(source)
    tried = H.retry_attempt(F.col("headers"))
    handler = column_handler(
        (F.col("payload") == F.lit(b"bad")) & ((tried == 0) | (F.col("offset") % 4 == 1)), F.lit("no")
    )
    policy = RetryPolicy("r", "d", max_attempts=3, initial_delay_ms=700, max_delay_ms=1_500)
    run = run_retry_path(stream_log(spark, source), folder, handler, policy, slot_ms=500).start()
    run.query.awaitTermination()
    assert run.pending() == 20
    began = time.time()
    run.drain()
    assert run.pending() == 0 and time.time() - began > 1
    out = outcomes_of(spark, folder).collect()
    tries = {}
    for r in sorted(out, key=lambda r: (r.offset, r.micro_batch)):
        tries.setdefault(r.offset, []).append((r.route, r.attempt, r.released))
    for offset, got in tries.items():
        if offset % 2 == 0:
            assert got == [("commit", None, False)]
        elif offset % 4 == 1:
            assert got == [("retry", 1, False), ("retry", 2, True), ("dlq", 3, True)]
        else:
            assert got == [("retry", 1, False), ("commit", None, True)]
    dead = read_results(spark, RunFolders(folder).dlq).select(F.element_at("headers", "mq.original.offset")).collect()
    assert sorted(int(r[0]) for r in dead) == [i for i in range(40) if i % 4 == 1]
    positions = read_results(spark, RunFolders(folder).commits).groupBy("partition").agg(F.max("next_offset").alias("n"))
    assert {(r.partition, r.n) for r in positions.collect()} == {(0, 39), (1, 40)}
    # Nothing is left to release, and slots that are over are deleted.
    run.start().query.awaitTermination()
    assert outcomes_of(spark, folder).count() == len(out)


def test_a_retry_path_goes_on_after_a_crash(spark, make, monkeypatch):
    from msgflow.streaming import retry_path

    source, folder = run_dir(spark, "path"), run_dir(spark, "run")
    make([{"offset": i} for i in range(10)]).write.parquet(source)
    policy = RetryPolicy("r", "d", max_attempts=2, initial_delay_ms=600, max_delay_ms=600)
    handler = column_handler(F.col("offset") >= 0, F.lit("no"))
    real, crashes = retry_path.commit_positions, []

    def crashing(df):
        crashes.append(1)
        if len(crashes) == 2:  # while the held rows are handled again
            raise OSError("the driver is gone")
        return real(df)

    monkeypatch.setattr(retry_path, "commit_positions", crashing)
    run = retry_path.run_retry_path(stream_log(spark, source), folder, handler, policy, slot_ms=500).start()
    with pytest.raises(Exception, match="driver is gone"):
        run.drain()
    run.start().drain()
    out = outcomes_of(spark, folder)
    assert sorted((r.offset, r.route) for r in out.collect()) == sorted([(i, k) for i in range(10) for k in ("retry", "dlq")])
    assert read_results(spark, RunFolders(folder).dlq).count() == 10


def test_limits_of_a_stream(spark, make):
    source, folder = run_dir(spark, "limits"), run_dir(spark, "run")
    for i in range(6):
        make([{"offset": 10 * i + j} for j in range(10)]).coalesce(1).write.mode("append").parquet(source)
    each = max(int(r[0]) for r in spark.read.format("binaryFile").load(source).select("length").collect())
    run_stream(stream_log(spark, source, max_bytes=2 * each), folder, fails()).start().drain()
    counts = outcomes_of(spark, folder).groupBy("micro_batch").count().collect()
    assert len(counts) >= 3 and sum(r["count"] for r in counts) == 60
    with pytest.raises(ValueError):
        stream_log(spark, source, 1, max_bytes=1)


def test_slow_slices_are_held_and_share_state_keys(spark, make):
    from msgflow.plans.stream_queries import _await_rows, _released, due_later

    source, folder = run_dir(spark, "slow"), run_dir(spark, "emitted")
    rows = [{"offset": i, "partition": i % 2, "payload": b"x" * (100_000 if i == 8 else 3)} for i in range(400)]
    make(rows).write.parquet(source)
    time.sleep(3)  # longer than the hold: counted from the slice, all would be due on arrival
    emitted = hold_until_due(due_later(stream_log(spark, source), hold_ms=2_500)).withColumn(
        "emitted_ms", F.unix_millis(F.current_timestamp())
    )
    query = (
        emitted.writeStream.foreachBatch(lambda batch, n: write_rows(batch, folder, n))
        .option("checkpointLocation", folder + "-checkpoint").trigger(processingTime="500 milliseconds").start()
    )
    try:
        count = lambda: _released(spark, folder)
        _await_rows(query, count, 400, idle_s=60, poll_s=0.2)
        states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    finally:
        query.stop()
    out = spark.read.parquet(folder).withColumn("taken", F.col("headers")["taken-ms"].cast("bigint")).collect()
    assert sorted(r.offset for r in out) == list(range(400))
    assert all((r.emitted_ms > r.taken) == (r.offset % 4 == 0) for r in out)
    assert all(len(r.payload) == (100_000 if r.offset == 8 else 3) for r in out)
    # One key, its timer and what Spark keeps with them, not 100 messages of them; the large one has its own.
    assert 0 < max(states) < 20
    with pytest.raises(RuntimeError, match="400 of 401"):
        _await_rows(query, count, 401)


def test_nothing_is_kept_of_messages_that_nobody_reads(spark, make):
    source, folder = run_dir(spark, "slim"), run_dir(spark, "run")
    make([{"offset": i, "headers": {"a": "b" * 50}} for i in range(9)]).write.parquet(source)
    run_stream(stream_log(spark, source), folder, batch_handler=lambda p: None, batch_policy=BatchPolicy(size=4)).start().query.awaitTermination()
    assert "headers" not in spark.read.parquet(RunFolders(folder).state + "/held").columns
    folder = run_dir(spark, "run")
    run_stream(stream_log(spark, source), folder, fails(), strategy=CircuitBreaker(BreakerPolicy(3)), keep=["headers"]).start().drain()
    log = spark.read.parquet(RunFolders(folder).log + "/outcomes")
    assert "payload" not in log.columns and "headers" in log.columns
    assert {r.headers["a"] for r in outcomes_of(spark, folder).collect()} == {"b" * 50}
