import datetime as dt

import pytest
from pyspark.sql import functions as F

from msgflow import FailFast, HandlerFailure, PayloadHandler, Retry, RetryPolicy, Skip, apply_handler, column_handler
from msgflow.operators import retry as R
from msgflow.operators import strategies as S
from msgflow.operators.handler import capture_panic, split_outcomes, spread

POLICY = RetryPolicy("r", "d")


def test_native_handler(make):
    df = make([{"payload": b"ok"}, {"payload": b"bad"}, {"payload": None}])
    failed = F.col("payload") == F.lit(b"bad")
    rows = apply_handler(df, column_handler(failed, F.lit("no"))).orderBy("offset").collect()
    assert [(r.ok, r.error) for r in rows] == [(True, None), (False, "no"), (True, None)]


def test_failure_without_text_is_still_a_failure(make):
    rows = apply_handler(make([{}]), column_handler(F.lit(True), F.lit(None).cast("string"))).collect()
    assert (rows[0].ok, rows[0].error) == (False, "")


def test_crash_fails_its_own_message(make):
    def handler(message):
        if message.payload == b"panic-me":
            raise ValueError("boom")

    df = make([{"payload": p} for p in (b"normal", b"panic-me", b"after-panic")])
    rows = apply_handler(df, handler).orderBy("offset").collect()
    assert [(r.ok, r.error) for r in rows] == [(True, None), (False, "handler panic: boom"), (True, None)]


def test_returned_and_raised_failures(make):
    def handler(message):
        if message.offset == 0:
            return "returned"
        if message.offset == 1:
            raise HandlerFailure("raised", next_step=4)

    rows = apply_handler(make([{}, {}, {}]), handler).orderBy("offset").collect()
    assert [(r.ok, r.error, r.next_step) for r in rows] == [
        (False, "returned", None), (False, "raised", 4), (True, None, None),
    ]


def test_next_step_goes_into_the_retry_headers(make):
    def handler(message):
        raise HandlerFailure("stuck", next_step=message.retry_step() + 1)

    df = make([{"headers": {"mq.retry.step": "2"}}, {"headers": {}}])
    retries, _ = R.retry(apply_handler(df, handler), POLICY)
    steps = sorted(r.headers["mq.retry.step"] for r in retries.collect())
    assert steps == ["1", "3"]


def test_handler_reads_metadata(make):
    def handler(m):
        return f"{m.topic} {m.partition} {m.offset} {m.timestamp.isoformat()} {sorted(m.headers.items())} {m.payload}"

    rows = [
        {"partition": 2, "offset": 7, "headers": {"a": "1", "b": None}, "payload": b"x"},
        {"partition": 1, "offset": 9, "headers": None, "payload": None, "timestamp": dt.datetime(2024, 3, 1)},
        {"partition": 0, "offset": 3, "headers": {"c": "ü"}, "payload": b""},
    ]
    got = {r.offset: r.error for r in apply_handler(make(rows).coalesce(1), handler).collect()}
    assert got == {
        7: "orders 2 7 2024-01-01T00:00:00+00:00 [('a', '1'), ('b', None)] b'x'",
        9: "orders 1 9 2024-03-01T00:00:00+00:00 [] None",
        3: "orders 0 3 2024-01-01T00:00:02+00:00 [('c', 'ü')] b''",
    }


def test_missing_timestamp_reaches_the_handler(make):
    df = make([{}, {}]).withColumn("timestamp", F.when(F.col("offset") == 1, F.col("timestamp")))
    rows = apply_handler(df, lambda m: str(m.timestamp)).orderBy("offset").collect()
    assert [r.error for r in rows] == ["None", "2024-01-01 00:00:01+00:00"]


def test_payload_handler(make):
    df = make([{"payload": b"1"}, {"payload": None}, {"payload": b"x"}])
    rows = apply_handler(df, PayloadHandler(lambda p: None if p is None else (int(p), None)[1])).orderBy("offset")
    assert [r.ok for r in rows.collect()] == [True, True, False]


def test_filters_do_not_run_a_handler_twice(make):
    from msgflow.operators.handler import apply_batch_handler
    from msgflow.operators.batching import batch_by_count

    frames = [
        apply_handler(spread(make([{}] * 20).coalesce(1)), lambda m: "x"),
        apply_handler(make([{}]), PayloadHandler(lambda p: "x")),
        apply_batch_handler(batch_by_count(make([{}]), 3), lambda p: "x"),
    ]
    for df in frames:
        good, bad = split_outcomes(df)
        for side in (good, bad, R.retry(bad, POLICY)[0]):
            # Split outcomes are a table already: the handler ran once for both sides.
            assert side._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 0


def test_handler_must_be_callable(make):
    with pytest.raises(ValueError, match="handler cannot be nil"):
        apply_handler(make([{}]), None)


def test_spread_leaves_wide_input_alone(make):
    df = make([{}] * 20)
    assert spread(df.coalesce(1)).rdd.getNumPartitions() == 8
    wide = df.repartition(9)
    assert spread(wide) is wide


def outcomes(make, marks, **over):
    rows = [{"ok": m == "S", "error": None if m == "S" else f"e{i}", **over} for i, m in enumerate(marks)]
    return make(rows, "ok boolean, error string")


def test_skip_goes_on(make):
    out = S.apply_strategy(outcomes(make, "SFS"))
    assert {r.route for r in out.collect()} == {"commit"}
    assert [r.error for r in S.error_log(out, "skip").collect()] == ["e1"]
    assert S.merge_routes(out).count() == 3 and Skip().name == "skip"


def test_fail_fast_cuts_each_partition(make):
    rows = [{"partition": 0, "offset": o, "ok": o != 2, "error": None if o != 2 else "x"} for o in range(5)]
    rows += [{"partition": 1, "offset": o, "ok": True, "error": None} for o in range(3)]
    out = S.fail_fast(make(rows, "ok boolean, error string"))
    got = {(r.partition, r.offset): r.route for r in out.collect()}
    assert got == {
        (0, 0): "commit", (0, 1): "commit", (0, 2): "stop", (1, 0): "commit", (1, 1): "commit", (1, 2): "commit",
    }
    stop = out.filter("route = 'stop'").first().stop_error
    assert stop == "fail-fast: handler error on topic=orders partition=0 offset=2: x"


def test_fail_fast_raise_fails_the_job(make):
    with pytest.raises(Exception, match="fail-fast: handler error on topic=orders partition=0 offset=1: e1"):
        S.apply_strategy(outcomes(make, "SF"), FailFast(mode="raise")).collect()
    assert S.apply_strategy(outcomes(make, "SS"), FailFast(mode="raise")).count() == 2


def test_retry_strategy_routes(make):
    rows = [
        {"ok": True, "error": None}, {"ok": False, "error": "e"},
        {"ok": False, "error": "e", "headers": {"mq.retry.attempt": "2"}},
    ]
    strategy = Retry(POLICY)
    out = S.apply_strategy(make(rows, "ok boolean, error string"), strategy).orderBy("offset")
    assert [(r.route, r.attempt) for r in out.collect()] == [("commit", None), ("retry", 1), ("dlq", 3)]
    retries, dead = strategy.outputs(out)
    assert retries.count() == 1 and dead.count() == 1


def test_batch_failure_retries_every_message(make):
    retries, dead = R.retry(outcomes(make, "FFF"), POLICY)
    assert sorted(bytes(r.value) for r in retries.collect()) == [b"p0", b"p1", b"p2"]
    assert dead.count() == 0


def test_custom_strategy_must_route(make):
    class Nothing:
        name = "nothing"

        def apply(self, df):
            return df

    assert isinstance(Nothing(), S.ErrorStrategy)
    with pytest.raises(ValueError, match="did not set a route"):
        S.apply_strategy(outcomes(make, "S"), Nothing())


def test_split(make):
    good, bad = split_outcomes(outcomes(make, "SFSS"))
    assert (good.count(), bad.count()) == (3, 1)


def test_native_panic(make):
    out = capture_panic(outcomes(make, "SS"), F.col("offset") == 1, F.lit("divide by zero")).orderBy("offset")
    assert [(r.ok, r.error) for r in out.collect()] == [(True, None), (False, "handler panic: divide by zero")]


@pytest.mark.parametrize("python", [False, True])
def test_retry_rounds(make, python):
    """Offsets 0..5 need that many attempts; three attempts are allowed."""
    if python:
        def handler(m):
            return "later" if int(m.headers.get("mq.retry.attempt", "0")) < m.offset else None
    else:
        from msgflow.functions.headers import retry_attempt

        handler = column_handler(retry_attempt(F.col("headers")) < F.col("offset"), F.lit("later"))
    result = R.run_with_retries(make([{}] * 6), handler, POLICY)
    assert sorted(r.offset for r in result.ok.collect()) == [0, 1, 2]
    assert sorted(r.offset for r in result.dlq.collect()) == [3, 4, 5]
    assert result.rounds == 3 and result.history.count() == 6 + 5 + 4
    # Two delays, 1 s and 2 s, then the dead letter: three handler calls in total.
    late = result.dlq.filter("offset = 5").first()
    assert (late.round, late.attempt, late.timestamp) == (2, 3, dt.datetime(2024, 1, 1, 0, 0, 8))
    assert late.headers["mq.original.topic"] == "orders"


def test_retry_rounds_can_be_bounded(make):
    handler = column_handler(F.lit(True), F.lit("never"))
    result = R.run_with_retries(make([{"headers": {"mq.retry.attempt": "-50"}}, {}]), handler, POLICY, max_rounds=1)
    assert result.rounds == 1 and result.pending.count() == 2 and result.dlq.count() == 0


def test_retry_due(make):
    def at(text):
        return {"headers": {"mq.retry.time": text}}

    df = make([at("2024-01-01T00:00:10Z"), at("2024-01-01T00:00:11Z"), at("soon"), {"headers": {}}])
    due = R.retry_due(df, F.lit("2024-01-01 00:00:10").cast("timestamp"))
    assert sorted(r.offset for r in due.collect()) == [0, 2, 3]


def test_held_messages_are_read_again(make):
    from msgflow.operators.strategies import held_again

    log = make([{"offset": i} for i in range(6)])
    done = [(0, "stop", 0), (0, "commit", 1), (1, "stop", 0), (2, "commit", 0), (3, "commit", 0), (3, "stop", 1), (4, "stop", 2), (4, "commit", 2)]
    outcomes = log.sparkSession.createDataFrame(
        [("orders", 0, o, r, n) for o, r, n in done], "topic string, partition int, offset long, route string, micro_batch int"
    )
    assert sorted(r.offset for r in held_again(log, outcomes).collect()) == [1, 3]
