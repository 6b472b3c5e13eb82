"""Streaming queries: the event log arrives in slices, each handled from the last checkpoint."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Optional

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.config import RetryPolicy, StreamPolicy
from msgflow.functions import headers as H
from msgflow.operators import strategies
from msgflow.operators.handler import column_handler
from msgflow.operators.segments import pick_span
from msgflow.plans.event_log import PREFIX, event_log
from msgflow.plans.queries import (
    BATCH,
    BREAKER,
    BREAKER_COLUMNS,
    BREAKER_SELECT,
    PART_OFF,
    POLICY,
    bad_event,
    native_handler,
)
from msgflow.plans.registry import BATCHES_SQL, BREAKER_SQL, LOG_SQL, SLICED_SQL, query
from msgflow.session import materialize, run_dir
from msgflow.sources.sinks import write_rows
from msgflow.sources.topics import stream_log
from msgflow.streaming.retry_path import run_retry_path
from msgflow.streaming.runner import RunFolders, StreamRun, read_results, run_stream
from msgflow.streaming.stateful import ROCKSDB, hold_until_due

SLICES = 4
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class GrowingLog:
    """The event log in a folder that grows by ranges of offsets, in log order."""

    def __init__(self, spark: SparkSession, sf_dir: str, slices: int = SLICES):
        self.spark, self.slices = spark, slices
        self.log = event_log(spark, sf_dir)
        low, high = self.log.agg(F.min("offset"), F.max("offset")).first()
        self.low, self.high = low or 0, high or 0
        self.folder = run_dir(spark, "growing-log")
        self.span = pick_span(self.log)

    def start_of(self, number: int) -> int:
        return self.low + number * (self.high + 1 - self.low) // self.slices

    def append(
        self, number: int, change: Optional[Callable[[DataFrame], DataFrame]] = None, files: Optional[int] = None
    ) -> None:
        part = self.log.filter(
            (F.col("offset") >= self.start_of(number)) & (F.col("offset") < self.start_of(number + 1))
        )
        part = part if change is None else change(part)
        (part if files is None else part.coalesce(files)).write.mode("append").parquet(self.folder)

    def stream(self, max_per_trigger=None) -> DataFrame:
        return stream_log(self.spark, self.folder, max_per_trigger, schema=self.log.schema)

    def feed(self, make: Callable[[DataFrame], StreamRun]) -> StreamRun:
        """One run per slice, each going on from the checkpoint of the one before."""
        for number in range(self.slices):
            self.append(number)
            run = make(self.stream()).start()
            run.query.awaitTermination()
        return run


@query(
    "stream_single",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, ok, error,
    CASE WHEN ok THEN 'commit' WHEN attempts + 1 >= 3 THEN 'dlq' ELSE 'retry' END AS route,
    CASE WHEN NOT ok THEN CAST(attempts + 1 AS BIGINT) END AS attempt FROM log""",
)
def stream_single(spark, sf_dir):
    log, folder = GrowingLog(spark, sf_dir), run_dir(spark, "stream-single")
    log.feed(
        lambda s: run_stream(s, folder, native_handler(), strategy=strategies.Retry(POLICY))
    ).drain()
    return read_results(spark, RunFolders(folder).outcomes).select(
        "partition", "offset", "ok", "error", "route", "attempt"
    )


@query(
    "stream_sinks",
    f"""WITH {LOG_SQL} SELECT CASE WHEN attempts + 1 >= 3 THEN 'events.dlq' ELSE 'events.retry' END
    AS target, CAST(off AS VARCHAR) AS original_offset, CAST(attempts + 1 AS VARCHAR) AS attempt_header
    FROM log WHERE NOT ok""",
)
def stream_sinks(spark, sf_dir):
    """Rows a streaming run wrote to the retry and dead-letter targets."""
    log, folder = GrowingLog(spark, sf_dir, 2), run_dir(spark, "stream-sinks")
    log.feed(
        lambda s: run_stream(s, folder, native_handler(), strategy=strategies.Retry(POLICY))
    ).drain()
    folders, h = RunFolders(folder), F.col("headers")
    columns = [
        F.col("topic").alias("target"), H.header(h, H.ORIGINAL_OFFSET).alias("original_offset"),
        H.header(h, H.RETRY_ATTEMPT).alias("attempt_header"),
    ]
    retries, dead = (read_results(spark, p).select(*columns) for p in (folders.retry, folders.dlq))
    return retries.unionByName(dead)


def _never_fails(payloads: list):
    return None


@query("stream_batch", f"WITH RECURSIVE {BATCHES_SQL} SELECT {PART_OFF}, batch_id, true AS ok FROM walk")
def stream_batch(spark, sf_dir):
    """Count-or-time batches go on across micro-batches; the tail is delivered at the end."""
    log, folder = GrowingLog(spark, sf_dir), run_dir(spark, "stream-batch")
    log.feed(
        lambda s: run_stream(
            s, folder, batch_handler=_never_fails, batch_policy=BATCH, span=log.span
        )
    ).drain()
    return read_results(spark, RunFolders(folder).outcomes).select(
        "partition", "offset", "batch_id", "ok"
    )


@query("stream_batch_restart", f"WITH {LOG_SQL} SELECT {PART_OFF}, CAST(1 AS BIGINT) AS deliveries FROM log")
def stream_batch_restart(spark, sf_dir):
    """Drained, grown and drained again: the flushed batches are not delivered a second time."""
    log, folder = GrowingLog(spark, sf_dir, 2), run_dir(spark, "batch-restart")
    for number in range(log.slices):
        log.append(number)
        run_stream(
            log.stream(), folder, batch_handler=_never_fails, batch_policy=BATCH, span=log.span
        ).start().drain()
    done = read_results(spark, RunFolders(folder).outcomes)
    return done.groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("deliveries"))


@query(
    "commit_after_success",
    f"""WITH {LOG_SQL},
    bounds AS (SELECT min(off) AS low, max(off) + 1 - min(off) AS width FROM log),
    sliced AS (
      SELECT log.*, NOT ok AND off >= low + width // 2 AS fails,
        CASE WHEN off >= low + 3 * width // 4 THEN 3 WHEN off >= low + 2 * width // 4 THEN 2
             WHEN off >= low + width // 4 THEN 1 ELSE 0 END AS slice
      FROM log, bounds),
    stop AS (SELECT min(slice) AS s FROM sliced WHERE fails),
    first_fail AS (
      SELECT part, min(off) AS f FROM sliced, stop WHERE fails AND slice = s GROUP BY part)
    SELECT 'stopped' AS stage, sliced.part AS "partition", max(off) + 1 AS next_offset
    FROM sliced CROSS JOIN stop LEFT JOIN first_fail ff ON ff.part = sliced.part
    WHERE slice <= s AND (slice < s OR f IS NULL OR off < f) GROUP BY sliced.part
    UNION ALL
    SELECT 'restarted', part, max(off) + 1 FROM log GROUP BY part""",
)
def commit_after_success(spark, sf_dir):
    """Positions after a fatal failure in the second half, and after a restart that skips."""
    log, folder = GrowingLog(spark, sf_dir), run_dir(spark, "commit-after-success")
    half = log.start_of(2)
    handler = column_handler((F.col("event_type") == "error") & (F.col("offset") >= half), bad_event())
    stages = []
    number = 0
    for stage, strategy in (("stopped", strategies.FailFast()), ("restarted", strategies.Skip())):
        while number < log.slices or stage == "restarted":
            if number < log.slices:
                log.append(number)
            number += 1
            run = run_stream(log.stream(), folder, handler, strategy=strategy).start()
            try:
                run.query.awaitTermination()
            except Exception:  # noqa: BLE001 - the strategy stopped the query
                break
            if number >= log.slices:
                break
        commits = read_results(spark, RunFolders(folder).commits)
        positions = commits.groupBy("partition").agg(F.max("next_offset").alias("next_offset"))
        stages.append(
            materialize(positions.select(F.lit(stage).alias("stage"), "partition", "next_offset"))
        )
    return stages[0].unionByName(stages[1])


@query(
    "commit_breaker_stop",
    f"""WITH RECURSIVE {BREAKER_SQL}, stages AS (SELECT unnest(['stopped', 'restarted']) AS stage),
    stops AS (SELECT part AS p, min(off) AS stop FROM breaker_log WHERE fatal GROUP BY part)
    SELECT stage, part AS "partition", max(off) + 1 AS next_offset
    FROM breaker_log LEFT JOIN stops ON p = part, stages
    WHERE stop IS NULL OR off < stop GROUP BY stage, part""",
)
def commit_breaker_stop(spark, sf_dir):
    """A breaker that stops the query leaves each position before the first fatal row, a restart too."""
    log, folder, stages = GrowingLog(spark, sf_dir, 1), run_dir(spark, "breaker-stop"), []
    log.append(0)
    strategy = strategies.CircuitBreaker(BREAKER, span=log.span)
    for stage in ("stopped", "restarted"):
        run = run_stream(log.stream(), folder, native_handler(), strategy=strategy).start()
        try:
            run.query.awaitTermination()
        except Exception:  # noqa: BLE001,S110 - the strategy stopped the query
            pass
        commits = read_results(spark, RunFolders(folder).commits)
        positions = commits.groupBy("partition").agg(F.max("next_offset").alias("next_offset"))
        stages.append(materialize(positions.select(F.lit(stage).alias("stage"), "partition", "next_offset")))
    return stages[0].unionByName(stages[1])


@query(
    "rate_limits",
    f"""WITH {SLICED_SQL} SELECT CAST(slice AS BIGINT) AS micro_batch, part AS "partition",
    count(*) AS messages, min(off) AS first_offset, max(off) AS last_offset
    FROM sliced GROUP BY slice, part""",
)
def rate_limits(spark, sf_dir):
    """Admission by files: what each micro-batch took of a log that was there at once."""
    log, folder = GrowingLog(spark, sf_dir), run_dir(spark, "rate-limits")
    for number in range(log.slices):
        log.append(number, files=1)
    policy = StreamPolicy(max_per_trigger=1)
    run_stream(
        log.stream(policy.max_per_trigger), folder, native_handler(), stream_policy=policy
    ).start().drain()
    done = read_results(spark, RunFolders(folder).outcomes)
    return done.groupBy(F.col("micro_batch").cast("bigint").alias("micro_batch"), "partition").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


@query(
    "drain_and_stop",
    f"""WITH {LOG_SQL} SELECT part AS "partition", max(off) + 1 AS next_offset,
    count(*) AS handled FROM log GROUP BY part""",
)
def drain_and_stop(spark, sf_dir):
    """Everything available is handled once; a second start with nothing new handles nothing."""
    log, folder = GrowingLog(spark, sf_dir, 2), run_dir(spark, "drain")
    log.append(0)
    log.append(1)
    for _ in range(2):
        run = run_stream(log.stream(), folder, native_handler()).start().drain()
        run.stop()
    return read_results(spark, RunFolders(folder).outcomes).groupBy("partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.count(F.lit(1)).alias("handled")
    )


@query("stream_breaker", f"WITH RECURSIVE {BREAKER_SQL} SELECT {BREAKER_SELECT} FROM breaker_log")
def stream_breaker(spark, sf_dir):
    """The breaker goes on across micro-batches and gives the rows of one replay."""
    log, folder = GrowingLog(spark, sf_dir), run_dir(spark, "stream-breaker")
    strategy = strategies.CircuitBreaker(BREAKER, span=log.span)
    log.feed(
        lambda s: run_stream(s, folder, native_handler(), strategy=strategy, on_fatal="hold")
    ).drain()
    return read_results(spark, RunFolders(folder).outcomes).select(*BREAKER_COLUMNS)


#: A message is held for so long after the micro-batch that took it.
HOLD_MS = 20_000
#: Idle time after which a query that waits for the timers gives up.
RELEASE_S = 300
#: Header with the time of the micro-batch that took a message.
TAKEN = "taken-ms"


def due_later(stream: DataFrame, hold_ms: int = HOLD_MS) -> DataFrame:
    """Every fourth message falls due ``hold_ms`` after the micro-batch that takes it.

    The time is that of the micro-batch, so however long a slice takes to be written or read,
    its messages are never due on arrival.
    """
    due_at, now = PREFIX + H.RETRY_TIME, F.current_timestamp()
    later = H.format_time(F.timestamp_millis(F.unix_millis(now) + hold_ms))
    others = F.map_filter("headers", lambda k, _: k != due_at)
    late = F.map_concat(others, F.create_map(F.lit(due_at), later))
    headers = F.when(F.col("offset") % 4 == 0, late).otherwise(F.col("headers"))
    taken = F.create_map(F.lit(TAKEN), F.unix_millis(now).cast("string"))
    return stream.withColumn("headers", F.map_concat(headers, taken))


@query(
    "retry_stream",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, event_type AS event_type_header, off % 4 = 0 AS held FROM log""",
)
def retry_stream(spark, sf_dir):
    """Every fourth message falls due later: a timer releases it in a micro-batch after its own."""
    log, folder = GrowingLog(spark, sf_dir, 2), run_dir(spark, "retry-stream")
    done, wanted = f"{folder}/released", log.log.count()
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_rows(batch, done, batch_id)

    # One run all the time: timers fire in micro-batches without input, which a query only has
    # once it has run one with input.
    log.append(0)
    try:
        emitted = hold_until_due(due_later(log.stream().drop("event_type", "value"))).select(
            "partition", "offset", "headers", F.unix_millis(F.current_timestamp()).alias("emitted_ms")
        )
        query = (
            emitted.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint").outputMode("append")
            .trigger(processingTime="1 second").start()
        )
        try:
            # The next slice comes while the first one's messages are held.
            _await_rows(query, lambda: _released(spark, done), 1)
            log.append(1)
            _await_rows(query, lambda: _released(spark, done), wanted)
        finally:
            query.stop()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return read_results(spark, done).select(
        "partition", "offset", F.col("headers")["event-type"].alias("event_type_header"),
        (F.col("emitted_ms") > F.col("headers")[TAKEN].cast("bigint")).alias("held"),
    )


def _await_rows(query, count: Callable[[], int], wanted: int, idle_s: float = RELEASE_S, poll_s: float = 1.0) -> None:
    """Wait until the query has given out so many rows; an error if it fails or idles too long instead.

    Idle is the time without new rows in which no micro-batch is at work, or one after the other ends at once.
    A micro-batch may take as long as its rows need.
    """
    rows, batch, idle = -1, None, 0.0
    while (now := count()) < wanted:
        if failure := query.exception():
            raise failure
        if not query.isActive:
            raise RuntimeError(f"the query ended after {now} of {wanted} rows")
        ended = (query.lastProgress or {}).get("batchId")
        at_work = query.status["isTriggerActive"] and ended == batch
        idle = 0.0 if now > rows else idle if at_work else idle + poll_s
        if idle > idle_s:
            raise TimeoutError(f"{now} of {wanted} rows after {idle_s} idle seconds")
        rows, batch = now, ended
        time.sleep(poll_s)


def _released(spark: SparkSession, path: str) -> int:
    try:
        return read_results(spark, path).count()
    except AnalysisException:  # nothing was written yet
        return 0


PATH_POLICY = RetryPolicy("events.retry", "events.dlq", max_attempts=3, initial_delay_ms=500, max_delay_ms=2_000)


@query(
    "retry_path",
    f"""WITH RECURSIVE {LOG_SQL}, tries AS (
      SELECT part, off, event_type, CAST(attempts AS BIGINT) AS tried, 0 AS k FROM log
      UNION ALL
      SELECT part, off, event_type, tried + 1, k + 1 FROM tries
      WHERE event_type = 'error' AND (tried = 0 OR off % 2 = 1) AND tried + 1 < 3)
    SELECT {PART_OFF}, k > 0 AS released, ok, CASE WHEN NOT ok THEN tried + 1 END AS attempt,
      CASE WHEN ok THEN 'commit' WHEN tried + 1 >= 3 THEN 'dlq' ELSE 'retry' END AS route
    FROM (SELECT *, NOT (event_type = 'error' AND (tried = 0 OR off % 2 = 1)) AS ok FROM tries)""",
)
def retry_path(spark, sf_dir):
    """Failures come back after their backoff: some succeed then, the others end as dead letters."""
    log, folder = GrowingLog(spark, sf_dir, 2), run_dir(spark, "retry-path")
    tried = H.retry_attempt(F.col("headers"))
    handler = column_handler((F.col("event_type") == "error") & ((tried == 0) | (F.col("offset") % 2 == 1)), bad_event())
    for number in range(log.slices):
        log.append(number)
        run = run_retry_path(log.stream(), folder, handler, PATH_POLICY).start()
        run.query.awaitTermination()
    run.drain()
    return read_results(spark, RunFolders(folder).outcomes).select(
        "partition", "offset", "released", "ok", "attempt", "route"
    )
