"""The retry path as one run: handle, hold, release, handle again, dead-letter, under one checkpoint.

A failed message is held until its backoff has passed and then handled again, together with
the new messages of a micro-batch, until it succeeds or its attempts are used up. What is held lies
in a table by the micro-batch that wrote it and the slot of time in which it falls due:
rows are written once and read once, however many are waiting, and a release reads only the slots
that have passed. The clock is a number that the log keeps for each micro-batch, so a replay
releases the same rows, stamps the same times, and uses the outcomes that the first attempt got.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from msgflow.config import RetryPolicy, StreamPolicy
from msgflow.functions.backoff import backoff_delay, retry_at
from msgflow.functions.headers import retry_headers
from msgflow.operators.handler import Handler, apply_handler
from msgflow.operators.offsets import commit_positions
from msgflow.operators.retry import RETRY, dlq_rows
from msgflow.operators.strategies import Retry
from msgflow.schema import LOG_KEY
from msgflow.sources.sinks import BATCH_FOLDER, write_dlq, write_rows
from msgflow.streaming.runner import RunFolders, Target, messages_of, with_clock
from msgflow.streaming.state import OutcomeLog, RunState, together

#: Width of a slot: a row is released at most this long, and one trigger, after it falls due.
SLOT_MS = 1_000
SLOT, RELEASED = "_slot", "released"


@dataclass
class RetryRun:
    """One run of the retry path. Build with ``run_retry_path``."""

    source: DataFrame
    folders: RunFolders
    handler: Handler
    policy: RetryPolicy
    stream_policy: StreamPolicy
    dlq_target: Target
    keep: Sequence[str]
    slot_ms: int
    query: Optional[StreamingQuery] = None

    def start(self, available_now: bool = True) -> "RetryRun":
        """Start the query: the input and the due rows of now, or continuously."""
        trigger = (
            {"availableNow": True}
            if available_now
            else {"processingTime": f"{self.stream_policy.trigger_interval_ms} milliseconds"}
        )
        self.query = (
            with_clock(self.source).writeStream.foreachBatch(self._process)
            .option("checkpointLocation", self.folders.checkpoint).trigger(**trigger).start()
        )
        return self

    def pending(self) -> int:
        """Rows that are held after the last micro-batch."""
        state = RunState(self.source.sparkSession, self.folders.state)
        return sum(state.load(state.last()).get("slots", {}).values())

    def drain(self, timeout_ms: Optional[int] = None) -> "RetryRun":
        """Handle the available input, then wait for what is held until nothing is, or until the time is up."""
        until = None if timeout_ms is None else time.monotonic() + timeout_ms / 1000
        self.query.awaitTermination()
        state = RunState(self.source.sparkSession, self.folders.state)
        while slots := state.load(state.last()).get("slots", {}):
            wait = (min(map(int, slots)) + 1) * self.slot_ms / 1000 - time.time()
            if until is not None and time.monotonic() + max(wait, 0) > until:
                break
            # The clock ticks once a second, and a run of what is available needs a tick.
            time.sleep(max(wait, 1.0))
            self.start().query.awaitTermination()
        return self

    def stop(self) -> None:
        self.query.stop()

    # -- one micro-batch -----------------------------------------------------

    @property
    def _held(self) -> str:
        return f"{self.folders.root}/held"

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state, log = RunState(spark, self.folders.state), OutcomeLog(spark, self.folders.log)
        now = log.number("clock", batch_id, lambda: time.time_ns() // 1_000_000)
        before = state.load(batch_id - 1)
        slots = {int(s): n for s, n in before.get("slots", {}).items()}
        passed = now // self.slot_ms - 1  # the last slot that is over
        due = sorted(s for s in slots if s <= passed)
        rows = messages_of(batch)
        if not due and rows.isEmpty():
            state.save(batch_id, before)
            log.trim(batch_id)
            return
        rows = rows.withColumn(RELEASED, F.lit(False))
        if due:
            rows = rows.unionByName(self._released(spark, rows, due, batch_id))
        outcomes = log.once("outcomes", batch_id, lambda: apply_handler(rows, self.handler))
        routed = Retry(self.policy).apply(outcomes)
        dead = dlq_rows(routed.filter("NOT ok"), self.policy, F.timestamp_millis(F.lit(now)))
        columns = [*LOG_KEY, "offset", "timestamp", "ok", "error", "attempt", "route", RELEASED, *self.keep]
        again, *_ = together(
            spark,
            lambda: self._hold(routed, rows.columns, now, passed, batch_id),
            lambda: write_dlq(dead, self.dlq_target, batch_id),
            lambda: write_rows(routed.select(*dict.fromkeys(columns)), self.folders.outcomes, batch_id),
        )
        written = spark.read.parquet(f"{self.folders.outcomes}/{BATCH_FOLDER}={batch_id}")
        write_rows(commit_positions(written.filter(~F.col(RELEASED))), self.folders.commits, batch_id)
        left = {s: n for s, n in slots.items() if s > passed}
        for slot, n in again.items():
            left[slot] = left.get(slot, 0) + n
        state.save(batch_id, {"slots": {str(s): n for s, n in left.items()}, "passed": passed})
        self._forget(state, before)
        log.trim(batch_id)

    def _released(self, spark, like: DataFrame, due: list[int], batch_id: int) -> DataFrame:
        """Rows of the slots that are over, from earlier micro-batches."""
        held = spark.read.parquet(self._held)
        # Both columns are folders, so only the files of these slots are read.
        return held.filter((F.col(BATCH_FOLDER) < batch_id) & F.col(SLOT).between(due[0], due[-1])).select(*like.columns)

    def _hold(self, routed: DataFrame, columns: Sequence[str], now: int, passed: int, batch_id: int) -> dict[int, int]:
        """Write the rows that are to be handled again, by slot; returns the rows of each slot."""
        failed = routed.filter(F.col("route") == RETRY)
        delay = backoff_delay(F.col("attempt"), self.policy)
        at = F.timestamp_millis(F.lit(now))
        code = F.col("code") if "code" in failed.columns else None
        step = F.col("next_step") if "next_step" in failed.columns else None
        headers = retry_headers(
            *(F.col(c) for c in ("headers", "topic", "partition", "offset")), F.col("attempt"),
            retry_at(at, delay), F.col("error"), at, self.policy.prefix, self.policy.origin, step, code,
        )
        slot = F.greatest(F.expr(f"(CAST({now} AS BIGINT) + _delay) div {self.slot_ms}L"), F.lit(passed + 1))
        held = failed.withColumn("_delay", delay.cast("bigint")).withColumns(
            {"headers": headers, RELEASED: F.lit(True), SLOT: slot}
        )
        path = f"{self._held}/{BATCH_FOLDER}={batch_id}"
        held.select(*columns, SLOT).write.mode("overwrite").partitionBy(SLOT).parquet(path)
        # As many rows as there are slots ahead: the longest backoff bounds them.
        counts = failed.sparkSession.read.schema(f"{SLOT} BIGINT").option("basePath", path).parquet(path)
        return {r[SLOT]: r["n"] for r in counts.groupBy(SLOT).agg(F.count(F.lit(1)).alias("n")).collect()}

    def _forget(self, state: RunState, before: dict) -> None:
        """Delete slots that were over before the micro-batch that may be replayed next."""
        passed = before.get("passed")
        if passed is None:
            return
        for folder in state.files.names(self._held):
            if not folder.startswith(f"{BATCH_FOLDER}="):
                continue
            slots = [n for n in state.files.names(f"{self._held}/{folder}") if n.startswith(f"{SLOT}=")]
            for name in slots:
                if int(name.rpartition("=")[2]) <= passed:
                    state.files.delete(f"{self._held}/{folder}/{name}")


def run_retry_path(
    source: DataFrame, folder: str, handler: Handler, policy: RetryPolicy,
    stream_policy: Optional[StreamPolicy] = None, dlq_target: Optional[Target] = None,
    keep: Sequence[str] = (), slot_ms: int = SLOT_MS,
) -> RetryRun:
    """A run in which failed messages come back after their backoff.

    Every message ends with one outcome whose route is ``commit`` or ``dlq``; each failed try before
    it has one whose route is ``retry``. ``released`` tells tries that came out of the hold. A message
    keeps its place and time; its headers are those of a retry row, stamped with the clock of the
    micro-batch. Positions follow the new messages only, as what is held is part of the run's state.
    Columns in ``keep`` are added to the outcomes.
    """
    folders = RunFolders(folder.rstrip("/"))
    return RetryRun(
        source, folders, handler, policy, stream_policy or StreamPolicy(), dlq_target or folders.dlq, keep, slot_ms
    )
