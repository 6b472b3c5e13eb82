"""Continuous handling: micro-batches, strategies, sinks, positions, state between batches.

Every micro-batch runs the batch operators, so a hot partition is split inside a
micro-batch as well. Outcomes are written ahead of all sinks (``OutcomeLog``). Whatever
must be remembered between micro-batches (open batches, breakers) is a small table
that only the last pointers name (``RunState``): a replayed micro-batch reads
the state of the one before it and writes its own again, so replays do not change results.

Batches have a second input, a clock that ticks once a second: it makes a continuous
run have micro-batches without messages, which deliver the batches of keys that fell silent.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Optional, Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from msgflow.config import (
    TEXT_BREAKER_BATCH,
    TEXT_HANDLER_BOTH,
    TEXT_HANDLER_NONE,
    BatchPolicy,
    StreamPolicy,
    TopicConfig,
)
from msgflow.operators.batching import BATCH_ID, assign_batches
from msgflow.operators.breaker import inherited_breakers, state_after
from msgflow.operators.handler import BatchHandler, Handler, apply_batch_handler, apply_handler
from msgflow.operators.joins import checked_join
from msgflow.operators.offsets import commit_positions
from msgflow.operators.retry import STOP
from msgflow.operators.segments import DEFAULT_SPAN
from msgflow.operators.strategies import (
    CircuitBreaker,
    ErrorStrategy,
    FailFast,
    Retry,
    Skip,
    accepted_rows,
    apply_strategy,
    merge_routes,
)
from msgflow.schema import IDENTITY, LOG_KEY
from msgflow.session import materialize
from msgflow.sources.sinks import BATCH_FOLDER, write_dlq, write_retry, write_rows
from msgflow.streaming.state import OutcomeLog, RunState, together

Target = Union[str, TopicConfig]


class FatalOutcome(RuntimeError):
    """The strategy said stop: the query fails and the micro-batch is not committed."""


@dataclass(frozen=True)
class RunFolders:
    """Where a run keeps its checkpoint, results, positions and state (a shared folder)."""

    root: str

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    @property
    def outcomes(self) -> str:
        return f"{self.root}/outcomes"

    @property
    def commits(self) -> str:
        return f"{self.root}/commits"

    @property
    def retry(self) -> str:
        return f"{self.root}/retry"

    @property
    def dlq(self) -> str:
        return f"{self.root}/dlq"

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    @property
    def log(self) -> str:
        return f"{self.root}/log"


#: Marks rows of the clock in a frame of messages.
CLOCK = "_clock"


def with_clock(source: DataFrame) -> DataFrame:
    """A stream of messages and, once a second, of a row that is only a tick (``_clock``)."""
    ticks = (
        source.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    )
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema]
    return source.withColumn(CLOCK, F.lit(False)).unionByName(ticks.select(*nothing, F.lit(True).alias(CLOCK)))


def messages_of(batch: DataFrame) -> DataFrame:
    return batch.filter(~F.col(CLOCK)).drop(CLOCK)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All rows written to a result folder, with the micro-batch that wrote them."""
    return spark.read.parquet(path)


@dataclass
class StreamRun:
    """One streaming run. Build with ``run_stream``."""

    source: DataFrame
    folders: RunFolders
    handler: Optional[Handler]
    batch_handler: Optional[BatchHandler]
    strategy: ErrorStrategy
    batch_policy: BatchPolicy
    stream_policy: StreamPolicy
    retry_target: Target
    dlq_target: Target
    keep: Sequence[str]
    on_fatal: str
    span: int
    query: Optional[StreamingQuery] = None
    continuous: bool = False

    def start(self, available_now: bool = True) -> "StreamRun":
        """Start the query: the input available now, or continuously."""
        self.continuous = not available_now
        trigger = (
            {"availableNow": True}
            if available_now
            else {"processingTime": f"{self.stream_policy.trigger_interval_ms} milliseconds"}
        )
        source = with_clock(self._needed(self.source, "payload")) if self.batch_handler else self.source
        process = self._process_batches if self.batch_handler else self._process_messages
        self.query = (
            source.writeStream.foreachBatch(process)
            .option("checkpointLocation", self.folders.checkpoint)
            .trigger(**trigger)
            .start()
        )
        return self

    def drain(self) -> "StreamRun":
        """Wait until the available input is handled; deliver the open batches; positions are saved."""
        self.query.awaitTermination()
        if self.batch_handler:
            self._flush()
        return self

    def stop(self) -> bool:
        """Stop within the shutdown deadline; False when it passed first."""
        conf, name = self.source.sparkSession.conf, "spark.sql.streaming.stopTimeout"
        before = conf.get(name, None)
        conf.set(name, f"{self.stream_policy.shutdown_timeout_ms}ms")
        try:
            self.query.stop()
        except Exception as late:  # noqa: BLE001  (a Java TimeoutException, by class name)
            if "Timeout" not in str(late):
                raise
        finally:
            conf.unset(name) if before is None else conf.set(name, before)
        return not self.query.isActive

    def _needed(self, df: DataFrame, *read: str) -> DataFrame:
        """``df`` without what nothing reads after the handler: a strategy that hands no messages on needs no headers."""
        kind = type(self.strategy)
        if kind not in (Skip, FailFast) and not (kind is CircuitBreaker and self.strategy.policy.retry is None):
            return df
        kept = {*IDENTITY, "timestamp", "ok", "error", "next_step", *read, *self.keep}
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c in kept])

    # -- one micro-batch -----------------------------------------------------

    def _process_messages(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = OutcomeLog(spark, self.folders.log)
        outcomes = log.once("outcomes", batch_id, lambda: self._needed(apply_handler(batch, self.handler)))
        if isinstance(self.strategy, CircuitBreaker):
            state = RunState(spark, self.folders.state)
            routed, pointer = self._breaker(outcomes, batch_id, state, log)
            self._deliver(routed, batch_id, log)
            state.save(batch_id, pointer)
        else:
            self._deliver(apply_strategy(outcomes, self.strategy), batch_id, log)
        log.trim(batch_id)

    def _breaker(self, outcomes: DataFrame, batch_id: int, state: RunState, log: OutcomeLog):
        """Routed outcomes, and the pointer to the breakers after them."""
        before = state.table("breaker", state.load(batch_id - 1))
        strategy: CircuitBreaker = self.strategy
        inherited = log.once(
            "inherited", batch_id,
            lambda: inherited_breakers(outcomes, strategy.policy, span=strategy.span, initial=before),
        )
        after = state_after(inherited)
        if before is not None:
            idle = before.join(after.select(*LOG_KEY), LOG_KEY, "left_anti")
            after = after.unionByName(idle)
        routed, written = together(
            outcomes.sparkSession,
            lambda: log.once("routed", batch_id, lambda: strategy.apply(outcomes, inherited=inherited)),
            lambda: state.put("breaker", after, batch_id),
        )
        return routed, {"tables": {"breaker": written}}

    def _process_batches(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state, log = RunState(spark, self.folders.state), OutcomeLog(spark, self.folders.log)
        now = log.number("clock", batch_id, lambda: time.time_ns() // 1_000_000)
        before = state.load(batch_id - 1)
        rows = messages_of(batch)
        late = self._overdue(state, before, now)
        # Nothing came and nobody has waited long enough: all stays as it was.
        if before and late is None and rows.isEmpty():
            state.save(batch_id, before)
        else:
            state.save(batch_id, self._batches(rows, batch_id, state, log, before, now, late))
        log.trim(batch_id)

    def _overdue(self, state: RunState, before: dict, now: int) -> Optional[DataFrame]:
        """Keys whose open batch has waited for its timeout, in a continuous run."""
        keys = state.table("keys", before)
        if not self.continuous or keys is None:
            return None
        late = keys.filter(F.col("since") + self.batch_policy.timeout_ms <= now).select(*LOG_KEY)
        return None if late.isEmpty() else late

    def _flush(self) -> None:
        """Deliver the open batches as they are, and leave none to the next micro-batch.

        Results go to an id of their own, below 0, which Spark gives to no micro-batch: a flush
        after micro-batch n delivers under -(n + 1) and then replaces n's state.
        """
        spark = self.source.sparkSession
        state, log = RunState(spark, self.folders.state), OutcomeLog(spark, self.folders.log)
        last = state.last()
        before = state.load(last)
        held, keys = state.table("held", before), state.table("keys", before)
        if held is None or before.get("flushed") or held.isEmpty():
            return
        numbers = keys.select(*LOG_KEY, F.col("batches").alias(BATCH_ID))
        closed = checked_join(held, numbers, LOG_KEY, "inner", computed=True)
        flush_id = -(last + 1)
        outcomes = log.once("outcomes", flush_id, lambda: apply_batch_handler(closed, self.batch_handler))
        self._deliver(apply_strategy(outcomes, self.strategy), flush_id, log)
        open_now = F.col("since").isNotNull().cast("bigint")
        after = keys.select(*LOG_KEY, (F.col("batches") + open_now).alias("batches"), F.lit(None).cast("bigint").alias("since"))
        state.save(last, {"tables": {"keys_flushed": state.put("keys_flushed", after, last)}, "flushed": True})

    def _batches(self, rows: DataFrame, batch_id: int, state: RunState, log: OutcomeLog, before: dict, now: int, late) -> dict:
        """Close the batches that are full or timed out; hold the open one of each key.

        Held rows start a batch, so batching (held + new) rows afresh continues the
        log's batches. At most one open batch per key is held. Batches of ``late`` keys are delivered
        as they are, before new rows join. Returns the pointer to what is remembered.
        """
        held = state.table("held", before)
        if held is not None:
            held = held.select(*rows.columns)  # a run may have kept more columns before
        keys = state.table("keys_flushed" if before.get("flushed") else "keys", before)
        overdue = None
        if late is not None:
            numbers = keys.select(*LOG_KEY, F.col("batches").alias(BATCH_ID)).join(late, LOG_KEY)
            overdue = checked_join(held, numbers, LOG_KEY, "inner")
            held = checked_join(held, late, LOG_KEY, "left_anti")
            keys = keys.join(late.withColumn("_late", F.lit(True)), LOG_KEY, "left").select(
                *LOG_KEY, (F.col("batches") + F.when(F.col("_late"), 1).otherwise(0)).alias("batches"),
                F.when(F.col("_late"), None).otherwise(F.col("since")).alias("since"),
            )
        both = rows if held is None else rows.unionByName(held)
        assigned = log.once("assigned", batch_id, lambda: assign_batches(both, self.batch_policy, span=self.span))
        sizes = assigned.groupBy(*LOG_KEY, BATCH_ID).agg(F.count(F.lit(1)).alias("_size"))
        ends = sizes.groupBy(*LOG_KEY).agg(F.max(F.struct(BATCH_ID, "_size")).alias("_end"))
        is_open = F.col("_end._size") < self.batch_policy.size
        ends = ends.select(
            *LOG_KEY,
            F.when(is_open, F.col(f"_end.{BATCH_ID}")).alias("_open"),
            (F.col(f"_end.{BATCH_ID}") + F.when(is_open, 0).otherwise(1)).alias("_closed"),
        )
        if keys is not None:
            ends = ends.join(keys, LOG_KEY, "full")
        else:
            ends = ends.withColumns({"batches": F.lit(0).cast("bigint"), "since": F.lit(None).cast("bigint")})
        first = F.coalesce("batches", F.lit(0))
        # An open batch that was held already goes on waiting; a new one starts now.
        since = F.when((F.col("_open") == 0) & F.col("since").isNotNull(), F.col("since")).otherwise(F.lit(now))
        ends = materialize(
            ends.select(
                *LOG_KEY, "_open", first.alias("_before"),
                (first + F.coalesce("_closed", F.lit(0))).alias("batches"),
                F.when(F.col("_open").isNotNull(), since).cast("bigint").alias("since"),
            )
        )
        placed = checked_join(assigned, ends.drop("batches", "since"), LOG_KEY, computed=True)
        in_open = F.col("_open").isNotNull() & (F.col(BATCH_ID) == F.col("_open"))
        closed = (
            placed.filter(~in_open)
            .withColumn(BATCH_ID, F.col(BATCH_ID) + F.col("_before"))
            .drop("_open", "_before")
        )
        if overdue is not None:
            closed = closed.unionByName(overdue)
        outcomes, keys_at, held_at = together(
            rows.sparkSession,
            lambda: log.once("outcomes", batch_id, lambda: apply_batch_handler(closed, self.batch_handler)),
            lambda: state.put("keys", ends.select(*LOG_KEY, "batches", "since"), batch_id),
            lambda: state.put("held", placed.filter(in_open).drop("_open", "_before", BATCH_ID), batch_id),
        )
        self._deliver(apply_strategy(outcomes, self.strategy), batch_id, log)
        return {"tables": {"keys": keys_at, "held": held_at}}

    def _deliver(self, routed: DataFrame, batch_id: int, log: OutcomeLog) -> None:
        """Write retry rows, dead letters and outcomes, and positions when these are there.

        Where the strategy stops the query, rows after the first one that is not
        accepted in their partition are not delivered: they are read again, and the
        position stays before that row.
        """
        # These two accept every row.
        may_stop = not isinstance(self.strategy, (Skip, Retry))
        if self.on_fatal == "stop" and may_stop:
            routed = until_stop(routed)
        outputs = getattr(self.strategy, "outputs", None)
        pair = outputs(routed) if outputs else None
        columns = [
            c
            for c in (
                *LOG_KEY, "offset", "timestamp", BATCH_ID, "ok", "error", "attempt", "route",
                "state_before", "state_after", "failure_count", "success_count", "action",
                "fatal", "stop_error", *self.keep,
            )
            if c in routed.columns
        ]
        sinks = [lambda: write_rows(routed.select(*dict.fromkeys(columns)), self.folders.outcomes, batch_id)]
        if pair:
            sinks += [
                lambda: write_retry(pair[0], self.retry_target, batch_id),
                lambda: write_dlq(pair[1], self.dlq_target, batch_id),
            ]
        together(routed.sparkSession, *sinks)
        written = routed.sparkSession.read.parquet(f"{self.folders.outcomes}/{BATCH_FOLDER}={batch_id}")
        handled = merge_routes(until_stop(written)) if may_stop else written
        write_rows(commit_positions(handled), self.folders.commits, batch_id)
        if self.on_fatal == "stop" and may_stop:
            fatal = F.col("route") == STOP
            if "fatal" in written.columns:
                fatal = fatal | F.col("fatal")
            text = F.col("stop_error" if "stop_error" in written.columns else "error")
            stopped = written.filter(fatal).select(text.alias("text")).take(1)
            if stopped:
                log.forget(batch_id)
                raise FatalOutcome(f"error strategy: {stopped[0].text}")


def until_stop(routed: DataFrame) -> DataFrame:
    """Rows up to the first one of their partition that is not accepted."""
    stops = materialize(
        routed.filter(~accepted_rows(routed)).groupBy(*LOG_KEY).agg(F.min("offset").alias("_stop"))
    )
    if stops.isEmpty():
        return routed
    kept = checked_join(routed, stops, LOG_KEY, computed=True)
    return kept.filter(F.col("_stop").isNull() | (F.col("offset") <= F.col("_stop"))).drop("_stop")


def run_stream(
    source: DataFrame,
    folder: str,
    handler: Optional[Handler] = None,
    batch_handler: Optional[BatchHandler] = None,
    strategy: Optional[ErrorStrategy] = None,
    batch_policy: Optional[BatchPolicy] = None,
    stream_policy: Optional[StreamPolicy] = None,
    retry_target: Optional[Target] = None,
    dlq_target: Optional[Target] = None,
    keep: Sequence[str] = (),
    on_fatal: str = "stop",
    span: int = DEFAULT_SPAN,
) -> StreamRun:
    """A run over a streaming message frame; exactly one kind of handler.

    ``on_fatal="stop"`` fails the query when the strategy says stop and leaves the
    position before the micro-batch; ``"hold"`` records them with
    their route and goes on; the position stays before the first one of the micro-batch.
    """
    if handler is None and batch_handler is None:
        raise ValueError(TEXT_HANDLER_NONE)
    if handler is not None and batch_handler is not None:
        raise ValueError(TEXT_HANDLER_BOTH)
    if on_fatal not in ("stop", "hold"):
        raise ValueError("on_fatal must be 'stop' or 'hold'")
    strategy = Skip() if strategy is None else strategy
    if batch_handler is not None and isinstance(strategy, CircuitBreaker):
        raise ValueError(TEXT_BREAKER_BATCH)
    folders = RunFolders(folder.rstrip("/"))
    return StreamRun(
        source, folders, handler, batch_handler, strategy,
        batch_policy or BatchPolicy(), stream_policy or StreamPolicy(),
        retry_target or folders.retry, dlq_target or folders.dlq, keep, on_fatal, span,
    )
