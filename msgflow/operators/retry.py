"""Retry: routing, retry and dead-letter rows, due filter, bounded rounds."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.config import RetryPolicy
from msgflow.functions.backoff import backoff_delay, retry_at, retry_moment
from msgflow.functions.headers import dlq_headers, retry_attempt, retry_headers, retry_time
from msgflow.functions.payload import dlq_envelope
from msgflow.operators.handler import ColumnHandler, Handler, apply_handler
from msgflow.operators.segments import settled
from msgflow.session import materialize

# The routes of an outcome.
COMMIT, RETRY, DLQ, STOP = "commit", "retry", "dlq", "stop"


def next_attempt(headers: Column, prefix: str) -> Column:
    """Attempt number of the failure at hand (stays at the largest BIGINT)."""
    return F.least(retry_attempt(headers, prefix), F.lit(2**63 - 2)) + 1


def route_failures(failed: DataFrame, policy: RetryPolicy) -> DataFrame:
    """Add ``attempt`` and ``route``: dead letter once the attempts are used up."""
    return failed.withColumn(
        "attempt", next_attempt(F.col("headers"), policy.prefix)
    ).withColumn(
        "route", F.when(F.col("attempt") >= policy.max_attempts, DLQ).otherwise(RETRY)
    )


def _next_step(df: DataFrame) -> Optional[Column]:
    return F.col("next_step") if "next_step" in df.columns else None


def _code(df: DataFrame) -> Optional[Column]:
    return F.col("code") if "code" in df.columns else None


def _message_columns():
    return [F.col(c) for c in ("headers", "topic", "partition", "offset")]


def retry_rows(routed: DataFrame, policy: RetryPolicy, failed_at: Column) -> DataFrame:
    """Rows for the retry target: NULL key, unchanged payload, nine headers."""
    rows = routed.filter(F.col("route") == RETRY)
    due = retry_at(failed_at, backoff_delay(F.col("attempt"), policy))
    headers = retry_headers(
        *_message_columns(), F.col("attempt"), due, F.col("error"), failed_at,
        policy.prefix, policy.origin, _next_step(routed), _code(routed),
    )
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("payload").alias("value"),
        headers.alias("headers"),
        F.lit(policy.retry_target).alias("topic"),
    )


def dlq_rows(routed: DataFrame, policy: RetryPolicy, failed_at: Column) -> DataFrame:
    """Rows for the dead-letter target: JSON envelope, seven headers."""
    rows = routed.filter(F.col("route") == DLQ)
    headers = dlq_headers(
        *_message_columns(), F.col("attempt"), F.col("error"), failed_at,
        policy.prefix, policy.origin, _code(routed),
    )
    envelope = dlq_envelope(
        *_message_columns(), F.col("payload"), F.col("attempt"), F.col("error"), failed_at,
        policy.payload_encoding, policy.prefix, policy.origin,
    )
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(envelope, "UTF-8").alias("value"),
        headers.alias("headers"),
        F.lit(policy.dlq_target).alias("topic"),
    )


def retry(
    failed: DataFrame, policy: RetryPolicy, failed_at: Optional[Column] = None
) -> tuple[DataFrame, DataFrame]:
    """(rows for the retry target, rows for the dead-letter target) of failed messages.

    ``failed_at`` defaults to the message's own time, so a rerun gives the same rows.
    """
    failed_at = F.col("timestamp") if failed_at is None else failed_at
    routed = failed if "route" in failed.columns else route_failures(failed, policy)
    return retry_rows(routed, policy, failed_at), dlq_rows(routed, policy, failed_at)


def retry_due(df: DataFrame, as_of: Column, prefix: str = "mq.") -> DataFrame:
    """Rows whose retry time has come; no or an unreadable time counts as due."""
    return df.filter(F.coalesce(retry_time(F.col("headers"), prefix) <= as_of, F.lit(True)))


@dataclass
class RetryResult:
    """Frames of ``run_with_retries``; every input row is in ``ok``, ``dlq`` or ``pending`` once."""

    ok: DataFrame
    dlq: DataFrame
    pending: DataFrame
    history: DataFrame

    @property
    def rounds(self) -> int:
        """Rounds that had rows, 1 at least."""
        return (self.history.agg(F.max("round")).first()[0] or 0) + 1


def _tried(outcomes: DataFrame, policy: RetryPolicy) -> DataFrame:
    """Outcomes of one round with ``attempt`` and ``route``."""
    # A negative attempt header counts as none here: it would add rounds without end.
    attempt = F.greatest(next_attempt(F.col("headers"), policy.prefix), F.lit(1))
    return outcomes.withColumn("attempt", attempt).withColumn(
        "route",
        F.when(F.col("ok"), COMMIT)
        .when(F.col("attempt") >= policy.max_attempts, DLQ)
        .otherwise(RETRY),
    )


def _again(routed: DataFrame, policy: RetryPolicy) -> tuple[Column, Column]:
    """Headers and time of a row in the round after its failure."""
    delay = backoff_delay(F.col("attempt"), policy)
    headers = retry_headers(
        *_message_columns(), F.col("attempt"), retry_at(F.col("timestamp"), delay),
        F.col("error"), F.col("timestamp"), policy.prefix, policy.origin, _next_step(routed),
    )
    return headers, retry_moment(F.col("timestamp"), delay)


#: Rounds of a column handler that are written out in one plan.
UNROLLED = 8
ROUND_COLUMNS = ("headers", "timestamp", "error", "ok", "next_step", "round", "attempt", "route")


def _unrolled(df: DataFrame, handler: ColumnHandler, policy: RetryPolicy, rounds: int) -> tuple[DataFrame, DataFrame]:
    """(history, pending) of all rounds in one plan over one scan, without a shuffle.

    Every row carries its rounds as columns, each made from the headers and time that the round before
    left; the rounds that took place are then given out as rows.
    """
    names, row = list(df.columns), df.withColumn("_open", F.lit(True))
    for number in range(rounds):
        row = _tried(apply_handler(row, handler).withColumn("round", F.lit(number)), policy)
        headers, moment = _again(row, policy)
        again = F.col("_open") & (F.col("route") == RETRY)
        row = row.withColumn(f"_round{number}", F.when(F.col("_open"), F.struct(*ROUND_COLUMNS)))
        row = row.withColumns({
            "_open": again, "headers": F.when(again, headers).otherwise(F.col("headers")),
            "timestamp": F.when(again, moment).otherwise(F.col("timestamp")),
        })
    pending = row.filter("_open").select(*names)
    others = [F.col(c) for c in names if c not in ROUND_COLUMNS]
    all_rounds = F.filter(F.array(*[f"_round{n}" for n in range(rounds)]), lambda r: r.isNotNull())
    history = row.select(*others, F.inline(all_rounds))
    return history.select(*dict.fromkeys([*names, *ROUND_COLUMNS])), pending


def run_with_retries(
    df: DataFrame, handler: Handler, policy: RetryPolicy,
    max_rounds: Optional[int] = None,
) -> RetryResult:
    """Handle, route failures, handle the retry rows again, until none is left.

    A failed row uses up one attempt per round and negative attempt headers count as
    0, so there are at most ``max_attempts`` rounds; rows still to be retried after
    ``max_rounds`` are returned as ``pending``. A row's time moves by the backoff.

    Up to ``UNROLLED`` rounds of a column handler are one plan that is not run here. Otherwise each
    round works on the remaining failures only, and its outcomes (for a column handler, its failures) are
    materialised, so lineage stays short and a Python handler runs once per row and round.
    """
    most = policy.max_attempts if max_rounds is None else min(max_rounds, policy.max_attempts)
    if isinstance(handler, ColumnHandler) and most <= UNROLLED:
        history, pending = _unrolled(settled(df), handler, policy, most)
        history = settled(history)
        return RetryResult(
            history.filter(F.col("route") == COMMIT), history.filter(F.col("route") == DLQ), pending, history
        )
    message_columns = list(df.columns)
    pending, history, round_no = df, None, 0
    while True:
        routed = _tried(apply_handler(pending, handler).withColumn("round", F.lit(round_no)), policy)
        if not isinstance(handler, ColumnHandler):
            routed = materialize(routed)
        history = routed if history is None else history.unionByName(routed)
        again = routed.filter(F.col("route") == RETRY)
        headers, moment = _again(again, policy)
        pending = again.withColumns({"headers": headers, "timestamp": moment}).select(*message_columns)
        if isinstance(handler, ColumnHandler):
            pending = materialize(pending)
        if round_no + 1 == max_rounds or pending.isEmpty():
            break
        round_no += 1
    return RetryResult(
        history.filter(F.col("route") == COMMIT),
        history.filter(F.col("route") == DLQ),
        pending,
        history,
    )
