"""Error strategies: outcomes in, routes out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Optional, Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.config import BreakerPolicy, RetryPolicy
from msgflow.operators.breaker import circuit_breaker
from msgflow.operators.joins import checked_join
from msgflow.operators.offsets import skip_ranges
from msgflow.operators.retry import COMMIT, DLQ, RETRY, STOP, next_attempt, retry
from msgflow.operators.segments import DEFAULT_SPAN, settled
from msgflow.schema import IDENTITY, LOG_KEY
from msgflow.session import materialize

# Texts of fatal results.
FAIL_FAST_TEXT = "fail-fast: handler error on topic=%s partition=%d offset=%d: %s"
TRIPPED_TEXT = "circuit breaker opened after %d consecutive failures"
REJECTED_TEXT = "circuit breaker open"
REOPENED_TEXT = "circuit breaker reopened after half-open failure: %s"


@runtime_checkable
class ErrorStrategy(Protocol):
    """A strategy sets ``route`` on every outcome row: commit, retry, dlq or stop."""

    name: str

    def apply(self, outcomes: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class Skip:
    """Failures are logged and count as handled. The default."""

    name: str = field(default="skip", init=False)

    def apply(self, outcomes: DataFrame) -> DataFrame:
        return outcomes.withColumn("route", F.lit(COMMIT))


def fail_fast(outcomes: DataFrame, mode: str = "cut") -> DataFrame:
    """Stop at the first failure of each (topic, partition).

    ``cut`` keeps rows up to it: earlier ones commit, the failing one stops, later
    ones are not read. ``raise`` fails the Spark job at any failure. The first
    failure is a partially aggregated minimum, so the log itself is not shuffled.
    """
    message = F.format_string(
        FAIL_FAST_TEXT, "topic", "partition", "offset", F.coalesce("error", F.lit(""))
    )
    if mode == "raise":
        return outcomes.withColumn(
            "route",
            F.when(F.col("ok"), F.lit(COMMIT)).otherwise(F.raise_error(message).cast("string")),
        )
    if mode != "cut":
        raise ValueError("mode must be 'cut' or 'raise'")
    outcomes = settled(outcomes)
    first = materialize(
        outcomes.filter(~F.col("ok")).groupBy(*LOG_KEY).agg(F.min("offset").alias("_stop"))
    )
    return (
        checked_join(skip_ranges(outcomes, first, "_stop", after=True), first, LOG_KEY, computed=True)
        .filter(F.col("_stop").isNull() | (F.col("offset") <= F.col("_stop")))
        .withColumn("route", F.when(F.col("ok"), COMMIT).otherwise(STOP))
        .withColumn("stop_error", F.when(~F.col("ok"), message))
        .drop("_stop")
    )


@dataclass(frozen=True)
class FailFast:
    """Stop at the first failure."""

    mode: str = "cut"
    name: str = field(default="fail-fast", init=False)

    def apply(self, outcomes: DataFrame) -> DataFrame:
        return fail_fast(outcomes, self.mode)


def _retry_route(policy: RetryPolicy) -> Column:
    attempt = next_attempt(F.col("headers"), policy.prefix)
    return F.when(attempt >= policy.max_attempts, DLQ).otherwise(RETRY)


@dataclass(frozen=True)
class Retry:
    """Failures go to the retry target, and to the dead-letter target when exhausted."""

    policy: RetryPolicy
    name: str = field(default="retry", init=False)

    def apply(self, outcomes: DataFrame) -> DataFrame:
        return outcomes.withColumn(
            "attempt", F.when(~F.col("ok"), next_attempt(F.col("headers"), self.policy.prefix))
        ).withColumn("route", F.when(F.col("ok"), COMMIT).otherwise(_retry_route(self.policy)))

    def outputs(
        self, routed: DataFrame, failed_at: Optional[Column] = None
    ) -> tuple[DataFrame, DataFrame]:
        return retry(routed, self.policy, failed_at)


@dataclass(frozen=True)
class CircuitBreaker:
    """Breaker over the outcomes of each key; failures it counts may also be retried."""

    policy: BreakerPolicy = BreakerPolicy()
    span: int = DEFAULT_SPAN
    name: str = field(default="circuit-breaker", init=False)

    def apply(
        self, outcomes: DataFrame, initial: Optional[DataFrame] = None, inherited: Optional[DataFrame] = None
    ) -> DataFrame:
        log = circuit_breaker(outcomes, self.policy, span=self.span, initial=initial, inherited=inherited)
        return breaker_routes(log, self.policy)

    def outputs(
        self, routed: DataFrame, failed_at: Optional[Column] = None
    ) -> Optional[tuple[DataFrame, DataFrame]]:
        return retry(routed, self.policy.retry, failed_at) if self.policy.retry else None


def breaker_routes(log: DataFrame, policy: BreakerPolicy) -> DataFrame:
    """Routes of a breaker log.

    With a retry policy, failures counted while closed and those that reopen are
    written to the retry or dead-letter target; a trip is fatal all the same.
    Probes are accepted without being retried. Without one, fatal rows stop.
    """
    action = F.col("action")
    if policy.retry is None:
        route = F.when(F.col("fatal"), STOP).otherwise(COMMIT)
        out = log
    else:
        retried = action.isin("continue", "tripped", "reopened")
        route = (
            F.when(retried, _retry_route(policy.retry))
            .when(F.col("fatal"), STOP)
            .otherwise(COMMIT)
        )
        out = log.withColumn(
            "attempt", F.when(retried, next_attempt(F.col("headers"), policy.retry.prefix))
        )
    text = (
        F.when(action == "tripped", F.format_string(TRIPPED_TEXT, "failure_count"))
        .when(action == "rejected", F.lit(REJECTED_TEXT))
        .when(action == "reopened", F.format_string(REOPENED_TEXT, "error"))
    )
    return out.withColumn("route", route).withColumn("stop_error", F.when(F.col("fatal"), text))


def apply_strategy(outcomes: DataFrame, strategy: Optional[ErrorStrategy] = None) -> DataFrame:
    """Route ``outcomes``; the default strategy skips."""
    strategy = Skip() if strategy is None else strategy
    routed = strategy.apply(outcomes)
    if "route" not in routed.columns:
        raise ValueError(f"strategy {strategy.name} did not set a route")
    return routed


def error_log(outcomes: DataFrame, strategy_name: str) -> DataFrame:
    """What a strategy logs: the failed rows with their position and error."""
    return outcomes.filter(~F.col("ok")).select(
        F.lit(strategy_name).alias("strategy"), *LOG_KEY, "offset", "error"
    )


def accepted_rows(routed: DataFrame) -> Column:
    """Whether a row was handled, or accepted by the strategy."""
    accepted = F.col("route") != STOP
    return accepted & ~F.col("fatal") if "fatal" in routed.columns else accepted


def merge_routes(routed: DataFrame) -> DataFrame:
    """Rows whose position may be committed."""
    return routed.filter(accepted_rows(routed))


def held_again(log: DataFrame, outcomes: DataFrame, on: Sequence[str] = IDENTITY, order: str = "micro_batch") -> DataFrame:
    """Messages of ``log`` whose last outcome was not accepted: those that a run with ``on_fatal="hold"`` went past.

    ``outcomes`` may have several rows for a message; the one with the largest ``order`` counts, and of
    several at one order an accepted one. Handle the result once more and add its outcomes under a larger
    order. Outcomes combine on the map side before the join.
    """
    accepted = F.coalesce(accepted_rows(outcomes), F.lit(False))
    last = outcomes.groupBy(*on).agg(F.max_by(accepted, F.struct(F.col(order), accepted)).alias("_done"))
    return log.join(last.filter("NOT _done").select(*on), list(on), "left_semi")
