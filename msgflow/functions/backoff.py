"""Retry delay and due time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgflow.config import RetryPolicy
from msgflow.functions.headers import format_time


def backoff_delay(attempt: Column, policy: RetryPolicy) -> Column:
    """Milliseconds before the retry that follows the ``attempt``-th failure (1-based).

    Exponential and capped; a policy's own ``backoff`` replaces it, uncapped.
    The cap is applied in DOUBLE, so a huge attempt gives the cap, not an overflow.
    """
    if policy.backoff is not None:
        return policy.backoff(attempt).cast("bigint")
    raw = F.lit(float(policy.initial_delay_ms)) * F.pow(
        F.lit(float(policy.multiplier)), (attempt - 1).cast("double")
    )
    return F.least(F.lit(float(policy.max_delay_ms)), raw).cast("bigint")


def retry_moment(failed_at: Column, delay_ms: Column) -> Column:
    """Timestamp at which the retry falls due."""
    return F.timestamp_micros(F.unix_micros(failed_at) + delay_ms * 1000)


def retry_at(failed_at: Column, delay_ms: Column) -> Column:
    """Due time as RFC 3339 text in whole seconds."""
    return format_time(retry_moment(failed_at, delay_ms))
