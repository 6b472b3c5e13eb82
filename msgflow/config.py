"""Policies: frozen dataclasses that validate when built, before any Spark job."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from enum import Enum
from typing import Any, Optional

from pyspark.sql import Column

# ---------------------------------------------------------------------------
# Defaults, limits and message texts that callers match on.
# ---------------------------------------------------------------------------
DEFAULT_BATCH_SIZE = 100
DEFAULT_BATCH_TIMEOUT_MS = 5_000
DEFAULT_POLL_TIMEOUT_MS = 100
MIN_POLL_TIMEOUT_MS = 10
DEFAULT_SHUTDOWN_TIMEOUT_MS = 30_000
DEFAULT_MAX_ATTEMPTS = 3
DEFAULT_INITIAL_DELAY_MS = 1_000
DEFAULT_MAX_DELAY_MS = 30_000
DEFAULT_MULTIPLIER = 2.0
DEFAULT_FAILURE_THRESHOLD = 10
DEFAULT_COOLDOWN_MS = 60_000
DEFAULT_HALF_OPEN_ATTEMPTS = 3

TEXT_TOPIC_EMPTY = "topic cannot be empty"
TEXT_BROKERS_NONE = "at least one broker must be provided"
TEXT_BROKER_EMPTY = "broker address cannot be empty"
TEXT_GROUP_EMPTY = "consumer group cannot be empty"
TEXT_HANDLER_NONE = "exactly one of Handler or BatchHandler must be set"
TEXT_HANDLER_BOTH = "only one of Handler or BatchHandler can be set"
TEXT_STRATEGY_NONE = "error strategy cannot be nil"
TEXT_BATCH_SIZE = "batch size must be positive"
TEXT_BATCH_TIMEOUT = "batch timeout must be positive"
TEXT_POLL_TIMEOUT = "poll timeout must be at least 10ms"
TEXT_SHUTDOWN_TIMEOUT = "shutdown timeout must be positive"
TEXT_KAFKA_CONFIG_NONE = "kafka config cannot be nil"
TEXT_MANAGED_KEY = 'kafka config key "{key}" is managed by the library ({reason}) and cannot be overridden'
TEXT_RETRY_TOPIC_EMPTY = "retry topic cannot be empty"
TEXT_DLQ_TOPIC_EMPTY = "DLQ topic cannot be empty"
TEXT_RETRY_TOPIC_REQUIRED = "retry topic is required"
TEXT_DLQ_TOPIC_REQUIRED = "DLQ topic is required"
TEXT_MAX_ATTEMPTS = "max attempts must be positive"
TEXT_INITIAL_DELAY = "initial delay must be positive"
TEXT_MAX_DELAY = "max delay must be positive"
TEXT_MULTIPLIER = "backoff multiplier must be >= 1.0"
TEXT_ENCODING = "unsupported payload encoding: {encoding}"
TEXT_THRESHOLD = "failure threshold must be positive"
TEXT_COOLDOWN = "cooldown period must be positive"
TEXT_HALF_OPEN = "half-open attempts must be positive"
TEXT_BREAKER_BATCH = "circuit breaker is only supported in single-message mode"

MANAGED_KAFKA_KEYS = {
    "bootstrap.servers": "managed by TopicConfig.brokers",
    "group.id": "managed by TopicConfig.group",
    "enable.auto.commit": "managed by the library for explicit offset control",
}
# ---------------------------------------------------------------------------


def _require(condition: bool, text: str) -> None:
    if not condition:
        raise ValueError(text)


class PayloadEncoding(str, Enum):
    """How a payload is written into a dead-letter envelope."""

    JSON = "json"
    BASE64 = "base64"

    @classmethod
    def of(cls, value: "PayloadEncoding | str") -> "PayloadEncoding":
        try:
            return cls(value)
        except ValueError:
            raise ValueError(TEXT_ENCODING.format(encoding=value)) from None


def check_kafka_options(options: Optional[Mapping[str, Any]]) -> dict[str, str]:
    """Options for the connector; keys the library sets itself are refused."""
    _require(options is not None, TEXT_KAFKA_CONFIG_NONE)
    for key in options:
        if key in MANAGED_KAFKA_KEYS:
            raise ValueError(TEXT_MANAGED_KEY.format(key=key, reason=MANAGED_KAFKA_KEYS[key]))
    return {
        k: (str(v).lower() if isinstance(v, bool) else str(v)) for k, v in options.items()
    }


@dataclass(frozen=True)
class TopicConfig:
    """One topic, its brokers and the consumer group that reads it."""

    topic: str
    brokers: tuple[str, ...]
    group: str
    kafka_options: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "brokers", tuple(self.brokers or ()))
        _require(bool(self.topic), TEXT_TOPIC_EMPTY)
        _require(len(self.brokers) > 0, TEXT_BROKERS_NONE)
        _require(all(self.brokers), TEXT_BROKER_EMPTY)
        _require(bool(self.group), TEXT_GROUP_EMPTY)
        check_kafka_options(self.kafka_options)


@dataclass(frozen=True)
class BatchPolicy:
    """A batch closes at ``size`` rows or ``timeout_ms`` after its first row."""

    size: int = DEFAULT_BATCH_SIZE
    timeout_ms: int = DEFAULT_BATCH_TIMEOUT_MS

    def __post_init__(self) -> None:
        _require(self.size > 0, TEXT_BATCH_SIZE)
        _require(self.timeout_ms > 0, TEXT_BATCH_TIMEOUT)


@dataclass(frozen=True)
class RetryPolicy:
    """Retry target, dead-letter target and backoff."""

    retry_target: str
    dlq_target: str
    max_attempts: int = DEFAULT_MAX_ATTEMPTS
    initial_delay_ms: int = DEFAULT_INITIAL_DELAY_MS
    max_delay_ms: int = DEFAULT_MAX_DELAY_MS
    multiplier: float = DEFAULT_MULTIPLIER
    backoff: Optional[Callable[[Column], Column]] = None
    payload_encoding: PayloadEncoding = PayloadEncoding.JSON
    prefix: str = "mq."
    origin: str = "last_hop"

    def __post_init__(self) -> None:
        _require(self.retry_target is not None, TEXT_RETRY_TOPIC_REQUIRED)
        _require(self.dlq_target is not None, TEXT_DLQ_TOPIC_REQUIRED)
        _require(self.retry_target != "", TEXT_RETRY_TOPIC_EMPTY)
        _require(self.dlq_target != "", TEXT_DLQ_TOPIC_EMPTY)
        _require(self.max_attempts > 0, TEXT_MAX_ATTEMPTS)
        _require(self.initial_delay_ms > 0, TEXT_INITIAL_DELAY)
        _require(self.max_delay_ms > 0, TEXT_MAX_DELAY)
        _require(self.multiplier >= 1.0, TEXT_MULTIPLIER)
        _require(self.backoff is None or callable(self.backoff), "custom backoff must be a function")
        _require(self.origin in ("last_hop", "first"), "origin must be 'last_hop' or 'first'")
        object.__setattr__(self, "payload_encoding", PayloadEncoding.of(self.payload_encoding))


@dataclass(frozen=True)
class BreakerPolicy:
    """Trip after ``threshold`` failures in a row; probe after the cooldown."""

    threshold: int = DEFAULT_FAILURE_THRESHOLD
    cooldown_ms: int = DEFAULT_COOLDOWN_MS
    half_open_attempts: int = DEFAULT_HALF_OPEN_ATTEMPTS
    retry: Optional[RetryPolicy] = None

    def __post_init__(self) -> None:
        _require(self.threshold > 0, TEXT_THRESHOLD)
        _require(self.cooldown_ms > 0, TEXT_COOLDOWN)
        _require(self.half_open_attempts > 0, TEXT_HALF_OPEN)


@dataclass(frozen=True)
class StreamPolicy:
    """Rate limits and stop deadline of a streaming run."""

    max_per_trigger: Optional[int] = None
    trigger_interval_ms: int = DEFAULT_POLL_TIMEOUT_MS
    shutdown_timeout_ms: int = DEFAULT_SHUTDOWN_TIMEOUT_MS

    def __post_init__(self) -> None:
        _require(self.trigger_interval_ms >= MIN_POLL_TIMEOUT_MS, TEXT_POLL_TIMEOUT)
        _require(self.shutdown_timeout_ms > 0, TEXT_SHUTDOWN_TIMEOUT)
        _require(
            self.max_per_trigger is None or self.max_per_trigger > 0,
            "max_per_trigger must be positive",
        )
