"""msgflow: reliable message processing on Spark DataFrames and streams."""

from msgflow.config import (
    BatchPolicy,
    BreakerPolicy,
    PayloadEncoding,
    RetryPolicy,
    StreamPolicy,
    TopicConfig,
)
from msgflow.operators.handler import (
    ColumnHandler,
    HandlerFailure,
    Message,
    PayloadHandler,
    apply_batch_handler,
    apply_handler,
    column_handler,
)
from msgflow.operators.strategies import CircuitBreaker, FailFast, Retry, Skip
from msgflow.schema import MESSAGE_SCHEMA
from msgflow.sources.topics import read_log, read_topic, stream_log, to_messages

__all__ = [
    "BatchPolicy",
    "BreakerPolicy",
    "CircuitBreaker",
    "ColumnHandler",
    "FailFast",
    "HandlerFailure",
    "MESSAGE_SCHEMA",
    "Message",
    "PayloadEncoding",
    "PayloadHandler",
    "Retry",
    "RetryPolicy",
    "Skip",
    "StreamPolicy",
    "TopicConfig",
    "apply_batch_handler",
    "apply_handler",
    "column_handler",
    "read_log",
    "read_topic",
    "stream_log",
    "to_messages",
]
