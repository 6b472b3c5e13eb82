"""Header codec: read, strip and build the reserved message headers.

Everything here is a Column expression: it stays inside whole-stage codegen and
never leaves the JVM.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The nine reserved header names, the error code and formats.
# ---------------------------------------------------------------------------
DEFAULT_PREFIX = "mq."
RETRY_ATTEMPT = "retry.attempt"
RETRY_TIME = "retry.time"
RETRY_STEP = "retry.step"
ERROR_CODE = "error.code"
ERROR_MESSAGE = "error.message"
ORIGINAL_TOPIC = "original.topic"
ORIGINAL_PARTITION = "original.partition"
ORIGINAL_OFFSET = "original.offset"
FAILED_AT = "failed.at"
RESERVED = (
    RETRY_ATTEMPT,
    RETRY_TIME,
    RETRY_STEP,
    ERROR_CODE,
    ERROR_MESSAGE,
    ORIGINAL_TOPIC,
    ORIGINAL_PARTITION,
    ORIGINAL_OFFSET,
    FAILED_AT,
)
HANDLER_ERROR = "HANDLER_ERROR"
RFC3339_SECONDS = "yyyy-MM-dd'T'HH:mm:ssXXX"
INTEGER_PATTERN = r"^[+-]?[0-9]+\z"
RFC3339_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"
)
# ---------------------------------------------------------------------------


def header(headers: Column, name: str, prefix: str = DEFAULT_PREFIX) -> Column:
    """The value of one reserved header, NULL when absent."""
    return F.try_element_at(headers, F.lit(prefix + name))


def _integer(text: Column, sql_type: str) -> Column:
    # The pattern refuses what a bare cast would trim or round (' 5 ', '5.0').
    parsed = F.when(text.rlike(INTEGER_PATTERN), text.try_cast(sql_type))
    return F.coalesce(parsed, F.lit(0).cast(sql_type))


def retry_attempt(headers: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    """Attempts so far: 0 when the header is absent, unreadable or out of range."""
    return _integer(header(headers, RETRY_ATTEMPT, prefix), "bigint")


def retry_step(headers: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    """The step a handler should resume at; 0 when absent or unreadable."""
    return _integer(header(headers, RETRY_STEP, prefix), "int")


def retry_time(headers: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    """When the retry falls due; NULL when absent or not RFC 3339."""
    text = header(headers, RETRY_TIME, prefix)
    return F.when(text.rlike(RFC3339_PATTERN), F.try_to_timestamp(text))


def original_topic(headers: Column, topic: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    """Topic of the first hop: the header if set and not empty, else ``topic``."""
    return F.coalesce(F.nullif(header(headers, ORIGINAL_TOPIC, prefix), F.lit("")), topic)


def strip_reserved(headers: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    """Application headers only. Matching is by whole key, not by prefix."""
    reserved = [prefix + name for name in RESERVED]
    return F.coalesce(
        F.map_filter(headers, lambda key, _: ~key.isin(reserved)),
        F.create_map().cast("map<string,string>"),
    )


def error_code(error: Column, code: Optional[Column] = None) -> Column:
    """Error class of a failure: ``code`` if given, ``HANDLER_ERROR`` otherwise, '' without error."""
    value = F.lit(HANDLER_ERROR) if code is None else F.coalesce(code, F.lit(HANDLER_ERROR))
    return F.when(error.isNull(), F.lit("")).otherwise(value)


def format_time(moment: Column) -> Column:
    """RFC 3339 text, whole seconds."""
    return F.date_format(moment, RFC3339_SECONDS)


def _origin(
    headers: Column, name: str, own: Column, prefix: str, origin: str
) -> Column:
    own_text = own.cast("string")
    if origin == "last_hop":
        return own_text
    return F.coalesce(F.nullif(header(headers, name, prefix), F.lit("")), own_text)


def dlq_headers(
    headers: Column,
    topic: Column,
    partition: Column,
    offset: Column,
    attempt: Column,
    error: Column,
    failed_at: Column,
    prefix: str = DEFAULT_PREFIX,
    origin: str = "last_hop",
    code: Optional[Column] = None,
) -> Column:
    """Application headers plus the seven keys of a dead letter."""
    return F.map_concat(
        strip_reserved(headers, prefix),
        F.create_map(
            F.lit(prefix + RETRY_ATTEMPT), attempt.cast("string"),
            F.lit(prefix + ERROR_CODE), error_code(error, code),
            F.lit(prefix + ERROR_MESSAGE), error,
            F.lit(prefix + ORIGINAL_TOPIC), original_topic(headers, topic, prefix),
            F.lit(prefix + ORIGINAL_PARTITION),
            _origin(headers, ORIGINAL_PARTITION, partition, prefix, origin),
            F.lit(prefix + ORIGINAL_OFFSET),
            _origin(headers, ORIGINAL_OFFSET, offset, prefix, origin),
            F.lit(prefix + FAILED_AT), format_time(failed_at),
        ),
    )


def retry_headers(
    headers: Column,
    topic: Column,
    partition: Column,
    offset: Column,
    attempt: Column,
    retry_at: Column,
    error: Column,
    failed_at: Column,
    prefix: str = DEFAULT_PREFIX,
    origin: str = "last_hop",
    next_step: Optional[Column] = None,
    code: Optional[Column] = None,
) -> Column:
    """Application headers plus all nine keys. ``retry_at`` is RFC 3339 text."""
    step = retry_step(headers, prefix)
    if next_step is not None:
        step = F.coalesce(next_step.cast("int"), step)
    return F.map_concat(
        dlq_headers(
            headers, topic, partition, offset, attempt, error, failed_at, prefix, origin, code
        ),
        F.create_map(
            F.lit(prefix + RETRY_TIME), retry_at,
            F.lit(prefix + RETRY_STEP), step.cast("string"),
        ),
    )


def headers_from_entries(entries: Column) -> Column:
    """``ARRAY<STRUCT<key, value>>`` → map; the last entry of a repeated key wins.

    Self-contained: does not depend on the session's map-key policy. Without a
    repeated key no higher-order function runs, so it stays in generated code.
    """
    keys, values = entries["key"], entries["value"].cast("array<string>")
    last = F.filter(
        entries,
        lambda e, i: F.array_position(F.slice(keys, i + 2, F.size(keys)), e["key"]) == 0,
    )
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.coalesce(
        F.when(repeated, F.map_from_entries(last).cast("map<string,string>"))
        .otherwise(F.map_from_arrays(keys, values)),
        F.create_map().cast("map<string,string>"),
    )
