"""Payload encoding and the dead-letter envelope."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgflow.config import PayloadEncoding
from msgflow.functions.headers import (
    DEFAULT_PREFIX,
    ORIGINAL_OFFSET,
    ORIGINAL_PARTITION,
    _origin,
    format_time,
    original_topic,
)

# The eight envelope fields, in the order they are written.
ENVELOPE_SCHEMA = (
    "attemptCount BIGINT, error STRING, originalOffset BIGINT, originalPartition INT, "
    "originalTopic STRING, payload STRING, payloadEncoding STRING, timestamp STRING"
)


def encode_payload(payload: Column, encoding: PayloadEncoding | str) -> Column:
    """Payload as text: UTF-8 (bad bytes replaced) or unwrapped base64."""
    if PayloadEncoding.of(encoding) is PayloadEncoding.BASE64:
        # Spark wraps base64 at 76 characters; the envelope wants one line.
        return F.replace(F.base64(payload), F.lit("\r\n"), F.lit(""))
    return F.make_valid_utf8(payload.cast("string"))


def dlq_envelope(
    headers: Column,
    topic: Column,
    partition: Column,
    offset: Column,
    payload: Column,
    attempt: Column,
    error: Column,
    failed_at: Column,
    encoding: PayloadEncoding | str = PayloadEncoding.JSON,
    prefix: str = DEFAULT_PREFIX,
    origin: str = "last_hop",
) -> Column:
    """The JSON document a dead letter carries."""
    encoding = PayloadEncoding.of(encoding)
    return F.to_json(
        F.struct(
            attempt.cast("bigint").alias("attemptCount"),
            error.alias("error"),
            _origin(headers, ORIGINAL_OFFSET, offset, prefix, origin)
            .try_cast("bigint").alias("originalOffset"),
            _origin(headers, ORIGINAL_PARTITION, partition, prefix, origin)
            .try_cast("int").alias("originalPartition"),
            original_topic(headers, topic, prefix).alias("originalTopic"),
            F.coalesce(encode_payload(payload, encoding), F.lit("")).alias("payload"),
            F.lit(encoding.value).alias("payloadEncoding"),
            format_time(failed_at).alias("timestamp"),
        )
    )


def parse_envelope(value: Column) -> Column:
    """Envelope JSON → struct of its eight typed fields (NULL when not an envelope)."""
    return F.from_json(value.cast("string"), ENVELOPE_SCHEMA)


def decode_payload(payload: Column, encoding: Column) -> Column:
    """Envelope payload text → the original bytes."""
    return F.when(
        encoding == PayloadEncoding.BASE64.value, F.unbase64(payload)
    ).otherwise(F.encode(payload, "UTF-8"))
