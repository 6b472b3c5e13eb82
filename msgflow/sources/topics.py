"""Read message logs: connector topics, tables of messages, dead letters."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.config import TopicConfig, check_kafka_options
from msgflow.functions.headers import headers_from_entries
from msgflow.functions.payload import decode_payload, parse_envelope
from msgflow.schema import MESSAGE_SCHEMA, check_messages

# Reconnect defaults of the connector, and the start when nothing is committed.
CONNECTOR_DEFAULTS = {"reconnect.backoff.ms": "100", "reconnect.backoff.max.ms": "10000"}
DEFAULT_START = "earliest"
# Client settings Spark's source expresses by options of its own.
START_OPTION = "auto.offset.reset"


# Options of Spark's source itself, which take no prefix.
READER_OPTIONS = (
    "minPartitions", "maxRecordsPerPartition", "failOnDataLoss", "endingOffsets", "startingTimestamp",
    "endingTimestamp", "maxOffsetsPerTrigger", "minOffsetsPerTrigger", "fetchOffset.numRetries",
)


def starting_offsets(positions: DataFrame, topic: str) -> str:
    """Committed positions of a topic as the source's ``startingOffsets`` (one row per partition)."""
    rows = positions.filter(F.col("topic") == topic).groupBy("partition").agg(F.max("next_offset").alias("at"))
    return json.dumps({topic: {str(r["partition"]): r["at"] for r in rows.orderBy("partition").collect()}})


def connector_options(
    config: TopicConfig, start: Optional[str] = None, reader: Optional[Mapping[str, str]] = None,
) -> dict[str, str]:
    """Reader options of Spark's Kafka source for ``config``.

    User options pass through with the ``kafka.`` prefix and may replace the
    defaults; managed keys were refused when the config was built. A user's
    ``auto.offset.reset`` becomes ``startingOffsets``, which Spark owns; ``start``
    may also be a JSON of positions (``starting_offsets``). ``reader`` holds options
    of the source itself, such as ``minPartitions`` to split large partitions.
    """
    reader = dict(reader or {})
    unknown = [k for k in reader if k not in READER_OPTIONS]
    if unknown:
        raise ValueError(f"not options of the source: {', '.join(unknown)}")
    user = check_kafka_options(config.kafka_options)
    begin = start or user.pop(START_OPTION, DEFAULT_START)
    user.pop(START_OPTION, None)
    if begin not in ("earliest", "latest") and not begin.startswith("{"):
        raise ValueError("start must be 'earliest' or 'latest'")
    return {
        "kafka.bootstrap.servers": ",".join(config.brokers),
        "kafka.group.id": config.group,
        "subscribe": config.topic,
        "includeHeaders": "true",
        "startingOffsets": begin,
        **{f"kafka.{k}": v for k, v in {**CONNECTOR_DEFAULTS, **user}.items()},
        **reader,
    }


def read_topic(
    spark: SparkSession, config: TopicConfig, start: Optional[str] = None,
    streaming: bool = False, max_per_trigger: Optional[int] = None,
    reader_options: Optional[Mapping[str, str]] = None,
) -> DataFrame:
    """A topic as a message frame. Needs Spark's Kafka connector on the class path."""
    options = connector_options(config, start, reader_options)
    if streaming and max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if not streaming and options["startingOffsets"] == "latest":
        raise ValueError("a batch read starts at 'earliest'; use start_position or a stream")
    reader = spark.readStream if streaming else spark.read
    return to_messages(reader.format("kafka").options(**options).load())


def read_log(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A table of messages. Column pruning and filters reach the files."""
    reader = spark.read.format(format)
    if format in ("json", "csv"):
        reader = reader.schema(MESSAGE_SCHEMA)
    return check_messages(reader.load(path))


def stream_log(
    spark: SparkSession, path: str, max_per_trigger: Optional[int] = None,
    format: str = "parquet", schema=MESSAGE_SCHEMA, max_bytes: Optional[int] = None,
) -> DataFrame:
    """A growing folder of message files as a stream.

    A micro-batch takes at most ``max_per_trigger`` files, or files of ``max_bytes`` bytes in
    all (at least one file); the source knows one of the two limits. Topics are limited by rows, see
    ``connector_options``.
    """
    if max_per_trigger and max_bytes:
        raise ValueError("give a limit of files or of bytes, not both")
    reader = spark.readStream.format(format).schema(schema)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(path)


def to_messages(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Source columns → message columns.

    Takes Spark's Kafka layout (``value``, header array) as well as message
    columns. Repeated header keys keep their last value.
    """
    payload = F.col("value") if "value" in df.columns and "payload" not in df.columns else F.col("payload")
    headers = F.create_map().cast("map<string,string>")
    if "headers" in df.columns:
        kind = df.schema["headers"].dataType.typeName()
        headers = headers_from_entries(F.col("headers")) if kind == "array" else F.coalesce("headers", headers)
    return df.select(
        F.col("topic").cast("string").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        headers.alias("headers"),
        payload.cast("binary").alias("payload"),
        *keep,
    )


def bounded_read(df: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` messages in log order (per partition, lowest partitions first).

    Planned as a top-k: every task keeps its own first ``limit`` rows.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    return df.orderBy("topic", "partition", "offset").limit(limit)


def read_dlq(df: DataFrame) -> DataFrame:
    """Dead-letter rows (``value``) → typed envelope columns and the original payload.

    With the ``json`` encoding bytes that were not UTF-8 come back as replacement
    characters; ``base64`` is exact.
    """
    e = F.col("_envelope")
    return df.withColumn("_envelope", parse_envelope(F.col("value"))).select(
        *[c for c in df.columns if c != "value"],
        e["originalTopic"].alias("original_topic"),
        e["originalPartition"].alias("original_partition"),
        e["originalOffset"].alias("original_offset"),
        e["attemptCount"].alias("attempt_count"),
        e["error"].alias("error"),
        e["payloadEncoding"].alias("payload_encoding"),
        F.try_to_timestamp(e["timestamp"]).alias("failed_at"),
        decode_payload(e["payload"], e["payloadEncoding"]).alias("payload"),
    )
