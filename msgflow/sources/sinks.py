"""Write retry and dead-letter rows."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.config import TopicConfig, check_kafka_options
from msgflow.schema import PRODUCED_SCHEMA, check_columns

# Fixed value: a write counts only when every replica has it.
PRODUCER_DEFAULTS = {"kafka.acks": "all"}
BATCH_FOLDER = "micro_batch"
# Client settings that only a consumer has.
READER_ONLY = (
    "auto.offset.reset", "fetch.min.bytes", "fetch.max.bytes", "max.poll.records",
    "session.timeout.ms", "heartbeat.interval.ms", "max.poll.interval.ms", "isolation.level",
)


def sink_options(config: TopicConfig) -> dict[str, str]:
    """Writer options of Spark's Kafka sink; the topic is a column of the rows.

    The user's connection settings (security and the like) go to the sink as to the source;
    those of reading do not.
    """
    user = {k: v for k, v in check_kafka_options(config.kafka_options).items() if k not in READER_ONLY}
    return {
        "kafka.bootstrap.servers": ",".join(config.brokers), **PRODUCER_DEFAULTS,
        **{f"kafka.{k}": v for k, v in user.items()},
    }


def kafka_rows(df: DataFrame) -> DataFrame:
    """Produced rows in the layout of Spark's Kafka sink (headers as an array)."""
    check_columns(df, PRODUCED_SCHEMA.fieldNames(), "a sink")
    entries = F.transform(
        F.map_entries("headers"),
        lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")),
    )
    return df.select("key", "value", entries.alias("headers"), "topic")


def write_topic(df: DataFrame, config: TopicConfig) -> None:
    """Produced rows to their topics. A failed delivery fails the task."""
    kafka_rows(df).write.format("kafka").options(**sink_options(config)).save()


def write_rows(df: DataFrame, path: str, batch_id: Optional[int] = None) -> None:
    """Rows to a table of files.

    With ``batch_id`` the rows go to a folder of their own that a replay of the
    same micro-batch overwrites, so a replay does not duplicate them.
    """
    if batch_id is None:
        df.write.mode("append").parquet(path)
    else:
        df.write.mode("overwrite").parquet(f"{path}/{BATCH_FOLDER}={batch_id}")


def write_retry(
    df: DataFrame, target: "str | TopicConfig", batch_id: Optional[int] = None
) -> None:
    """Retry rows (NULL key, unchanged payload, nine headers) to a topic or a folder."""
    _write(df, target, batch_id)


def write_dlq(df: DataFrame, target: "str | TopicConfig", batch_id: Optional[int] = None) -> None:
    """Dead letters (JSON envelope, seven headers) to a topic or a folder."""
    _write(df, target, batch_id)


def _write(df: DataFrame, target: "str | TopicConfig", batch_id: Optional[int]) -> None:
    if isinstance(target, TopicConfig):
        write_topic(df, target)
    else:
        write_rows(df, target, batch_id)
