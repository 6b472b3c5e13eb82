"""Delivery audits: tallies, duplicates, losses, lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.functions.headers import (
    DEFAULT_PREFIX,
    INTEGER_PATTERN,
    ORIGINAL_OFFSET,
    ORIGINAL_PARTITION,
    ORIGINAL_TOPIC,
    header,
)
from msgflow.operators.joins import HOT_ROWS, salted_join
from msgflow.schema import IDENTITY


def outcome_summary(df: DataFrame, by: Sequence[str] = ("topic",)) -> DataFrame:
    """Handled, failed and total rows per ``by`` (add ``route`` to see where failures went)."""
    return df.groupBy(*by).agg(
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def duplicate_deliveries(received: DataFrame, on: Sequence[str] = IDENTITY) -> DataFrame:
    """Identities delivered more than once. Copies merge on the map side, so a hot one is cheap."""
    return (
        received.groupBy(*on).agg(F.count(F.lit(1)).alias("deliveries"))
        .filter(F.col("deliveries") > 1)
    )


def missing_messages(
    produced: DataFrame, received: DataFrame, on: Sequence[str] = IDENTITY
) -> DataFrame:
    """Produced rows never received; empty for at-least-once delivery.

    The received side is reduced to distinct identities first (partially before
    the shuffle), so many copies of one message do not gather in one task.
    """
    return produced.join(received.select(*on).distinct(), list(on), "left_anti")


def failure_lineage(
    failed: DataFrame, source: DataFrame, prefix: str = DEFAULT_PREFIX, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Retry or dead-letter rows (``headers``) with the source message they come from.

    Needs headers built with ``origin="first"`` when rows took several hops. One
    source message may have any number of failed rows, hence the salted join.
    """

    def integer(name: str, sql_type: str):
        text = header(F.col("headers"), name, prefix)
        return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(sql_type))

    keyed = (
        failed.withColumn("_topic", header(F.col("headers"), ORIGINAL_TOPIC, prefix))
        .withColumn("_partition", integer(ORIGINAL_PARTITION, "int"))
        .withColumn("_offset", integer(ORIGINAL_OFFSET, "bigint"))
    )
    keys = ["_topic", "_partition", "_offset"]
    messages = source.select(
        *[F.col(c).alias(k) for c, k in zip(IDENTITY, keys)],
        F.col("timestamp").alias("source_timestamp"),
        F.col("payload").alias("source_payload"),
    )
    joined = salted_join(keyed, messages, keys, "inner", hot_rows=hot_rows)
    return (
        joined.withColumnRenamed("_topic", "source_topic")
        .withColumnRenamed("_partition", "source_partition")
        .withColumnRenamed("_offset", "source_offset")
    )
