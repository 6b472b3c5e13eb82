"""Message logs derived from the given tables (rules in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.functions.headers import ORIGINAL_TOPIC, RETRY_ATTEMPT, RETRY_TIME, format_time

PREFIX = "mq."
PARTITIONS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(events: DataFrame) -> DataFrame:
    """``events`` as a message log.

    The event id is the offset: unique and rising inside a partition, with gaps,
    as in a compacted topic. Nothing is shuffled to build the log.
    """
    case = F.col("event_id") % 5
    due = F.col("ts").cast("timestamp") + F.make_interval(mins=(F.col("event_id") % 120).cast("int"))
    attempt = (
        F.when(case == 1, "1").when(case == 2, "2").when(case == 3, "abc").when(case == 4, "7")
    )
    kind = [F.lit("event-type"), F.col("event_type")]
    tried = [F.lit(PREFIX + RETRY_ATTEMPT), attempt]
    hopped = [
        F.lit(PREFIX + ORIGINAL_TOPIC), F.lit("events.src"),
        F.lit(PREFIX + RETRY_TIME), format_time(due),
    ]
    headers = (
        F.when(case.isin(1, 2), F.create_map(*kind, *tried, *hopped))
        .when(case > 0, F.create_map(*kind, *tried))
        .otherwise(F.create_map(*kind))
    )
    return events.select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        headers.alias("headers"),
        F.when(F.col("event_id") % 50 == 0, F.unhex(F.lit("00FFFE")))
        .otherwise(F.encode("props", "UTF-8")).alias("payload"),
        "event_type",
        "value",
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message log of the ``events`` table, with two decoded columns handlers may read."""
    return event_messages(table(spark, sf_dir, "events"))


def redelivered(log: DataFrame) -> DataFrame:
    """The log with a second copy of every tenth message, as after a crash before the commit."""
    return log.unionByName(log.filter(F.col("offset") % 10 == 0))


def document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message log of the ``documents`` table: whole texts as payloads."""
    return table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("topic"),
        (F.col("doc_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("headers"),
        F.encode("text", "UTF-8").alias("payload"),
    )
