"""The message data model: one row per message, opaque payload, string headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("payload", T.BinaryType(), True),
    ]
)

# What a sink (retry topic, dead-letter topic) takes.
PRODUCED_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("topic", T.StringType(), False),
    ]
)

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("next_offset", T.LongType(), False),
    ]
)

#: Identity of a message, and the key inside which offsets are ordered.
IDENTITY = ["topic", "partition", "offset"]
LOG_KEY = ["topic", "partition"]


def check_columns(df: DataFrame, required: list[str], what: str) -> DataFrame:
    """Fail at plan time, before any job, when ``df`` lacks a required column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} needs the columns {missing}; got {df.columns}")
    return df


def check_messages(df: DataFrame) -> DataFrame:
    """``df`` must carry every column of ``MESSAGE_SCHEMA`` with its type."""
    check_columns(df, MESSAGE_SCHEMA.fieldNames(), "a message frame")
    for field in MESSAGE_SCHEMA:
        actual = df.schema[field.name].dataType
        if actual.simpleString() != field.dataType.simpleString():
            raise ValueError(
                f"message column {field.name} must be {field.dataType.simpleString()}, "
                f"got {actual.simpleString()}"
            )
    return df
