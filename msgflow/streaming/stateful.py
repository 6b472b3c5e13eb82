"""Hold retry messages until they fall due."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from msgflow.functions.headers import retry_time
from msgflow.schema import IDENTITY, LOG_KEY, MESSAGE_SCHEMA

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Offsets of a log partition whose messages, if they fall due together, are held under one key.
BLOCK = 1_024
#: Bytes beyond which a message has a key of its own.
LARGE = 1 << 16

# A held message; headers travel as JSON text.
_OUT = T.StructType(
    [
        *[MESSAGE_SCHEMA[c] for c in IDENTITY],
        T.StructField("timestamp_us", T.LongType()),
        T.StructField("headers_json", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
# What the state keeps: the rows of a key that came together, as one Arrow table.
_HELD = T.StructType([T.StructField("rows", T.BinaryType())])
_KEY = [*LOG_KEY, "due_ms", "block"]


def _pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, to_arrow_schema(_OUT), preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_pandas()


class _Holder(StatefulProcessor):
    """Keeps messages that are not due yet; the timer of their key, their retry time, lets them go."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due_ms = int(key[_KEY.index("due_ms")])
        late = due_ms <= timerValues.getCurrentProcessingTimeInMs()
        for frame in rows:
            frame = frame[_OUT.fieldNames()]
            if late:
                yield frame
            else:
                self.held.appendValue((_pack(frame),))
        if not late:
            self.handle.registerTimer(due_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.held.exists():
            for (packed,) in self.held.get():
                yield _unpack(bytes(packed))
            self.held.clear()

    def close(self) -> None:
        pass


def hold_until_due(retries: DataFrame, prefix: str = "mq.") -> DataFrame:
    """Stream of retry messages → the same messages, each emitted once its retry time has passed.

    Messages due on arrival pass through in the JVM. The others wait in state under a key of
    their log partition, retry time and block of ``BLOCK`` offsets: all rows of a key leave at one
    timer, no key is hot, and a state call is made for each key rather than each message. A message of over
    ``LARGE`` bytes has a key of its own, so a key stays within a few dozen MB. Needs the RocksDB state
    store; state that was keyed by single messages cannot be read.
    """
    due_at = retry_time(F.col("headers"), prefix)
    columns = MESSAGE_SCHEMA.fieldNames()
    now = F.current_timestamp()
    ready = retries.filter(due_at.isNull() | (due_at <= now)).select(*columns)
    held = retries.filter(due_at > now).select(
        *IDENTITY,
        F.unix_micros("timestamp").alias("timestamp_us"),
        F.to_json("headers").alias("headers_json"),
        "payload",
        F.unix_millis(due_at).alias("due_ms"),
    )
    size = F.coalesce(F.octet_length("payload"), F.lit(0)) + F.coalesce(F.octet_length("headers_json"), F.lit(0))
    # Numbers below 0 are those of single large messages.
    block = F.when(size > LARGE, -1 - F.col("offset")).otherwise(F.expr(f"offset div {BLOCK}L"))
    waiting = held.withColumn("block", block)
    released = waiting.groupBy(*_KEY).transformWithStateInPandas(
        statefulProcessor=_Holder(), outputStructType=_OUT, outputMode="Append",
        timeMode="ProcessingTime",
    )
    return ready.unionByName(
        released.select(
            *IDENTITY,
            F.timestamp_micros("timestamp_us").alias("timestamp"),
            F.from_json("headers_json", MESSAGE_SCHEMA["headers"].dataType).alias("headers"),
            "payload",
        )
    )
