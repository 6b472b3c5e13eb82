"""Run a handler over messages: outcome columns, captured exceptions, batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Optional, Union

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.functions.headers import DEFAULT_PREFIX, RETRY_STEP
from msgflow.operators.batching import BATCH_ID, order_for
from msgflow.operators.segments import settled
from msgflow.schema import IDENTITY, LOG_KEY, MESSAGE_SCHEMA, check_columns

# Fixed value: how a captured exception is reported.
PANIC_PREFIX = "handler panic: "

OUTCOME_TYPE = "struct<ok:boolean,error:string,next_step:int>"
_OUTCOME_ARROW = pa.struct(
    [("ok", pa.bool_()), ("error", pa.string()), ("next_step", pa.int32())]
)


_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Message:
    """What a Python handler receives. Time and headers are decoded when first read."""

    __slots__ = ("topic", "partition", "offset", "payload", "_us", "_keys", "_values", "_headers")

    def __init__(self, topic, partition, offset, us, keys, values, payload):
        self.topic, self.partition, self.offset, self.payload = topic, partition, offset, payload
        self._us, self._keys, self._values, self._headers = us, keys, values, None

    @property
    def timestamp(self) -> Optional[dt.datetime]:
        """Message time, in UTC."""
        return None if self._us is None else _EPOCH + dt.timedelta(microseconds=self._us)

    @property
    def headers(self) -> dict[str, str]:
        if self._headers is None:
            self._headers = dict(zip(self._keys, self._values))
        return self._headers

    def retry_step(self, prefix: str = DEFAULT_PREFIX) -> int:
        """Step to resume at, 0 when the header is absent or unreadable."""
        text = self.headers.get(prefix + RETRY_STEP) or ""
        digits = text[1:] if text[:1] in ("+", "-") else text
        if not (digits.isascii() and digits.isdigit()):
            return 0
        step = int(text)
        return step if -(2**31) <= step < 2**31 else 0


class HandlerFailure(Exception):
    """Raise to fail a message with a plain error, and maybe the step to resume at."""

    def __init__(self, message: str, next_step: Optional[int] = None):
        super().__init__(message)
        self.next_step = next_step


@dataclass(frozen=True)
class ColumnHandler:
    """Handler as Catalyst expressions: fails with ``text`` where ``failed`` holds."""

    failed: Column
    text: Column
    next_step: Optional[Column] = None

    def error(self) -> Column:
        return F.when(self.failed, F.coalesce(self.text, F.lit("")))

    def ok(self) -> Column:
        # In this form a filter on failures is pushed down into the scan.
        return self.failed.isNull() | ~self.failed


@dataclass(frozen=True)
class PayloadHandler:
    """Python handler that reads the payload only: no other column travels to Python."""

    call: Callable[[Optional[bytes]], Any]


Handler = Union[ColumnHandler, PayloadHandler, Callable[[Message], Any]]
BatchHandler = Callable[[list], Any]


def column_handler(
    failed: Column, text: Column, next_step: Optional[Column] = None
) -> ColumnHandler:
    """Handler that fails with ``text`` where ``failed`` holds (NULL counts as success)."""
    return ColumnHandler(failed, text, next_step)


def _call_each(call: Callable[[Any], Any], arguments: Iterable) -> pa.Array:
    """Outcome of every call; an exception fails its own row only."""
    ok, errors, steps = [], [], []
    for argument in arguments:
        error, step = None, None
        try:
            result = call(argument)
            if result is not None:
                error = str(result)
        except HandlerFailure as failure:
            error, step = str(failure), failure.next_step
        except Exception as crash:  # noqa: BLE001 - one bad message must not stop the task
            error = f"{PANIC_PREFIX}{crash}"
        ok.append(error is None)
        errors.append(error)
        steps.append(step)
    return pa.StructArray.from_arrays(
        [pa.array(ok, pa.bool_()), pa.array(errors, pa.string()), pa.array(steps, pa.int32())],
        fields=list(_OUTCOME_ARROW),
    )


def _values(array: pa.Array) -> list:
    """Python values of an array; by way of numpy, much faster than element by element."""
    if array.null_count and not (pa.types.is_string(array.type) or pa.types.is_binary(array.type)):
        return array.to_pylist()
    return array.to_numpy(zero_copy_only=False).tolist()


def _list_slices(array: pa.Array, *children: pa.Array) -> Iterator[tuple[list, ...]]:
    """Entries of each row of a list or map array, from children decoded in one go."""
    decoded = [_values(c) for c in children]
    ends = _values(array.offsets)
    for start, end in zip(ends, ends[1:]):
        yield tuple(values[start:end] for values in decoded)


def _messages(
    topic: pa.Array, partition: pa.Array, offset: pa.Array, timestamp: pa.Array,
    headers: pa.Array, payload: pa.Array,
) -> Iterator[Message]:
    rows = zip(
        _values(topic), _values(partition), _values(offset), _values(timestamp.cast(pa.int64())),
        _list_slices(headers, headers.keys, headers.items), _values(payload),
    )
    for t, p, o, us, (keys, values), body in rows:
        yield Message(t, p, o, us, keys, values, body)


def _once(run: Callable[..., pa.Array]) -> Callable[..., Column]:
    """Arrow UDF the optimizer must not copy: a filter on ``ok`` would else run it again."""
    return F.arrow_udf(run, OUTCOME_TYPE).asNondeterministic()


def _python_outcome(handler: PayloadHandler | Callable[[Message], Any]) -> Column:
    """Arrow UDF: only the columns the handler reads travel to Python."""
    if isinstance(handler, PayloadHandler):
        call = handler.call

        def run_payload(payload: pa.Array) -> pa.Array:
            return _call_each(call, _values(payload))

        return _once(run_payload)("payload")

    def run(
        topic: pa.Array, partition: pa.Array, offset: pa.Array, timestamp: pa.Array,
        headers: pa.Array, payload: pa.Array,
    ) -> pa.Array:
        return _call_each(
            handler, _messages(topic, partition, offset, timestamp, headers, payload)
        )

    return _once(run)(*(F.col(c) for c in MESSAGE_SCHEMA.fieldNames()))


def spread(df: DataFrame, by: Sequence[str] = IDENTITY) -> DataFrame:
    """Use all cores for a Python handler when the input has fewer partitions than cores.

    A large input already has more partitions than cores and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *by)


def apply_handler(df: DataFrame, handler: Handler) -> DataFrame:
    """Add ``ok BOOLEAN, error STRING, next_step INT``.

    A ``ColumnHandler`` stays in whole-stage codegen. A Python callable gets a
    ``Message``; returning None is success, any other value or a raised
    ``HandlerFailure`` is a failure, and any other exception is reported as a panic
    without stopping the rest. Filter before this call: Catalyst cannot push a
    predicate through a Python handler.
    """
    if isinstance(handler, ColumnHandler):
        step = F.lit(None) if handler.next_step is None else handler.next_step
        return (
            df.withColumn("error", handler.error())
            .withColumn("ok", handler.ok())
            .withColumn("next_step", step.cast("int"))
        )
    payload_only = isinstance(handler, PayloadHandler)
    if not payload_only and not callable(handler):
        raise ValueError("handler cannot be nil")
    read = ["payload"] if payload_only else MESSAGE_SCHEMA.fieldNames()
    check_columns(df, read, "a Python handler")
    return (
        df.withColumn("_outcome", _python_outcome(handler))
        .withColumn("error", F.col("_outcome.error"))
        .withColumn("ok", F.col("_outcome.ok"))
        .withColumn("next_step", F.col("_outcome.next_step"))
        .drop("_outcome")
    )


def panics_of(attempt: Column, *inputs: Column) -> Column:
    """Where an expression would have raised: its ``try_`` form gave NULL, though its inputs are there.

    Write a native handler's casts, divisions and lookups as ``try_`` expressions and give
    the result to ``capture_panic``; a plain one would end the whole job instead of the row.
    """
    raised = attempt.isNull()
    for column in inputs:
        raised = raised & column.isNotNull()
    return raised


def capture_panic(df: DataFrame, panics: Column, text: Column) -> DataFrame:
    """Turn rows whose native handler would raise into failed rows; others are kept."""
    return (
        df.withColumn(
            "error",
            F.when(panics, F.concat(F.lit(PANIC_PREFIX), text)).otherwise(F.col("error")),
        )
        .withColumn("ok", F.col("error").isNull())
    )


def split_outcomes(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(succeeded, failed). Outcomes of a Python handler are written once, so it runs once per row."""
    outcomes = settled(outcomes)
    return outcomes.filter(F.col("ok")), outcomes.filter(~F.col("ok"))


def apply_batch_handler(
    batched: DataFrame, handler: BatchHandler, by: Sequence[str] = LOG_KEY
) -> DataFrame:
    """Call ``handler(payloads)`` once per batch; its outcome goes to every row of the batch.

    Rows of a batch are gathered into one row (the batch size bounds it), so Python
    sees a stream of batches, many per Arrow record batch, and rows are unpacked
    again without a join.
    """
    if not callable(handler):
        raise ValueError("batch handler cannot be nil")
    by, order = list(by), order_for(by)
    rest = [c for c in batched.columns if c not in (*by, *order, BATCH_ID)]
    maps = {c for c in rest if batched.schema[c].dataType.typeName() == "map"}
    # Maps cannot be compared, so they travel as entries while the rows are sorted.
    packed = F.struct(*(F.map_entries(c).alias(c) if c in maps else F.col(c) for c in rest))
    rows = F.sort_array(F.collect_list(F.struct(*order, packed.alias("_rest"))))

    def run(payloads: pa.Array) -> pa.Array:
        batches = (batch for (batch,) in _list_slices(payloads, payloads.values))
        return _call_each(handler, batches)

    payloads = F.transform("_rows", lambda r: r["_rest"]["payload"])

    def unpack(c: str) -> Column:
        value = F.col(f"_row._rest.{c}")
        return (F.map_from_entries(value) if c in maps else value).alias(c)

    return (
        batched.groupBy(*by, BATCH_ID).agg(rows.alias("_rows"))
        .withColumn("_outcome", _once(run)(payloads))
        .select(*by, BATCH_ID, "_outcome", F.explode("_rows").alias("_row"))
        .select(
            *by, BATCH_ID,
            *[F.col(f"_row.{c}").alias(c) for c in order if c not in by],
            *[unpack(c) for c in rest],
            F.col("_outcome.ok").alias("ok"),
            F.col("_outcome.error").alias("error"),
        )
    )
