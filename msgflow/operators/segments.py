"""Ordered operators that do not need a whole log partition in one task.

A log partition may hold a third of all rows, so ``Window.partitionBy(topic,
partition)`` would put that third into one task. Offsets are unique inside a log
partition, so cutting it at every ``span`` offsets gives segments of at most
``span`` rows. Each ordered operator then works in three steps:

1. summarise every segment on its own (parallel, narrow columns),
2. run over the summaries of one key in order - a table ``span`` times smaller
   than the data - to find what each segment inherits from those before it,
3. finish every segment with what it inherits (parallel).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.session import materialize

DEFAULT_SPAN = 1 << 20
SEGMENT = "_segment"
TAG = "_tag"
#: Microseconds of a row without a time: before all times as a moment, after them as a start.
#: So such a row sorts first among times, and a gap to or from it is never long enough.
NO_TIME, NEVER = -(1 << 60), 1 << 60
#: Bytes that the other columns of a segment may have to go through Python with its order columns.
CARRIED_BYTES = 128 << 20


def settled(df: DataFrame) -> DataFrame:
    """``df`` itself, or a table of it when its plan may give other rows the next time.

    A Python handler runs once per row this way, however often an operator reads its outcomes.
    """
    plan = df._jdf.queryExecution().withCachedData()
    return df if plan.deterministic() or df.isStreaming else materialize(df)


def tagged(df: DataFrame, *decisive: str) -> DataFrame:
    """Add ``_tag``, a hash of the nullable columns that an operator's result depends on."""
    return df.withColumn(TAG, F.xxhash64(*[c for c in decisive if c in df.columns], F.lit(0)))


def identity_of(by: Sequence[str], order: Sequence[str]) -> list[str]:
    """Columns that place a row, without those that may be null, and its tag."""
    return [*(c for c in dict.fromkeys([*by, *order]) if c != "timestamp"), TAG]


def give_back(df: DataFrame, results: DataFrame, identity: Sequence[str]) -> DataFrame:
    """The rows of tagged ``df`` with what ``results`` (one row for each of them) adds.

    Rows that share the whole identity (repeated deliveries) are numbered on both sides. They
    are alike in all that the results depend on, so any pairing is right, and no row is lost or
    multiplied. The windows use the join's own partitioning and order.
    """
    number = F.row_number().over(Window.partitionBy(*identity).orderBy(F.lit(1)))
    rows, results = df.withColumn("_copy", number), results.withColumn("_copy", number)
    added = [c for c in results.columns if c not in rows.columns]
    return results.select(*identity, "_copy", *added).join(rows, [*identity, "_copy"]).select(
        *[c for c in df.columns if c != TAG], *added
    )


def carried(
    df: DataFrame, narrow: Sequence[str], order: Sequence[str], span: int, added: Sequence[str],
) -> Optional[list[str]]:
    """Columns of ``df`` besides ``narrow`` that go through Python with them; None where they join the results.

    They go along if ``span`` of the longest rows stay within ``CARRIED_BYTES``: then a segment stays
    small whatever it holds, and rows are not moved and sorted a second time. Nested columns, and frames that have
    a column which the operator adds, join.
    """
    others = [c for c in df.columns if c not in narrow]
    kinds = [df.schema[c].dataType for c in others]
    sized = (T.StringType, T.BinaryType)
    fixed = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType)
    if not _offset_like(df, order) or set(added) & set(df.columns) or not all(isinstance(k, sized + fixed) for k in kinds):
        return None
    width = F.lit(8 * len(others))
    for c, kind in zip(others, kinds):
        if isinstance(kind, sized):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
    longest = df.agg(F.max(width)).first()[0] or 0
    return others if longest * span <= CARRIED_BYTES else None


def moment_us(column: str = "timestamp") -> Column:
    """Microseconds of a time column, ``NO_TIME`` where it is null."""
    return F.coalesce(F.unix_micros(column), F.lit(NO_TIME))


def as_start(us: np.ndarray) -> np.ndarray:
    """Times as the start of a wait: without a time the wait does not end."""
    return np.where(us <= NO_TIME, NEVER, us)


def with_segments(
    df: DataFrame, order: Sequence[str] = ("offset",), span: int = DEFAULT_SPAN,
    by: Sequence[str] = ("topic", "partition"),
) -> DataFrame:
    """Add ``_segment``: numbered ranges of ``order`` inside each key ``by``.

    One integral order column that is unique per key gives ranges of ``span``
    values, decided row by row. Any other order is split by Spark's range
    partitioner on (by, order) into ranges of about ``span`` rows, whose sampled
    bounds also cut a hot key; the frame is materialised once so that every later
    step sees the same cut.
    """
    if span <= 0:
        raise ValueError("span must be positive")
    if _offset_like(df, order):
        return df.withColumn(SEGMENT, F.expr(f"`{order[0]}` div {span}L"))
    ranges = -(-df.count() // span) or 1
    ranged = df.repartitionByRange(ranges, *by, *order)
    return materialize(ranged.withColumn(SEGMENT, F.spark_partition_id().cast("bigint")))


def _offset_like(df: DataFrame, order: Sequence[str]) -> bool:
    return len(order) == 1 and isinstance(
        df.schema[order[0]].dataType, (T.LongType, T.IntegerType, T.ShortType)
    )


def in_segment(by: Sequence[str], order: Sequence[str] = ("offset",)) -> WindowSpec:
    """Window over one segment, in log order."""
    return Window.partitionBy(*by, SEGMENT).orderBy(*order)


def earlier_segments(by: Sequence[str]) -> WindowSpec:
    """Window over the summaries of all segments before the current one."""
    return (
        Window.partitionBy(*by)
        .orderBy(SEGMENT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )


def segment_rows(segmented: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """Rows per segment (partially aggregated before the shuffle) and rows before it."""
    counts = segmented.groupBy(*by, SEGMENT).agg(F.count(F.lit(1)).alias("_rows"), *extra)
    before = F.sum("_rows").over(earlier_segments(by))
    return counts.withColumn("_base", F.coalesce(before, F.lit(0)).cast("bigint"))


def with_position(
    df: DataFrame, by: Sequence[str] = ("topic", "partition"),
    order: Sequence[str] = ("offset",), span: int = DEFAULT_SPAN, name: str = "position",
) -> DataFrame:
    """0-based rank of each row in its key: rows in earlier segments + rank inside its own."""
    if not _offset_like(df, order):
        # Only the identity is cut into ranges and materialised; payloads join it.
        rows = tagged(settled(df), "timestamp")
        slim = rows.select(*dict.fromkeys([*by, *order, TAG]))
        placed = _positions(slim, by, [*order, TAG], span, name)
        return give_back(rows, placed, identity_of(by, order))
    return _positions(df, by, order, span, name)


def _positions(
    df: DataFrame, by: Sequence[str], order: Sequence[str], span: int, name: str
) -> DataFrame:
    segmented = with_segments(df, order, span, by)
    base = segment_rows(segmented.select(*by, SEGMENT), by).drop("_rows")
    rank = F.row_number().over(in_segment(by, order)).cast("bigint")
    return (
        segmented.join(base, [*by, SEGMENT])
        .withColumn(name, F.col("_base") + rank - 1)
        .drop("_base", SEGMENT)
    )


# --------------------------------------------------------------------------
# Folds whose carry is not a sum or a maximum (greedy batches, breaker state).
# --------------------------------------------------------------------------


def key_runs(table: pa.Table | pa.RecordBatch, by: Sequence[str]) -> Iterator[tuple[tuple, int, int]]:
    """(key, start, end) of consecutive rows with one key."""
    keys = list(zip(*(table.column(c).to_pylist() for c in by)))
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield keys[start], start, i
            start = i


def fold_summaries(
    summaries: DataFrame,
    by: Sequence[str],
    initial: Callable[[dict], object],
    advance: Callable[[object, dict], tuple[dict, object]],
    out_schema: T.StructType,
) -> DataFrame:
    """Run over each key's segment summaries in order, with one carry per key.

    ``initial(first summary)`` starts a key; ``advance(carry, summary)`` returns
    what the segment inherits and the carry after it. Arrays of a summary stay
    Arrow arrays: a fold looks up a few of their entries.
    """
    by = list(by)
    fields = [f for f in out_schema.fieldNames() if f not in (*by, SEGMENT)]
    arrow_schema = _arrow_schema(out_schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carry = None, None
        for batch in batches:
            out = []
            for row in _summary_rows(batch):
                row_key = tuple(row[c] for c in by)
                if row_key != key:
                    key, carry = row_key, initial(row)
                inherited, carry = advance(carry, row)
                out.append(
                    {
                        **dict(zip(by, row_key)),
                        SEGMENT: row[SEGMENT],
                        **{f: inherited[f] for f in fields},
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=arrow_schema)

    return (
        summaries.repartition(*by)
        .sortWithinPartitions(*by, SEGMENT)
        .mapInArrow(fold, out_schema)
    )


def _summary_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    lists = {f.name for f in batch.schema if pa.types.is_list(f.type)}
    for i in range(batch.num_rows):
        yield {
            name: batch.column(name)[i].values if name in lists else batch.column(name)[i].as_py()
            for name in batch.schema.names
        }


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def key_fields(df: DataFrame, by: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(c, df.schema[c].dataType, True) for c in by] + [
        T.StructField(SEGMENT, T.LongType(), True)
    ]


def key_arrays(table: pa.Table, by: Sequence[str]) -> dict[str, pa.Array]:
    """The (constant) key columns of one segment, one row."""
    return {c: table.column(c).slice(0, 1) for c in (*by, SEGMENT)}


def micros(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False)


def first_reaching(values: np.ndarray, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """For every i: the first position >= start[i] whose value is >= bound[i], else len(values)."""
    n = len(values)
    start = np.asarray(start, dtype=np.int64)
    if n == 0:
        return np.zeros_like(start)
    if n == 1 or bool(np.all(values[1:] >= values[:-1])):
        return np.maximum(np.searchsorted(values, bound, side="left"), start)
    # Not sorted: skip blocks of 2^k values whose maximum stays below the bound.
    levels = [values]
    while (1 << len(levels)) <= n:
        half = 1 << (len(levels) - 1)
        last = levels[-1]
        levels.append(np.maximum(last[:-half], last[half:]))
    at = start.copy()
    for k in range(len(levels) - 1, -1, -1):
        level, width = levels[k], 1 << k
        inside = at + width <= n
        skip = inside & (level[np.where(inside, at, 0)] < bound)
        at = np.where(skip, at + width, at)
    return at


def chain_ends(following: np.ndarray) -> np.ndarray:
    """For a forward-only chain (following[i] > i, or i itself at an end): its last node."""
    last = following
    while True:
        further = last[last]
        if np.array_equal(further, last):
            return last
        last = further


def pick_span(df: DataFrame, order: str = "offset") -> int:
    """Offsets per segment for ``df``: four segments per core, at most ``DEFAULT_SPAN``."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    if low is None:
        return DEFAULT_SPAN
    wanted = 4 * df.sparkSession.sparkContext.defaultParallelism
    return max(1024, min(DEFAULT_SPAN, (high - low) // wanted + 1))
