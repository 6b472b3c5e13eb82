"""Batches: by count, by count or time, tail, payload arrays, all-or-nothing outcome."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.config import BatchPolicy
from msgflow.operators.joins import checked_join
from msgflow.operators.segments import (
    DEFAULT_SPAN,
    SEGMENT,
    TAG,
    as_start,
    carried,
    chain_ends,
    first_reaching,
    fold_summaries,
    give_back,
    identity_of,
    key_arrays,
    key_fields,
    micros,
    moment_us,
    settled,
    tagged,
    with_position,
    with_segments,
)
from msgflow.schema import LOG_KEY, check_columns

BATCH_ID = "batch_id"


def order_for(by: Sequence[str]) -> list[str]:
    """Log order inside a key: by offset, or by time when a key spans partitions."""
    return ["offset"] if set(LOG_KEY) <= set(by) else ["timestamp", "partition", "offset"]


def in_log_order(df: DataFrame, by: Sequence[str] = LOG_KEY) -> DataFrame:
    """Rows of every key contiguous and in log order, over as many tasks as the data needs.

    Range partitioning cuts inside a hot key too, so no key has to fit one task.
    """
    order = [*by, *order_for(by)]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def batch_by_count(
    df: DataFrame, size: int, by: Sequence[str] = LOG_KEY, span: int = DEFAULT_SPAN,
    dense: bool = False,
) -> DataFrame:
    """Consecutive batches of ``size`` rows per key, numbered from 0.

    ``dense=True`` promises offsets without gaps per (topic, partition): the
    batch then follows from the offset and the key's first offset, without a shuffle.
    """
    BatchPolicy(size=size)
    if dense:
        first = df.groupBy(*by).agg(F.min("offset").alias("_first"))
        return (
            checked_join(df, first, by)
            .withColumn(BATCH_ID, F.expr(f"(offset - _first) div {size}L"))
            .drop("_first")
        )
    placed = with_position(df, by, order_for(by), span, "_position")
    return placed.withColumn(BATCH_ID, F.expr(f"_position div {size}L")).drop("_position")


def _follow(times: np.ndarray, size: int, timeout_us: int) -> np.ndarray:
    """For a batch that starts at row i: the row that starts the next batch (n = none)."""
    n = len(times)
    here = np.arange(n, dtype=np.int64)
    late = first_reaching(times, here + 1, as_start(times) + timeout_us)
    return np.minimum(np.minimum(here + size, late), n)


def _summarise_batches(table: pa.Table, by: Sequence[str], size: int, timeout_us: int) -> dict:
    """What a segment does to any open batch it inherits.

    An inherited batch has room for fewer than ``size`` rows, so the first new
    batch starts at one of the first ``size`` rows, or not at all. For each of
    those entry rows: how many batches start, and the last one's place and time.
    """
    times = micros(table.column("_us"))
    n = len(times)
    entries = min(size, n)
    following = _follow(times, size, timeout_us)
    to_end = np.where(following >= n, np.arange(n), following)
    last = chain_ends(to_end)
    started = np.ones(n, dtype=np.int64)
    # Path lengths by doubling, in step with the chain.
    hop, hops = to_end.copy(), (to_end != np.arange(n)).astype(np.int64)
    while True:
        further = hop[hop]
        if np.array_equal(further, hop):
            break
        hops = hops + hops[hop]
        hop = further
    started = started + hops
    return {
        **key_arrays(table, by),
        "_rows": pa.array([n]),
        "_head": pa.array([np.maximum.accumulate(times[:entries])]),
        "_started": pa.array([started[:entries]]),
        "_tail_rows": pa.array([n - last[:entries]]),
        "_tail_us": pa.array([as_start(times)[last[:entries]]]),
    }


def _inherit_batch(carry, row: dict, size: int, timeout_us: int):
    """Where the first new batch starts in a segment, and the open batch after it."""
    batches, held, first_us = carry
    n, head = row["_rows"], row["_head"]
    if held == 0:
        entry = 0
    else:
        late = int(np.searchsorted(head.to_numpy(), first_us + timeout_us, side="left"))
        entry = min(size - held, late if late < len(head) else n, n)
    inherited = {"_entry": entry, "_batches": batches}
    if entry >= n:
        return inherited, (batches, held + n, first_us)
    return inherited, (
        batches + row["_started"][entry].as_py(),
        row["_tail_rows"][entry].as_py(),
        row["_tail_us"][entry].as_py(),
    )


def _number_batches(times: np.ndarray, entry: int, batches: int, size: int, timeout_us: int) -> np.ndarray:
    n = len(times)
    starts = np.zeros(n, dtype=np.int64)
    following = _follow(times, size, timeout_us)
    at = entry
    while at < n:
        starts[at] = 1
        at = following[at]
    return batches - 1 + np.cumsum(starts)


def assign_batches(
    df: DataFrame, policy: BatchPolicy, by: Sequence[str] = LOG_KEY, span: int = DEFAULT_SPAN,
) -> DataFrame:
    """Greedy batches: a row opens a new one when the open batch is full or timed out.

    Timed out means ``timestamp - first row's timestamp >= timeout``. Greedy
    batching depends on all earlier rows, so it runs as a segment fold: only key,
    order and time columns go through Python; payloads join the result by identity, unless they are so
    short that a segment of them is small (``carried``).
    Every row is in one batch, rows delivered twice as often as they come. A row
    without a time sorts before those with one and never times a batch out.
    """
    by = list(by)
    order = order_for(by)
    size, timeout_us = policy.size, policy.timeout_ms * 1000
    check_columns(df, [*by, *order, "timestamp"], "assign_batches")
    rows = tagged(settled(df), "timestamp")
    slim_columns = list(dict.fromkeys([*by, *order, "timestamp", TAG]))
    more = carried(rows, slim_columns, order, span, [BATCH_ID])
    segmented = with_segments(rows.select(*slim_columns, *(more or [])), order, span, by)
    whole = segmented.withColumn("_us", moment_us())
    slim = whole.drop(*(more or []))
    keys = [*by, SEGMENT]
    sort_keys = [(c if c != "timestamp" else "_us", "ascending") for c in [*order, TAG]]
    identity = identity_of(by, order)

    summary_schema = T.StructType(
        [
            *key_fields(slim, by),
            T.StructField("_rows", T.LongType()),
            T.StructField("_head", T.ArrayType(T.LongType())),
            T.StructField("_started", T.ArrayType(T.LongType())),
            T.StructField("_tail_rows", T.ArrayType(T.LongType())),
            T.StructField("_tail_us", T.ArrayType(T.LongType())),
        ]
    )

    def summarise(table: pa.Table) -> pa.Table:
        return pa.table(_summarise_batches(table.sort_by(sort_keys), by, size, timeout_us))

    inherit_schema = T.StructType(
        [
            *key_fields(slim, by),
            T.StructField("_entry", T.LongType()),
            T.StructField("_batches", T.LongType()),
        ]
    )
    inherited = fold_summaries(
        slim.groupBy(*keys).applyInArrow(summarise, summary_schema),
        by,
        lambda _: (0, 0, 0),
        lambda carry, row: _inherit_batch(carry, row, size, timeout_us),
        inherit_schema,
    )

    given = identity if more is None else df.columns
    numbered_schema = T.StructType(
        [T.StructField(c, whole.schema[c].dataType) for c in given]
        + [T.StructField(BATCH_ID, T.LongType())]
    )

    def number(log: pa.Table, start: pa.Table) -> pa.Table:
        log = log.sort_by(sort_keys)
        ids = _number_batches(
            micros(log.column("_us")), start.column("_entry")[0].as_py(),
            start.column("_batches")[0].as_py(), size, timeout_us,
        )
        return pa.table({**{c: log.column(c) for c in given}, BATCH_ID: ids})

    numbered = (
        whole.groupBy(*keys).cogroup(inherited.groupBy(*keys)).applyInArrow(number, numbered_schema)
    )
    return give_back(rows, numbered, identity) if more is None else numbered


def tail_batch(
    batched: DataFrame, size: int, by: Sequence[str] = LOG_KEY, log: Optional[DataFrame] = None
) -> DataFrame:
    """Mark rows of each key's last batch when it is not full (``is_partial``).

    Nothing is held back at the end of the input: the last batch is delivered as it is.
    For batches by count, give the ``log`` they were made of: the last batch then follows
    from the rows of each key, and the batching runs once.
    """
    if log is not None:
        rows = log.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        partial = rows.filter(F.col("_n") % size != 0).select(*by, F.expr(f"_n div {size}L").alias("_partial"))
    else:
        sizes = batched.groupBy(*by, BATCH_ID).agg(F.count(F.lit(1)).alias("_size"))
        last = sizes.groupBy(*by).agg(F.max(F.struct(BATCH_ID, "_size")).alias("_last"))
        partial = last.filter(F.col("_last._size") < size).select(
            *by, F.col(f"_last.{BATCH_ID}").alias("_partial")
        )
    return (
        checked_join(batched, partial, by)
        .withColumn("is_partial", F.coalesce(F.col(BATCH_ID) == F.col("_partial"), F.lit(False)))
        .drop("_partial")
    )


def batch_payloads(batched: DataFrame, by: Sequence[str] = LOG_KEY) -> DataFrame:
    """One row per batch: payloads in log order. The batch size bounds each array."""
    order = order_for(by)
    entries = F.sort_array(F.collect_list(F.struct(*order, "payload")))
    return batched.groupBy(*by, BATCH_ID).agg(
        F.transform(entries, lambda e: e["payload"]).alias("payloads")
    )


def atomic_batch_outcome(batched: DataFrame, by: Sequence[str] = LOG_KEY) -> DataFrame:
    """One failed row fails its whole batch, with the first error in log order."""
    whole = Window.partitionBy(*by, BATCH_ID)
    failed_order = F.when(~F.col("ok"), F.struct(*order_for(by), "error"))
    return (
        batched.withColumn("_first", F.min(failed_order).over(whole))
        .withColumn("ok", F.col("_first").isNull())
        .withColumn("error", F.col("_first.error"))
        .drop("_first")
    )

