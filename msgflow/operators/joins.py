"""Joins that stay correct and balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.session import materialize, planned_bytes

#: A frame may be broadcast only when it was counted and has at most this many rows, and its files this many bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
#: Keys with more rows than this are split over several tasks.
HOT_ROWS = 1_000_000
SALTS = 64
#: Rows of a key with just ``hot_rows`` that the sample for hot keys holds on average.
SAMPLED = 400
#: Hot keys up to which their table is broadcast.
FEW_KEYS = 10_000


def checked_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS, computed: bool = False,
) -> DataFrame:
    """Join ``big`` to a ``small`` frame that has one row per key (positions, cuts).

    ``small`` is computed once and counted. Up to ``broadcast_rows`` rows, in files of
    at most ``BROADCAST_BYTES`` bytes, it is broadcast and ``big`` is not shuffled; beyond
    that the join is salted. A frame that is a table already (``computed``) is not written again.
    """
    if not computed:
        small = materialize(small)
    if planned_bytes(small) <= BROADCAST_BYTES and small.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return big.join(F.broadcast(small), list(on), how)
    return salted_join(big, small, on, how, hot_rows=hot_rows)


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys that hold about ``hot_rows`` rows of ``df`` or more, from a sample of its rows.

    One row in ``hot_rows / SAMPLED`` is counted, so hardly any key moves; a key with ``hot_rows`` rows
    has 400 of them there, and is missed if under half of these turn up. The keys only decide what is spread: a join is
    whole either way.
    """
    rate = min(1.0, SAMPLED / hot_rows)
    some = df.select(*on) if rate >= 1 else df.select(*on).sample(rate, seed=17)
    least = hot_rows if rate >= 1 else SAMPLED // 2
    return some.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > least).select(*on)


def salted_join(
    big: DataFrame, unique: DataFrame, on: Sequence[str], how: str = "left",
    hot_rows: int = HOT_ROWS, salts: int = SALTS,
) -> DataFrame:
    """Equi-join of ``big`` to a frame with one row per key, hot keys spread over ``salts`` tasks.

    Hot keys of ``big`` come from a sample. There are at most 2 * rows / ``hot_rows``; only their
    rows on the unique side are repeated, and only their rows in ``big`` get a salt.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError("salted_join keeps the big side: use inner, left, left_semi or left_anti")
    on = list(on)
    if big.count() <= hot_rows:
        return big.join(unique, on, how)  # no key can be hot; a count reads no column
    hot = hot_keys(big, on, hot_rows).withColumn("_hot", F.lit(True))
    found = hot.limit(FEW_KEYS + 1).collect()
    if not found:
        return big.join(unique, on, how)
    if len(found) <= FEW_KEYS:
        hot = F.broadcast(big.sparkSession.createDataFrame(found, hot.schema))
    else:
        hot = materialize(hot)
    # The salt comes from the row and its map task, both stable when a lost task is
    # recomputed (a random salt is not); the task number spreads exact copies.
    other = [c for c in big.columns if big.schema[c].dataType.typeName() != "map"]
    spread = F.pmod(F.xxhash64(*other) + F.spark_partition_id(), F.lit(salts)).cast("int")
    salted = (
        big.join(hot, on, "left")
        .withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0)))
        .drop("_hot")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    repeated = (
        unique.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
