"""Committed positions: high water, resume, start position, dedupe of routes."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.operators.joins import BROADCAST_ROWS, checked_join
from msgflow.schema import LOG_KEY, check_columns
from msgflow.session import materialize

#: With up to so many positions, each becomes a literal filter of the scan.
PUSHED_BOUNDS = 64


def commit_positions(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``next_offset`` = highest offset + 1 per (topic, partition), and per ``by`` if given.

    One maximum per key: partial aggregation leaves one row per key and map task
    for the shuffle, however uneven the partitions are.
    """
    keys = list(dict.fromkeys([*LOG_KEY, *by]))
    return df.groupBy(*keys).agg((F.max("offset") + 1).alias("next_offset"))


def skip_ranges(
    df: DataFrame, bounds: DataFrame, bound: str, after: bool = False, most: int = PUSHED_BOUNDS
) -> DataFrame:
    """Filter ``df`` by literal bounds, so that scans can leave out files and row groups.

    Drops rows before (``after``: behind) the ``bound`` of their partition. With more than
    ``most`` bounds the frame is left as it is: the caller's join filters all the same.
    """
    rows = bounds.limit(most + 1).collect()
    if len(rows) > most:
        return df
    for row in rows:
        beyond = F.col("offset") > row[bound] if after else F.col("offset") < row[bound]
        here = [F.col(c) == row[c] for c in LOG_KEY]
        df = df.filter(~(here[0] & here[1] & beyond))
    return df


def latest_commits(commits: DataFrame) -> DataFrame:
    """Furthest position per (topic, partition) of a table of commit records."""
    return commits.groupBy(*LOG_KEY).agg(F.max("next_offset").alias("next_offset"))


def start_position(
    df: DataFrame, start: str = "earliest", known: Optional[DataFrame] = None
) -> DataFrame:
    """Rows a group without a committed position reads.

    ``earliest``: all. ``latest``: only rows past ``known``, the end positions
    (``next_offset``) of the log when the group started.
    """
    if start == "earliest":
        return df
    if start != "latest":
        raise ValueError("start must be 'earliest' or 'latest'")
    if known is None:
        raise ValueError("start='latest' needs the end positions at the start")
    ends = materialize(latest_commits(known).withColumnRenamed("next_offset", "_end"))
    return (
        checked_join(skip_ranges(df, ends, "_end"), ends, LOG_KEY, computed=True)
        .filter(F.col("_end").isNull() | (F.col("offset") >= F.col("_end")))
        .drop("_end")
    )


def resume_from(
    df: DataFrame, commits: DataFrame, start: str = "earliest",
    known: Optional[DataFrame] = None, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows at or after the group's committed position; other partitions start per ``start``."""
    check_columns(commits, [*LOG_KEY, "next_offset"], "commits")
    if start not in ("earliest", "latest"):
        raise ValueError("start must be 'earliest' or 'latest'")
    positions = latest_commits(commits).withColumnRenamed("next_offset", "_from")
    if start == "latest":
        if known is None:
            raise ValueError("start='latest' needs the end positions at the start")
        ends = latest_commits(known).withColumnRenamed("next_offset", "_end")
        positions = positions.join(ends, LOG_KEY, "full").select(
            *LOG_KEY, F.coalesce("_from", "_end").alias("_from")
        )
    positions = materialize(positions.filter("_from IS NOT NULL"))
    return (
        checked_join(
            skip_ranges(df, positions, "_from"), positions, LOG_KEY, broadcast_rows=broadcast_rows,
            computed=True,
        )
        .filter(F.col("offset") >= F.coalesce("_from", F.lit(0)))
        .drop("_from")
    )
