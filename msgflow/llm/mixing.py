"""Mixing sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash of its key. A source takes whole multiples of all its
documents, and one copy more of those whose hash lies under the source's threshold. The
threshold is found in nested histograms: words are summed by source and hash bucket, the
bucket in which the running sum crosses the budget is the only one that is looked at more
closely, and after all bits are used the crossing is at one hash. No rows are sorted; the
windows run over histogram buckets, at most 4096 of a source.

Only the narrow table (key, source, size, hash) is read more than once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgflow.operators.joins import checked_join
from msgflow.session import materialize

HASH_BITS = 60
#: Bits of the hash that each nested histogram adds; the last one is over what is left.
LEVELS = (12, 12, 12, 24)
WORD = r"[^\x20\x09-\x0D]+"
SOURCE = ["_source", "_null"]


def key_hash(key: str):
    """60 bits of the MD5 of the key as text; a null key counts as an empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _with_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns(
        {"_source": F.coalesce(F.col(source), F.lit("")), "_null": F.col(source).isNull()}
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Target of each source: by weight, stopped at ``most`` times its size, the excess reshared.

    ``sizes`` has one row per source (``_source``, ``_null``, ``source_size``). Sources fill up
    in the order of ``most * size / weight``; those before the water level stop at their bound
    and the rest share what is left by weight. The windows run over one row per source.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    number = F.row_number().over(Window.orderBy("_null", "_source")) - 1
    ranked = sizes.withColumn(
        "_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    ).withColumn("_bound", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("_bound") / F.col("_weight"), "_null", "_source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        ranked.withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_full", F.coalesce(F.sum("_bound").over(before), F.lit(0.0)))
        .withColumn("_rest", F.sum("_weight").over(after))
        .withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_rest"))
        .withColumn("_stops", F.col("_bound") <= F.col("_level") * F.col("_weight"))
        .withColumn("_water", F.first(F.when(~F.col("_stops"), F.col("_level")), ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    return level.select(
        *SOURCE, "source_size",
        F.when(F.col("_stops"), F.col("_bound")).otherwise(F.col("_water") * F.col("_weight")).alias("target"),
    )


def thresholds(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: how often all documents are taken and the hash under which one more copy is."""
    per_source = targets.withColumn(
        "_times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    ).withColumn("_budget", F.col("target") - F.col("_times") * F.col("source_size"))
    found = materialize(
        per_source.select(*SOURCE, "_budget", F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_below"))
    )
    rest, used = narrow, 0
    for bits in LEVELS:
        if used:
            # Only documents of the boundary bucket are looked at again.
            rest = materialize(
                checked_join(rest, found.select(*SOURCE, "_prefix"), SOURCE, "inner", computed=True)
                .filter(F.shiftright("_hash", HASH_BITS - used) == F.col("_prefix"))
                .drop("_prefix")
            )
        used += bits
        bucket = F.shiftright("_hash", HASH_BITS - used)
        histogram = rest.groupBy(*SOURCE, bucket.alias("_bucket")).agg(F.sum("_size").alias("_mass"))
        running = Window.partitionBy(*SOURCE).orderBy("_bucket")
        crossing = (
            checked_join(histogram, found, SOURCE, "inner", computed=True)
            .withColumn("_upto", F.col("_below") + F.sum("_mass").over(running))
            .filter(F.col("_upto") > F.col("_budget"))
            .groupBy(*SOURCE, "_budget")
            .agg(F.min("_bucket").alias("_prefix"), F.min("_upto").alias("_upto"),
                 F.min_by(F.col("_upto") - F.col("_mass"), "_bucket").alias("_below"))
        )
        found = materialize(crossing)
    # At the last level the bucket is one hash: leave it or take it, whichever is nearer.
    nearer = F.col("_budget") - F.col("_below") <= F.col("_upto") - F.col("_budget")
    cut = found.select(*SOURCE, F.when(nearer, F.col("_prefix")).otherwise(F.col("_prefix") + 1).alias("_cut"))
    return materialize(
        per_source.join(cut, SOURCE, "left")
        .select(*SOURCE, "source_size", "target", "_times", F.coalesce("_cut", F.lit(0)).alias("_cut"))
    )


def _plan(docs: DataFrame, key: str, text: str, source: str, weights, share, most) -> tuple[DataFrame, DataFrame]:
    narrow = materialize(
        _with_source(docs.select(F.col(key).alias("_key"), F.col(source).cast("string").alias("_of"),
                                 word_count(text).alias("_size"), key_hash(key).alias("_hash")), "_of")
        .drop("_of")
    )
    sizes = materialize(narrow.groupBy(*SOURCE).agg(F.sum("_size").alias("source_size")))
    targets = materialize(source_targets(sizes, weights, share, most))
    return narrow, thresholds(narrow, targets)


def mix_report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
) -> DataFrame:
    """One row per document: key, size, source_size, target and taken (its words in the mix).

    Null or empty texts have size 0 and take nothing. A null source is a source of its own and
    comes last. Rows with the same key have the same hash and are taken alike, so rows that
    repeat are repeated in the mix as well. An empty table gives no rows.
    """
    narrow, cuts = _plan(docs, key, text, source, weights, share, most)
    return checked_join(narrow, cuts, SOURCE, "inner", computed=True).select(
        F.col("_key").alias(key), F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * _copies()).alias("taken"),
    )


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``.

    The texts are not shuffled: the hash is computed again beside them and held against the
    thresholds, one row per source. Documents of sources without words are left out.
    """
    _, cuts = _plan(docs, key, text, source, weights, share, most)
    # The document goes into one column, so that none of its names meets one of these.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    marked = _with_source(docs.select(whole, key_hash(key).alias("_hash"), F.col(f"`{source}`").cast("string").alias("_of")), "_of")
    return (
        checked_join(marked, cuts.select(*SOURCE, "_times", "_cut"), SOURCE, "inner", computed=True)
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), _copies())))
        .select("_doc.*")
    )


def _copies():
    return F.col("_times") + (F.col("_hash") < F.col("_cut")).cast("int")
