"""Exact deduplication by content-defined chunk recipes.

A text is cut where a rolling hash of its last bytes has a fixed pattern, so equal texts are
cut alike. Each chunk has a 128-bit identifier; a text's recipe is the ordered list of its
chunk identifiers. Identifiers are verified once: chunks are moved to the place of their
identifier, where two different contents under one identifier would meet. If that happens
the corpus is chunked again under another seed, so equal identifiers always mean equal bytes.
After that only recipes move, about 16 bytes for each KB of text, however long a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import BLOCK, LOWER, small_batches, spread_table, text_bytes
from msgflow.operators.joins import salted_join
from msgflow.session import materialize

WINDOW = 32
#: A cut is made where the upper bits of the rolling hash are zero: every 1024 bytes or so.
CUT_BITS = 10
SHORTEST, LONGEST = 256, 8192
GEAR = spread_table(256, 11, np.uint32)


def cut_candidates(data: np.ndarray) -> np.ndarray:
    """Positions after which the hash of the last ``WINDOW`` bytes asks for a cut."""
    found = []
    for start in range(0, len(data), BLOCK):
        lead = min(start, WINDOW - 1)
        rolling = GEAR[data[start - lead : start + BLOCK]]
        step = 1
        while step < WINDOW:
            older = rolling[:-step] << np.uint32(step)
            rolling[step:] += older
            step *= 2
        hits = np.flatnonzero((rolling[lead:] >> np.uint32(32 - CUT_BITS)) == 0)
        found.append(hits + (start + 1))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(candidates: np.ndarray, start: int, end: int) -> list[int]:
    """Ends of the chunks of one text; they depend on the text alone."""
    first = np.searchsorted(candidates, start + SHORTEST)
    last = np.searchsorted(candidates, end)
    ends, at = [], start
    for cut in candidates[first:last].tolist():
        while cut - at > LONGEST:
            at += LONGEST
            ends.append(at)
        if cut - at >= SHORTEST:
            ends.append(cut)
            at = cut
    while end - at > LONGEST:
        at += LONGEST
        ends.append(at)
    if end > at:
        ends.append(end)
    return ends


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, list[int]]]:
    """Row number, lowered bytes and chunk ends (from the text's start) of each row."""
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index("_text")))
    data = LOWER[data]
    candidates = cut_candidates(data)
    bounds = offsets.tolist()
    for row in range(len(bounds) - 1):
        start, end = bounds[row], bounds[row + 1]
        yield row, data[start:end].tobytes(), [x - start for x in chunk_ends(candidates, start, end)]


def chunk_id(chunk: bytes, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)


def _recipes(seed: int, name):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, recipes = [], []
            for _, text, ends in _texts(batch):
                view = memoryview(text)
                digests.append(hashlib.sha256(text).digest())
                recipes.append(b"".join(name(view[a:b], seed) for a, b in zip([0, *ends], ends)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(recipes, pa.binary())],
                ["_key", "_sha", "_recipe"],
            )

    return run


def _chunks(seed: int, name):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, bytes] = {}
            more: list[tuple[bytes, bytes]] = []
            for _, text, ends in _texts(batch):
                for a, b in zip([0, *ends], ends):
                    chunk = text[a:b]
                    if seen.setdefault(k := name(chunk, seed), chunk) != chunk:
                        more.append((k, chunk))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*seen, *[k for k, _ in more]], pa.binary()),
                 pa.array([*seen.values(), *[c for _, c in more]], pa.binary())],
                ["_id", "_chunk"],
            )

    return run


def clashing_ids(texts: DataFrame, seed: int, name=chunk_id) -> DataFrame:
    """Identifiers that stand for more than one content. Each chunk is moved once."""
    chunks = texts.mapInArrow(_chunks(seed, name), "_id binary, _chunk binary")
    return chunks.distinct().groupBy("_id").count().filter("count > 1")


def recipes(docs: DataFrame, key: str, text: str, name=chunk_id) -> DataFrame:
    """A table of (_key, _sha, _recipe, _row); equal recipes mean equal normalised texts."""
    texts = small_batches(docs).select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    for seed in range(64):
        if clashing_ids(texts, seed, name).isEmpty():
            return materialize(
                texts.mapInArrow(_recipes(seed, name), f"_key {kind}, _sha binary, _recipe binary")
                .withColumn("_row", F.monotonically_increasing_id())
            )
    raise ValueError("chunk identifiers clash under every seed")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", name=chunk_id) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lowering A-Z; null counts as empty. Of equal
    texts the row with the largest key stays, a null key being the smallest; if rows repeat
    that key, exactly one of them is kept. Keys may be of any type that has an order. An empty table gives no rows. Other columns of
    ``docs`` are not looked at.
    """
    table = recipes(docs, key, text, name)
    groups = materialize(
        table.groupBy("_recipe").agg(
            F.max("_key").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
            F.max_by("_row", F.struct(F.col("_key").isNotNull(), "_key", "_row")).alias("_kept_row"),
        )
    )
    return salted_join(table, groups, ["_recipe"], "inner").select(
        F.col("_key").alias(key), "keep_id", "group_size",
        (F.col("_row") == F.col("_kept_row")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` does not keep."""
    decided = materialize(exact_groups(docs, key, text).select(F.col(key).alias("_id"), "kept", "text_sha256"))
    each = materialize(
        decided.filter("NOT kept").select("_id", "text_sha256").distinct()
        .join(decided.filter("kept").select("_id", "text_sha256", F.lit(True).alias("_also")), ["_id", "text_sha256"], "left")
    )
    sha = F.sha2(F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").cast("binary"), 256)
    same = lambda other: F.col(f"`{key}`").eqNullSafe(other["_id"]) & (sha == other["text_sha256"])
    gone = docs.join(each, same(each), "left_anti")
    repeated = each.filter("_also")
    if repeated.isEmpty():
        return gone
    # Rows repeated with key and text: one of each stays.
    twice = docs.join(repeated, same(repeated), "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    one = twice.select(whole, F.col(f"`{key}`").alias("_key"), sha.alias("_sha")).dropDuplicates(["_key", "_sha"]).select("_doc.*")
    return gone.unionByName(one)
