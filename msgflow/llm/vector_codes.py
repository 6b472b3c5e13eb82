"""Vector codes: product quantisation with codebooks that are searched through a GNAT.

A vector of whole numbers is cut into equal consecutive parts, and each part is replaced by the
index of the nearest entry of its position's codebook. Codebooks are refined in rounds: every part
is assigned, and an entry becomes the floored mean of its parts.

The nearest entry is found in a geometric near-neighbour access tree over the entries. A node picks
a few split points, gives every other entry to its nearest one, and keeps for each child the range of
distances from every split point to the child's entries. A query measures its distance d to the
split points; with r the best distance so far, a child whose range from some split point is [lo, hi]
holds nothing as near as r if d - r > hi or d + r < lo, so the whole subtree goes. The comparison is
strict and rounded to the safe side, so no entry at the same distance is lost, and what is left is
decided by whole numbers: squared distance first, then index.

Rounds send only sums and counts for each entry through the shuffle and to the driver; their size
is that of the codebooks, whatever the table's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.operators.joins import checked_join
from msgflow.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096.0
#: Split points of a node, and entries that are looked through without one.
DEGREE, LEAF = 4, 4
#: Queries searched at a time.
BLOCK = 4_096
#: Components must stay below this, so that squared distances fit 64 bits.
LARGEST = 1 << 27


def squares(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances as whole numbers, one row for each query."""
    apart = queries[:, None, :] - points[None, :, :]
    return np.einsum("qpw,qpw->qp", apart, apart)


class Gnat:
    """A tree over the rows of an integer matrix; answers nearest-row queries exactly."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.entries, self.degree, self.leaf = np.ascontiguousarray(entries, np.int64), degree, leaf
        #: Entries' distances that queries have had computed.
        self.measured = 0
        #: (numbers of the split points, children, lo and hi by child and split point)
        self.nodes: list[tuple[np.ndarray, list[int], np.ndarray, np.ndarray]] = []
        self._node(np.arange(len(entries)))

    def _node(self, numbers: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append((numbers, [], np.zeros((0, 0)), np.zeros((0, 0))))
        if len(numbers) <= max(self.leaf, self.degree):
            return at
        points = self.entries[numbers]
        # Split points far from each other: the first entry, then always the one farthest from all so far.
        chosen, far = [0], squares(points, points[:1])[:, 0]
        while len(chosen) < self.degree:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, squares(points, points[chosen[-1:]])[:, 0])
        rest = np.setdiff1d(np.arange(len(numbers)), chosen)
        near = squares(points[rest], points[chosen])
        owner = near.argmin(axis=1)
        reach = np.sqrt(near.astype(np.float64))
        children, lows, highs = [], [], []
        for i in range(len(chosen)):
            own = owner == i
            if own.any():
                lows.append(reach[own].min(axis=0))
                highs.append(reach[own].max(axis=0))
                children.append(self._node(numbers[rest[own]]))
        self.nodes[at] = (numbers[chosen], children, np.array(lows), np.array(highs))
        return at

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest row and its squared distance; ties go to the lower number."""
        index, best = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for lo in range(0, len(queries), BLOCK):
            index[lo : lo + BLOCK], best[lo : lo + BLOCK] = self._search(queries[lo : lo + BLOCK])
        return index, best

    def _search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        todo = [(0, np.arange(len(queries)))]
        while todo:
            at, active = todo.pop()
            numbers, children, lows, highs = self.nodes[at]
            found = squares(queries[active], self.entries[numbers])
            self.measured += found.size
            for j, number in enumerate(numbers.tolist()):
                d = found[:, j]
                better = (d < best[active]) | ((d == best[active]) & (number < index[active]))
                best[active[better]], index[active[better]] = d[better], number
            if not children:
                continue
            d, r = np.sqrt(found.astype(np.float64)), np.sqrt(best[active].astype(np.float64))[:, None]
            # Roots and ranges are rounded; what lies this near to a bound is not given up.
            slack = 1e-6 + 1e-9 * (d + r)
            for child, lo, hi in zip(children, lows, highs):
                gone = ((d - r > hi + slack) | (d + r < lo - slack)).any(axis=1)
                if not gone.all():
                    todo.append((child, active[~gone]))
        return index, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), width)


def _assign(trees: list[Gnat], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each part and its squared distance, one column for each part."""
    cut = vectors.reshape(len(vectors), len(trees), vectors.shape[1] // len(trees))
    found = [tree.nearest(np.ascontiguousarray(cut[:, p])) for p, tree in enumerate(trees)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(books, width: int):
    """Per part and entry the count and the sum of its parts, over all rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = books.value
        parts, entries, w = codebooks.shape
        trees = [Gnat(book) for book in codebooks]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, w), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column(0), width)
            codes, _ = _assign(trees, vectors)
            cut = vectors.reshape(len(vectors), parts, w)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[p], codes[:, p], cut[:, p])
        used = np.argwhere(counts > 0)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used[:, 0].astype(np.int32)), pa.array(used[:, 1].astype(np.int32)), pa.array(counts[counts > 0]),
                 pa.array([sums[p, e].tolist() for p, e in used.tolist()], pa.list_(pa.int64()))],
                ["_part", "_entry", "_count", "_sum"],
            )

    return run


def _codes(books, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books.value]
        digits = max(2, -(-max(1, (len(trees[0].entries) - 1).bit_length()) // 4))
        for batch in batches:
            codes, errors = _assign(trees, _matrix(batch.column(2), width))
            text = ["".join(f"{e:0{digits}x}" for e in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(errors.sum(axis=1), pa.int64())],
                ["_key", "_label", "_code", "_error"],
            )

    return run


def usable_vectors(table: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """Key, label and vector as whole numbers, without vectors that are null or hold null or non-finite components."""
    x = F.col(f"`{vector}`")
    clear = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return table.filter(clear).select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").alias("_label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("_vector"),
    )


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) of ``usable_vectors``, refined over all of them."""
    shape = rows.agg(
        F.min(F.size("_vector")), F.max(F.size("_vector")),
        F.max(F.array_max(F.transform("_vector", lambda c: F.abs(c.cast("double"))))),
    ).first()
    if shape[0] is None:
        return np.zeros((parts, 0, 0), np.int64)
    width = shape[1]
    if shape[0] != width or width % parts:
        raise ValueError(f"vectors have {shape[0]} to {width} components; all must have the same multiple of {parts}")
    if (shape[2] or 0) >= LARGEST:
        raise ValueError(f"components reach {shape[2]}; squared distances fit 64 bits below {LARGEST}")
    first = rows.orderBy(F.col("_key").asc_nulls_last(), "_vector").limit(entries).select("_vector").collect()
    books = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    context = rows.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(books)  # parts x entries x components: parameters, not data
        sums = rows.select("_vector").mapInArrow(
            _sums(shared, width), "_part int, _entry int, _count bigint, _sum array<bigint>"
        )
        totals = (
            sums.select("_part", "_entry", "_count", F.posexplode("_sum").alias("_at", "_value"))
            .groupBy("_part", "_entry", "_at").agg(F.sum("_count").alias("_count"), F.sum("_value").alias("_value"))
        )
        books = books.copy()
        for part, entry, at, count, value in totals.collect():
            books[part, entry, at] = value // count
    return books


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE,
) -> DataFrame:
    """One row per usable row of ``table``: key, code, error, label_error, codebooks_sha256.

    Components become floor(scale * x). ``code`` has two hex digits for each part (more if there
    are more than 256 entries), ``error`` is the squared distance to the coded vector, ``label_error``
    its sum over all rows with the same label, nulls together.

    Rows whose vector is null or holds null or non-finite components are left out; rows without a
    key or label take part (first entries: null keys last, equal keys by their vector). Rows that
    repeat are all coded. With fewer rows than entries the codebooks are smaller. An empty table gives no
    rows. Vectors must have one length, a multiple of ``parts``. Other columns are not looked at.
    """
    rows = materialize(usable_vectors(table, key, vector, label, scale))
    books = fit_codebooks(rows, parts, entries, rounds)
    width = parts * books.shape[2]
    kinds = rows.schema
    shared = table.sparkSession.sparkContext.broadcast(books)
    coded = materialize(
        rows.mapInArrow(
            _codes(shared, width),
            f"_key {kinds['_key'].dataType.simpleString()}, _label {kinds['_label'].dataType.simpleString()}, _code string, _error bigint",
        )
    )
    # A key without nulls, so that rows without a label join as well.
    by_label = F.coalesce(F.concat(F.lit("="), F.col("_label").cast("string")), F.lit("")).alias("_by")
    coded = coded.select("_key", "_code", "_error", by_label)
    sums = coded.groupBy("_by").agg(F.sum("_error").alias("_label_error"))
    joined = checked_join(coded, sums, ["_by"])
    return joined.select(
        F.col("_key").alias(key), F.col("_code").alias("code"), F.col("_error").alias("error"),
        F.col("_label_error").alias("label_error"), F.lit(codebooks_digest(books)).alias("codebooks_sha256"),
    )
