"""Repeated byte strings by longest previous factors, over the places where repeats can be.

The longest previous factor of a place is the longest string that starts there and also starts at
an earlier place of the corpus. With the suffixes in byte order it is reached at the nearest smaller
position before or after the place in that order, so these two tell whether a string of ``SIZE``
bytes is a later copy; the nearest larger positions tell whether it is an earlier one. Removing later
copies keeps the first; removing both leaves no copy.

Putting every suffix of a corpus in order would move each byte ``SIZE`` times. Every string of ``SIZE`` bytes has an
anchor in it: the gram of ``GRAM`` bytes with the smallest hash. Equal strings have their anchor at the
same place in them, so only suffixes that start at one distance before the anchors of one gram
have to be ordered together:

1. Texts that are equal are counted; they are repeats as a whole, and the first one stands for all.
2. Anchors are counted by gram and by their context, the text in which all strings with this
   anchor lie. Of a context that occurs twice all strings are repeats (later copies but for its first place); a
   gram that occurs once is in no repeat. What is left are the edges of repeats.
3. An anchor is open if a string that it is the anchor of still has uncovered bytes. For the grams
   of open anchors, one context of each kind is moved to the gram's bin. A bin orders the
   suffixes at the anchors by their bytes, with the lengths of common prefixes; the order of the suffixes
   one byte further left follows from it by that byte alone, as in induced sorting. In each order the smaller and larger
   positions on either side, as far as prefixes of ``SIZE`` bytes are common, give the factors.
   A gram with more than ``GROUP`` kinds of context is not gathered: its strings are counted by
   64-bit mark with partial sums, to the same end.

Texts are told apart by SHA-256, contexts and counted strings within one gram (itself a 64-bit hash) by 64-bit marks under
a key that each run draws anew, so that no texts can be made to share one; in bins, bytes are compared.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import mix64, small_batches, spread_table, text_bytes
from msgflow.operators.joins import checked_join
from msgflow.session import materialize

SIZE, GRAM = 400, 100
REACH = SIZE - GRAM  # an anchor lies at most so many bytes after the start of its string
GROUP, BIN_ROWS = 16_000, 4_000
#: Bytes of a text whose anchors are found at a time, and bytes around them that take part.
SLICE, AROUND = 1 << 20, 2 * SIZE
LETTERS = spread_table(256, 31)
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


class Hashes:
    """Hashes of all substrings of one size, from running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(LETTERS[data] * powers_of(FACTOR, n)[:-1], out=self.sums[1:])
        self.back = powers_of(INVERSE, n)

    def sized(self, size: int) -> np.ndarray:
        m = len(self.sums) - size
        return mix64((self.sums[size:] - self.sums[:m]) * self.back[:m])


_POWERS: dict[int, np.ndarray] = {}


def powers_of(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 17), np.uint64(base), np.uint64)
        known[0] = 1
        known = _POWERS[base] = np.multiply.accumulate(known)
    return known[:n]


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every run of ``width`` values, by doubling."""
    out, size = values, 1
    while size * 2 <= width:
        out, size = pick(out[:-size], out[size:]), size * 2
    if size < width:
        m = len(values) - width + 1
        out = pick(out[:m], out[width - size : width - size + m])
    return out


def least_grams(hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at each place, and the smallest one inside each string of SIZE bytes."""
    grams = hashes.sized(GRAM)
    return grams, sliding(grams, REACH + 1, np.minimum)


def context_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: bytes) -> np.ndarray:
    view = memoryview(data)
    marks = [hashlib.blake2b(view[a:b], digest_size=8, key=key).digest() for a, b in zip(starts.tolist(), ends.tolist())]
    return np.frombuffer(b"".join(marks), np.uint64)


def string_marks(data: np.ndarray, key: bytes) -> np.ndarray:
    """Marks of all strings of SIZE bytes, of the marks of their halves; words drawn from the key differ for each size."""
    words = np.frombuffer(hashlib.shake_256(key).digest(8 * (256 + SIZE.bit_length())), np.uint64)
    out, size, turn = words[:256][data], 1, 256
    while size < SIZE:
        step = min(size, SIZE - size)
        out = mix64(out[:-step] ^ words[turn]) + out[step:]
        size, turn = size + step, turn + 1
    return out


def anchors(data: np.ndarray, key: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, grams and contexts of the anchors of a text of at least SIZE bytes."""
    n, parts = len(data), []
    for lo in range(0, n, SLICE):
        # What decides about a place lies this near to it.
        first, last = max(0, lo - AROUND), min(n, lo + SLICE + AROUND)
        places, grams, contexts = _anchors(data[first:last], key)
        own = (places >= lo - first) & (places < lo - first + SLICE)
        parts.append((places[own] + first, grams[own], contexts[own]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchors(data: np.ndarray, key: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes = Hashes(data)
    grams, least = least_grams(hashes)
    edge = np.zeros(REACH, np.uint64)
    # A place is an anchor if its gram is the least one of some string around it.
    places = np.flatnonzero(sliding(np.concatenate([edge, least, edge]), REACH + 1, np.maximum) == grams)
    starts, ends = np.maximum(places - REACH, 0), np.minimum(places + SIZE, len(data))
    contexts = context_marks(data, starts, ends, key) + (places - starts).astype(np.uint64)
    return places, grams[places], contexts


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *[len(a) for a in arrays]]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, np.int64)])
    flat = flat.view(np.int64) if flat.dtype == np.uint64 else flat.astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def _find_anchors(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.schema.get_field_index("_text")))
            bounds = offsets.tolist()
            found = [anchors(data[a:b], key) if b - a >= SIZE else none for a, b in zip(bounds[:-1], bounds[1:])]
            places, grams, contexts = zip(*found) if found else ([], [], [])
            keep = [i for i, name in enumerate(batch.schema.names) if name != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], _lists(list(places), pa.int32()),
                 _lists([g.view(np.int64) for g in grams], pa.int64()), _lists([c.view(np.int64) for c in contexts], pa.int64())],
                [*[batch.schema.names[i] for i in keep], "_places", "_grams", "_contexts"],
            )

    return run


def covered_bytes(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def _context_ranges(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(places - REACH, 0), np.minimum(places + SIZE, n)


def _ints(column, row: int) -> np.ndarray:
    value = column[row].values
    return np.zeros(0, np.int64) if value is None else value.to_numpy(zero_copy_only=False).astype(np.int64)


def _open_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of anchors of strings that the repeated contexts leave partly uncovered."""
    for batch in batches:
        data, offsets = text_bytes(batch["_text"])
        out: set[int] = set()
        for row in range(len(batch)):
            text = data[offsets[row] : offsets[row + 1]]
            places, fixed = _ints(batch["_at"], row), _ints(batch["_fixed"], row)
            mixed = _ints(batch["_mixed"], row)
            covered = covered_bytes(len(text), *_context_ranges(places[fixed > 0], len(text)))
            bare = np.concatenate([[0], np.cumsum(~covered)])
            is_open = bare[SIZE:] > bare[:-SIZE]
            grams, least = least_grams(Hashes(text))
            for at in places[mixed > 0].tolist():
                lo, hi = max(at - REACH, 0), min(at + 1, len(least))
                if (is_open[lo:hi] & (least[lo:hi] == grams[at])).any():
                    out.add(int(grams[at].view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64())], ["_gram"])


def _own_strings(hashes: Hashes, places: np.ndarray) -> list[tuple[int, int]]:
    """First and last start of the strings that each place is the anchor of (one run of starts)."""
    grams, least = least_grams(hashes)
    out = []
    for at in places.tolist():
        lo = max(at - REACH, 0)
        own = np.flatnonzero(least[lo : at + 1] == grams[at])
        out.append((lo + int(own[0]), lo + int(own[-1])))
    return out


def _per_anchor(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    """Columns of rows, each value once for every anchor of its row."""
    counts = batch["_at"].value_lengths().to_numpy(zero_copy_only=False)
    which = pa.array(np.repeat(np.arange(len(batch)), counts))
    return [batch[n].take(which) for n in names]


def _joined(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]))


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of all strings of the wanted anchors, and the anchor's place in it."""
    for batch in batches:
        data, offsets = text_bytes(batch["_text"])
        grams, kinds, lefts, texts, at = [], [], [], [], []
        for row in range(len(batch)):
            text = data[offsets[row] : offsets[row + 1]]
            places = _ints(batch["_at"], row)
            own = np.array(_own_strings(Hashes(text), places), np.int64).reshape(-1, 2)
            grams.append(_ints(batch["_gram"], row))
            kinds.append(_ints(batch["_context"], row))
            lefts.append(places - own[:, 0])
            at.append(places)
            texts += [text[a : b + SIZE].tobytes() for a, b in own.tolist()]
        yield pa.RecordBatch.from_arrays(
            [*_per_anchor(batch, ["_key", "_row"]), _joined(at), _joined(grams), _joined(kinds), _joined(lefts),
             pa.array(texts, pa.binary())],
            ["_key", "_row", "_at", "_gram", "_context", "_left", "_around"],
        )


def _cut_strings(key: bytes):
    """Marks of all strings of the wanted anchors, with their offset before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["_text"])
            for row in range(len(batch)):
                text = data[offsets[row] : offsets[row + 1]]
                strings = string_marks(text, key).view(np.int64)
                places = _ints(batch["_at"], row)
                runs = np.array(_own_strings(Hashes(text), places)).reshape(-1, 2)
                sizes = runs[:, 1] - runs[:, 0] + 1
                # Some anchors at a time, so that a batch stays small.
                for lo in range(0, len(places), 256):
                    some, n = slice(lo, lo + 256), sizes[lo : lo + 256]
                    spread = lambda x: np.repeat(x[some], n)
                    ends = np.cumsum(n)
                    start = np.repeat(runs[some, 0] - (ends - n), n) + np.arange(ends[-1])
                    at = spread(places)
                    which = pa.array(np.full(len(start), row))
                    yield pa.RecordBatch.from_arrays(
                        [batch["_key"].take(which), batch["_row"].take(which), pa.array(at),
                         pa.array(spread(_ints(batch["_gram"], row))), pa.array(spread(_ints(batch["_context"], row))),
                         pa.array(at - start), pa.array(strings[start])],
                        ["_key", "_row", "_at", "_gram", "_context", "_offset", "_string"],
                    )

    return run


class SuffixOrder:
    """Suffixes of contexts that start one distance before their anchors, in byte order.

    ``order`` holds the numbers of the contexts, ``common`` the length of the prefix that
    each shares with the one before it. ``step`` goes one byte further left.
    """

    def __init__(self, grams: np.ndarray, lefts: np.ndarray, texts: list[bytes]):
        self.lefts, self.distance = lefts, 0
        self.ends = np.array([len(t) for t in texts], np.int64) - lefts
        n, width = len(texts), int(self.ends.max(initial=0))
        right = [t[left:] for t, left in zip(texts, lefts.tolist())]
        self.order = np.array(sorted(range(n), key=lambda i: (grams[i], right[i])), np.int64)
        self.common = np.zeros(n, np.int64)
        #: The bytes before the anchors, the nearest one in column 0.
        self.before = np.zeros((n, REACH + 1), np.uint8)
        for i, (t, left) in enumerate(zip(texts, lefts.tolist())):
            self.before[i, :left] = np.frombuffer(t, np.uint8, left)[::-1]
        for lo in range(1, n, 1024):
            ids = self.order[lo - 1 : lo + 1024]
            rows = np.frombuffer(b"".join([right[i].ljust(width, b"\0") for i in ids.tolist()]), np.uint8).reshape(len(ids), width)
            apart = rows[1:] != rows[:-1]
            same = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
            same = np.minimum(same, np.minimum(self.ends[ids[1:]], self.ends[ids[:-1]]))
            # Suffixes at anchors of other grams count as having nothing in common.
            self.common[lo : lo + 1024] = np.where(grams[ids[1:]] == grams[ids[:-1]], same, 0)

    def step(self) -> None:
        """The order of the suffixes one byte further left: by that byte, then as they are."""
        kept = np.flatnonzero(self.lefts[self.order] > self.distance)
        ids = self.order[kept]
        first = self.before[ids, self.distance]
        turn = np.argsort(first, kind="stable")
        ranks, first = kept[turn], first[turn]
        common = np.zeros(len(ids), np.int64)
        if len(ids) > 1:
            common[1:] = np.where(first[1:] == first[:-1], 1 + self._least(ranks[:-1], ranks[1:]), 0)
        self.order, self.common, self.distance = ids[turn], common, self.distance + 1

    def _least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the prefix that ranks a < b share: the least of those between; 0 where a > b."""
        levels, width = [self.common], int((b - a).max(initial=1))
        while 2 << (len(levels) - 1) <= width:
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        out = np.zeros(len(a), np.int64)
        up = b > a
        size = np.where(up, b - a, 1)
        level = np.frexp(size)[1] - 1
        for k in np.unique(level[up]).tolist():
            at = np.flatnonzero(up & (level == k))
            row = levels[k]
            out[at] = np.minimum(row[a[at] + 1], row[b[at] - (1 << k) + 1])
        return out

    def factors(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts whose string of SIZE bytes is shared; of these, the later and the earlier copies.

        A copy is later if a smaller position stands before or after it in the order, with
        SIZE bytes in common all the way, and earlier if a larger one does.
        """
        shared = self.common >= SIZE
        member = shared.copy()
        member[:-1] |= shared[1:]
        at = np.flatnonzero(member)
        ids = self.order[at]
        run = np.cumsum(~shared[at])  # a suffix that shares nothing with the one before it starts a run
        place, far = positions[ids], len(positions) + 1
        return ids, _beside(place, run, far), _beside(-place, run, far)


def _beside(place: np.ndarray, run: np.ndarray, far: int) -> np.ndarray:
    """Whether a smaller value stands before or after each value in its run."""
    falling = place - run * (2 * far)  # later runs lie below all earlier ones
    rising = place + run * (2 * far)
    out = np.zeros(len(place), bool)
    if len(place) > 1:
        out[1:] |= (np.minimum.accumulate(falling)[:-1] < falling[1:]) & (run[1:] == run[:-1])
        out[:-1] |= (np.minimum.accumulate(rising[::-1])[::-1][1:] < rising[:-1]) & (run[1:] == run[:-1])
    return out


def aligned_factors(
    grams: np.ndarray, lefts: np.ndarray, texts: list[bytes], positions: np.ndarray, keep_first: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """For each context the largest and smallest offset of a string before its anchor that goes (-1: none).

    ``lefts`` are the anchors' places in the contexts, ``positions`` the order of the
    contexts in the corpus. All copies go, or with ``keep_first`` the later ones.
    """
    most, least = np.full(len(texts), -1), np.full(len(texts), -1)
    if not len(texts):
        return most, least
    order = SuffixOrder(grams, lefts, texts)
    for offset in range(int(lefts.max()) + 1):
        if offset:
            order.step()
        ids, later, earlier = order.factors(positions)
        hits = ids[later] if keep_first else ids[later | earlier]
        most[hits] = offset
        least[hits[least[hits] < 0]] = offset
    return most, least


def _order_bin(keep_first: bool):
    def run(rows: pa.Table) -> pa.Table:
        places = list(zip(rows["_key"].to_pylist(), rows["_row"].to_pylist(), rows["_at"].to_pylist()))
        in_order = sorted(range(len(places)), key=lambda i: (places[i][0] is not None, *places[i][0 if places[i][0] is not None else 1 :]))
        positions = np.empty(len(places), np.int64)
        positions[in_order] = np.arange(len(places))
        most, least = aligned_factors(
            rows["_gram"].to_numpy(), rows["_left"].to_numpy(), rows["_around"].to_pylist(), positions, keep_first
        )
        found = np.flatnonzero(most >= 0)
        return pa.table({
            "_gram": rows["_gram"].take(found), "_context": rows["_context"].take(found),
            "_most": pa.array(most[found], pa.int64()), "_least": pa.array(least[found], pa.int64()),
        })

    return run


def _runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    steps = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.flatnonzero(steps > 0), np.flatnonzero(steps < 0)


def _remove(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["_text"])
            starts, ends, digests, kept = [], [], [], []
            for row in range(len(batch)):
                text = data[offsets[row] : offsets[row + 1]]
                covered = covered_bytes(len(text), _ints(batch["_starts"], row), _ints(batch["_ends"], row))
                lo, hi = _runs(covered)
                starts.append(lo)
                ends.append(hi)
                body = text[~covered].tobytes()
                digests.append(hashlib.sha256(body).hexdigest())
                kept.append(body if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch["_row"], _lists(starts, pa.int64()), _lists(ends, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(kept, pa.binary())],
                ["_row", "_from", "_to", "_kept", "_body"],
            )

    return run


def _repeats(docs: DataFrame, key: str, text: str, group: int, keep_first: bool, with_text: bool) -> DataFrame:
    """Per row of ``docs``: _key, _n, _spans (start and end), _kept (digest), _body (with_text)."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    texts = small_batches(docs).select(
        F.col(f"`{key}`").alias("_key"), body.alias("_text"), F.sha2(body.cast("binary"), 256).alias("_sha"),
    )
    kind, run_key = docs.schema[key].dataType.simpleString(), secrets.token_bytes(16)
    table = materialize(
        texts.withColumn("_n", F.octet_length("_text").cast("long"))
        .mapInArrow(_find_anchors(run_key), f"_key {kind}, _sha string, _n bigint, "
                    "_places array<int>, _grams array<bigint>, _contexts array<bigint>")
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # The order of the corpus: by key, nulls first; rows of one key as they stand in the table.
    place = F.struct(F.col("_key").isNotNull().alias("a"), F.col("_key").alias("b"), F.col("_row").alias("c"))
    here = F.struct(place.alias("p"), F.col("_at").alias("q"))
    # 1. The first of all equal texts stands for them.
    classes = materialize(
        table.filter(F.col("_n") >= SIZE).groupBy("_sha")
        .agg(F.min_by("_row", place).alias("_row"), F.count(F.lit(1)).alias("_copies"))
    )
    firsts = table.join(classes.select("_row", "_copies"), "_row")
    each = materialize(firsts.select(
        "_row", "_key", "_copies",
        F.inline(F.arrays_zip(F.col("_places").alias("_at"), F.col("_grams").alias("_gram"), F.col("_contexts").alias("_context"))),
    ))
    # 2. Grams that occur again, and which of their contexts do.
    first_place = [F.min(here).alias("_first")] if keep_first else []
    kinds = materialize(each.groupBy("_gram", "_context").agg(F.count(F.lit(1)).alias("_times"), *first_place))
    again = materialize(
        kinds.groupBy("_gram").agg(F.sum("_times").alias("_all"), F.count(F.lit(1)).alias("_kinds")).filter("_all > 1").drop("_all")
    )
    fixed = F.col("_times").isNotNull()
    if keep_first:
        fixed = fixed & (F.col("_first") != here)
    marked = materialize(
        each.join(kinds.filter("_times > 1"), ["_gram", "_context"], "left").join(again, "_gram")
        .select("_row", "_key", "_at", "_gram", "_context", fixed.alias("_fixed"), "_kinds", "_copies")
    )
    # 3. Texts that hold such grams, with their anchors.
    lists = materialize(
        marked.groupBy("_row").agg(
            F.max("_copies").alias("_copies"),
            F.collect_list(F.struct("_at", F.col("_fixed").cast("int").alias("_fixed"), (F.col("_kinds") > 1).cast("int").alias("_mixed"))).alias("_l"),
        ).select("_row", "_copies", F.col("_l._at").alias("_at"), F.col("_l._fixed").alias("_fixed"), F.col("_l._mixed").alias("_mixed"))
    )
    wanted = materialize(
        lists.select("_row").join(table.select("_row", "_key", "_sha"), "_row")
        .withColumns({"_null": F.col("_key").isNull(), "_key": F.coalesce("_key", F.lit(0).cast(kind))})
    )
    keyed = texts.withColumns({"_null": F.col("_key").isNull(), "_key": F.coalesce("_key", F.lit(0).cast(kind))})
    held = materialize(
        checked_join(keyed, wanted, ["_key", "_null", "_sha"], "inner", computed=True)
        .select("_row", F.when(~F.col("_null"), F.col("_key")).alias("_key"), "_text").dropDuplicates(["_row"])
    )
    # Of texts that occur again as a whole nothing stays, unless the first one does.
    looked_at = lists if keep_first else lists.filter("_copies = 1")
    open_grams = materialize(
        held.join(looked_at, "_row").select("_text", "_at", "_fixed", "_mixed")
        .mapInArrow(_open_anchors, "_gram bigint").distinct().join(again, "_gram").filter("_kinds > 1")
    )
    members = materialize(
        (marked.filter("NOT _fixed") if keep_first else marked).drop("_kinds").join(open_grams, "_gram")
        .select("_row", "_key", "_at", "_gram", "_context", "_kinds")
    )
    one = members.groupBy("_gram", "_context").agg(
        F.min_by(F.struct("_row", "_at"), here).alias("_m"), F.min("_kinds").alias("_kinds")
    ).select("_m._row", "_m._at", "_gram", "_context", "_kinds")
    chosen = materialize(
        one.groupBy("_row", (F.col("_kinds") > group).alias("_many"))
        .agg(F.collect_list(F.struct("_at", "_gram", "_context")).alias("_l"))
        .select("_row", "_many", F.col("_l._at").alias("_at"), F.col("_l._gram").alias("_gram"), F.col("_l._context").alias("_context"))
    )
    n = chosen.filter("NOT _many").agg(F.sum(F.size("_at"))).first()[0] or 0
    around = held.join(chosen, "_row")
    bins = max(1, -(-n // BIN_ROWS))
    where = f"_key {kind}, _row bigint, _at bigint, _gram bigint, _context bigint"
    needed = ["_key", "_row", "_text", "_at", "_gram", "_context"]
    ordered = (
        around.filter("NOT _many").select(*needed)
        .mapInArrow(_cut_contexts, f"{where}, _left bigint, _around binary")
        .groupBy(F.pmod(F.xxhash64("_gram"), F.lit(bins)).alias("_bin"))
        .applyInArrow(_order_bin(keep_first), "_gram bigint, _context bigint, _most bigint, _least bigint")
    )
    strings = (
        around.filter("_many").select(*needed)
        .mapInArrow(_cut_strings(run_key), f"{where}, _offset bigint, _string bigint")
    )
    string = ["_gram", "_offset", "_string"]
    often = strings.groupBy(*string).agg(F.count(F.lit(1)).alias("_n"), *first_place).filter("_n > 1").drop("_n")
    if keep_first:
        later = strings.join(materialize(often), string).filter(F.col("_first") != here)
    else:
        later = strings.join(materialize(often), string, "left_semi")
    counted = later.groupBy("_gram", "_context").agg(F.max("_offset").alias("_most"), F.min("_offset").alias("_least"))
    found = materialize(ordered.unionByName(counted))
    # All strings of one anchor hold it, so together they are one range.
    ranges = materialize(
        members.join(found, ["_gram", "_context"])
        .select("_row", (F.col("_at") - F.col("_most")).alias("_start"), (F.col("_at") - F.col("_least") + SIZE).alias("_end"))
        .groupBy("_row").agg(F.collect_list(F.struct("_start", "_end")).alias("_l"))
    )
    sizes = table.select("_row", F.col("_n").alias("_length"))
    settled = F.filter(F.arrays_zip("_at", "_fixed"), lambda x: x["_fixed"] > 0)
    contexts = F.transform(settled, lambda x: F.struct(
        F.greatest(x["_at"] - REACH, F.lit(0)).cast("long").alias("_start"),
        F.least(x["_at"].cast("long") + SIZE, F.col("_length")).alias("_end")))
    cover = (
        looked_at.join(sizes, "_row").join(ranges, "_row", "left")
        .select("_row", F.concat(contexts, F.coalesce("_l", F.array().cast("array<struct<_start:bigint,_end:bigint>>"))).alias("_c"))
        .filter(F.size("_c") > 0).select("_row", F.col("_c._start").alias("_starts"), F.col("_c._end").alias("_ends"))
    )
    partly = materialize(
        held.join(cover, "_row").select("_row", "_text", "_starts", "_ends")
        .mapInArrow(_remove(with_text), "_row bigint, _from array<bigint>, _to array<bigint>, _kept string, _body binary")
    )
    whole = materialize(classes.filter("_copies > 1").select("_sha", F.col("_row").alias("_whole")))
    gone = F.col("_whole").isNotNull() & (F.col("_n") >= SIZE)
    if keep_first:
        gone = gone & (F.col("_whole") != F.col("_row"))
    spans = F.transform(F.arrays_zip("_from", "_to"), lambda x: F.struct(x["_from"].alias("start"), x["_to"].alias("end")))
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("_n").alias("end")))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    out = table.select("_row", "_key", "_sha", "_n").join(whole, "_sha", "left").join(partly, "_row", "left").select(
        "_row", "_key", "_sha", "_n", F.when(gone, all_of_it).otherwise(F.coalesce(spans, nothing)).alias("_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("_kept", "_sha")).alias("_kept"),
        F.when(gone, F.lit(b"")).otherwise(F.col("_body")).alias("_body"),
    )
    if not with_text:
        return out
    # Texts of which nothing goes come from the documents; one row of a text serves all equal ones.
    untouched = out.filter("_body IS NULL").select("_sha").distinct()
    bodies = texts.join(untouched, "_sha", "left_semi").groupBy("_sha").agg(F.first("_text").cast("binary").alias("_whole_text"))
    return out.join(bodies, "_sha", "left").withColumn("_body", F.coalesce("_body", "_whole_text")).drop("_whole_text")


def _removed(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", group: int = GROUP, keep_first: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Removed is every byte that lies in a string of 400 bytes that also starts anywhere else in the
    table, in the same text or another; with ``keep_first``, anywhere before, by key (nulls first) and place.
    Strings do not cross texts and are judged on the input. n_spans counts maximal removed runs, spans
    lists them (bytes, end exclusive), kept_sha256 is the digest of the bytes that stay. Null
    counts as empty; texts under 400 bytes keep everything; of rows that repeat all lose everything from
    400 bytes on, or all but the first. An empty table gives no rows; other columns are not looked at.
    """
    out = _repeats(docs, key, text, group, keep_first, with_text=False)
    return out.select(
        F.col("_key").alias(key), F.col("_n").alias("n_bytes"), _removed(F.col("_spans")).alias("n_removed"),
        F.size("_spans").cast("long").alias("n_spans"), F.col("_kept").alias("kept_sha256"), F.col("_spans").alias("spans"),
    )


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", group: int = GROUP, keep_first: bool = True) -> DataFrame:
    """One row per row of ``docs``: key, kept (the bytes that stay), spans (what went); rules as above.

    ``kept`` is binary, as a span may end inside a character.
    """
    out = _repeats(docs, key, text, group, keep_first, with_text=True)
    return out.select(F.col("_key").alias(key), F.col("_body").alias("kept"), F.col("_spans").alias("spans"))
