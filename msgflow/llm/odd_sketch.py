"""Near-duplicate links by MinHash bands, with odd sketches in front of the exact comparison.

1. Every text becomes a set of hashed word shingles. 128 MinHash samples give 32 band keys of
   four samples each, and are folded into an odd sketch: a bitmap of 512 bits in which each
   sample flips one bit. The population count of the XOR of two sketches estimates how many
   samples differ, precisely so at high similarity. Texts with the same set form one class.
2. Classes that share a band are candidates. Each is first held against one leader of its bands
   only, the member whose bands are shared most, so a group of n near copies costs n comparisons,
   not n squared.
3. After the components of these links are known, only bands whose members lie in more than one
   component are left. A member outside the band's largest component stays open if the odd sketch
   of any member of another component is near its own (a semi-join, which makes no pairs). Open
   members are held against the members of their bands, both in blocks: sketches first, then full sets.
   So every pair that shares a band is either connected already, rejected by its sketches, or
   compared on full sets.

A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8; its sketches are
rejected with about 1e-7 (mean 46 differing bits, deviation 8, bound 88).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import BLOCK, LOWER, mix64, small_batches, spread_table, text_bytes
from msgflow.session import materialize

SAMPLES, BANDS, ROWS = 128, 32, 4
SKETCH_BITS = 512
#: Differing sketch bits up to which a pair is compared exactly.
FAR = 88
#: Rows of open members, and of those they are held against, in one task on average.
BLOCK_ROWS = 1_024
#: Longer words are hashed one by one.
LONG_WORD = 64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LETTERS = spread_table(256, 21)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))
MULTIPLIERS = spread_table(SAMPLES, 22, np.uint32) | np.uint32(1)
SHIFTS = spread_table(SAMPLES, 23, np.uint32)
SKETCH = [f"_s{i}" for i in range(SKETCH_BITS // 64)]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all words of ``data``, block by block; a longer word makes a longer block."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end, step = at + BLOCK, BLOCK
        while end < len(data) and not (gaps := np.flatnonzero(SPACE[data[max(at, end - step) : end]])).size:
            end, step = end + BLOCK, BLOCK
        if end < len(data):
            end = max(at, end - step) + int(gaps[-1]) + 1
        s, h = _block_hashes(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def _block_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # The factor's power depends on the place in the block; bringing every word to the power of
    # its own start makes equal words equal wherever they stand.
    inside = ~SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    powers = np.full(len(data), FACTOR, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(LETTERS[LOWER[data]] * powers, dtype=np.uint64)])
    back = np.full(len(data), INVERSE, np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    hashes = mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    # Running sums collide on long words of a certain build (Thue-Morse, from 2,048 letters on).
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(LOWER[data[starts[i] : ends[i]]].tobytes())
    return starts, hashes



def _positions(count: int) -> np.ndarray:
    """Odd factors, one for each place of a shingle."""
    return spread_table(count, 24) | np.uint64(1)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle."""
    n = len(words)
    if not n:
        return words
    if n < width:
        joined = (words * _positions(n)).sum(dtype=np.uint64, keepdims=True)
        return mix64(joined + np.uint64(n))
    joined = np.zeros(n - width + 1, np.uint64)
    for i, factor in enumerate(_positions(width)):
        joined += words[i : n - width + 1 + i] * factor
    return np.unique(mix64(joined + np.uint64(width)))


def minhash(members: np.ndarray) -> np.ndarray:
    """The smallest value of each of the 128 hash functions over a set."""
    small = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(members), 1024):
        x = (members[at : at + 1024] >> np.uint64(32)).astype(np.uint32)[:, None] ^ SHIFTS
        x *= MULTIPLIERS
        x ^= x >> np.uint32(15)
        np.minimum(small, x.min(axis=0), out=small)
    return small


BAND_SALT = spread_table(BANDS, 25)
ROW_FACTORS = spread_table(ROWS, 26) | np.uint64(1)
SAMPLE_SALT = spread_table(SAMPLES, 27)


def band_keys(samples: np.ndarray) -> np.ndarray:
    grouped = samples.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mix64((grouped * ROW_FACTORS).sum(axis=2, dtype=np.uint64) ^ BAND_SALT)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Each sample flips one bit of its row's bitmap; rows of 64-bit words."""
    bits = (mix64(samples.astype(np.uint64) ^ SAMPLE_SALT) >> np.uint64(64 - 9)).astype(np.int64)
    flat = bits + np.arange(len(samples))[:, None] * SKETCH_BITS
    parity = np.bincount(flat.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(samples), -1), axis=1).view(np.int64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    data, offsets = text_bytes(batch.column(1))
    # A blank after each text keeps its last word apart from the next text's first one.
    shift = np.arange(len(offsets))
    padded = np.full(len(data) + len(offsets) - 1, 32, np.uint8)
    padded[np.arange(len(data)) + np.repeat(shift[:-1], np.diff(offsets))] = data
    starts, hashes = word_hashes(padded)
    cuts = np.searchsorted(starts, offsets + shift)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield shingle_set(hashes[a:b], width)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, samples = [], [], []
            for members in _sets(batch, width):
                sizes.append(len(members))
                classes.append(xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None)
                samples.append(minhash(members))
            stacked = np.array(samples, np.uint32).reshape(-1, SAMPLES)
            keys = band_keys(stacked).astype(np.int64)
            sketches = odd_sketches(stacked)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), lists,
                 *[pa.array(sketches[:, i].copy()) for i in range(len(SKETCH))]],
                ["_id", "_digest", "_size", "_class", "_bands", *SKETCH],
            )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch, width))
            ends = np.cumsum([0, *[len(s) for s in sets]]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["_id", "_set"]
            )

    return run


def connected(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: (_id, _root), by large-star and small-star rounds.

    ``edges`` has columns a and b. A hub's neighbours are never gathered: each round takes the
    smallest neighbour as an aggregate and joins it back.
    """
    pairs = lambda d: d.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    mark = lambda d: tuple(d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    table = materialize(pairs(edges))
    state = mark(table)
    while state[0]:
        both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("_least")))
        large = materialize(pairs(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))))
        least = materialize(large.groupBy("a").agg(F.min("b").alias("_least")))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
        table = materialize(pairs(moved.unionByName(least.select("a", F.col("_least").alias("b")))))
        now = mark(table)
        if now == state:
            break
        state = now
    roots = table.select(F.col("a").alias("_id"), F.col("b").alias("_root"))
    return materialize(roots.unionByName(table.select(F.col("b").alias("_id"), F.col("b").alias("_root")).distinct()))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("_id").alias("a"), F.col("_set").alias("_set_a"))
    right = sets.select(F.col("_id").alias("b"), F.col("_set").alias("_set_b"))
    common = F.size(F.array_intersect("_set_a", "_set_b"))
    union = F.size("_set_a") + F.size("_set_b") - F.col("_common")
    return materialize(
        pairs.join(left, "a").join(right, "b").withColumn("_common", common)
        .filter(100 * F.col("_common") >= percent * union).select("a", "b").distinct()
    )


def _links_between(percent: int):
    def run(asking: pa.Table, against: pa.Table) -> pa.Table:
        """Links of open members to members of other components, one for each component."""
        part = lambda t: (
            t["_id"].to_numpy(), t["_root"].to_numpy(),
            # Unsigned: numpy counts the bits of a negative number's absolute value.
            np.stack([t[c].to_numpy().view(np.uint64) for c in SKETCH], axis=1),
            [x.values.to_numpy() for x in t["_set"]],
        )
        ids, roots, sketches, sets = part(against)
        sizes = np.array([len(x) for x in sets], np.int64)
        a, b = [], []
        for one, root, sketch, own in zip(*part(asking)):
            apart = np.bitwise_count(sketches ^ sketch).sum(axis=1, dtype=np.int64)
            # Sets of too different sizes cannot be similar.
            fits = (100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))) & (roots != root)
            linked: set[int] = set()
            hits = np.flatnonzero(fits & (apart <= FAR))
            for i in hits[np.argsort(apart[hits], kind="stable")].tolist():
                if roots[i] in linked:
                    continue
                common = len(np.intersect1d(own, sets[i], assume_unique=True))
                if 100 * common >= percent * (len(own) + len(sets[i]) - common):
                    linked.add(roots[i])
                    a.append(int(one))
                    b.append(int(ids[i]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, kept.

    Words are separated by ASCII white space and lowered in A-Z. Documents are linked when their
    shingle sets have 100 * intersection >= percent * union; ``component_id`` is the smallest key
    reachable over links. A text without words (or null) has no shingles and is linked with
    nothing; a text of fewer words than ``width`` is one shingle. Rows that share a key count as
    one document in links. A null key has component null and is kept. An empty table gives no
    rows; other columns are not looked at. Keys are integers.
    """
    return _groups(docs, key, text, width, percent).drop("_digest")


def text_digest(text: str):
    return F.unhex(F.md5(F.col(f"`{text}`").cast("string").cast("binary")))


def _groups(docs: DataFrame, key: str, text: str, width: int, percent: int, digests: bool = False) -> DataFrame:
    """``near_groups`` with the digest of each row's text, if wanted."""
    texts = small_batches(docs).select(
        F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"),
        (text_digest(text) if digests else F.lit(None).cast("binary")).alias("_digest"))
    longs = ", ".join(f"{c} bigint" for c in SKETCH)
    table = materialize(texts.mapInArrow(
        _signatures(width), f"_id bigint, _digest binary, _size bigint, _class binary, _bands array<bigint>, {longs}"))
    usable = table.filter("_class IS NOT NULL AND _id IS NOT NULL")
    classes = materialize(usable.groupBy("_class").agg(F.min("_id").alias("_first")))
    firsts = materialize(
        usable.join(classes.withColumnRenamed("_first", "_id"), ["_class", "_id"], "left_semi")
        .select("_id", "_bands", *SKETCH)
    )
    banded = firsts.select("_id", F.explode("_bands").alias("_band"))
    shared = materialize(
        banded.groupBy("_band").agg(F.min("_id").alias("_least"), F.max("_id").alias("_most"), F.count(F.lit(1)).alias("_members"))
        .filter("_least < _most").select("_band", "_members")
    )
    members = materialize(banded.join(shared, "_band").distinct())
    shares = materialize(members.groupBy("_id").agg(F.sum("_members").alias("_shares")))
    leaders = materialize(
        members.join(shares, "_id").groupBy("_band")
        .agg(F.max_by("_id", F.struct("_shares", -F.col("_id"))).alias("_leader"), F.max("_shares").alias("_shares"))
    )
    star = materialize(
        members.join(leaders, "_band").filter("_id <> _leader").groupBy("_id")
        .agg(F.max_by("_leader", F.struct("_shares", -F.col("_leader"))).alias("b")).withColumnRenamed("_id", "a")
    )
    wanted = materialize(members.select("_id").distinct())
    sets = materialize(
        texts.join(wanted, "_id", "left_semi").mapInArrow(_full_sets(width), "_id bigint, _set array<bigint>")
    )
    links = confirm(star, sets, percent)
    roots = connected(links)
    labelled = materialize(
        members.join(roots, "_id", "left").select("_band", "_id", F.coalesce("_root", "_id").alias("_root"))
    )
    mixed = (
        labelled.groupBy("_band", "_root").count().groupBy("_band")
        .agg(F.max_by("_root", "count").alias("_largest"), F.count(F.lit(1)).alias("_roots"))
        .filter("_roots > 1").select("_band", "_largest")
    )
    open_bands = materialize(labelled.join(materialize(mixed), "_band"))
    sketched = materialize(open_bands.join(firsts.select("_id", *SKETCH), "_id"))
    here, there = sketched.filter("_root <> _largest").alias("x"), sketched.alias("y")
    distance = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in SKETCH[1:]),
                   F.bit_count(F.col(f"x.{SKETCH[0]}").bitwiseXOR(F.col(f"y.{SKETCH[0]}"))))
    near = (F.col("x._band") == F.col("y._band")) & (F.col("x._root") != F.col("y._root")) & (distance <= FAR)
    open_ones = materialize(here.join(there, near, "left_semi").select("x.*"))
    partners = there.join(open_ones.alias("x"), near, "left_semi").select("y._id", "y._largest").distinct()
    rows = lambda of: of.join(roots, "_id", "left").join(firsts.select("_id", *SKETCH), "_id").join(sets, "_id").select(
        "_id", F.coalesce("_root", "_id").alias("_root"), "_largest", *SKETCH, "_set")
    asked, partners = open_ones.select("_id", "_largest").distinct(), materialize(partners)
    # Both sides are cut, so that a task holds two blocks, however many members are open.
    blocks = materialize(
        partners.groupBy("_largest").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_blocks"))
        .join(asked.groupBy("_largest").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_asks")), "_largest")
    )
    own = lambda blocks: F.pmod(F.xxhash64("_id"), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    against = rows(partners).join(blocks, "_largest").withColumn("_block", own("_blocks")).withColumn("_ask", every("_asks"))
    asking = materialize(rows(asked).join(blocks, "_largest").withColumn("_ask", own("_asks")))
    asking = asking.withColumn("_block", every("_blocks"))
    more = materialize(
        asking.groupBy("_largest", "_ask", "_block").cogroup(against.groupBy("_largest", "_ask", "_block"))
        .applyInArrow(_links_between(percent), "a bigint, b bigint")
    )
    if not more.isEmpty():
        roots = connected(links.unionByName(more))
    # The class's smallest member is a node, so a root is the smallest document of its component.
    of_class = materialize(
        classes.join(roots, classes["_first"] == roots["_id"], "left")
        .select("_class", F.coalesce("_root", "_first").alias("component_id"))
    )
    decided = table.select("_id", "_digest", "_size", "_class").join(of_class, "_class", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id"))
    return decided.select(
        F.col("_id").alias(key), F.col("_size").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"), "_digest",
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest key.

    Of rows that share a key but not their text, each goes or stays as ``near_groups`` marks it.
    """
    gone = materialize(
        _groups(docs, key, text, width, percent, True).filter("NOT kept")
        .select(F.col(key).alias("_gone"), F.col("_digest").alias("_gone_text")).distinct()
    )
    same = (F.col(f"`{key}`") == gone["_gone"]) & (text_digest(text) == gone["_gone_text"])
    return docs.join(gone, same, "left_anti")
