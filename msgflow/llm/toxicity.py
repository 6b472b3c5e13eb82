"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with marks at its ends) and itself, each hashed to
a row of an embedding table; a text is the average of the rows of all its words, and a linear
softmax over that average gives the class. Table and softmax are trained jointly in numpy, on a
bounded sample of labelled rows. A misspelling shares most n-grams with the word it stands for,
so it lies near it without having been seen.

Since all is linear before the softmax, the trained model folds to one weight for each row of the
table: tasks sum the folded weights of a text's words, in one pass over the texts, without a
shuffle. The folded table has a fixed size and is broadcast.
"""

import re
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence  # noqa: TC003  (read by pandas_udf)
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import mix64, small_batches, spread_table
from msgflow.session import materialize

BUCKETS = 1 << 18
WIDTH = 8
SHORTEST, LONGEST = 3, 6
#: At most so many rows of label 1 and of label 0 are trained on; the bound is a parameter.
SAMPLE = (1500, 4000)
ROUNDS, RATE, DECAY = 150, 0.05, 1e-5
#: Longer texts (in characters) are not drawn for training. Scoring always reads whole texts.
LONG_TEXT = 200_000
#: Averages are scaled by this before the softmax, as few words of a text are telling.
SCALE = 20.0
#: Deviations by which a row's share of texts must differ between the classes, in how many texts at least.
CLEAR, LEAST = 6.0, 8
#: Few labelled rows cannot show as much: then this share of the most they can, in this share of the smaller class.
CLEAR_SHARE, LEAST_SHARE = 0.5, 0.25
#: Log-odds where there is nothing to learn from: a score of 0.018.
UNKNOWN = -4.0
#: Texts whose subwords are spread out at a time.
STRETCH = 64
WORD = re.compile(r"\w+")
#: Words a worker keeps the weight of before it starts a new generation, and the longest it keeps.
KEPT, LONG_WORD = 75_000, 64
#: Characters that are hashed by one numpy pass; longer words are passed in slices.
SLICE = 1 << 18
#: Bytes of text that go to the driver for training, at most.
SAMPLE_BYTES = 48 << 20
#: Characters of text whose words are looked up together.
TOGETHER = 1 << 20
FACTORS = spread_table(LONGEST, 41) | np.uint64(1)
POWER = 0x9E3779B97F4A7C15
SHIFT = np.uint64(64 - (BUCKETS - 1).bit_length())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _row(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rows of the table for hashes of n-grams of one size (0: whole words)."""
    return (mix64(hashes + np.uint64(size)) >> SHIFT).astype(np.int64)


def _grams(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Size and hash at each place of all n-grams, each size from the one before."""
    n = len(codes)
    hashes = np.zeros(n, np.uint64)
    for size in range(1, min(LONGEST, n) + 1):
        hashes = hashes[: n - size + 1] + codes[size - 1 :] * FACTORS[size - 1]
        if size >= SHORTEST:
            yield size, _row(hashes, size)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(POWER), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def subwords(words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the table for all words, in parts: number of the word, and row.

    A word has a row for itself, with marks at its ends, and for each of its n-grams.
    """
    lo = 0
    while lo < len(words):
        hi, size = lo, 0
        while hi < len(words) and (hi == lo or size + len(words[hi]) + 2 <= SLICE):
            size += len(words[hi]) + 2
            hi += 1
        if size > SLICE:
            yield from _long_word(words[lo], lo)
        else:
            yield from _short_words(words[lo:hi], lo)
        lo = hi


def _short_words(words: Sequence[str], number: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes = _codes("".join([f"<{w}>" for w in words]))
    lengths = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    left = ends[word] - np.arange(len(codes))
    for size, rows in _grams(codes):
        inside = np.flatnonzero(left[: len(rows)] >= size)
        yield number + word[inside], rows[inside]
    starts = ends - lengths
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    whole = np.add.reduceat(codes * _powers(int(lengths.max()))[place], starts)
    yield number + np.arange(len(words)), _row(whole, 0)


def _long_word(word: str, number: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    n, whole, scale = len(word) + 2, 0, 1
    for lo in range(0, n, SLICE):
        hi = lo + SLICE + LONGEST - 1
        part = ("<" if lo == 0 else "") + word[max(lo - 1, 0) : hi - 1] + (">" if hi >= n else "")
        codes = _codes(part[: hi - lo])
        own = codes[:SLICE]
        for _, rows in _grams(codes):
            rows = rows[:SLICE]  # n-grams that start later are the next slice's
            yield np.full(len(rows), number), rows
        whole = (whole + scale * int((own * _powers(len(own))).sum(dtype=np.uint64))) & (2**64 - 1)
        scale = scale * pow(POWER, len(own), 1 << 64) & (2**64 - 1)
    yield np.array([number]), _row(np.array([whole], np.uint64), 0)


def weigh(words: Sequence[str], folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the weights of each word's rows, and how many rows it has."""
    sums, counts = np.zeros(len(words)), np.zeros(len(words), np.int64)
    for word, rows in subwords(words):
        if len(word):
            first, last = int(word[0]), int(word[-1]) + 1
            sums[first:last] += np.bincount(word - first, folded[rows], last - first)
            counts[first:last] += np.bincount(word - first, minlength=last - first)
    return sums, counts


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Bags:
    """Texts as counts of words, words as subwords, both as flat arrays."""

    def __init__(self, texts: Sequence[str]):
        # Compact arrays: the driver holds this for the whole sample.
        number: dict[str, int] = {}
        ids, counts, lengths = array("i"), array("i"), []
        for text in texts:
            bag = Counter(words_of(text))
            ids.extend(number.setdefault(w, len(number)) for w in bag)
            counts.extend(bag.values())
            lengths.append(len(bag))
        self.word, self.count = (np.frombuffer(x, np.int32) for x in (ids, counts))
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        parts = [(w.astype(np.int32), r.astype(np.int32)) for w, r in subwords(list(number))]
        word = np.concatenate([np.zeros(0, np.int32), *[w for w, _ in parts]])
        gram = np.concatenate([np.zeros(0, np.int32), *[r for _, r in parts]])
        del parts
        self.size = np.bincount(word, minlength=len(number)).astype(np.int64)
        self.gram = gram[np.argsort(word, kind="stable")]
        self.first = np.cumsum(self.size) - self.size
        #: Subwords of each text, repeats counted.
        self.total = np.maximum(np.bincount(self.doc, self.count * self.size[self.word], len(texts)), 1)

    def pairs(self, lo: int, hi: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, row of the table and count of the subwords of texts lo to hi whose row is kept."""
        a, b = np.searchsorted(self.doc, [lo, hi])
        if not len(self.word):
            return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        word = self.word[a:b]
        size = self.size[word]
        ends = np.cumsum(size)
        place = np.repeat(self.first[word] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        row = self.gram[place]
        held = keep[row]
        return np.repeat(self.doc[a:b], size)[held], row[held], np.repeat(self.count[a:b], size)[held]


def telling_rows(bags: Bags, y: np.ndarray) -> np.ndarray:
    """Rows of the table that occur in clearly more texts of one class than of the other.

    The others would only learn single texts by heart; their vectors stay zero, but they count
    in every average. A row that tells n texts apart without fault differs by sqrt(n) deviations,
    so the bounds are scaled to the labelled rows, and further down until rows remain; no row is
    left only if none occurs more often in one class than in the other.
    """
    seen = np.zeros((2, BUCKETS))
    everything = np.ones(BUCKETS, bool)
    for lo in range(0, len(y), STRETCH):
        doc, row, _ = bags.pairs(lo, lo + STRETCH, everything)
        once = np.unique(doc.astype(np.int64) * BUCKETS + row)
        for label in (0, 1):
            seen[label] += np.bincount(once[y[once // BUCKETS] == label] % BUCKETS, minlength=BUCKETS)
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)[:, None]
    rate, all_rate = seen / n, seen.sum(axis=0) / len(y)
    spread = np.sqrt(np.maximum(all_rate * (1 - all_rate), 1e-9) * (1 / n).sum())
    texts, apart = seen.sum(axis=0), np.abs(rate[1] - rate[0]) / spread
    clear, least = min(CLEAR, CLEAR_SHARE * len(y) ** 0.5), min(LEAST, max(1, int(LEAST_SHARE * n.min())))
    while True:
        keep = (apart > clear) & (texts >= least)
        if keep.any() or (least == 1 and not (apart > 1e-9).any()):
            return keep
        clear, least = clear * 0.75, max(1, least // 2)


class Model(NamedTuple):
    """Vectors of the rows of the table that were trained (all others are zero), softmax and bias."""

    used: np.ndarray
    table: np.ndarray
    soft: np.ndarray
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, float]:
        """One weight for each row of the table, and a bias, for the log-odds of label 1."""
        weights = np.zeros(BUCKETS, np.float32)
        weights[self.used] = self.table @ (self.soft[:, 1] - self.soft[:, 0]) * SCALE
        return weights, float(self.bias[1] - self.bias[0])


def constant_model(odds: float) -> Model:
    return Model(np.zeros(0, np.int64), np.zeros((0, WIDTH)), np.zeros((WIDTH, 2)), np.array([0.0, odds]))


def train(texts: Sequence[str], labels: Sequence[int]) -> Model:
    """Table and softmax, trained jointly."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        # Nothing to tell apart: always the only class, or 0 without rows.
        return constant_model(-UNKNOWN if len(y) and y[0] else UNKNOWN)
    bags = Bags(texts)
    keep = telling_rows(bags, y)
    if not keep.any():
        return constant_model(UNKNOWN)
    parts = [bags.pairs(lo, lo + STRETCH, keep) for lo in range(0, len(y), STRETCH)]
    doc, row, count = (np.concatenate(x) for x in zip(*parts))
    used, row = np.unique(row, return_inverse=True)
    key, place = np.unique(doc.astype(np.int64) * (len(used) + 1) + row, return_inverse=True)
    weight = np.bincount(place, count, len(key))
    doc, row = key // (len(used) + 1), key % (len(used) + 1)
    weight = (weight * SCALE / bags.total[doc])[:, None]
    rng = np.random.default_rng(7)
    table = rng.uniform(-1, 1, (len(used), WIDTH)) / WIDTH
    soft, bias = rng.normal(0, 1, (WIDTH, 2)) / WIDTH, np.zeros(2)
    goal = np.stack([y == 0, y == 1], axis=1).astype(float)
    share = (0.5 / goal.mean(axis=0))[y][:, None] / len(y)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, soft, bias)]
    for step in range(1, ROUNDS + 1):
        mean = _sums(table[row] * weight, doc, len(y))
        odds = mean @ soft + bias
        p = np.exp(odds - odds.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        back = (p - goal) * share
        to_mean = back @ soft.T
        grads = (_sums(to_mean[doc] * weight, row, len(used)) + DECAY * table, mean.T @ back + DECAY * soft, back.sum(axis=0))
        for value, grad, (m, v) in zip((table, soft, bias), grads, moments):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Model(used, table, soft, bias)


def _sums(rows: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by group number."""
    return np.stack([np.bincount(of, rows[:, k], n) for k in range(rows.shape[1])], axis=1)


class Scorer:
    """Scores whole texts with folded weights.

    What is kept, by word as it stands between blanks: the sum of its weights and their number. There
    are two generations, so that what is asked for again outlives the change to a new one.
    """

    def __init__(self, folded: np.ndarray, bias: float):
        self.folded, self.bias = folded, bias
        self.young: dict[str, tuple[float, int]] = {}
        self.old: dict[str, tuple[float, int]] = {}

    def _weights(self, wanted: set[str]) -> dict[str, tuple[float, int]]:
        """Sum and number of the weights of each chunk."""
        young, old = self.young, self.old
        out = {c: young.get(c) or old.get(c) for c in wanted}
        new = [c for c, known in out.items() if known is None]
        if new:
            words = [WORD.findall(c) for c in new]
            sums, counts = weigh([w for ws in words for w in ws], self.folded)
            ends = np.cumsum([len(ws) for ws in words])
            total = np.concatenate([[0.0], np.cumsum(sums)])
            rows = np.concatenate([[0], np.cumsum(counts)])
            starts = ends - [len(ws) for ws in words]
            alone = (ends - starts) == 1
            # A difference of running sums loses digits; most chunks are one word.
            each = np.where(alone, sums[np.minimum(starts, max(len(sums) - 1, 0))] if len(sums) else 0.0, total[ends] - total[starts])
            out.update(zip(new, zip(each.tolist(), (rows[ends] - rows[starts]).tolist())))
        short = {c: v for c, v in out.items() if len(c) <= LONG_WORD}
        young.update(short)
        if len(young) >= KEPT:
            self.young, self.old = {}, young
        return out

    def odds(self, texts: Sequence[str]) -> list[float]:
        """Log-odds of label 1."""
        out: list[float] = []
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= TOGETHER):
                size += len(texts[hi])
                hi += 1
            chunks = [t.lower().split() for t in texts[lo:hi]]
            known = self._weights(set().union(*chunks))
            for some in chunks:
                pairs = [known[c] for c in some]
                rows = sum([n for _, n in pairs])
                out.append(self.bias + (sum([s for s, _ in pairs]) / rows if rows else 0.0))
            lo = hi
        return out


def held_out(key: str):
    """Rows of one in five keys, and those without a key, are never trained on."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
    bounds: tuple[int, int] = SAMPLE, long_text: int = LONG_TEXT, most_bytes: int = SAMPLE_BYTES,
) -> list:
    """At most ``bounds`` rows of label 1 and 0, chosen by a hash of the key; texts and labels.

    Keys whose text is longer than ``long_text`` are left out before the draw; each label's rows end
    where half of ``most_bytes`` is used up.
    """
    sizes = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text")).filter(
        F.length("_text") <= long_text
    ).groupBy("_id").agg(F.max(F.octet_length("_text")).alias("_bytes"))
    clear = (
        labels.filter(F.col(label).isin(0, 1) & ~held_out(key)).groupBy(F.col(key).alias("_id"))
        .agg(F.min(label).alias("_label"), F.max(label).alias("_most")).filter("_label = _most")
        .join(sizes, "_id")
    )
    chosen = None
    for value, bound in ((1, bounds[0]), (0, bounds[1])):
        some = clear.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(bound)
        chosen = some if chosen is None else chosen.unionByName(some)
    chosen = materialize(chosen.select("_id", "_label", "_bytes", F.xxhash64("_id").alias("_order")))
    # At most sum(bounds) rows: ids and sizes only.
    picked, used = [], {0: 0, 1: 0}
    for r in sorted(chosen.collect(), key=lambda r: (r["_order"], r["_id"])):
        used[r["_label"]] += r["_bytes"]
        if used[r["_label"]] <= most_bytes // 2:
            picked.append((r["_id"], r["_label"]))
    spark = docs.sparkSession
    few = spark.createDataFrame(picked, chosen.select("_id", "_label").schema)
    rows = (
        docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
        .join(F.broadcast(few), "_id")
        .filter(F.length("_text") <= long_text).groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    )
    return sorted((r["_id"], r["_text"], int(r["_label"])) for r in rows.collect())


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    bounds: tuple[int, int] = SAMPLE, long_text: int = LONG_TEXT, most_bytes: int = SAMPLE_BYTES,
) -> tuple[np.ndarray, float]:
    """Train on the labelled rows that are not held out; without such rows every score is low."""
    rows = training_sample(docs, labels, key, text, label, bounds, long_text, most_bytes)
    return train([t for _, t, _ in rows], [y for _, _, y in rows]).folded()


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text"):
    """A column of scores from 0 to 1 for the whole texts; a null text scores as an empty one."""
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(model)  # one float for each row of the table

    def odds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*shared.value)
        for texts in batches:
            yield pd.Series(scorer.odds([t or "" for t in texts]), dtype="float64")

    return F.lit(1.0) / (1.0 + F.exp(-F.pandas_udf(odds, "double")(F.col(f"`{text}`"))))


def toxicity_report(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", **sample
) -> DataFrame:
    """One row per row of ``docs``: key, held_out, score, predicted.

    Learns from ``labels`` (key, label 0 or 1; other labels and keys with both are left out),
    never from held-out rows. If the classes have the same words, every score is low. Null and empty texts get the score of the bias alone. Rows that
    repeat score alike; an empty table gives no rows; without labels of both classes all texts
    get one score. Other columns are not looked at. ``sample``: the bounds of ``training_sample``.
    """
    scored = score(docs, fit(docs, labels, key, text, label, **sample), text)
    return docs.select(
        F.col(f"`{key}`").alias(key), held_out(key).alias("held_out"), scored.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", **sample
) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5."""
    return docs.filter(score(docs, fit(docs, labels, key, text, label, **sample), text) < 0.5)
