"""Audit of filter orders by an incremental stream that takes back what it counted too early.

Four filters look at a text alone; the fifth fails a document whose text a smaller id has too, which
only the whole table can tell. The files are read as available-now micro-batches. Each document is
counted at once in its part's counters, under the mask of the filters it fails; a keyed state remembers, for
each text, the smallest id so far and what was counted for it. If a smaller id arrives later, the
earlier document fails as well: its count under the old mask is retracted and made again under the
new one. Counters are sums of such changes, so any order of arrival gives the same numbers.

- Before the shuffle a task settles its own copies: in a batch of rows only the smallest id of a
  text goes on to the state, the others are counted there. A text that a third of all documents
  share is a few rows for each batch.
- The state holds texts by digest, packed into a fixed number of buckets, so that a micro-batch
  costs a merge of arrays for each bucket it touches rather than a call for each text.
- All orders and steps follow from the counters of (part, mask): 80 sums for each part, one for each
  filter and set of filters before it, give its 600 rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from typing import Optional

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from msgflow.operators.joins import BROADCAST_ROWS
from msgflow.session import materialize, run_dir

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
SIGNS = "[#$%&*|]"
#: Micro-batches that a table is read in, and texts that a state bucket is planned for.
MICRO_BATCHES, BUCKET_TEXTS = 4, 4_096
#: Pass-through keys for counts that are final already.
SETTLED_KEYS = 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Settings of the state. RocksDB reserves some MB for the logs of each store, many times what a bucket holds; not here.
STATE_CONF = {PROVIDER: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}

TEXT = ["h1", "h2"]
INFO = ["part", "mask", "good", "toxic"]
ROW_SCHEMA = (
    "bucket int, h1 bigint, h2 bigint, id bigint, part string, mask int, good boolean, toxic boolean, n bigint"
)
CHANGE_SCHEMA = "part string, mask int, good boolean, toxic boolean, n bigint"


def own_mask(text):
    """Bits of the filters that a text fails by itself: A to D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": n < LEAST_WORDS,
        "B": 100 * distinct.cast("long") < DISTINCT_PERCENT * n.cast("long"),
        "C": 100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(text).cast("long"),
        "D": text.rlike(SIGNS),
    }
    bits = [F.when(c, F.lit(1 << FILTERS.index(k))).otherwise(F.lit(0)) for k, c in fails.items()]
    return bits[0] + bits[1] + bits[2] + bits[3]


# -- changes --------------------------------------------------------------


def _counts(rows: pd.DataFrame, sign: int = 1, copy: bool = False) -> pd.DataFrame:
    out = rows[[*INFO, "n"]].copy()
    out["n"] *= sign
    if copy:
        out["mask"] |= COPY
    return out


def _summed(frames: Sequence[pd.DataFrame], by: Sequence[str]) -> pd.DataFrame:
    rows = pd.concat(frames, ignore_index=True)
    return rows.groupby(list(by), sort=False, as_index=False)["n"].sum()


def settle(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(rows of the smallest id of each text, rows that share a text with a smaller id)."""
    least = rows.groupby(TEXT, sort=False)["id"].transform("min")
    return rows[rows["id"] == least], rows[rows["id"] > least]


def advance(state: Optional[pd.DataFrame], new: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """State and changes after new rows: the smallest ids, and what the counters gain or lose.

    Rows in the state are counted as the first of their text already. Those that a smaller id
    now precedes are retracted and counted again as copies.
    """
    new = new.assign(known=False)
    rows = new if state is None else pd.concat([state.assign(known=True), new], ignore_index=True)
    first, later = settle(rows)
    late_known = later[later["known"]]
    changes = _summed(
        [_counts(first[~first["known"]]), _counts(later, copy=True), _counts(late_known, -1)], INFO
    )
    return _summed([first], [*TEXT, "id", *INFO]), changes[changes["n"] != 0]


def _combine(buckets: int):
    """Settle the copies inside one batch of rows; only first ones go on to the state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            rows = batch.to_pandas()
            digest = pc.binary_slice(batch.column(batch.schema.get_field_index("digest")), 0, 16)
            words = memoryview(b"".join(digest.to_pylist())).cast("q").tolist()
            rows["h1"], rows["h2"], rows["n"] = words[::2], words[1::2], 1
            # A row without an id is nobody's copy and makes none.
            bare = rows["id"].isna()
            rows["id"] = rows["id"].fillna(0).astype("int64")
            first, later = settle(rows[~bare])
            first = _summed([first], [*TEXT, "id", *INFO])
            first["bucket"] = first["h1"] % buckets
            done = _summed([_counts(rows[bare]), _counts(later, copy=True)], INFO)
            done["bucket"] = -1 - (pd.util.hash_pandas_object(done[INFO], index=False) % SETTLED_KEYS).astype("int64")
            done = done.assign(h1=0, h2=0, id=0)
            schema = schema or pa.schema([
                ("bucket", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("part", pa.string()),
                ("mask", pa.int32()), ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64()),
            ])
            both = pd.concat([first, done], ignore_index=True)[schema.names]
            yield from pa.Table.from_pandas(both, schema, preserve_index=False).to_batches()

    return run


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_pandas()


def _pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def keep_first(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One bucket of texts in one micro-batch: merge, remember, give out the changes."""
    if key[0] < 0:
        for rows in frames:
            yield rows[[*INFO, "n"]]
        return
    held = _unpack(state.get[0]) if state.exists else None
    for rows in frames:
        held, changes = advance(held, rows.drop(columns="bucket"))
        if len(changes):
            yield changes
    state.update((_pack(held),))


def audit_changes(stream: DataFrame, labels: DataFrame, buckets: int, key: str, text: str, part: str) -> DataFrame:
    """Stream of documents -> changes of the counters. ``labels`` has one row per key: key, good, toxic."""
    # The document goes into names of its own before anything joins it.
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = stream.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        own_mask(body).alias("mask"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"),
    )
    known = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    labelled = rows.join(labels, "id", "left").select("id", "part", "mask", "digest", known("good"), known("toxic"))
    return (
        labelled.mapInArrow(_combine(buckets), ROW_SCHEMA)
        .groupBy("bucket")
        .applyInPandasWithState(keep_first, CHANGE_SCHEMA, "texts binary", "append", GroupStateTimeout.NoTimeout)
    )


# -- orders ---------------------------------------------------------------


def before_sets() -> list[tuple[int, int, int]]:
    """(filter, mask of the filters before it, number of orders in which just these come before it)."""
    n = len(FILTERS)
    counts: dict[tuple[int, int], int] = {}
    for order in permutations(range(n)):
        earlier = 0
        for f in order:
            counts[f, earlier] = counts.get((f, earlier), 0) + 1
            earlier |= 1 << f
    return [(f, earlier, times) for (f, earlier), times in sorted(counts.items())]


def order_report(counters: DataFrame) -> DataFrame:
    """One row per part, order and step, from counters (part, mask, good, toxic, n)."""
    combos = [F.struct(F.lit(f).alias("f"), F.lit(1 << f).alias("bit"), F.lit(b).alias("earlier"), F.lit(t).alias("times"))
              for f, b, t in before_sets()]
    orders = []
    for order in permutations(range(len(FILTERS))):
        earlier = 0
        for step, f in enumerate(order, 1):
            orders.append((f, earlier, "".join(FILTERS[i] for i in order), step))
            earlier |= 1 << f
    spark = counters.sparkSession
    steps = spark.createDataFrame(orders, "f int, earlier int, filter_order string, step int")  # 600 rows
    n, mask = F.col("n"), F.col("mask")
    hit, gone = mask.bitwiseAND(F.col("bit")) != 0, mask.bitwiseAND(F.col("earlier")) != 0
    total = lambda c: F.sum(F.when(c, n).otherwise(0))
    # 80 sums for each part.
    sums = (
        counters.select("*", F.inline(F.array(*combos))).groupBy("part", "f", "earlier")
        .agg(
            total(~hit & ~gone).alias("kept"), total(hit & ~gone).alias("removed"), total(hit & gone).alias("redundant"),
            total(mask == F.col("bit")).alias("unique_fails"), total(hit & ~gone & F.col("good")).alias("good_lost"),
            total(hit & ~gone & F.col("toxic")).alias("toxic_lost"), F.first("times").alias("times"),
        )
    )
    whole = F.struct("earlier", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost").alias("row")
    # A filter's 16 sets are gathered, as many whatever the table.
    each = (
        sums.groupBy("part", "f").agg(F.sum(F.col("removed") * F.col("times")).alias("shapley"), F.collect_list(whole).alias("rows"))
        .select("part", "f", "shapley", F.inline("rows"))
    )
    return each.join(F.broadcast(steps), ["f", "earlier"]).select(
        "part", "filter_order", "step",
        *[F.col(c).cast("long").alias(c) for c in
          ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")],
    )


# -- runs -----------------------------------------------------------------


def label_flags(labels: DataFrame, key: str = "doc_id", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per key: id, good, toxic; broadcast if there are few. A key with several rows has the largest label."""
    flags = materialize(
        labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(
            F.coalesce(F.max("quality") == 1, F.lit(False)).alias("good"),
            F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic"),
        ).filter("good OR toxic")
    )
    return F.broadcast(flags) if flags.limit(broadcast_rows + 1).count() <= broadcast_rows else flags


def stream_files(spark: SparkSession, path: str, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """The files of a table as a stream of about so many micro-batches."""
    table = spark.read.parquet(path)
    files = table.inputFiles()
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-len(files) // micro_batches)))
    folder, _, name = path.rstrip("/").rpartition("/")
    if len(files) == 1 and files[0].endswith(f"/{name}"):
        # A table that is one file: a stream reads folders.
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def run_audit(
    stream: DataFrame, labels: DataFrame, folder: str, buckets: int,
    key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """Handle what the stream has now, going on from the folder's checkpoint; returns all changes so far.

    A later call with more files continues the same counters. ``buckets`` must stay the same for a folder.
    """
    spark = stream.sparkSession
    changes = audit_changes(stream, labels, buckets, key, text, part)
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():  # state of many texts does not fit a heap
        spark.conf.set(k, v)
    try:
        query = (
            changes.writeStream.format("parquet").option("path", f"{folder}/changes")
            .option("checkpointLocation", f"{folder}/checkpoint").outputMode("append")
            .trigger(availableNow=True).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    return spark.read.schema(CHANGE_SCHEMA).parquet(f"{folder}/changes")


def filter_audit(
    spark: SparkSession, path: str, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
    micro_batches: int = MICRO_BATCHES, buckets: Optional[int] = None, folder: Optional[str] = None,
) -> DataFrame:
    """What each filter removes, in all 120 orders, over the files of the table at ``path``.

    One row per part, filter_order and step (1 to 5): kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley; rows whose counts are all zero are given as well. Null and empty texts are
    equal to each other. A null part is the part ''. A row without an id is no copy and makes none;
    rows that repeat an id are counted each, and none of them makes the others copies. Keys must be
    integers. A key labelled more than once has its largest labels; null or missing labels are 0.
    Texts are told apart by 128 bits of their SHA-256. An empty table gives no rows. Other columns
    are not looked at.
    """
    folder = folder or run_dir(spark, "audit")
    if buckets is None:
        rows = spark.read.parquet(path).count()
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_TEXTS))
    stream = stream_files(spark, path, micro_batches)
    changes = run_audit(stream, label_flags(labels, key), folder, buckets, key, text, part)
    counters = materialize(changes.groupBy(*INFO).agg(F.sum("n").alias("n")).filter("n <> 0"))
    return order_report(counters)
