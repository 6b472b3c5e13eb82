"""Token ids of a corpus in binary files: bit-plane shuffled chunks, compressed plane by plane.

A file holds the ids of consecutive documents, in order of their key, as chunks of a fixed number
of ids. A chunk is transposed into planes - plane b holds bit b (or byte b) of all its ids - and
each plane is compressed on its own, as the high planes of token ids are almost constant while the
low ones are noise (a plane that does not shrink is stored as it is). Behind the chunks follow the
documents' keys and lengths, and a chunk index with the size of every plane, so a reader gets to any
range of ids by decoding the chunks that hold it and nothing else.

Texts are dealt out by ranges of their key and encoded in the task that writes them, so they move once
and nothing lies between text and file. A task writes files of its own under names that no other attempt uses; the manifest, a table that Spark commits, names
the files that count, so a lost executor or a repeated task leaves at most files that nobody reads.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import Optional

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import byte_slices, small_batches
from msgflow.session import file_system, materialize, planned_bytes, run_dir

MAGIC = b"MFLOWIDS"
#: Ids of a chunk, and ids after which a task starts its next file.
CHUNK_IDS, FILE_IDS = 1 << 16, 1 << 26
#: Bytes of the table for each range at most; the session's shuffle partitions are the least number of ranges.
PART_BYTES = 256 << 20
#: Id written behind every document.
END = 0
LEVEL = 3
FOOTER = struct.Struct("<qqqqiii")  # documents at, index at, chunks, ids, bytes of an id, bits of a plane, crc32

# -- planes ---------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: int) -> np.ndarray:
    """Rows of bytes, one for each plane, of an array of unsigned ids."""
    width = ids.dtype.itemsize
    by_byte = ids.view(np.uint8).reshape(len(ids), width)
    if bits == 8:
        return np.ascontiguousarray(by_byte.T)
    return np.packbits(np.unpackbits(by_byte, axis=1, bitorder="little").T, axis=1, bitorder="little")


def from_planes(planes: np.ndarray, n: int, width: int, bits: int) -> np.ndarray:
    kind = np.dtype(f"<u{width}")
    if bits == 8:
        return np.ascontiguousarray(planes.T).view(kind).reshape(n)
    each = np.unpackbits(planes, axis=1, count=n, bitorder="little")
    return np.packbits(np.ascontiguousarray(each.T), axis=1, bitorder="little").view(kind).reshape(n)


# -- one file -------------------------------------------------------------


class IdWriter:
    """Writes one file; ``add`` takes whole documents."""

    def __init__(self, path: str, width: int, bits: int = 8, chunk_ids: int = CHUNK_IDS):
        system, place = file_system(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(place)
        self.width, self.bits, self.chunk_ids = width, bits, chunk_ids
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.at = 0
        self.index: list[int] = []
        self.documents: list[pa.Table] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, keys: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.documents.append(pa.table({"key": keys, "n": pa.array(lengths, pa.int64())}))
        self.waiting.append(ids.astype(f"<u{self.width}"))
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.chunk_ids:
            ready = np.concatenate(self.waiting)
            whole = len(ready) // self.chunk_ids * self.chunk_ids
            for lo in range(0, whole, self.chunk_ids):
                self._chunk(ready[lo : lo + self.chunk_ids])
            self.waiting, self.n_waiting = [ready[whole:]], len(ready) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        self.index.append(len(ids))
        for plane in to_planes(ids, self.bits):
            raw = plane.tobytes()
            small = self.squeeze.compress(raw)
            # The size of a plane that is stored as it is counts below zero.
            stored, size = (small, len(small)) if len(small) < len(raw) else (raw, -len(raw))
            self.index.append(size)
            self._put(stored)

    def close(self) -> None:
        if self.n_waiting:
            self._chunk(np.concatenate(self.waiting))
        documents_at = self.at
        table = pa.concat_tables(self.documents).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        self._put(self.squeeze.compress(sink.getvalue().to_pybytes()))
        index_at, index = self.at, np.array(self.index, "<i8").tobytes()
        self._put(index)
        planes = self.width * 8 // self.bits
        self._put(
            FOOTER.pack(documents_at, index_at, len(self.index) // (planes + 1), self.n_ids,
                        self.width, self.bits, zlib.crc32(index) & 0x7FFFFFFF)
        )
        self._put(MAGIC)
        self.out.close()


class IdFile:
    """Reads one file: its documents, any range of its ids, any one document."""

    def __init__(self, path: str):
        system, place = file_system(path)
        self.source = system.open_input_file(place)
        size = self.source.size()
        tail = self.source.read_at(FOOTER.size + len(MAGIC), size - FOOTER.size - len(MAGIC))
        if tail[-len(MAGIC):] != MAGIC or self.source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a file of ids, or cut off: {path}")
        documents_at, index_at, chunks, self.n_ids, self.width, self.bits, crc = FOOTER.unpack(tail[: FOOTER.size])
        raw = self.source.read_at(size - FOOTER.size - len(MAGIC) - index_at, index_at)
        if zlib.crc32(raw) & 0x7FFFFFFF != crc:
            raise ValueError(f"the chunk index is damaged: {path}")
        planes = self.width * 8 // self.bits
        index = np.frombuffer(raw, "<i8").reshape(chunks, planes + 1)
        self.sizes, self.planes = index[:, 0], index[:, 1:]
        self.id_ends = np.cumsum(self.sizes)
        self.byte_ends = len(MAGIC) + np.cumsum(np.abs(self.planes).sum(axis=1))
        packed = self.source.read_at(index_at - documents_at, documents_at)
        self.documents = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()
        self.lengths = self.documents["n"].to_numpy()
        self.ends = np.cumsum(self.lengths)
        self.expand = zstandard.ZstdDecompressor()

    def chunk(self, number: int) -> np.ndarray:
        n, sizes = int(self.sizes[number]), self.planes[number].tolist()
        total = sum(map(abs, sizes))
        data = self.source.read_at(total, int(self.byte_ends[number]) - total)
        rows, at = [], 0
        for size in sizes:
            part = data[at : at + abs(size)]
            rows.append(np.frombuffer(part if size < 0 else self.expand.decompress(part), np.uint8))
            at += abs(size)
        return from_planes(np.stack(rows), n, self.width, self.bits)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi of the file, from the chunks that hold them."""
        if lo >= hi:
            return np.zeros(0, f"<u{self.width}")
        first, last = np.searchsorted(self.id_ends, [lo, hi - 1], side="right")
        ids = np.concatenate([self.chunk(c) for c in range(first, last + 1)])
        before = int(self.id_ends[first] - self.sizes[first])
        return ids[lo - before : hi - before]

    def document(self, number: int) -> np.ndarray:
        """Ids of the document at a place of this file, with the end id."""
        return self.ids(int(self.ends[number] - self.lengths[number]), int(self.ends[number]))

    def stretches(self, n_ids: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """All documents in order: numbers of the first and behind the last one, and their ids.

        About ``n_ids`` ids at a time, every chunk decoded once.
        """
        held, have, chunk, at = np.zeros(0, f"<u{self.width}"), 0, 0, 0
        while at < len(self.lengths):
            start = int(self.ends[at] - self.lengths[at])
            to = max(at + 1, int(np.searchsorted(self.ends, start + n_ids, side="right")))
            parts = [held]
            while have < self.ends[to - 1]:
                parts.append(self.chunk(chunk))
                have, chunk = int(self.id_ends[chunk]), chunk + 1
            held = np.concatenate(parts)
            size = int(self.ends[to - 1]) - start
            yield at, to, held[:size]
            held, at = held[size:], to


# -- encoding -------------------------------------------------------------


class PieceEncoder:
    """Ids of texts as the tokenizers library gives them, asking it once for each distinct piece.

    The vocabulary's pattern never joins what lies before and after a blank that a visible
    character follows, so a text is cut there and its pieces' ids are put together. Pieces are
    kept in two generations, the older of which is forgotten when the younger one is full.
    """

    #: A blank that no visible character follows.
    OPEN = r" ([\s\p{Z}\x{85}]|$)"
    CUT = re.compile(r" (?=\S)")
    KEPT, LONG, ASKED = 500_000, 64, 4_096

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        #: Bytes of text behind each id; byte-level tokens have one letter for each.
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.lengths[number] = len(token)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ask(self, texts: list[str]) -> list[bytes]:
        """Ids of pieces from the library; those behind a blank in one text, as they keep apart there."""
        out: list[bytes] = [b""] * len(texts)
        blanked = [i for i, t in enumerate(texts) if t.startswith(" ")]
        for lo in range(0, len(blanked), self.ASKED):
            some = blanked[lo : lo + self.ASKED]
            whole = self.library.encode_batch_fast(["".join([texts[i] for i in some])], add_special_tokens=False)[0]
            ids = np.array(whole.ids, self.kind)
            token_ends = np.cumsum(self.lengths[ids])
            ends = np.cumsum([len(texts[i].encode()) for i in some])
            cuts = np.searchsorted(token_ends, ends)
            if not len(ids) or cuts[-1] >= len(ids) or (token_ends[cuts] != ends).any():
                raise ValueError("the vocabulary's pieces do not keep apart; it is no byte-level one")
            raw, at = ids.tobytes(), 0
            for i, cut in zip(some, ((cuts + 1) * self.width).tolist()):
                out[i], at = raw[at:cut], cut
        others = [i for i, t in enumerate(texts) if not t.startswith(" ")]
        found = self.library.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)
        for i, one in zip(others, found):
            out[i] = np.array(one.ids, self.kind).tobytes()
        return out

    def pieces(self, texts: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        out = [young.get(p) for p in texts]
        missing = [i for i, ids in enumerate(out) if ids is None]
        unknown = []
        for i in missing:
            ids = old.get(texts[i])
            if ids is None:
                unknown.append(i)
            else:
                out[i] = ids
        for i, ids in zip(unknown, self.ask([texts[i] for i in unknown])):
            out[i] = ids
        for i in missing:
            if len(texts[i]) <= self.LONG:
                young[texts[i]] = out[i]
        if len(young) >= self.KEPT:
            self.young, self.old = {}, young
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Lengths in ids, and the ids of all texts one after the other."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        plain = pc.invert(pc.match_substring_regex(texts, self.OPEN)).to_numpy(zero_copy_only=False)
        if plain.all():
            parts = pc.split_pattern(texts, " ")
        else:
            parts = pa.array(
                [t.split(" ") if p else self.CUT.split(t) for t, p in zip(texts.to_pylist(), plain.tolist())],
                pa.large_list(pa.large_string()),
            )
        counts = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        words = parts.flatten()
        if not len(words):
            return np.zeros(len(texts), np.int64), np.zeros(0, self.kind)
        # A text's first piece has no blank before it; all others have.
        starts = np.cumsum(counts) - counts
        first = starts[counts > 0]
        coded = words.dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        number[first] = len(coded.dictionary) + np.arange(len(first))
        blanked = [f" {w}" for w in coded.dictionary.to_pylist()]
        distinct = self.pieces(blanked + words.take(pa.array(first)).to_pylist())
        sizes = np.array([len(p) for p in distinct], np.int64) // self.width
        flat, begins = np.frombuffer(b"".join(distinct), self.kind), np.cumsum(sizes) - sizes
        each = sizes[number]
        ends = np.cumsum(each)
        place = np.repeat(begins[number] - (ends - each), each) + np.arange(ends[-1])
        running = np.concatenate([[0], ends])
        bounds = running[np.concatenate([starts, [len(words)]])]
        return np.diff(bounds), flat[place]


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


_BUILT: dict[str, PieceEncoder] = {}


def encoder_of(path: str) -> PieceEncoder:
    """The process's encoder; a worker keeps its pieces from one task to the next."""
    if path not in _BUILT:
        _BUILT.clear()
        _BUILT[path] = PieceEncoder(path)
    return _BUILT[path]


def _with_ends(flat: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(len(flat) + len(lengths), end, flat.dtype)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)] = flat
    return out, lengths + 1


# -- the corpus -----------------------------------------------------------

FILE_ROW = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _write(vocabulary: str, end: int, folder: str, bits: int, chunk_ids: int, file_ids: int):
    """Encode the documents of a range in their order, and write its files; one row for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = encoder_of(vocabulary), TaskContext.get().partitionId(), 0
        out: Optional[IdWriter] = None
        name, n_docs = "", 0

        def closed() -> pa.RecordBatch:
            out.close()
            row = {"part": part, "number": number, "file": name, "n_docs": n_docs, "n_ids": out.n_ids}
            return pa.RecordBatch.from_pylist([row], FILE_ROW)

        for batch in batches:
            for some in byte_slices(batch, "_text"):
                lengths, ids = encoder.encode(some.column(1))
                ids, lengths = _with_ends(ids, lengths, end)
                offsets, lo = _offsets(lengths), 0
                while lo < len(lengths):
                    if out is None:
                        # A name that no other attempt of this task uses.
                        name, n_docs = f"part-{part:05d}-{number:04d}-{uuid.uuid4().hex}.ids", 0
                        out = IdWriter(f"{folder}/{name}", encoder.width, bits, chunk_ids)
                    # Documents up to the one that fills the file.
                    full = offsets[lo] + file_ids - out.n_ids
                    hi = max(lo + 1, min(len(lengths), int(np.searchsorted(offsets, full, side="left"))))
                    out.add(some.column(0)[lo:hi], lengths[lo:hi], ids[offsets[lo] : offsets[hi]])
                    n_docs += hi - lo
                    lo = hi
                    if out.n_ids >= file_ids:
                        yield closed()
                        out, number = None, number + 1
        if out is not None:
            yield closed()

    return run


def write_ids(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", end: int = END,
    folder: Optional[str] = None, bits: int = 8, chunk_ids: int = CHUNK_IDS, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of all whole texts in ascending order of the key; returns the manifest.

    The manifest has one row per file: part and number (which order the files), file (its path),
    n_docs, n_ids and base, the ids in all files before. Each document is followed by the id
    ``end``; a null or empty text is that id alone. Null keys come first; rows that share a
    key are all written, ordered by a hash of their text and then by their place in the table.
    An empty table gives no files. Keys of any type are kept; other columns are not looked at.
    ``bits`` is 1 for bit planes, 8 for byte planes. ``folder`` is a shared folder; without one
    it is made in the session's.
    """
    if bits not in (1, 8):
        raise ValueError("planes hold one bit or eight")
    spark = docs.sparkSession
    folder = (folder or run_dir(spark, "ids")).rstrip("/")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("_key"), body.alias("_text"), F.xxhash64(body).alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    size = planned_bytes(docs)
    # Of a frame that is no table the planner knows no size.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES + 1 if size < 1 << 62 else 1)
    # The last two decide between rows of one key, so the ranges can cut a hot key as well.
    order = [F.col("_key").asc_nulls_first(), F.col("_hash"), F.col("_row")]
    files = materialize(
        small_batches(rows).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("_key", "_text")
        .mapInArrow(_write(vocabulary, end, folder, bits, chunk_ids, file_ids),
                    "part int, number int, file string, n_docs bigint, n_ids bigint")
    )
    # One row per file: the only thing that is ordered in one task.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    return materialize(
        files.select("part", "number", F.concat(F.lit(f"{folder}/"), "file").alias("file"), "n_docs", "n_ids",
                     F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    )


def _read(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                source = IdFile(file)
                for lo, hi, ids in source.stretches():
                    lengths = source.lengths[lo:hi]
                    starts = base + source.ends[lo:hi] - lengths
                    ids, offsets = ids.astype("<u4"), _offsets(lengths)
                    if digest:
                        bounds = offsets.tolist()
                        value = pa.array([zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64())
                    else:
                        value = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int64)))
                    keys = source.documents["key"].slice(lo, hi - lo).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), value],
                        ["key", "start", "n_tokens", "value"],
                    )

    return run


def read_ids(manifest: DataFrame, kind: str = "bigint", digest: bool = False) -> DataFrame:
    """Documents of the files that a manifest names: key, start, n_tokens and value.

    ``value`` is the array of ids, or with ``digest`` their unsigned crc32 as little-endian
    32-bit words. ``start`` counts the ids of all documents before. ``kind`` is the keys' type.
    """
    files = max(1, manifest.count())
    value = "bigint" if digest else "array<bigint>"
    return manifest.repartitionByRange(files, "part", "number").select("file", "base").mapInArrow(
        _read(digest), f"key {kind}, start bigint, n_tokens bigint, value {value}"
    )


def id_file_report(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``, read back from the files: key, start, n_tokens, ids_crc32."""
    kind = docs.schema[key].dataType.simpleString()
    rows = read_ids(write_ids(docs, vocabulary, key, text, **options), kind, digest=True)
    return rows.select(F.col("key").alias(key), "start", "n_tokens", F.col("value").alias("ids_crc32"))
