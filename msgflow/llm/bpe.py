"""Byte-pair encoding by backtracking over longest tokens, and decoding by an offset table.

The merges of a word need not be replayed. A token sequence is what the merges give exactly
when every neighbouring pair is compatible, i.e. the merges of the two tokens' joint text keep
the boundary between them. So a word is covered from the left by the longest token that starts
at each place (found for all places at once by an Aho-Corasick automaton over reversed tokens);
if a token does not go with the one before it, the next shorter token with the same start is
tried, and if none is left, the token before is shortened. A place from which no cover exists is
marked and never entered again, which keeps the work linear in the word's length.

Compatibility of a pair is decided once and kept in a table.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import small_batches

#: Entries of a generation of encoded texts, and of decided pairs before these start anew.
KEPT_WORDS, KEPT_PAIRS = 120_000, 200_000
#: Words longer than this are not kept.
LONG_WORD = 64
#: Tokens decoded by one numpy pass.
DECODE_BLOCK = 1 << 18
#: Rows given back at a time, so that ids and decoded texts of a whole batch are never held.
ROWS = 256


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others get the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    letters = {b: chr(b) for b in plain}
    return [letters.get(b) or chr(next(spare)) for b in range(256)]


class MergeCoder:
    """The merges of one vocabulary. A word is a string of symbols, one for each base token.

    ``bases`` are the base tokens' ids, symbol ``chr(i)`` standing for ``bases[i]``;
    ``merges`` are pairs of ids in order of rank, with the id that each makes.
    """

    def __init__(self, bases: list[int], merges: list[tuple[int, int, int]]):
        n = len(bases)
        self.ids = list(bases)
        rank = {token: i for i, token in enumerate(bases)}
        self.words = [chr(i) for i in range(n)]
        #: The two tokens (as ranks) that a token is merged from; a base token has none.
        self.halves: list[tuple[int, int] | None] = [None] * n
        self.merged: dict[tuple[int, int], int] = {}
        for left, right, made in merges:
            a, b = rank[left], rank[right]
            rank[made] = len(self.ids)
            self.merged[a, b] = len(self.ids)
            self.ids.append(made)
            self.halves.append((a, b))
            self.words.append(self.words[a] + self.words[b])
        if len(set(self.words)) != len(self.words):
            raise ValueError("a token is made by more than one merge")
        self.length = [len(w) for w in self.words]
        self.by_word = by_word = {w: i for i, w in enumerate(self.words)}
        #: The longest token that is a proper beginning of a token.
        self.shorter = [
            next((by_word[w[:k]] for k in range(len(w) - 1, 0, -1) if w[:k] in by_word), -1) for w in self.words
        ]
        self.reversed = ahocorasick.Automaton()
        for i, w in enumerate(self.words):
            self.reversed.add_word(w[::-1], i)
        self.reversed.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    def longest(self, word: str) -> list[int]:
        """For each place the longest token that starts there."""
        n = len(word)
        out = [-1] * n
        for end, token in self.reversed.iter(word[::-1]):
            place = n - 1 - end
            if out[place] < 0 or self.length[token] > self.length[out[place]]:
                out[place] = token
        return out

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._keeps_boundary(a, b)
        return known

    def _keeps_boundary(self, a: int, b: int) -> bool:
        """Whether no merge crosses from token a into token b when both are built side by side.

        Merges happen in order of rank. Going back in time, the younger of the two tokens at
        the boundary is taken apart; whenever the two that then touch have a merge that comes
        before the step just undone, it would have happened across the boundary.
        """
        before = len(self.ids) + 1  # merges of a lower rank come before the step just undone
        while True:
            crossing = self.merged.get((a, b))
            if crossing is not None and crossing < before:
                return False
            left, right = self.halves[a], self.halves[b]
            if left is None and right is None:
                return True
            if right is None or (left is not None and a > b):
                before, a = a, left[1]
            else:
                # At equal rank the left one is built first, so a crossing merge of the
                # rank of b itself would have come before it.
                before, b = b + 1, right[0]

    def encode(self, word: str) -> list[int]:
        n = len(word)
        if not n:
            return []
        if word in self.by_word:
            return [self.ids[self.by_word[word]]]
        starts, length, known = self.longest(word), self.length, self.pairs.get
        dead = bytearray(n + 1)
        chosen: list[int] = []
        at, token = 0, starts[0]
        while True:
            end = at + length[token]
            if dead[end]:
                fits = False
            elif chosen:
                fits = known((chosen[-1], token))
                if fits is None:
                    fits = self.compatible(chosen[-1], token)
            else:
                fits = True
            if fits:
                chosen.append(token)
                if end == n:
                    return [self.ids[t] for t in chosen]
                at, token = end, starts[end]
                continue
            token = self.shorter[token]
            while token < 0:
                dead[at] = 1
                last = chosen.pop()
                at -= length[last]
                token = self.shorter[last]


class Kept(dict):
    """Results by text, in two generations: what is asked for again outlives a change of generation."""

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}

    def keep(self, text: str, out: bytes) -> bytes:
        if len(text) <= LONG_WORD:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[text] = out
        return out


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokenizer:
    """A lower-casing byte-level tokenizer with word ends, from the text of its JSON file."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        bases = [vocab[c] for c in letters] + [vocab[c + self.suffix] for c in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.coder = MergeCoder(bases, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.parts = regex.compile(split["pattern"]["Regex"])
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        blob = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        #: Offset table: the bytes of token i are blob[starts[i]:starts[i + 1]].
        self.starts = np.concatenate([[0], np.cumsum([len(b) for b in blob])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(blob), np.uint8)
        self.known, self.words = Kept(), Kept()
        self.special_parts = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space, as little-endian 32-bit words."""
        out = self.known.older.get(chunk)
        if out is None:
            if chunk.isascii():
                parts = self.parts.findall(chunk.lower())
            else:
                plain = unicodedata.normalize("NFC", chunk).translate(NEWER_CASES).lower()
                # Characters newer than the vocabulary's library are symbols, not letters.
                found = self.parts.finditer(NEWER.sub("\ue000", plain))
                parts = [plain[m.start() : m.end()] for m in found]
            words, make = self.words, self._word
            out = b"".join([words.get(p) or make(p) for p in parts])
        return self.known.keep(chunk, out)

    def _word(self, part: str) -> bytes:
        out = self.words.older.get(part)
        if out is None:
            raw = part.encode("utf-8", "replace")
            out = pack(self.coder.encode(raw[:-1].decode("latin-1") + chr(raw[-1] + 256)))
        return self.words.keep(part, out)

    def _plain(self, text: str) -> bytes:
        chunks = SPACES.split(text) if SEPARATORS.search(text) else text.split()
        known, make = self.known, self._chunk
        return b"".join([known.get(c) or make(c) for c in chunks if c])

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return self._plain(text)
        return b"".join(
            pack([self.special[p]]) if p in self.special else self._plain(p)
            for p in self.special_parts.split(text)
        )

    def forget(self) -> None:
        """Drop what was kept: a worker lives on after its task, beside those of other stages."""
        for kept in (self.known, self.words):
            kept.clear()
            kept.older = {}
        self.coder.pairs.clear()

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens with blanks between them, copied out of the offset table."""
        out = []
        for i in range(0, len(ids), DECODE_BLOCK):
            part = ids[i : i + DECODE_BLOCK]
            first, size = self.starts[part], self.starts[part + 1] - self.starts[part]
            ends = np.cumsum(size)
            place = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
            out.append(self.blob[place].tobytes())
        return b"".join(out)[:-1]


# Ranges of letters and numbers newer than Unicode 16, which the tokenizers
# library classes as symbols and the regex module as letters or numbers.
NEWER_RANGES = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf
10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f
12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2
18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff
1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e
2cea2-2cead 323b0-33479 3d000-3fc3f
""".split()
NEWER = regex.compile("[" + "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in NEWER_RANGES) + "]")
# Lower-case forms newer than Python's tables, and the sigma, whose form at the
# end of a word is not used here.
NEWER_CASES = {0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
               0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEWER_CASES |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
#: str.split takes these for white space, the vocabulary's pattern does not.
SEPARATORS = regex.compile("[\x1c-\x1f]")
SPACES = regex.compile(r"\s+")

_BUILT: dict[str, WordTokenizer] = {}


def tokenizer_of(definition: str, digest: str) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary; built once in a process."""
    if digest not in _BUILT:
        _BUILT.clear()
        _BUILT[digest] = WordTokenizer(definition)
    return _BUILT[digest]


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _run_batches(shared, digest: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_of(shared.value, digest)
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, len(whole), ROWS)):
            counts, id_digests, text_digests, lists, texts = [], [], [], [], []
            for text in batch.column(1):
                raw = coder.encode(text.as_py() or "")
                ids = np.frombuffer(raw, "<u4")
                decoded = coder.decode(ids)
                counts.append(len(ids))
                if full:
                    lists.append(ids.astype(np.int32))
                    texts.append(decoded.decode())
                else:
                    id_digests.append(hashlib.sha256(raw).hexdigest())
                    text_digests.append(hashlib.sha256(decoded).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64())]
            if full:
                arrays += [pa.array(lists, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            else:
                arrays += [pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])
        coder.forget()
        pa.default_memory_pool().release_unused()

    return run


def _apply(docs: DataFrame, path: str, key: str, text: str, full: bool, columns: str) -> DataFrame:
    definition = read_definition(path)
    # A vocabulary file has a fixed size, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    digest = hashlib.sha256(definition.encode()).hexdigest()
    kind = docs.schema[key].dataType.simpleString()
    return small_batches(docs).select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(
        _run_batches(shared, digest, full), f"`{key}` {kind}, n_tokens bigint, {columns}"
    )


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens, ids and the decoded text of every row; a null text is empty.

    ``path`` is the vocabulary file, read by the driver and broadcast. Rows that repeat are
    repeated; an empty text has no ids and decodes to an empty text.
    """
    return _apply(docs, path, key, text, True, "ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`encode_documents`, but with SHA-256 digests of the ids and the decoded text."""
    return _apply(docs, path, key, text, False, "ids_sha256 string, decoded_sha256 string")
