"""Token counts of the sections of a document, from one encoding of the whole document.

Encoding sections apart changes tokens at their edges. Here the whole text is encoded once; the
byte lengths of the tokens, looked up by id, give their spans by running sums (a byte-level
vocabulary loses nothing), and the spans are joined with the sections' spans by interval. A token
that crosses a boundary is allocated by an explicit rule:

``first``     to the section that holds its first byte,
``last``      to the section that holds its last byte,
``most``      to the section that holds most of its bytes, the earlier one at a tie.

Every token is counted in exactly one section, so sections add up to the document.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import small_batches

RULES = ("first", "last", "most")
#: Characters that the pattern takes for white space, and runs of these that the library's pattern matcher cannot hold.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_BLANK = re.compile(f"[{BLANKS}]{{8192,}}")
_BUILT: dict[str, tuple[tiktoken.Encoding, np.ndarray]] = {}


def encoding_of(ranks_text: bytes, pattern: str, digest: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The worker's encoding and the byte length of each id; built once in a process."""
    if digest not in _BUILT:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_text.splitlines() if line)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        lengths[list(ranks.values())] = [len(t) for t in ranks]
        _BUILT.clear()
        _BUILT[digest] = (
            tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
        )
    return _BUILT[digest]


def encode(coder: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text; very long runs of white space go to the merges without the pattern.

    The pattern takes such a run as one piece: whole at the end of the text, else without its last
    character, which belongs to what follows.
    """
    out, at = [], 0
    for run in LONG_BLANK.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += coder.encode_ordinary(text[at : run.start()])
        out += coder._encode_single_piece(text[run.start() : end])
        at = end
    return out + coder.encode_ordinary(text[at:]) if at else coder.encode_ordinary(text)


def line_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the sections of a text: its lines, each with its line feed; an empty text is one section."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token by the rule, and whether it crosses a boundary."""
    starts = np.concatenate([[0], token_ends]).astype(np.int64)[:-1]
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    crosses = first != last
    if rule == "first":
        return first, crosses
    if rule == "last":
        return last, crosses
    chosen = first.copy()
    for t in np.flatnonzero(crosses).tolist():
        edges = np.clip(section_ends[first[t] : last[t] + 1], starts[t], token_ends[t])
        chosen[t] += int(np.argmax(np.diff(np.concatenate([[starts[t]], edges]))))
    return chosen, crosses


def _count(shared, pattern: str, digest: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, lengths = encoding_of(shared.value, pattern, digest)
        for batch in batches:
            rows, columns = [], [[] for _ in range(5)]
            for row, text in enumerate(batch.column(1).to_pylist()):
                raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
                ends = line_ends(raw)
                ids = np.array(encode(coder, text or ""), np.int64)
                section, crosses = allocate(np.cumsum(lengths[ids]), ends, rule)
                # Characters are bytes that do not continue one.
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[np.concatenate([[0], ends])]
                rows.append(np.full(len(ends), row))
                for column, part in zip(columns, (
                    np.arange(len(ends)), chars[:-1], chars[1:], np.bincount(section, minlength=len(ends)),
                    np.bincount(section[crosses], minlength=len(ends)),
                )):
                    column.append(part)
            taken = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), *[pa.array(np.concatenate(c).astype(np.int64) if c else [], pa.int64()) for c in columns]],
                [str(i) for i in range(6)],
            )

    return run


def section_tokens(
    docs: DataFrame, path: str, pattern: str, rule: str = "first", key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per line of every text: key, section, start_char, end_char, n_tokens, n_crossing.

    ``path`` is a file of byte-level ranks, read by the driver and broadcast (it has a fixed size);
    ``pattern`` splits the text before the merges. Sections are numbered from 0; spans are in code
    points, ends exclusive. ``n_crossing`` counts the section's tokens that reach into another one.
    A null or empty text is one empty section. Rows that repeat are repeated; an empty table gives
    no rows; other columns are not looked at.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    with open(path, "rb") as f:
        ranks = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema[key].dataType.simpleString()
    return small_batches(docs).select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(
        _count(shared, pattern, hashlib.sha256(ranks + pattern.encode()).hexdigest(), rule),
        f"`{key}` {kind}, section bigint, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint",
    )
