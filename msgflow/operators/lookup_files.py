"""Sorted tables in files of the shared folder, of which a reader needs one page per question.

For what a summary would carry only in odd cases, and then without bound: the task that makes it
writes a file under a name of its own, and the summary carries the path.
"""

from __future__ import annotations

import struct

import numpy as np

from msgflow.session import file_system

PAGE = 4_096
HEAD = struct.Struct("<qqq")


def write_lookup(path: str, keys: np.ndarray, rows: np.ndarray) -> None:
    """Rows of whole numbers by keys that do not fall."""
    system, place = file_system(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    keys, rows = keys.astype("<i8"), np.ascontiguousarray(rows, "<i8")
    with system.open_output_stream(place) as out:
        out.write(HEAD.pack(len(keys), rows.shape[1], PAGE))
        out.write(keys[PAGE - 1 :: PAGE].tobytes())  # the last key of every full page
        out.write(keys.tobytes())
        out.write(rows.tobytes())


def first_at_least(path: str, key: int) -> list[int] | None:
    """The row of the first key that is ``key`` or more; None when all are less."""
    system, place = file_system(path)
    with system.open_input_file(place) as source:
        n, width, page = HEAD.unpack(source.read_at(HEAD.size, 0))
        full = n // page
        lasts = np.frombuffer(source.read_at(full * 8, HEAD.size), "<i8")
        lo = int(np.searchsorted(lasts, key, "left")) * page
        keys_at = HEAD.size + full * 8
        keys = np.frombuffer(source.read_at(min(page, n - lo) * 8, keys_at + lo * 8), "<i8")
        at = lo + int(np.searchsorted(keys, key, "left"))
        if at >= n:
            return None
        return np.frombuffer(source.read_at(width * 8, keys_at + n * 8 + at * width * 8), "<i8").tolist()
