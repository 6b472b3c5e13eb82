"""License scans with template markup compiled to token automata.

A template is wording with marked regions: ``<<optional>> ... <<end>>`` may be left out, and
``<<var words="0-12" match="...">>`` stands for that many words, each matching the expression.
All other words are mandatory. A template compiles to an automaton over words; a text is accepted
where its words, from some place on, lead to the end of the automaton, so the mandatory wording
matches exactly whatever its case, punctuation and line breaks.

A template begins with mandatory words. They are searched in the text's bytes, and only from where
they stand the automaton runs, over at most as many words as the template can take.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import small_batches, text_bytes

#: Lowers A-Z and turns every ASCII byte that is no letter or digit into a blank.
PLAIN = np.full(256, 32, np.uint8)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    PLAIN[_lo:_hi] = np.arange(_lo, _hi)
PLAIN[65:91] = np.arange(97, 123)

MARK = re.compile(r'<<(optional|end|var)((?:\s+\w+="[^"]*")*)\s*>>')
OPTION = re.compile(r'(\w+)="([^"]*)"')


def plain_words(text: str) -> list[bytes]:
    return PLAIN[np.frombuffer(text.encode(), np.uint8)].tobytes().split()


class Automaton:
    """States 0..n; state i holds its word test and the states reachable from it without a word."""

    def __init__(self, template: str):
        self.tests: list[bytes | re.Pattern | None] = []
        self.skips: list[set[int]] = []
        opened: list[int] = []
        at = 0
        for mark in [*MARK.finditer(template), None]:
            for word in plain_words(template[at : mark.start() if mark else len(template)]):
                self._state(word)
            if mark is None:
                break
            at = mark.end()
            options = dict(OPTION.findall(mark[2]))
            if mark[1] == "optional":
                opened.append(self._state(None))
            elif mark[1] == "end":
                self._join(opened.pop())
            else:
                least, most = map(int, options.get("words", "0-10").split("-"))
                test = re.compile(options.get("match", ".*").encode(), re.S)
                for n in range(most):
                    if n >= least:
                        opened.append(self._state(None))
                    self._state(test)
                for _ in range(most - least):
                    self._join(opened.pop())
        if opened:
            raise ValueError("a region is not ended")
        self.end = len(self.tests)
        self.tests.append(None)
        self.skips.append(set())
        prefix = []
        for test in self.tests:
            if not isinstance(test, bytes):
                break
            prefix.append(test)
        if not prefix:
            raise ValueError("a template begins with mandatory words")
        self.prefix = prefix
        self.gate = max(prefix, key=len)
        self.find = re.compile(rb"(?<![^ ])" + b" +".join(map(re.escape, prefix)) + rb"(?![^ ])")
        self.longest = sum(t is not None for t in self.tests)
        self._closed = [self._closure(i) for i in range(len(self.tests))]

    def _state(self, test) -> int:
        self.tests.append(test)
        self.skips.append({len(self.tests)} if test is None else set())
        return len(self.tests) - 1

    def _join(self, opened: int) -> None:
        """The region from state ``opened`` to here may be left out."""
        self.skips[opened].add(len(self.tests))

    def _closure(self, state: int) -> frozenset[int]:
        found, todo = set(), [state]
        while todo:
            s = todo.pop()
            if s not in found:
                found.add(s)
                todo += self.skips[s]
        return frozenset(s for s in found if s == self.end or self.tests[s] is not None)

    def accepts(self, words: list[bytes]) -> int:
        """Words taken by the longest accepted beginning of ``words``; 0 if none is accepted."""
        live, longest = self._closed[0], 0
        for n, word in enumerate(words):
            step: set[int] = set()
            for s in live:
                test = self.tests[s]
                if s != self.end and (test == word if isinstance(test, bytes) else test.fullmatch(word)):
                    step |= self._closed[s + 1]
            if not step:
                break
            live = step
            if self.end in live:
                longest = n + 1
        return longest


# The three phrases whose places are always counted, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public notices in template markup. Their labels tell what kind of notice it is.
NOTICES = (
    ("mit-notice", 'released under the mit <<optional>>x11<<end>> license'),
    ("mit-notice", 'licensed under the <<optional>>terms of the<<end>> mit <<optional>>x11<<end>> license'),
    ("mit-text", '''Permission is hereby granted, free of charge, to any person obtaining a copy of this
     software and associated documentation files <<optional>>(the "Software")<<end>>, to deal in the Software
     without restriction, including without limitation the rights to use, copy, modify, merge, publish,
     distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
     furnished to do so, subject to the following conditions: The above copyright notice and this permission
     notice <<optional>>(including the next paragraph)<<end>> shall be included in all copies or substantial
     portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
     IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
     AND NONINFRINGEMENT. IN NO EVENT SHALL <<var words="1-20">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
     LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
     THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'''),
    ("apache-notice", 'licensed under the apache license <<optional>>version 2 <<optional>>0<<end>><<end>>'),
    ("gpl-notice", '''licensed under the <<optional>>terms of the<<end>> gnu <<optional>><<var words="1-1"
     match="lesser|library|affero">><<end>> general public license <<optional>>version <<var words="1-1"
     match="[123]">><<optional>>or <<optional>>at your option any<<end>> later <<optional>>version<<end>><<end>><<end>>'''),
    ("gpl-text", '''This program is free software<<optional>>:<<end>> you can redistribute it and/or modify it under
     the terms of the GNU <<optional>><<var words="1-1" match="lesser|library|affero">><<end>> General Public
     License as published by the Free Software Foundation <<var words="0-12">> any later version'''),
    ("cc-notice", '''licensed under <<optional>>a<<end>> <<optional>>the<<end>> <<optional>>creative commons<<end>>
     <<optional>>cc<<end>> by <<optional>>nc<<end>> <<optional>>nd<<end>> <<optional>>sa<<end>> <<var words="1-1"
     match="[1234]">> <<var words="1-1" match="[05]">>'''),
    ("bsd-text", '''Redistribution and use in source and binary forms, with or without modification, are permitted
     provided that the following conditions are met: <<optional>>1<<end>> Redistributions of source code must
     retain the above copyright notice, this list of conditions and the following disclaimer'''),
)


def _scan(phrases, notices):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = [(Automaton(t), label) for t, label in phrases]
        more = [(Automaton(t), label) for label, t in notices]
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            data, bounds = PLAIN[data], offsets.tolist()
            rows = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                part = data[lo:hi]
                word = part != 32
                first = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]])) if hi > lo else np.zeros(0, np.int64)
                rows.append(_row(part.tobytes(), first, base, more))
            columns = list(zip(*rows)) or [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], [str(i) for i in range(8)]
            )

    return run


def _row(text: bytes, first: np.ndarray, base, more) -> tuple:
    places, labels, own, longest = [], set(), set(), 0
    for automata, into in ((base, labels), (more, own)):
        for automaton, label in automata:
            if automaton.gate not in text:
                continue
            start = 0
            while found := automaton.find.search(text, start):
                start = found.start() + 1
                number = int(np.searchsorted(first, found.start()))
                stop = first[number + automaton.longest] if number + automaton.longest < len(first) else len(text)
                taken = automaton.accepts(text[found.start() : stop].split())
                if taken:
                    into.add(label)
                    longest = max(longest, taken)
                    if into is labels:
                        places.append(number)
    return (
        len(first), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
        ",".join(sorted(labels | own)), longest / (longest + 4.0),
    )


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lowered. n_base counts
    the places of ``phrases``, first_word and last_word are the smallest and largest of them (else
    null); labels add those of ``notices`` that accept a place of the text. score is n / (n + 4) for
    the longest accepted run of n words. Null and empty texts have no words, labels "" and score 0.
    Rows that repeat are scanned alike; an empty table gives no rows; other columns are not looked at.
    """
    kind = docs.schema[key].dataType.simpleString()
    return small_batches(docs).select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(
        _scan(phrases, notices),
        f"`{key}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )
