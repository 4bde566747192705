"""Words of whole texts as spans of bytes, found by numpy over a column's own buffer.

A word is a run of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased
(``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``). In UTF-8 every byte of a character beyond ASCII is
above 0x7F, so bytes decide, and lower-casing A-Z moves no byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The byte a text's byte counts as: itself, lower-cased, or 0 for what separates words.
FOLDED = np.zeros(256, np.uint8)
FOLDED[0x80:] = np.arange(0x80, 256)
for _from, _to in (("0", "9"), ("a", "z")):
    FOLDED[ord(_from):ord(_to) + 1] = np.arange(ord(_from), ord(_to) + 1)
FOLDED[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)

#: Texts are taken together up to about so many bytes, which bounds the arrays made for them.
TOGETHER = 1 << 20


@dataclass
class Words:
    """The words of some texts that lie one after the other: word ``w`` is ``data[starts[w]:ends[w]]``,
    text ``t`` has the words ``first[t]`` to ``first[t + 1]`` and begins at byte ``begin[t]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    begin: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def _words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    data = FOLDED[raw]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = data != 0
    edge = inside[1:] != inside[:-1]  # between byte i - 1 and byte i
    begins, ends = edge & inside[1:], edge & inside[:-1]
    # A text's last word does not run on into the next text.
    touching = offsets[1:-1]
    touching = touching[inside[touching] & inside[touching + 1]]
    begins[touching] = ends[touching] = True
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(ends), np.searchsorted(starts, offsets), offsets[:-1])


def text_words(column: pa.Array) -> Iterator[tuple[int, Words]]:
    """(first text, its and the next texts' words) over a string column; null texts have no words."""
    column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TOGETHER, "right")) - 1)
        own = offsets[at:to + 1]
        yield at, _words(data[own[0]:own[-1]], own - own[0])
        at = to


def positions(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(every position of all spans in turn, where each span begins among them)."""
    first = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths), first
