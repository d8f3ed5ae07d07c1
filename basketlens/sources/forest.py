"""Elements of many objects' texts at once, as arrays by level: where the values at a path stand, for a whole Arrow batch.

The same elements as in `tree`, which takes one object apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from basketlens.sources.cutter import tags
from basketlens.sources.tree import plain

_ENDS_NAME = np.zeros(256, dtype=bool)
_ENDS_NAME[[*b" \t\r\n\f\v/>"]] = True


class Level(NamedTuple):
    """Elements of one depth in order of the text: bounds as in `tree.Element`, and those of their local names."""

    start: np.ndarray
    begin: np.ndarray
    stop: np.ndarray
    end: np.ndarray
    name: np.ndarray
    name_end: np.ndarray


def bytes_of(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """Texts without nulls end to end, and their bounds."""
    texts = texts.cast(pa.binary())
    if not len(texts):
        return b"", np.zeros(1, dtype=np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return data.slice(bounds[0], bounds[-1] - bounds[0]).to_pybytes(), bounds - bounds[0]


class Forest:
    """Objects that lie end to end between ``bounds``; ``whole`` tells whether each is one element."""

    def __init__(self, data: bytes, bounds: np.ndarray):
        self.data, self._text = data, np.frombuffer(data, dtype=np.uint8)
        self._tags = tags(data)
        kinds = self._tags.kinds
        depth = np.cumsum(kinds)
        self._depth = np.where(kinds >= 0, depth - kinds, depth)
        self._levels: dict[int, Level] = {}
        roots = self.level(0)
        self.whole = (len(roots.start) == len(bounds) - 1 and bool((roots.start == bounds[:-1]).all())
                      and bool((roots.end == bounds[1:]).all()))

    def level(self, number: int) -> Level:
        if number not in self._levels:
            at = np.flatnonzero(self._depth == number)
            kinds = self._tags.kinds[at]
            opens = np.flatnonzero(kinds >= 0)
            # An element ends with the next tag of its level, an empty one with its own.
            own = at[opens]
            last = np.where(kinds[opens] > 0, at[np.minimum(opens + 1, len(at) - 1)], own) if len(own) else own
            start, begin = self._tags.starts[own], self._tags.ends[own]
            stop = np.where(kinds[opens] > 0, self._tags.starts[last], begin)
            self._levels[number] = Level(start, begin, stop, self._tags.ends[last], *self._names(start))
        return self._levels[number]

    def _names(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        name, at = start + 1, start + 1
        alive = np.arange(len(start))
        while len(alive):
            char = self._text[at[alive]]
            colon = alive[char == 0x3A]
            name[colon] = at[colon] + 1
            alive = alive[~_ENDS_NAME[char]]
            at[alive] += 1
        return name, at

    def children(self, number: int, parents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Elements one level below some elements of a level, and which of ``parents`` each belongs to."""
        above, below = self.level(number), self.level(number + 1)
        first, after = (np.searchsorted(below.start, x[parents]) for x in (above.start, above.end))
        counts = after - first
        owner = np.repeat(np.arange(len(parents)), counts)
        return np.arange(len(owner)) + np.repeat(first - (np.cumsum(counts) - counts), counts), owner

    def _called(self, number: int, elements: np.ndarray, name: bytes) -> np.ndarray:
        """Which of some elements have a local name."""
        here = self.level(number)
        same = np.flatnonzero(here.name_end[elements] - here.name[elements] == len(name))
        for i, char in enumerate(name):
            same = same[self._text[here.name[elements[same]] + i] == char]
        return same

    def at_path(self, objects: np.ndarray, steps: Sequence) -> tuple[int, np.ndarray, np.ndarray]:
        """Level and numbers of the property elements at a path (see `tree.at_path`), and which of ``objects`` each belongs to."""
        number, found, owner = 0, objects, np.arange(len(objects))
        for place, step in enumerate(steps, 1):
            below, of = self.children(number, found)
            number += 1
            named = self._called(number, below, step.name.encode())
            below, of = below[named], of[named]
            if place < len(steps):
                below, parent = self.children(number, below)
                number, of = number + 1, of[parent]
            if not step.every:
                chosen = np.arange(len(of)) - np.searchsorted(of, of) == (step.index or 1) - 1
                below, of = below[chosen], of[chosen]
            found, owner = below, owner[of]
        return number, found, owner

    def texts(self, number: int, elements: np.ndarray) -> pa.Array:
        """The values of scalar properties (see `tree.Element.text`) in order of the text."""
        if not len(elements):
            return pa.array([], pa.string())
        here = self.level(number)
        places = np.column_stack([here.begin[elements], here.stop[elements]]).ravel().astype(np.int32)
        every = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(self.data)])
        inner = every.take(pa.array(np.arange(0, len(places) - 1, 2))).cast(pa.string())
        marked = np.flatnonzero(pc.match_substring_regex(inner, "&|<!").to_numpy(zero_copy_only=False))
        if not len(marked):
            return inner
        _, parents = self.children(number, elements[marked])
        resolved = np.setdiff1d(np.arange(len(marked)), parents)  # markup inside a value is shown as it stands
        if not len(resolved):
            return inner
        change = np.zeros(len(inner), dtype=bool)
        change[marked[resolved]] = True
        new = [plain(x) for x in inner.filter(pa.array(change)).to_pylist()]
        return pc.replace_with_mask(inner, pa.array(change), pa.array(new, pa.string()))


def by_text(values: pa.Array) -> list[tuple[str, np.ndarray]]:
    """Each distinct text with its places."""
    coded = values.dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(1, len(coded.dictionary)))
    return list(zip(coded.dictionary.to_pylist(), np.split(order, cuts), strict=True)) if len(codes) else []


def first_of(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` owners how many entries it has, and the place of the first; entries are in order of owners."""
    return np.bincount(owner, minlength=n), np.searchsorted(owner, np.arange(n))
