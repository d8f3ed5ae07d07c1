"""Objects cut out of transfer text by nesting depth, a stretch of bytes at a time.

The depth is a running sum over tags: a start tag adds one, an end tag takes one.  Whatever its name, an element of the
data section is a basket and an element of a basket is an object.  Comments, CDATA sections, processing instructions and
quoted attribute values may hold anything.

Text is fed in stretches that begin with ``<`` (but for the first of a file).  What a stretch leaves open is a small state, and what a
whole byte range does to any state before it is a `Change`; changes follow one another associatively, so every range of a
large file can be surveyed by itself.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np

from basketlens.errors import TransferError

#: What a stretch of text can begin in.
CONTENT, COMMENT, CDATA, INSTRUCTION, SUBSET = range(5)
_END = {COMMENT: b"-->", CDATA: b"]]>", INSTRUCTION: b"?>", SUBSET: b"]>"}
STRETCH = 1 << 20

_LT, _GT, _SLASH, _QUOTE, _APOSTROPHE = b"<>/\"'"
_TAG = re.compile(rb"""<(?:[^<>"']|"[^"]*"|'[^']*')*>""")
_NAME = re.compile(rb"<([^\s/>]+)")
_DECLARED = re.compile(rb"""^\s*<\?xml\b[^>]*?\bencoding\s*=\s*["']([\w.:-]+)["']""")

#: Kinds of rows.
HEADER, BASKET, OBJECT, BEGUN, CONTINUED, ENDED = "header", "basket", "object", "begun", "continued", "ended"


class Tags(NamedTuple):
    """Tags of a stretch: bounds, +1 / -1 / 0 (empty element); comments; what the text behind it begins in."""

    starts: np.ndarray
    ends: np.ndarray
    kinds: np.ndarray
    comments: list[tuple[int, int]]
    mode: int


def _hidden(data: bytes, mode: int) -> tuple[list[tuple[int, int, int]], int]:
    """Spans that are not tags, with their kind, and the mode behind the stretch."""
    spans, at = [], 0
    if mode != CONTENT:
        end = data.find(_END[mode])
        if end < 0:
            return [(0, len(data), mode)], mode
        at = end + len(_END[mode])
        spans.append((0, at, mode))
    marks = [data.find(b"<!", at), data.find(b"<?", at)]
    while max(marks) >= 0:
        at = min(m for m in marks if m >= 0)
        if data.startswith(b"<!--", at):
            kind, begin = COMMENT, at + 4
        elif data.startswith(b"<![CDATA[", at):
            kind, begin = CDATA, at + 9
        elif data.startswith(b"<?", at):
            kind, begin = INSTRUCTION, at + 2
        else:
            kind, begin = SUBSET, at + 2
        end = data.find(_END[kind], begin)
        size = len(_END[kind])
        if kind == SUBSET:  # a declaration without a subset ends at its bracket
            plain, subset = data.find(b">", begin), data.find(b"[", begin)
            if plain >= 0 and not 0 <= subset < plain:
                end, size = plain, 1
        if end < 0:
            spans.append((at, len(data), kind))
            return spans, kind
        spans.append((at, end + size, kind))
        at = end + size
        marks = [m if m < 0 or m >= at else data.find(sign, at) for m, sign in zip(marks, (b"<!", b"<?"), strict=True)]
    return spans, CONTENT


def tags(data: bytes, mode: int = CONTENT) -> Tags:
    """Tags of a stretch; a tag without end (a torn file) is left out."""
    spans, after = _hidden(data, mode)
    text = np.frombuffer(data, dtype=np.uint8)
    starts, closing = np.flatnonzero(text == _LT), np.flatnonzero(text == _GT)
    if spans:
        begins, stops = np.array([s[0] for s in spans]), np.array([s[1] for s in spans])

        def seen(at: np.ndarray) -> np.ndarray:
            span = np.searchsorted(begins, at, side="right") - 1
            return at[(span < 0) | (at >= stops[np.maximum(span, 0)])]

        starts, closing = seen(starts), seen(closing)
    # Mostly every bracket is closed before the next one opens.
    paired = len(starts) == len(closing) and bool((starts < closing).all() and (closing[:-1] < starts[1:]).all())
    if not paired:
        place = np.searchsorted(closing, starts)
        starts = starts[place < len(closing)]
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return Tags(none, none, none, [(a, b) for a, b, kind in spans if kind == COMMENT], after)
    ends = closing if paired else closing[place[place < len(closing)]]

    def inside(sign: int) -> np.ndarray:
        """How many of a kind of quotes each tag holds."""
        at = np.flatnonzero(text == sign)
        if not paired:
            return np.searchsorted(at, ends) - np.searchsorted(at, starts)
        tag = np.searchsorted(starts, at) - 1
        return np.bincount(tag[(tag >= 0) & (at < ends[tag])], minlength=len(starts))

    double, single = inside(_QUOTE), inside(_APOSTROPHE)
    # A bracket inside a value: one of the quotes before it is open.
    odd = np.flatnonzero((double % 2 == 1) | (single % 2 == 1) | ((double > 0) & (single > 0)))
    whole = np.ones(len(starts), dtype=bool)
    for i in odd:
        found = _TAG.match(data, int(starts[i]))
        if found:
            ends[i] = found.end() - 1
        elif data[starts[i] + 1] != _SLASH:
            whole[i] = False
    starts, ends = starts[whole], ends[whole]
    kinds = np.where(text[starts + 1] == _SLASH, -1, np.where(text[ends - 1] == _SLASH, 0, 1))
    return Tags(starts, ends + 1, kinds, [(a, b) for a, b, kind in spans if kind == COMMENT], after)


def name_of(tag: bytes) -> bytes:
    return _NAME.match(tag).group(1)


def is_data_section(tag: bytes) -> bool:
    return name_of(tag).rpartition(b":")[2].lower() == b"datasection"


class Open(NamedTuple):
    """A start tag that is still open, and the range it stands in."""

    tag: bytes
    block: int


class Change(NamedTuple):
    """What a range does: how many open elements it closes, which it leaves open, what it ends in."""

    closes: int
    opens: tuple[Open, ...]
    mode: int


def followed(first: Change, then: Change) -> Change:
    """Two ranges as one (associative)."""
    left = len(first.opens) - then.closes
    if left >= 0:
        return Change(first.closes, first.opens[:left] + then.opens, then.mode)
    return Change(first.closes - left, then.opens, then.mode)


class Survey:
    """The change of a range for each mode that the text before it may end in."""

    def __init__(self, block: int):
        self._block = block
        self.changes = {mode: Change(0, (), mode) for mode in range(5)}

    def feed(self, data: bytes) -> None:
        known: dict[int, Change] = {}
        for mode, so_far in self.changes.items():
            if so_far.mode not in known:
                known[so_far.mode] = self._change(data, so_far.mode)
            self.changes[mode] = followed(so_far, known[so_far.mode])

    def _change(self, data: bytes, mode: int) -> Change:
        if mode != CONTENT and data.find(_END[mode]) < 0:
            return Change(0, (), mode)
        found = tags(data, mode)
        if not len(found.kinds):
            return Change(0, (), found.mode)
        depth = np.cumsum(found.kinds)
        closes = max(0, -int(depth.min()))
        opens = []
        for level in range(1 - closes, int(depth[-1]) + 1):
            at = np.flatnonzero((depth == level) & (found.kinds == 1))[-1]
            opens.append(Open(data[found.starts[at]:found.ends[at]], self._block))
        return Change(closes, tuple(opens), found.mode)


class Row(NamedTuple):
    kind: str
    owner: int
    basket_no: int
    pos: int
    basket_tag: bytes | None
    text: bytes


class Run(NamedTuple):
    """Whole objects of one basket in the order of a stretch: where their start tags begin and end, and where they end."""

    owner: int
    basket_no: int
    pos: int
    basket_tag: bytes | None
    starts: np.ndarray
    heads: np.ndarray
    ends: np.ndarray

    def rows(self, data: bytes) -> Iterator[Row]:
        for i, (start, end) in enumerate(zip(self.starts.tolist(), self.ends.tolist(), strict=True)):
            yield Row(OBJECT, self.owner, self.basket_no, self.pos + i, self.basket_tag, data[start:end])


class Cutter:
    """Rows of a file, or of one range of it that begins with the given elements open."""

    def __init__(self, block: int = 0, opened: Sequence[Open] = (), mode: int = CONTENT):
        self.block, self.mode, self.depth = block, mode, len(opened)
        self._opened = [o.tag for o in opened[:3]]
        self._in_data = len(opened) > 1 and is_data_section(opened[1].tag)
        self._basket_no = self._pos = 0
        self._owner = opened[3].block if len(opened) > 3 and self._in_data else None
        self._parts: list[bytes] | None = [] if self._owner is not None else None
        self._header: list[bytes] | None = None if opened else []
        self.root = self._opened[0] if self._opened else None

    def feed(self, data: bytes) -> Iterator[Row]:
        for found in self.runs(data):
            if isinstance(found, Row):
                yield found
            else:
                yield from found.rows(data)

    def runs(self, data: bytes) -> Iterator[Row | Run]:
        """Rows of a stretch; objects that lie whole in it, one after the other in a basket, come as one `Run`."""
        found = tags(data, self.mode)
        comments = found.comments

        def text(begin: int, end: int) -> bytes:
            """Text without comments."""
            out, at = [], begin
            for a, b in comments:
                if b > at and a < end:
                    out.append(data[at:max(a, at)])
                    at = b
            out.append(data[at:end])
            return b"".join(out) if len(out) > 1 else out[0]

        after = self.depth + np.cumsum(found.kinds)
        before = after - found.kinds
        level = np.where(found.kinds >= 0, before, after)
        frame, objects = np.flatnonzero(level < 3), np.flatnonzero(level == 3)
        begin, done = 0, 0  # of what is held; objects' tags that are done
        for i, upto in zip([*frame.tolist(), None], [*np.searchsorted(objects, frame).tolist(), len(objects)], strict=True):
            here, done = objects[done:upto], upto
            if len(here) and self._parts is not None:
                own = self._owner == self.block
                self._parts.append(text(begin, int(found.ends[here[0]])))
                yield self._row(OBJECT if own else ENDED, b"".join(self._parts))
                self._parts = self._owner = None
                here = here[1:]
            if len(here) and self._in_data:
                left = here[-1] if found.kinds[here[-1]] > 0 else None
                opening = here[found.kinds[here] >= 0]
                whole = opening if left is None else opening[:-1]
                # An object ends with the next of these tags, an empty one with its own.
                last = np.where(found.kinds[whole] > 0, here[np.minimum(np.searchsorted(here, whole) + 1, len(here) - 1)], whole)
                if len(whole):
                    run = Run(self.block, self._basket_no, self._pos + 1, self._opened[2] if len(self._opened) > 2 else None,
                              found.starts[whole], found.ends[whole], found.ends[last])
                    if comments:
                        yield from (r._replace(text=text(int(a), int(z)))
                                    for r, a, z in zip(run.rows(data), run.starts, run.ends, strict=True))
                    else:
                        yield run
                self._pos += len(opening)
                if left is not None:
                    self._parts, self._owner, begin = [], self.block, int(found.starts[left])
            if i is None:
                break
            kind, start, end = int(found.kinds[i]), int(found.starts[i]), int(found.ends[i])
            if kind >= 0:
                above, tag = int(before[i]), data[start:end]
                if above == 2 and self._in_data:
                    if self._header is not None:
                        yield self._made_header(text(0, start))
                    self._basket_no, self._pos = self._basket_no + 1, 0
                    self._opened[2:] = [tag]
                    yield self._row(BASKET, b"")
                elif above == 1:
                    self._in_data = kind == 1 and is_data_section(tag)
                elif above == 0:
                    self.root = tag
                if kind:
                    self._opened[above:] = [tag]
                else:
                    del self._opened[above:]
            else:
                above = int(after[i])
                if above == 1 and self._in_data and self._header is not None:
                    yield self._made_header(text(0, start))
                if above <= 1:
                    self._in_data = False
                del self._opened[max(above, 0):]
        if len(after):
            self.depth = int(after[-1])
        self.mode = found.mode
        if self._parts is not None:
            self._parts.append(text(begin, len(data)))
        elif self._header is not None:
            self._header.append(text(0, len(data)))

    def rest(self) -> Iterator[Row]:
        """What a range leaves open: a header before any basket, the part of an object that goes on in the next range."""
        if self._header is not None and self._in_data:
            yield self._made_header(b"")
        if self._parts is not None:
            yield self._row(BEGUN if self._owner == self.block else CONTINUED, b"".join(self._parts))

    def torn(self) -> bool:
        """Whether the file ends before its elements do."""
        return self.depth != 0 or self.mode != CONTENT or self.root is None

    def _made_header(self, last: bytes) -> Row:
        made = Row(HEADER, self.block, -1, 0, None, b"".join([*self._header, last]))
        self._header = None
        return made

    def _row(self, kind: str, text: bytes) -> Row:
        basket = self._opened[2] if len(self._opened) > 2 else None
        owner = self.block if self._owner is None else self._owner
        return Row(kind, owner, self._basket_no, self._pos, basket, text)


def children(element: bytes) -> Iterator[tuple[str, bytes]]:
    """Local name and inner text of the direct children of an element."""
    found = tags(element)
    depth = np.cumsum(found.kinds)
    begin = name = None
    for i in np.flatnonzero(np.where(found.kinds >= 0, depth - found.kinds == 1, depth == 1)):
        start, end = int(found.starts[i]), int(found.ends[i])
        if found.kinds[i] >= 0:
            name, begin = name_of(element[start:end]).rpartition(b":")[2].decode(), end
        if found.kinds[i] <= 0:
            yield name, element[begin:start] if found.kinds[i] else b""


# ---------------------------------------------------------------- encodings

def encoding_of(head: bytes) -> str | None:
    """Encoding that a file names, None for UTF-8; ``utf-16`` and ``utf-32`` are told by their mark."""
    for mark, name in ((codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"),
                       (codecs.BOM_UTF16_BE, "utf-16")):
        if head.startswith(mark):
            return name
    found = _DECLARED.match(head.removeprefix(codecs.BOM_UTF8))
    if not found:
        return None
    name = found.group(1).decode()
    try:
        known = codecs.lookup(name).name
    except LookupError:
        raise TransferError(f"unknown encoding {name}") from None
    return None if known in ("utf-8", "ascii") else known


def recoded(text: bytes, encoding: str | None) -> bytes:
    return text if encoding is None else text.decode(encoding).encode()


def stretches(data: bytes) -> Iterator[bytes]:
    """A text in pieces that begin with a tag."""
    at = 0
    while at < len(data):
        end = data.find(b"<", at + STRETCH)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end
