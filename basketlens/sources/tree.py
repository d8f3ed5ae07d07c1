"""Elements of one object's text as a tree: any depth, and where each element stands in the text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from basketlens.sources.cutter import name_of, tags

_ATTRIBUTE = re.compile(r"""\s([\w.:-]+)\s*=\s*("[^"]*"|'[^']*')""")
_REFERENCE = re.compile(r"<!\[CDATA\[(.*?)\]\]>|&(#x[0-9A-Fa-f]+|#[0-9]+|lt|gt|quot|apos|amp);", re.S)
_TAGS = re.compile(rb"""<(/?)([^\s/<>"']+)(?:[^<>"']|"[^"]*"|'[^']*')*>""")
# The predefined entities.
_NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}


def plain(text: str) -> str:
    """Text with its references and CDATA sections resolved."""
    def resolved(found: re.Match) -> str:
        section, name = found.groups()
        if section is not None:
            return section
        if name.startswith("#x"):
            return chr(int(name[2:], 16))
        return chr(int(name[1:])) if name.startswith("#") else _NAMED[name]

    return _REFERENCE.sub(resolved, text) if "&" in text or "<!" in text else text


class Element:
    """``data[start:begin]`` is the start tag, ``data[begin:stop]`` the content, ``data[stop:end]`` the end tag."""

    __slots__ = ("tag", "name", "start", "begin", "stop", "end", "kids")

    def __init__(self, tag: str, start: int, begin: int):
        self.tag, self.name, self.start, self.begin = tag, tag.rpartition(":")[2], start, begin
        self.stop = self.end = begin
        self.kids: list[Element] = []

    def attributes(self, data: bytes) -> dict[str, str]:
        """Values by local name in upper case."""
        found = _ATTRIBUTE.findall(data[self.start:self.begin].decode())
        return {name.rpartition(":")[2].upper(): plain(value[1:-1]) for name, value in found if not name.startswith("xmlns")}

    def inner(self, data: bytes) -> str:
        return data[self.begin:self.stop].decode()

    def text(self, data: bytes) -> str:
        """The value of a scalar property; markup inside one is shown as it stands."""
        return self.inner(data) if self.kids else plain(self.inner(data))


def _tags_of(data: bytes) -> Iterator[tuple[bytes, int, int, int]]:
    """Name, bounds and kind (as in `Tags`) of each tag; the name of an end tag is not used.

    An object is short, so one expression finds its tags sooner than arrays do; text that may hold a bracket elsewhere goes the long way.
    """
    if b"<!" not in data and b"<?" not in data:
        found = list(_TAGS.finditer(data))
        if len(found) == data.count(b"<"):
            for tag in found:
                start, end = tag.span()
                yield tag.group(2), start, end, -1 if tag.group(1) else 0 if data[end - 2] == 47 else 1
            return
    found = tags(data)
    for start, end, kind in zip(found.starts.tolist(), found.ends.tolist(), found.kinds.tolist(), strict=True):
        yield b"" if kind < 0 else name_of(data[start:end]), start, end, kind


def parse(data: bytes) -> Element:
    root, stack = None, []
    for name, start, end, kind in _tags_of(data):
        if kind < 0:
            last = stack.pop()
            last.stop, last.end = start, end
            continue
        element = Element(name.decode(), start, end)
        if stack:
            stack[-1].kids.append(element)
        elif root is None:
            root = element
        if kind:
            stack.append(element)
    return root


def at_path(root: Element, steps: Sequence) -> list[Element]:
    """Property elements at a path; steps have ``name``, ``index`` (from 1, None for the first) and ``every``."""
    found = [root]
    for number, step in enumerate(steps, 1):
        below = []
        for parent in found:
            values = [k for k in parent.kids if k.name == step.name]
            if number < len(steps):
                values = [v for k in values for v in k.kids]
            first = (step.index or 1) - 1
            below += values if step.every else values[first:first + 1]
        found = below
    return found


def escaped(text: str) -> str:
    """Element content; a carriage return must stay a reference."""
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace("\r", "&#13;")


def replaced(data: bytes, changes: list[tuple[Element, str]]) -> bytes:
    """New contents for some elements that lie apart; all other text stays byte for byte."""
    out = []
    at = 0
    for element, value in sorted(changes, key=lambda c: c[0].start):
        out += [data[at:element.start], renewed(data[element.start:element.begin], element.tag.encode(), value)]
        at = element.end
    return b"".join([*out, data[at:]])


def renewed(head: bytes, tag: bytes, value: str) -> bytes:
    """An element with a new value behind its start tag."""
    if head.endswith(b"/>"):
        head = head[:-2] + b">"
    return b"".join([head, escaped(value).encode(), b"</", tag, b">"])
