"""License notices in texts, by patience alignment with templates.

Words that a template has and common prose has not (its marks) lead to regions of a
text.  A region is aligned with the template: words that occur once in both are
anchors, the longest run of anchors in increasing order is kept, and the gaps between them are aligned in
the same way, after equal words at a gap's ends.  Coverage is the share of the template's words that are aligned.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import text_of

# The wording of public license notices.
TEMPLATES: dict[str, str] = {
    "MIT": "Released under the MIT License",
    "MIT-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "Apache": "Licensed under the Apache License, Version 2.0",
    "Apache-full": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    "GPL": "This work is licensed under the GNU General Public License, version 3",
    "GPL-full": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"),
    "BSD-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"),
    "CC-BY": "Licensed under CC BY 4.0",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0",
    "CC-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "reserved": "All rights reserved",
}
#: Template words that ordinary prose has too; they are aligned but lead to no region.
ORDINARY = frozenset(
    "a all and any are as by can charge conditions copies copy either following forms free from general in including is it "
    "kind law met of on or person program provided public required rights sell source terms the this to under use version with "
    "without work writing you agreed".split())
MIN_COVERAGE = 0.8
#: Least number of words; templates are aligned with so many words more on either side.
SLACK = 8


def plain_words(text: str) -> list[str]:
    """Words in lower case without punctuation at their ends."""
    return [w.strip(".,;:!?\"'()[]{}<>*#").lower() for w in text.split()]


def increasing(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given in order of their first part, whose second parts increase."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        at = bisect.bisect_left(tails, b)
        before[i] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(b)
            ends.append(i)
        else:
            tails[at], ends[at] = b, i
    out = []
    i = ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Aligned places (in the text, in the template), both increasing."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {template[i]: i for i in range(c, d) if there[template[i]] == 1}
        anchors = increasing([(i, place[text[i]]) for i in range(a, b) if here[text[i]] == 1 and text[i] in place])
        if not anchors:
            continue
        out += anchors
        edge = (a, c)
        for i, j in [*anchors, (b, d)]:
            gaps.append((edge[0], i, edge[1], j))
            edge = (i + 1, j + 1)
    return sorted(out)


class Scanner:
    def __init__(self, templates: Mapping[str, str], min_coverage: float):
        self.templates = {name: plain_words(text) for name, text in templates.items()}
        self.min_coverage = min_coverage
        self.marks: dict[str, list[str]] = {}
        self.needed: dict[str, int] = {}
        for name, found in self.templates.items():
            marks = {w for w in found if w not in ORDINARY} or {found[-1]}
            self.needed[name] = max(1, len(marks) // 2)
            for word in marks:
                self.marks.setdefault(word, []).append(name)

    def regions(self, found: Sequence[str]) -> Iterator[tuple[str, int, int]]:
        """Template and stretch of text where enough of its marks stand close together."""
        open_at: dict[str, list[int]] = {}
        seen: dict[str, set[str]] = {}

        def close(name: str) -> Iterator[tuple[str, int, int]]:
            places, several = open_at.pop(name), seen.pop(name)
            if len(several) >= self.needed[name]:
                size = len(self.templates[name])
                yield name, max(0, places[0] - size), min(len(found), places[-1] + size)

        for i, word in enumerate(found):
            for name in self.marks.get(word, ()):
                if name in open_at and (i - open_at[name][-1] > SLACK + len(self.templates[name]) // 2
                                        or word in seen[name] and i - open_at[name][0] >= len(self.templates[name]) - 1):
                    yield from close(name)
                open_at.setdefault(name, []).append(i)
                seen.setdefault(name, set()).add(word)
        for name in list(open_at):
            yield from close(name)

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """License, coverage, first word and the word after the last, in order of place; of notices that overlap, the best covered and longest."""
        found = plain_words(text)
        hits = []
        for name, first, last in self.regions(found):
            template = self.templates[name]
            pairs = align(found[first:last], template)
            if not pairs:
                continue
            # What lies far from the rest is no part of the notice.
            middle = pairs[len(pairs) // 2]
            near = [p for p in pairs if abs((p[0] - middle[0]) - (p[1] - middle[1])) <= SLACK]
            coverage = len(near) / len(template)
            if coverage >= self.min_coverage:
                hits.append((name, coverage, first + near[0][0], first + near[-1][0] + 1))
        hits.sort(key=lambda h: (-(h[3] - h[2]) * h[1], h[2], h[0]))
        kept: list[tuple[str, float, int, int]] = []
        for hit in hits:
            if all(hit[2] >= k[3] or hit[3] <= k[2] for k in kept):
                kept.append(hit)
        return sorted(kept, key=lambda h: h[2])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Mapping[str, str] = TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per notice found: the id, ``license``, ``coverage``, ``start_word`` and ``end_word`` (after the last).

    A null or empty text has none, an empty table or an empty set of templates gives an empty result, and repeated rows
    have their notices once each.  Words are counted as split at any white space.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("license", T.StringType()),
        T.StructField("coverage", T.DoubleType()), T.StructField("start_word", T.LongType()),
        T.StructField("end_word", T.LongType())])
    given = dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given, min_coverage)
        for batch in batches:
            rows, hits = [], []
            for i, value in enumerate(batch.column(1)):
                for hit in scanner.scan(value.as_py()):
                    rows.append(i)
                    hits.append(hit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, type=pa.int64())), pa.array([h[0] for h in hits], type=pa.string()),
                 pa.array([h[1] for h in hits], type=pa.float64()), pa.array([h[2] for h in hits], type=pa.int64()),
                 pa.array([h[3] for h in hits], type=pa.int64())], names=schema.names)

    return docs.select(F.col(f"`{id_col}`"), text_of(text_col).alias("scanned_text")).mapInArrow(run, schema)
