"""Quality rules: simple counts, then the divergence of a text from its nearest language.

A language's reference is what all its documents hold together, but for those
that fail the simple counts: a histogram of character classes and one of its
commonest words with the rest as one bin.  A text is compared with every
reference by Jensen-Shannon distance (base 2, 0 to 1), and the nearest counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import small_batches, text_of
from basketlens.llm.text_arrays import SPACE, Chunk, chunks, runs_of, words
from basketlens.sources.session import cut_lineage

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Words that a task counts before it hands them on.
HELD = 1 << 16
RESULTS = (*COUNTS, "base_failed", "class_distance", "word_distance", "kept")


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; distances count only for texts long enough to have a histogram."""

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    max_class_distance: float = 0.30
    max_word_distance: float = 0.46
    class_guard: int = 200  # code points
    word_guard: int = 50  # words
    common_words: int = 50  # of each language
    common_length: int = 12  # code points of a common word at most
    reference_guard: int = 1000  # words of a language below which it has no reference


def _classes() -> np.ndarray:
    """Class of each byte: white space, lower, upper, digit, stop, symbol, other ASCII, other letter; 8 is no new character."""
    table = np.full(256, 6, dtype=np.int64)
    table[SPACE] = 0
    table[ord("a"):ord("z") + 1] = 1
    table[ord("A"):ord("Z") + 1] = 2
    table[ord("0"):ord("9") + 1] = 3
    table[list(b".,")] = 4
    table[list(SYMBOLS)] = 5
    table[0xC0:] = 7
    table[0x80:0xC0] = 8
    return table


CLASSES = _classes()
N_CLASSES = 8


def _repeated(hashes: np.ndarray, width: int) -> int:
    """Words that lie in a window found at least twice."""
    runs = runs_of(hashes, width)
    if len(runs) < 2:
        return 0
    _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
    twice = times[which] > 1
    if not twice.any():
        return 0
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    edges[:len(runs)] += twice
    edges[width:width + len(runs)] -= twice
    return int((np.cumsum(edges)[:-1] > 0).sum())


def _repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _counts(chunk: Chunk, found, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The five counts and the class histogram of each row."""
    rows = np.repeat(np.arange(len(chunk)), np.diff(chunk.offsets))
    kinds = np.bincount(rows * 9 + CLASSES[chunk.data], minlength=9 * len(chunk)).reshape(-1, 9)[:, :N_CLASSES]
    counts = np.zeros((len(chunk), 5), dtype=np.int64)
    counts[:, 0] = np.diff(found.rows)
    counts[:, 1] = kinds[:, 1:].sum(axis=1)
    counts[:, 2] = kinds[:, 5]
    for i in range(len(chunk)):
        counts[i, 3] = _repeated_lines(chunk.data[chunk.offsets[i]:chunk.offsets[i + 1]].tobytes())
        counts[i, 4] = _repeated(found.hashes[found.of(i)], window)
    return counts, kinds


def _failed(counts: np.ndarray, rules: Rules) -> np.ndarray:
    n = counts[:, 0]
    return (n < rules.min_words) | (100 * counts[:, 4] > rules.max_repeat_percent * n)


@dataclass
class References:
    """One row per language: class shares, common word shares; the last bin is the other words."""

    languages: list[str] = field(default_factory=list)
    class_shares: np.ndarray = field(default_factory=lambda: np.zeros((0, N_CLASSES)))
    word_shares: list[np.ndarray] = field(default_factory=list)
    word_hashes: list[np.ndarray] = field(default_factory=list)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` from ``q``."""
    middle = (p + q) / 2

    def towards(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / middle), 0.0).sum(axis=1)

    return np.sqrt(np.clip((towards(p) + towards(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _hash_words(values: list[str]) -> np.ndarray:
    """The hashes that a chunk's words have, for given words."""
    out = [words(c).hashes for c in chunks(pa.array(values, type=pa.string()))]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _common_candidates(chunk: Chunk, found, used: np.ndarray, longest: int) -> Iterator[tuple[str, int]]:
    """Words of the ``used`` rows, short enough and with a letter, each once with its count."""
    at = np.flatnonzero(np.repeat(used, np.diff(found.rows)))
    _, first, times = np.unique(found.hashes[at], return_index=True, return_counts=True)
    at = at[first]
    starts, ends = found.starts[at], found.ends[at]
    short = np.flatnonzero(ends - starts <= 4 * longest)  # a code point has at most four bytes
    for k in short:
        word = chunk.data[starts[k]:ends[k]].tobytes().decode("utf-8", "replace")
        if len(word) <= longest and any(map(str.isalpha, word)):
            yield word, int(times[k])


def gather(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``lang, kind, word, n`` of the texts that pass the simple counts, summed up within each task.

    Kind -1 says how often a word comes, a kind of 0 to 7 how many characters of that class come, and kind ``N_CLASSES`` how many
    words; the last two have no ``word``.  ``docs`` has ``lang``, without nulls, and ``text``.  A task hands on what it holds
    whenever that reaches ``HELD`` words, so its memory is bounded.
    """
    names = ["lang", "kind", "word", "n"]

    def batch_of(totals: dict[str, np.ndarray], held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, t in totals.items():
            found = held[lang]
            kinds = [*range(N_CLASSES + 1), *[-1] * len(found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(kinds), type=pa.string()), pa.array(kinds, type=pa.int32()),
                 pa.array([*[None] * (N_CLASSES + 1), *found], type=pa.string()),
                 pa.array([*t.tolist(), *found.values()], type=pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        held: dict[str, Counter] = {}
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = words(chunk)
                counts, kinds = _counts(chunk, found, rules.window)
                passed = ~_failed(counts, rules)
                langs = np.array(batch.column(0).slice(chunk.first, len(chunk)).to_pylist(), dtype=object)
                for lang in set(langs):
                    used = passed & (langs == lang)
                    totals[lang] = totals.get(lang, 0) + np.append(kinds[used].sum(axis=0), counts[used, 0].sum())
                    mine = held.setdefault(lang, Counter())
                    for word, n in _common_candidates(chunk, found, used, rules.common_length):
                        mine[word] += n
                if len(totals) + sum(map(len, held.values())) >= HELD:
                    yield from batch_of(totals, held)
                    totals, held = {}, {}
        yield from batch_of(totals, held)

    return docs.select("lang", "text").mapInArrow(run, "lang string, kind int, word string, n long")


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> References:
    """References of all languages in ``docs``, from all documents that pass the simple counts.

    What reaches the driver is one histogram and ``common_words`` words per language of at least ``reference_guard`` words.
    """
    small_batches(docs.sparkSession)
    rows = docs.filter(F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), text_of(text_col).alias("text"))
    gathered = cut_lineage(gather(rows, rules).groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")), "quality-counts")
    kinds = (
        gathered.filter("kind >= 0").groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("kind", "n"))).alias("sums"))
        .filter(F.col("sums")[N_CLASSES] >= rules.reference_guard).orderBy("lang").collect())
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    common = (
        gathered.filter((F.col("kind") == -1) & F.col("lang").isin([r["lang"] for r in kinds])).select("lang", "word", "n")
        .withColumn("place", place).filter(F.col("place") <= rules.common_words).collect())
    out = References()
    shares = []
    for row in kinds:
        total = row["sums"][N_CLASSES]
        mine = sorted((r for r in common if r["lang"] == row["lang"]), key=lambda r: r["place"])
        counts = np.array([r["n"] for r in mine], dtype=float)
        hist = np.array([row["sums"][k] for k in range(N_CLASSES)], dtype=float)
        out.languages.append(row["lang"])
        shares.append(hist / hist.sum())
        out.word_shares.append(np.append(counts, total - counts.sum()) / total)
        out.word_hashes.append(_hash_words([r["word"] for r in mine]))
    if shares:
        out.class_shares = np.array(shares)
    return out


def _word_distances(found, rows: int, refs: References) -> np.ndarray:
    """Least distance of each row's words from a reference."""
    n = np.diff(found.rows)
    row_of = np.repeat(np.arange(rows), n)
    least = np.ones(rows)
    for hashes, share in zip(refs.word_hashes, refs.word_shares):
        order = np.argsort(hashes)
        at = np.minimum(np.searchsorted(hashes[order], found.hashes), max(len(hashes) - 1, 0))
        hit = hashes[order][at] == found.hashes if len(hashes) else np.zeros(len(found.hashes), dtype=bool)
        bins = np.where(hit, order[at] if len(hashes) else 0, len(hashes))
        width = len(hashes) + 1
        hist = np.bincount(row_of * width + bins, minlength=rows * width).reshape(rows, width)
        least = np.minimum(least, distance(hist / np.maximum(n, 1)[:, None], share))
    return least


def judge(docs: DataFrame, refs: References, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Every row of ``docs`` with the counts, ``base_failed``, both distances and ``kept``.

    A null text is empty and so fails for its length.  Distances of texts
    shorter than the guards are null and reject nothing, as they do when there
    is no reference.  Columns named like a result are replaced.  Repeated rows stay.
    """
    small_batches(docs.sparkSession)
    columns = [c for c in docs.columns if c.lower() not in RESULTS]
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(*f) for f in zip(RESULTS, kinds)])
    positions = [docs.columns.index(c) for c in columns]
    text_at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = shared.value
        for batch in batches:
            for chunk in chunks(batch.column(text_at)):
                found = words(chunk)
                counts, hist = _counts(chunk, found, rules.window)
                failed = _failed(counts, rules)
                size = hist.sum(axis=1)
                by_class = np.full(len(chunk), np.nan)
                by_word = np.full(len(chunk), np.nan)
                if refs.languages:
                    share = hist / np.maximum(size, 1)[:, None]
                    least = np.min([distance(share, q) for q in refs.class_shares], axis=0)
                    by_class = np.where(size >= rules.class_guard, least, np.nan)
                    by_word = np.where(
                        counts[:, 0] >= rules.word_guard, _word_distances(found, len(chunk), refs), np.nan)
                far = (by_class > rules.max_class_distance) | (by_word > rules.max_word_distance)
                rows = batch.slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(k) for k in positions] + [pa.array(counts[:, k]) for k in range(5)]
                    + [pa.array(failed), pa.array(by_class, from_pandas=True), pa.array(by_word, from_pandas=True),
                       pa.array(~failed & ~far)],
                    names=schema.names)

    return docs.mapInArrow(run, schema)
