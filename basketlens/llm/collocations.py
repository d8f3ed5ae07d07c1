"""Phrases of two to four words that occur together more often than apart.

**Tries.**  Candidates of one length are a double-array trie: ``base[state] + symbol`` is the next state if ``check`` names the
state there.  A task lays its texts end to end as word numbers and advances the states of all positions at once, one word per
level; accepting states are counted with ``bincount`` and the counts of all tasks are summed.  Words get their numbers from a trie
over their bytes in the same way.

**Candidates.**  Level by level: the sequences seen in the text both of whose parts (all words but the last, all but the first)
are candidates themselves, and that reach the least count.  The pass that counts a level also proposes the next one: each
task sends a proposal once per stretch of text with its count, of which no more than the least count is needed as evidence.

**Size.**  Tries hold at most ``SHARD`` candidates.  More candidates are cut into shards by number; each shard is broadcast
and counted by itself, and its counts are added to the others'.  Texts are read twice (to count words, to number them);
further passes read the written word numbers.  Scores are exact decimals.

A null text is empty, a null language is ``und``.  Repeated rows count each.  Ties in score go by count, then by phrase in byte
order.  An empty table, and one without a phrase that is frequent enough, give an empty result.  Other columns are not read.  Very
long texts are worked on whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import numbered, small_batches, text_of
from basketlens.llm.text_arrays import LOWER, Chunk, chunks
from basketlens.sources.session import cut_lineage

#: Candidates of a trie at most; bytes of text, and word numbers, that are worked on at once.
SHARD = 1 << 20
STRETCH, STRIDE = 2 << 20, 1 << 19
#: Bytes of a row group of word numbers.  Their rows are long: a task holds a row group as one batch, however large its file is.
GROUP = 8 << 20
#: Bits of a symbol of a phrase trie, and symbols of a word's number (31 bits).
DIGIT, DIGITS = 11, 3
SCHEMA = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"

_BLANK, _STOP = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _STOP


# ---------------------------------------------------------------- double arrays

class Trie(NamedTuple):
    """``base`` and ``check`` by state, and the number of the sequence that ends there (-1: none); state 0 is the root."""

    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and which of them exist."""
        to = self.base[states] + symbols
        there = (symbols >= 0) & (to >= 0) & (to < len(self.check))
        to[~there] = 0
        there &= self.check[to] == states
        return to.astype(np.int32), there


def _places(children: list[np.ndarray]) -> tuple[list[int], int]:
    """A base for each set of symbols (ascending) so that no two sets meet in a slot; and the number of slots.

    First fit, larger sets first; sets of one symbol fill the holes.  A stretch of slots is left behind when a
    set of the size at hand is unlikely to fit there.
    """
    free = np.ones(1 << 12, dtype=bool)
    free[0] = False
    bases, hint, window = [0] * len(children), 1, 1 << 10
    order = sorted(range(len(children)), key=lambda i: -len(children[i]))
    several = [i for i in order if len(children[i]) > 1]
    for i in several:
        apart = (children[i] - children[i][0]).tolist()
        at = hint
        while True:
            if at + window + apart[-1] >= len(free):
                free = np.append(free, np.ones(len(free) + apart[-1], dtype=bool))
            fits = free[at:at + window].copy()
            for d in apart[1:]:
                fits &= free[at + d:at + d + window]
            first = int(fits.argmax())
            if fits[first]:
                at += first
                break
            if at == hint and window * free[at:at + window].mean() ** len(apart) < 4:
                hint += window
            at += window
        for d in apart:
            free[at + d] = False
        bases[i] = at - int(children[i][0])
    lone = order[len(several):]
    slots = np.flatnonzero(free)
    if len(slots) < len(lone):
        slots = np.append(slots, len(free) + np.arange(len(lone) - len(slots)))
    for i, slot in zip(lone, slots.tolist(), strict=False):
        bases[i] = slot - int(children[i][0])
    used = max([0, *np.flatnonzero(~free)[-1:].tolist(), *slots[:len(lone)][-1:].tolist()])
    return bases, used + 1


def trie(symbols: np.ndarray, bounds: np.ndarray, numbers: np.ndarray) -> Trie:
    """The trie of sequences that lie end to end between bounds, none of them empty."""
    begins, lengths = bounds[:-1], np.diff(bounds)
    parent = np.zeros(len(begins), dtype=np.int64)
    edges, nodes = [], 1  # node 0 is the root; edges are (parent, symbol) of the nodes from 1 on
    alive = np.arange(len(begins))
    span = int(symbols.max(initial=0)) + 1
    level = 0
    while len(alive := alive[lengths[alive] > level]):
        edge, node = np.unique(parent[alive] * span + symbols[begins[alive] + level], return_inverse=True)
        edges.append(edge)
        parent[alive] = node + nodes
        nodes += len(edge)
        level += 1
    end = parent
    edge = np.concatenate(edges) if edges else np.zeros(0, dtype=np.int64)
    above, symbol = edge // span, edge % span
    order = np.lexsort((symbol, above))
    inner, first = np.unique(above[order], return_index=True)
    bases, slots = _places([c for c in np.split(symbol[order], first[1:]) if len(c)])
    base_of = np.zeros(nodes, dtype=np.int64)
    base_of[inner] = bases
    slot = np.zeros(nodes, dtype=np.int64)
    slot[1:] = base_of[above] + symbol
    base, check, accept = (np.full(slots, v, dtype=np.int32) for v in (0, -2, -1))
    base[slot] = base_of
    check[slot[1:]] = slot[above]
    accept[slot[end]] = numbers
    return Trie(base, check, accept)


def byte_rows(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary values end to end, and their bounds."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)), bounds


def word_trie(langs: pa.Array, words: pa.Array, numbers: np.ndarray) -> tuple[dict[str, int], Trie]:
    """A trie over the bytes of words behind one symbol for the language (256 and up), and these symbols."""
    names = {lang: 256 + i for i, lang in enumerate(sorted(set(langs.to_pylist())))}
    data, bounds = byte_rows(words)
    starts = bounds[:-1] - bounds[0]
    symbols = np.insert(data[bounds[0]:bounds[-1]].astype(np.int64), starts, [names[lang] for lang in langs.to_pylist()])
    return names, trie(symbols, bounds - bounds[0] + np.arange(len(bounds)), numbers)


def find_words(words: pa.Array, symbol: int | None, by_bytes: Trie) -> np.ndarray:
    """The number of each word of a language (-1: none); all words advance together, a byte at a time."""
    out = np.full(len(words), -1, dtype=np.int32)
    if symbol is None or not len(words):
        return out
    data, bounds = byte_rows(words)
    at, left = bounds[:-1].copy(), np.diff(bounds)
    states, there = by_bytes.step(np.zeros(len(words), dtype=np.int64), np.full(len(words), symbol, dtype=np.int64))
    alive = np.flatnonzero(there)
    states = states[alive]
    while len(alive):
        done = left[alive] == 0
        out[alive[done]] = by_bytes.accept[states[done]]
        alive, states = alive[~done], states[~done]
        states, there = by_bytes.step(states, data[at[alive]].astype(np.int64))
        alive, states = alive[there], states[there]
        at[alive] += 1
        left[alive] -= 1
    return out


def digits(words: np.ndarray) -> np.ndarray:
    """Word numbers as symbols: digits of `DIGIT` bits in a new last axis, so that no state has many or far children."""
    return words[..., None] >> (DIGIT * np.arange(DIGITS)[::-1]) & ((1 << DIGIT) - 1)


def phrase_trie(words: np.ndarray, numbers: np.ndarray) -> Trie:
    """The trie of the rows of a matrix of word numbers."""
    size = words.shape[1] * DIGITS
    return trie(digits(words).ravel(), size * np.arange(len(words) + 1), numbers)


def accepted(ids: np.ndarray, words: int, by_words: Trie) -> np.ndarray:
    """Of each position of the numbered text: the candidate of so many words that begins there (-1: none)."""
    out = np.full(len(ids), -1, dtype=np.int32)
    alive = np.flatnonzero(ids[:max(0, len(ids) - words + 1)] >= 0)
    states = np.zeros(len(alive), dtype=np.int32)
    for level in range(words):
        for shift in range(DIGIT * (DIGITS - 1), -1, -DIGIT):
            here = ids[alive + level]
            states, there = by_words.step(states, np.where(here < 0, -1, here >> shift & ((1 << DIGIT) - 1)))
            alive, states = alive[there], states[there]
    out[alive] = by_words.accept[states]
    return out


# ---------------------------------------------------------------- text to word numbers

class Tokens(NamedTuple):
    """Lower-cased words of a chunk, the row of each, and whether it opens a piece."""

    words: pa.Array
    rows: np.ndarray
    opens: np.ndarray


def tokens(chunk: Chunk) -> Tokens:
    kind = _KIND[chunk.data]
    inside = kind == 0
    n = len(inside)
    cut = np.zeros(n + 1, dtype=bool)
    cut[chunk.offsets] = True
    begins, stops = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1] | cut[1:n]
        stops[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(LOWER[chunk.data[inside]])])
    rows = np.searchsorted(chunk.offsets, starts, side="right") - 1
    piece = np.cumsum(kind == _STOP)[starts] if len(starts) else starts
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = (rows[1:] != rows[:-1]) | (piece[1:] != piece[:-1])
    return Tokens(words, rows, opens)


def _by_language(langs: list[str], found: Tokens) -> Iterator[tuple[str, np.ndarray]]:
    """Each language of a chunk with the places of its words."""
    names = sorted(set(langs))
    place = {name: i for i, name in enumerate(names)}
    of_row = np.array([place[lang] for lang in langs])
    of_word = of_row[found.rows]
    for i, name in enumerate(names):
        yield name, np.flatnonzero(of_word == i)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, word, n`` of each stretch; the row without word has the number of all words."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for chunk in chunks(batch.column(1), STRETCH):
            found = tokens(chunk)
            for lang, at in _by_language(langs[chunk.first:chunk.first + len(chunk)], found):
                counts = found.words.take(pa.array(at)).value_counts()
                words, times = counts.field(0).cast(pa.large_string()), counts.field(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(words) + 1)), pa.concat_arrays([words, pa.nulls(1, pa.large_string())]).cast(pa.string()),
                     pa.concat_arrays([times.cast(pa.int64()), pa.array([len(at)], type=pa.int64())])],
                    names=["lang", "word", "n"])


def _closed_up(ids: np.ndarray) -> np.ndarray:
    """Word numbers without words that stand alone; one gap (-1) between runs."""
    known = ids >= 0
    before, after = np.append(False, known[:-1]), np.append(known[1:], False)
    out = np.where(known & (before | after), ids, -1)
    keep = out >= 0
    keep[1:] |= out[:-1] >= 0
    return out[keep]


def _numbers(docs: DataFrame, shards: list) -> DataFrame:
    """``ids``: texts as runs of word numbers, many texts to a row.  A row of an earlier shard's pass brings its open words along."""
    fields = "lang string, ids array<int>, rest array<string>"

    def looked_up(words: pa.Array, lang: str, shared) -> np.ndarray:
        names, by_bytes = shared.value
        return find_words(words, names.get(lang), by_bytes)

    def row(lang: str, ids: np.ndarray, rest: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([ids.astype(np.int32)], type=pa.list_(pa.int32())),
             pa.array([rest.to_pylist()], type=pa.list_(pa.string()))], names=["lang", "ids", "rest"])

    def resolved(lang: str, ids: np.ndarray, open_words: pa.Array, shared, last: bool) -> pa.RecordBatch:
        """Open words are numbered from -2 downwards."""
        number = looked_up(open_words, lang, shared)
        still = np.flatnonzero(number < 0)
        number[still] = -1 if last else -2 - np.arange(len(still))
        whole = np.where(ids <= -2, number[np.clip(-2 - ids, 0, len(number) - 1)], ids) if len(number) else ids
        return row(lang, _closed_up(whole) if last else whole, pa.array([], pa.string()) if last else open_words.take(pa.array(still)))

    def first(shared, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                langs = batch.column(0).to_pylist()
                for chunk in chunks(batch.column(1), STRETCH):
                    found = tokens(chunk)
                    for lang, at in _by_language(langs[chunk.first:chunk.first + len(chunk)], found):
                        if not len(at):
                            continue
                        coded = found.words.take(pa.array(at)).dictionary_encode()
                        ids = np.full(2 * len(at), -3, dtype=np.int64)
                        ids[1::2] = -2 - coded.indices.to_numpy()
                        keep = np.ones(len(ids), dtype=bool)
                        keep[::2] = found.opens[at]
                        ids[::2] = -1
                        yield resolved(lang, ids[keep], coded.dictionary.cast(pa.large_string()).cast(pa.string()), shared, last)
        return run

    def later(shared, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lang, ids, rest in zip(*(batch.column(k) for k in range(3)), strict=True):
                    yield resolved(lang.as_py(), ids.values.to_numpy().astype(np.int64), rest.values, shared, last)
        return run

    spark, coded = docs.sparkSession, docs
    for i, load in enumerate(shards):
        shared = spark.sparkContext.broadcast(load())
        coded = cut_lineage(
            coded.mapInArrow((later if i else first)(shared, i == len(shards) - 1), fields), "phrase-ids", GROUP)
        shared.unpersist()
    return coded.select("ids")


# ---------------------------------------------------------------- levels

def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Word numbers of many rows end to end, a gap behind each."""
    for batch in batches:
        held, size = [], 0
        for ids in batch.column(0):
            held += [ids.values.to_numpy(), np.array([-1], dtype=np.int32)]
            size += len(held[-2])
            if size >= STRIDE:
                yield np.concatenate(held)
                held, size = [], 0
        if held:
            yield np.concatenate(held)


def _pass(ids: DataFrame, words: int, shared, whole: bool, further: bool, least: int) -> DataFrame:
    """``kind, key, n``: counts of the candidates of a trie (kind 0), and proposals that are one word longer (kind 1).

    A proposal's key is its first part's number and its last word's (31 bits).  ``whole``: the trie holds all candidates of its length.
    Without a trie, candidates are the words themselves.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text in _stretches(batches):
            if shared is None:
                here = text.astype(np.int64)
            else:
                first, by_words = shared.value
                here = accepted(text, words, by_words).astype(np.int64)
                times = np.bincount(here[here >= 0]) if len(here) else here
                seen = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(seen), dtype=np.int32)), pa.array(seen + first), pa.array(times[seen].astype(np.int64))],
                    names=["kind", "key", "n"])
            if further and len(text) > words:
                ahead = text[words:].astype(np.int64)
                longer = (here[:-words] >= 0) & (ahead >= 0)
                if whole:
                    longer &= here[1:len(here) - words + 1] >= 0
                at = np.flatnonzero(longer)
                start = here[at] + (0 if shared is None else shared.value[0])
                key, times = np.unique(start << 31 | ahead[at], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(key), dtype=np.int32)), pa.array(key), pa.array(np.minimum(times, least).astype(np.int64))],
                    names=["kind", "key", "n"])

    return ids.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).filter(
        (F.col("kind") == 0) | (F.col("n") >= least))


def _level(ids: DataFrame, candidates: DataFrame | None, words: int, further: bool, least: int) -> tuple[DataFrame | None, DataFrame]:
    """Counts of a level's candidates (``rank, n``) and the proposals for the next (``key``)."""
    spark = ids.sparkSession
    if candidates is None:
        found = cut_lineage(_pass(ids, words, None, True, further, least), "phrase-counts")
        return None, found.filter("kind = 1").select("key")
    size, parts = candidates.count(), []
    columns = [f"w{i}" for i in range(1, words + 1)]
    for first in range(0, size, SHARD):
        table = candidates.filter(f"rank >= {first} AND rank < {first + SHARD}").select("rank", *columns).toArrow()
        rows = np.stack([table.column(c).to_numpy() for c in columns], axis=1).astype(np.int64)
        made = phrase_trie(rows, table.column("rank").to_numpy() - first)
        shared = spark.sparkContext.broadcast((first, made))
        parts.append(cut_lineage(_pass(ids, words, shared, size <= SHARD, further, least), "phrase-counts"))
        shared.unpersist()
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    # A proposal comes from the shard of its first part alone.
    return found.filter("kind = 0").select(F.col("key").alias("rank"), "n"), found.filter("kind = 1").select("key")


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences; None if no word is that frequent.

    ``docs`` has ``lang`` and ``text`` without nulls.  Returns ``lang, n`` (words of a language), ``id, lang, word`` of the frequent words
    and ``ws, f``: word numbers and count of every frequent phrase, single words too.
    """
    small_batches(docs.sparkSession)
    counted = cut_lineage(
        docs.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(f"word IS NULL OR n >= {least}"), "phrase-words")
    totals = counted.filter("word IS NULL").select("lang", "n")
    words = cut_lineage(
        numbered(counted.filter("word IS NOT NULL"), None, [F.col("n").desc(), F.col("lang"), F.col("word")], "phrase-rank")
        .select(F.col("rank").cast("int").alias("id"), "lang", "word", "n"), "phrase-vocabulary")
    size = words.count()
    if not size:
        return None

    def shard(first: int):
        def load():
            table = words.filter(f"id >= {first} AND id < {first + SHARD}").toArrow().combine_chunks()
            return word_trie(*(table.column(c).combine_chunks() for c in ("lang", "word")), table.column("id").to_numpy())
        return load

    ids = _numbers(docs.select("lang", "text"), [shard(first) for first in range(0, size, SHARD)])
    phrases = words.select(F.array("id").alias("ws"), F.col("n").alias("f"))
    level, before = None, words.select(F.col("id").cast("long").alias("rank"), F.col("id").alias("w1"))
    for length in range(1, longest + 1):
        counts, proposals = _level(ids, level, length, length < longest, least)
        columns = [f"w{i}" for i in range(1, length + 1)]
        if counts is not None:
            phrases = phrases.union(level.join(counts, "rank").select(F.array(*columns).alias("ws"), F.col("n").alias("f")))
        if length == longest:
            break
        longer = proposals.select(F.shiftright("key", 31).alias("rank"), F.col("key").bitwiseAND((1 << 31) - 1).cast("int").alias("next"))
        longer = longer.join(before, "rank").select(*columns, F.col("next").alias(f"w{length + 1}"))
        level = cut_lineage(numbered(longer, None, [F.col(c) for c in longer.columns], "phrase-rank"), f"phrase-level{length + 1}")
        before = level
        if not level.limit(1).count():
            break
    return totals, words, cut_lineage(phrases, "phrase-frequent")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = 30,
    longest: int = 4,
    percent: int = 80,
    scale: int = 2_000_000,
    top: int = 2000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of each language.

    Of a phrase's cuts the one with the lowest score counts: ``floor(scale * a / (l + r))`` of its count and those of both
    sides (ties: the shorter left side).  Phrases inside a longer one that has ``percent`` of their occurrences are left out.
    """
    plain = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    found = frequent_phrases(plain, least, longest)
    if found is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    totals, words, phrases = found
    wide = F.size("ws")
    candidates = phrases.filter(wide > 1).select("ws", F.col("f").alias("a"))

    def parts(ws, first, size):
        return F.slice(ws, first, size)

    # Every part of a longer phrase, with the largest count of a phrase around it.
    inside = F.flatten(F.transform(F.sequence(F.lit(2), wide - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("ws") - m + 1), lambda i: parts(F.col("ws"), i, m))))
    around = candidates.filter(wide > 2).select(F.explode(inside).alias("ws"), F.col("a").alias("f")).groupBy("ws").agg(F.max("f").alias("around"))
    exact = "decimal(28,0)"
    kept = candidates.join(around, "ws", "left").filter(
        F.col("around").isNull() | (F.col("around").cast(exact) * 100 < F.col("a").cast(exact) * percent)).select("ws", "a")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), wide - 1))).select(
        "ws", "a", "k", parts(F.col("ws"), F.lit(1), F.col("k")).alias("left"),
        parts(F.col("ws"), F.col("k") + 1, wide - F.col("k")).alias("right"))
    one = phrases.select(F.col("ws").alias("left"), F.col("f").alias("l"))
    two = phrases.select(F.col("ws").alias("right"), F.col("f").alias("r"))
    # A decimal divided by ``div`` is a whole number.
    score = F.expr(f"(cast({scale} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.join(one, "left").join(two, "right").withColumn("score", score).groupBy("ws", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spelled = (
        scored.select("ws", F.posexplode("ws").alias("place", "id")).join(words.select("id", "lang", "word"), "id").groupBy("ws")
        .agg(F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelled"))
        .select("ws", "lang", F.concat_ws(" ", "spelled.word").alias("phrase")))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.select("ws", "a", "cut.score", "cut.l", "cut.r").join(spelled, "ws").withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
