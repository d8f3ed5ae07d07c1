"""Hidden Markov language model over the words of a corpus.

Words are counted over all training documents.  The ``head`` commonest words are symbols of
their own; other words are symbols by class (a hash of their last three bytes), within which a word has its
share of the class's count plus one.  The end of a text is a symbol too.

Baum-Welch: every task runs forward and backward over its training documents, cut
into segments, and sends expected counts per symbol and state; Spark sums them, and the driver
holds the model, whose size is fixed by ``head``, ``classes`` and ``states``.  The first states are
groups of common words that occur near each other.  Scoring runs the scaled forward recursion over whole texts; words
outside the head get their share by a join with the counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import lower_ascii, row_struct, text_of, unpacked, words_of
from basketlens.sources.session import cut_lineage

#: Symbols of a row of written training texts, about.
LOT = 1 << 18
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


@dataclass(frozen=True)
class Settings:
    head: int = 1 << 16
    classes: int = 1024
    states: int = 8
    rounds: int = 3
    segment: int = 128  # tokens of a training sequence
    grouped: int = 512  # commonest words that the first states are made from
    near: int = 4  # words apart that count as near
    prior: float = 200.0  # tokens' worth of the overall distribution in each state


@dataclass
class Vocabulary:
    """The head in order of count, and totals."""

    words: list[bytes]
    counts: np.ndarray
    class_counts: np.ndarray  # tokens of each class of other words
    tokens: int  # with the ends of texts
    types: int
    texts: int

    @property
    def n_symbols(self) -> int:
        return len(self.words) + len(self.class_counts) + 1

    @property
    def end(self) -> int:
        return self.n_symbols - 1


@dataclass
class Model:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # symbols x states


def count_words(train: DataFrame) -> DataFrame:
    """``word, c`` over all rows of ``train`` (column ``text``)."""
    return train.select(F.explode(words_of(lower_ascii(F.col("text")))).alias("word")).groupBy("word").agg(
        F.count("*").alias("c"))


def class_of(classes: int) -> Column:
    return (F.crc32(F.substring(F.encode("word", "utf-8"), -3, 3)) % classes).cast("int")


def vocabulary(train: DataFrame, counts: DataFrame, settings: Settings) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and class totals ``class, class_n, class_types`` of words outside the head."""
    head = counts.orderBy(F.col("c").desc(), "word").limit(settings.head).collect()
    names = [r["word"].encode("utf-8") for r in head]
    # The head ends within a count; the words of that count are in it up to the last one by name.
    least, last = (head[-1]["c"], head[-1]["word"]) if head else (0, "")
    outside = (F.col("c") < least) | ((F.col("c") == least) & (F.col("word") > last))
    classes = cut_lineage(
        counts.filter(outside).groupBy(class_of(settings.classes).alias("class"))
        .agg(F.sum("c").alias("class_n"), F.count("*").alias("class_types")), "lm-classes")
    sums = np.zeros(settings.classes, dtype=np.int64)
    types = len(names)
    for r in classes.collect():
        sums[r["class"]] = r["class_n"]
        types += r["class_types"]
    texts = train.count()
    head_counts = np.array([r["c"] for r in head], dtype=np.int64)
    tokens = int(head_counts.sum() + sums.sum() + texts)
    return Vocabulary(names, head_counts, sums, tokens, types + (texts > 0), texts), classes


class Coder:
    """Turns texts into symbols."""

    def __init__(self, vocab: Vocabulary):
        self.of = {w: i for i, w in enumerate(vocab.words)}
        self.first_class, self.classes, self.end = len(vocab.words), len(vocab.class_counts), vocab.end

    def symbols(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        """Symbols of a text with its end, and its words outside the head."""
        tokens = text.encode("utf-8").lower().split()
        get = self.of.get
        out = [get(t, -1) for t in tokens]
        out.append(self.end)
        found = np.array(out, dtype=np.int64)
        missing = np.flatnonzero(found < 0)
        other = [tokens[i] for i in missing]
        if other:
            found[missing] = [self.first_class + zlib.crc32(t[-3:]) % self.classes for t in other]
        return found, other


def _per_task(function, vocab_shared):
    """A mapInArrow function whose tasks make their coder once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches, Coder(vocab_shared.value))
    return run


def _symbols(train: DataFrame, shared) -> DataFrame:
    """The training texts as symbols, each text closed by its end, many to a row; written once for all passes."""
    def run(batches, coder):
        for batch in batches:
            held, weight = [], 0
            for value in batch.column(0):
                held.append(coder.symbols(value.as_py())[0].astype(np.int32))
                weight += len(held[-1])
                if weight >= LOT:
                    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held)], type=pa.list_(pa.int32()))], names=["symbols"])
                    held, weight = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held)], type=pa.list_(pa.int32()))], names=["symbols"])

    return cut_lineage(train.mapInArrow(_per_task(run, shared), "symbols array<int>"), "lm-symbols")


def _near_words(coded: DataFrame, vocab: Vocabulary, settings: Settings) -> np.ndarray:
    """How often two of the commonest words occur near each other in a text."""
    m, head, end = settings.grouped, len(vocab.words), vocab.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(m * m, dtype=np.int64)
        for batch in batches:
            for row in batch.column(0):
                found = row.values.to_numpy()
                text = np.cumsum(found == end)
                common = (found < m) & (found < head)
                for gap in range(1, settings.near + 1):
                    both = common[:-gap] & common[gap:] & (text[:-gap] == text[gap:])
                    total += np.bincount(found[:-gap][both].astype(np.int64) * m + found[gap:][both], minlength=m * m)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    rows = coded.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(m * m)
    table[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=float)
    table = table.reshape(m, m)
    return table + table.T


def first_groups(table: np.ndarray, states: int) -> np.ndarray:
    """A group for each common word: k-means over what stands near it, from far-apart words."""
    size = np.maximum(table.sum(axis=1), 1.0)
    near = np.sqrt(table / size[:, None])
    chosen = [int(size.argmax())]
    apart = ((near - near[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(1, states):
        chosen.append(int((apart * np.sqrt(size)).argmax()))
        apart = np.minimum(apart, ((near - near[chosen[-1]]) ** 2).sum(axis=1))
    centres = near[chosen]
    group = np.zeros(len(table), dtype=np.int64)
    for _ in range(25):
        group = ((near[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for k in range(states):
            if (group == k).any():
                centres[k] = np.average(near[group == k], axis=0, weights=size[group == k])
    return group


def overall(vocab: Vocabulary) -> np.ndarray:
    """The distribution of symbols without states."""
    counts = np.concatenate((vocab.counts, vocab.class_counts, [vocab.texts])).astype(float) + 1.0
    return counts / counts.sum()


def first_model(vocab: Vocabulary, group: np.ndarray, settings: Settings) -> Model:
    s = settings.states
    emits = np.repeat(overall(vocab)[:, None], s, axis=1)
    for word in range(min(len(group), len(vocab.words))):
        emits[word] *= 0.1
        emits[word, group[word]] *= 50.0
    moves = np.full((s, s), 0.1 / max(1, s - 1))
    np.fill_diagonal(moves, 0.9)
    return Model(np.full(s, 1.0 / s), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def expected_counts(segments: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward over segments (time x segments, -1 after the end): counts of symbols, moves and starts."""
    steps, width = segments.shape
    s = len(model.start)
    pad = len(model.emits)
    emits = np.vstack((model.emits, np.ones(s)))
    symbol = np.where(segments < 0, pad, segments)
    forward = np.empty((steps, width, s))
    scale = np.empty((steps, width))
    now = np.broadcast_to(model.start, (width, s))
    for t in range(steps):
        now = (now if t == 0 else now @ model.moves) * emits[symbol[t]]
        scale[t] = now.sum(axis=1)
        now = now / scale[t][:, None]
        forward[t] = now
    backward = np.ones((width, s))
    moves = np.zeros((s, s))
    state = np.empty_like(forward)
    state[-1] = forward[-1]
    for t in range(steps - 1, 0, -1):
        seen = emits[symbol[t]] * backward / scale[t][:, None]
        inside = (segments[t] >= 0)[:, None]
        moves += (forward[t - 1] * inside).T @ seen
        backward = seen @ model.moves.T
        state[t - 1] = forward[t - 1] * backward
    flat = symbol.ravel()
    flows = state.reshape(-1, s)
    counts = np.stack([np.bincount(flat, flows[:, k], pad + 1)[:pad] for k in range(s)], axis=1)
    return counts, moves * model.moves, state[0].sum(axis=0)


def _round(coded: DataFrame, vocab: Vocabulary, model: Model, settings: Settings) -> Model:
    """One step of Baum-Welch over all training documents."""
    sent = coded.sparkSession.sparkContext.broadcast(model)
    length, s, n_symbols, end = settings.segment, settings.states, vocab.n_symbols, vocab.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        total = np.zeros((n_symbols + s + 1, s))  # symbols, then moves, then starts
        held: list[np.ndarray] = []
        weight = 0

        def work():
            table = np.full((len(held), length), -1, dtype=np.int64)
            for i, part in enumerate(held):
                table[i, :len(part)] = part
            counts, moves, start = expected_counts(np.ascontiguousarray(table.T), model)
            total[:n_symbols] += counts
            total[n_symbols:n_symbols + s] += moves
            total[-1] += start

        for batch in batches:
            for row in batch.column(0):
                found, begin = row.values.to_numpy(), 0
                for stop in (np.flatnonzero(found == end) + 1).tolist():
                    for at in range(begin, stop, length):
                        held.append(found[at:min(at + length, stop)])
                        weight += 1
                        if weight == 1024:
                            work()
                            held, weight = [], 0
                    begin = stop
        if held:
            work()
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(list(total[at]), type=pa.list_(pa.float64()))], names=["at", "n"])

    sums = [F.sum(F.col("n")[k]).alias(f"s{k}") for k in range(s)]
    rows = coded.mapInArrow(run, "at long, n array<double>").groupBy("at").agg(*sums).toPandas()
    total = np.zeros((n_symbols + s + 1, s))
    total[rows["at"].to_numpy(dtype=np.int64)] = rows[[f"s{k}" for k in range(s)]].to_numpy(dtype=float)
    emits = total[:n_symbols] + settings.prior * overall(vocab)[:, None]
    moves = total[n_symbols:-1] + 1.0
    start = total[-1] + 1.0
    return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def likelihoods(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural log of each symbol sequence's probability, by the scaled forward recursion."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    lengths = np.array([len(texts[i]) for i in order])
    joined = np.concatenate([texts[i] for i in order])
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    out = np.zeros(len(texts))
    now = np.broadcast_to(model.start, (len(texts), len(model.start)))
    active = len(texts)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        while active and lengths[active - 1] <= t:
            active -= 1
        now = now[:active] if t == 0 else now[:active] @ model.moves
        now = now * model.emits[joined[firsts[:active] + t]]
        size = now.sum(axis=1)
        now = now / size[:, None]
        out[:active] += np.log(size)
    result = np.empty(len(texts))
    result[order] = out
    return result


def _score_texts(docs: DataFrame, shared, model: Model) -> DataFrame:
    """Per row: what the head and the states give, and the words outside the head with their numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.select("row_id", "row").schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("head_known", T.LongType()),
        T.StructField("head_logs", T.DoubleType()), T.StructField("forward", T.DoubleType()),
        T.StructField("other", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])))])

    def run(batches, coder):
        vocab, model = shared.value, sent.value
        logs = np.zeros(vocab.n_symbols)
        logs[:len(vocab.words)] = np.log10(vocab.counts + 1.0)
        logs[-1] = np.log10(vocab.texts + 1.0)
        for batch in batches:
            first = 0
            while first < batch.num_rows:
                texts, names, numbers, offsets, weight = [], [], [], [0], 0
                while first + len(texts) < batch.num_rows and weight < 2_000_000:
                    found, other = coder.symbols(batch.column(2)[first + len(texts)].as_py())
                    texts.append(found)
                    several = Counter(other)
                    names += several.keys()
                    numbers += several.values()
                    offsets.append(len(names))
                    weight += len(found)
                known = [int((t < len(vocab.words)).sum()) + (vocab.texts > 0) for t in texts]
                others = pa.StructArray.from_arrays(
                    [pa.array(names, type=pa.binary()).cast(pa.string()), pa.array(numbers, type=pa.int64())], ["word", "n"])
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array([len(t) for t in texts], type=pa.int64()),
                     pa.array(known, type=pa.int64()), pa.array([float(logs[t].sum()) for t in texts], type=pa.float64()),
                     pa.array(likelihoods(texts, model) / np.log(10.0)),
                     pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), others)],
                    names=schema.names)
                first += len(texts)

    return docs.select("row_id", "row", "text").mapInArrow(_per_task(run, shared), schema)


def score(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
          settings: Settings = Settings(), carry: list[str] | None = None) -> DataFrame:
    """Every row with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities).

    The model and the counts come from the rows where ``learn_from`` holds (null: not).  A null text is empty and has one
    token, its end.  Repeated rows are scored each, and count each where they are learnt from.  With nothing to
    learn from, every token has probability 1 in the base and the model is uniform over symbols.  ``carry`` names the columns to return
    (default: all but the text); one named like a result is replaced.
    """
    columns = [c for c in docs.columns if c != text_col] if carry is None else list(carry)
    spark = docs.sparkSession
    train = docs.filter(learn_from).select(text_of(text_col).alias("text"))
    counts = cut_lineage(count_words(train), "lm-counts")
    vocab, classes = vocabulary(train, counts, settings)
    shared = spark.sparkContext.broadcast(vocab)
    coded = _symbols(train, shared)
    group = first_groups(_near_words(coded, vocab, settings), settings.states)
    model = first_model(vocab, group, settings)
    for _ in range(settings.rounds):
        model = _round(coded, vocab, model, settings)

    rows = docs.select(row_struct(docs, columns).alias("row"), text_of(text_col).alias("text"))
    # Row numbers are fixed by writing them with the scores.
    scored = cut_lineage(
        _score_texts(rows.withColumn("row_id", F.monotonically_increasing_id()), shared, model), "lm-scored")
    total = float(vocab.tokens + vocab.types + 1)
    each = scored.select("row_id", F.explode("other").alias("one")).select("row_id", "one.word", "one.n")
    share = (
        each.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
        .withColumn("class", class_of(settings.classes))
        .join(F.broadcast(classes), "class", "left")  # a row per class: ``classes`` at most
        .groupBy("row_id").agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
            F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"),
            F.sum(F.col("n") * F.log10(F.coalesce("class_n", F.lit(0)) + F.coalesce("class_types", F.lit(0)) + 1.0)).alias("within")))
    joined = scored.drop("other").join(share, "row_id", "left")
    logs = F.col("head_logs") + F.coalesce("logs", F.lit(0.0))
    return unpacked(joined, columns, {
        "n_tokens": F.col("n_tokens"), "n_known": F.col("head_known") + F.coalesce("known", F.lit(0)),
        "train_tokens": F.lit(vocab.tokens).cast("long"),
        "base_score": logs - F.col("n_tokens") * F.log10(F.lit(total)),
        "score": F.col("forward") + F.coalesce(F.col("logs") - F.col("within"), F.lit(0.0))})
