"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies cover all training documents.  The weights are fitted
by follow-the-regularised-leader with L1 and L2 penalties on a sample whose size is the
parameter ``sample`` (distinct texts by smallest hash); a further ``calibration`` rows
set the temperature.  Fitting runs in one task on these bounded rows, prediction on every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import text_of
from basketlens.llm.text_arrays import mix64

RESULTS = ("lang_pred", "score")
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15  # hashed n-grams
    shortest: int = 1
    longest: int = 3
    sample: int = 4000
    calibration: int = 1000
    epochs: int = 3
    alpha: float = 0.5  # step size of the leader
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0


def grams(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and how often each occurs; digits are one sign, white space another."""
    folded = " " + text.lower() + " "
    codes = np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    codes = np.where((codes >= 48) & (codes <= 57), np.uint64(48), codes)
    codes = np.where((codes >= 9) & (codes <= 13), np.uint64(32), codes)
    counts = np.zeros(settings.buckets, dtype=np.int64)
    rolling = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, settings.longest + 1):
        if len(codes) < n:
            break
        rolling = rolling[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:]
        if n >= settings.shortest:
            hashed = mix64(rolling + np.uint64(n << 56)) % np.uint64(settings.buckets)
            counts += np.bincount(hashed.astype(np.int64), minlength=settings.buckets)
    at = np.flatnonzero(counts)
    return at, counts[at]


def features(text: str, idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sparse TF-IDF vector of length 1."""
    at, counts = grams(text, settings)
    value = (1.0 + np.log(counts)) * idf[at]
    norm = np.sqrt((value * value).sum())
    return at, value / norm if norm else value


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, settings: Settings):
    """Weights and bias by follow-the-regularised-leader, one row at a time."""
    size = settings.buckets + 1  # the last is the bias
    z = np.zeros((size, n_labels))
    n = np.zeros((size, n_labels))

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        rate = (settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2
        return np.where(np.abs(zz) <= settings.l1, 0.0, -(zz - np.sign(zz) * settings.l1) / rate)

    for _ in range(settings.epochs):
        for (at, value), label in zip(vectors, labels):
            at, value = np.append(at, settings.buckets), np.append(value, 1.0)
            w = weights(at)
            error = _softmax(value @ w)
            error[label] -= 1.0
            g = value[:, None] * error[None, :]
            before = n[at]
            after = before + g * g
            z[at] += g - (np.sqrt(after) - np.sqrt(before)) / settings.alpha * w
            n[at] = after
    w = weights(np.arange(size))
    return w[:-1], w[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, part = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all rows of ``texts``; a task sends its sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(settings.buckets, dtype=np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                seen[grams(value.as_py() or "", settings)[0]] += 1
                rows += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))],
                                         names=["bucket", "n"])

    out = np.zeros(settings.buckets, dtype=np.int64)
    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = 0
    for r in rows:
        if r["bucket"] < 0:
            total = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, total


def train(docs: DataFrame, learn_from: Column, text_col: str = "text", lang_col: str = "lang",
          settings: Settings = Settings()) -> Model | None:
    """Fit on the rows where ``learn_from`` holds and the language is not null; None if there are none."""
    rows = docs.filter(learn_from & F.col(f"`{lang_col}`").isNotNull()).select(
        text_of(text_col).alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    frequency, total = document_frequencies(rows.select("text"), settings)
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return None
    idf = np.log((1.0 + total) / (1.0 + frequency)) + 1.0
    code = {lang: k for k, lang in enumerate(languages)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py(), idf, settings) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([at.astype(np.int32) for at, _ in found], type=pa.list_(pa.int32())),
                 pa.array([v.astype(np.float32) for _, v in found], type=pa.list_(pa.float32()))],
                names=["lang", "at", "value"])

    # The bounded sample: the texts with the smallest hashes, each once.
    hashed = rows.withColumn("pick", F.xxhash64("text"))
    last = (hashed.select("pick").distinct().orderBy("pick").limit(settings.sample + settings.calibration)
            .agg(F.max("pick")).first()[0])
    picked = (hashed.filter(F.col("pick") <= last).groupBy("pick").agg(F.min(F.struct("lang", "text")).alias("row"))
              .select("row.lang", "row.text"))
    fitted = picked.mapInArrow(vectors, "lang string, at array<int>, value array<float>").repartition(1).mapInArrow(
        lambda batches: _fit_task(batches, code, settings), "weights binary, bias binary, temperature double").first()
    return Model(languages, idf, np.frombuffer(fitted["weights"]).reshape(settings.buckets, len(languages)),
                 np.frombuffer(fitted["bias"]), fitted["temperature"])


def _fit_task(batches: Iterator[pa.RecordBatch], code: dict[str, int], settings: Settings) -> Iterator[pa.RecordBatch]:
    found, labels = [], []
    for batch in batches:
        labels += [code[v] for v in batch.column(0).to_pylist()]
        found += [(np.asarray(a.values), np.asarray(v.values, dtype=np.float64))
                  for a, v in zip(batch.column(1), batch.column(2))]
    found_order = sorted(range(len(found)), key=lambda i: (labels[i], found[i][0].tobytes(), found[i][1].tobytes()))
    order = np.array(found_order, dtype=np.int64)[np.random.default_rng(7).permutation(len(found))]
    held = len(found) * settings.calibration // (settings.sample + settings.calibration)
    tune, learn = order[:held], order[held:]
    label = np.array(labels, dtype=np.int64)
    weights, bias = fit([found[i] for i in learn], label[learn], len(code), settings)
    logits = np.array([found[i][1] @ weights[found[i][0]] + bias for i in tune]).reshape(len(tune), len(code))
    yield pa.RecordBatch.from_pydict({
        "weights": pa.array([weights.tobytes()], type=pa.binary()), "bias": pa.array([bias.tobytes()], type=pa.binary()),
        "temperature": [calibrate(logits, label[tune])]})


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Every row with ``lang_pred`` and ``score``, its calibrated probability.

    A null text, one without a letter, and every text if nothing was learnt get ``und`` with score 0.  Columns
    named like a result are replaced.  Repeated rows stay; an empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c.lower() not in RESULTS]
    at = docs.columns.index(text_col)
    positions = [docs.columns.index(c) for c in columns]
    schema = T.StructType([docs.schema[c] for c in columns] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores = [], []
            for value in batch.column(at):
                text = value.as_py()
                if model is None or text is None or not _LETTER.search(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                where, value = features(text, model.idf, settings)
                p = _softmax((value @ model.weights[where] + model.bias) / model.temperature)
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in positions] + [pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64())],
                names=schema.names)

    return docs.mapInArrow(run, schema)
