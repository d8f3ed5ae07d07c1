"""Passages that repeat across documents, by a sparse suffix array over words.

Suffixes begin at minimisers: of every ``select`` words the run of ``gram`` words with the least hash, so that equal
passages select equal places.  Any passage of ``width`` words has a selected
place near its start from which at least ``width - select + gram - 1`` words lie inside it.

Suffixes are range-partitioned and sorted by that many words (as a 64-bit hash), and neighbours
compared: those that agree across documents stay.  The matches are then extended to the left
and right: each window of ``width`` words around a match is sorted and compared in the same way.  Windows
found in several documents are joined to spans.  A sort key ends with document and place, so a passage of very many
documents spreads over several partitions; only the first and the last key of a partition are looked up beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import SPACES, text_of
from basketlens.llm.text_arrays import chunks, runs_of, words
from basketlens.sources.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    width: int = 50  # words of a passage at least
    select: int = 26  # any so many words have a selected place
    gram: int = 10  # words that are compared to select a place

    @property
    def suffix(self) -> int:
        return self.width - (self.select - self.gram)


def selected(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    """Places of minimisers that are followed by enough words."""
    grams = runs_of(hashes, settings.gram)
    window = settings.select - settings.gram + 1
    if len(hashes) < settings.width or len(grams) < window:
        return np.zeros(0, dtype=np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1) + np.arange(len(grams) - window + 1)
    places = np.unique(least)
    return places[places + settings.suffix <= len(hashes)]


def _records(docs: DataFrame, settings: Settings) -> DataFrame:
    """``key, doc, place`` of the suffixes of every text (``doc, text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1)):
                found = words(chunk)
                keys, places, owners = [], [], []
                for i in range(len(chunk)):
                    hashes = found.hashes[found.of(i)]
                    at = selected(hashes, settings)
                    if len(at):
                        keys.append(runs_of(hashes, settings.suffix)[at])
                        places.append(at)
                        owners.append(np.full(len(at), ids[chunk.first + i]))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners)),
                         pa.array(np.concatenate(places).astype(np.int32))], names=["key", "doc", "place"])

    return docs.mapInArrow(run, "key long, doc long, place int")


def _windows(docs: DataFrame, settings: Settings) -> DataFrame:
    """``key, doc, place`` of every window around the matched ``places`` of each text (``doc, places, text``)."""
    reach = settings.width - settings.suffix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(2)):
                found = words(chunk)
                keys, places, owners = [], [], []
                for i in range(len(chunk)):
                    at = np.asarray(batch.column(1)[chunk.first + i].values, dtype=np.int64)
                    runs = runs_of(found.hashes[found.of(i)], settings.width)
                    starts = np.unique(at[:, None] - np.arange(reach + 1)[None, :])
                    starts = starts[(starts >= 0) & (starts < len(runs))]
                    keys.append(runs[starts])
                    places.append(starts)
                    owners.append(np.full(len(starts), ids[chunk.first + i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners)),
                     pa.array(np.concatenate(places).astype(np.int32))], names=["key", "doc", "place"])

    return docs.mapInArrow(run, "key long, doc long, place int")


#: States of a compared record: to be looked up beyond the partition, found in several documents, or only a partition's border.
OPEN, FOUND, BORDER = 0, 1, 2


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted records with the state of their key.  Held back are at most one document's records of one key."""
    names = ["key", "doc", "place", "state"]

    def rows(key, doc, place, state):
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(doc), pa.array(place), pa.array(np.full(len(key), state, dtype=np.int32))], names=names)

    def border(key, docs):
        return rows(np.full(len(docs), key), np.array(docs, dtype=np.int64), np.full(len(docs), -1, dtype=np.int32), BORDER)

    first_key = known = last = None
    held = None
    for batch in batches:
        key, doc, place = (batch.column(k).to_numpy() for k in range(3))
        if held is not None:
            key, doc, place = (np.concatenate(pair) for pair in zip(held, (key, doc, place)))
            held = None
        if not len(key):
            continue
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        ends = np.append(starts[1:], len(key))
        several = doc[starts] != doc[ends - 1]
        if known is not None and key[0] == known:
            several[0] = True
        if first_key is None:
            first_key = key[0]
        if key[0] == first_key:
            yield border(first_key, [doc[0], doc[ends[0] - 1]])
        at_last = starts[-1]
        last = (key[-1], last[1] if last and last[0] == key[-1] else doc[at_last], doc[-1])
        known = key[-1] if several[-1] else None
        take = np.repeat(several, ends - starts)
        if take.any():
            yield rows(key[take], doc[take], place[take], FOUND)
        if not several[0] and key[0] == first_key and len(starts) > 1:
            yield rows(key[:ends[0]], doc[:ends[0]], place[:ends[0]], OPEN)
        if not several[-1]:
            held = key[at_last:], doc[at_last:], place[at_last:]
    if last is not None:
        yield border(last[0], [last[1], last[2]])
    if held is not None:
        yield rows(*held, OPEN)


def repeated(records: DataFrame, label: str) -> DataFrame:
    """``doc, place`` of the records (``key, doc, place``) whose key occurs in several documents."""
    order = ["key", "doc", "place"]
    compared = cut_lineage(
        records.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_compare_neighbours, "key long, doc long, place int, state int"), label)
    across = (
        compared.filter(F.col("state") != FOUND).groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .filter("low <> high").select("key"))  # two keys a partition at most
    looked_up = compared.filter(F.col("state") == OPEN).join(F.broadcast(across), "key", "left_semi")
    return compared.filter(F.col("state") == FOUND).select("doc", "place").union(looked_up.select("doc", "place"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A key of each row from its id and text; rows equal in both are one document."""
    text = text_of(text_col)
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("doc"), text.alias("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``doc_id, start_word, end_word, n_words`` of each longest run of words covered by passages found in several documents.

    Words count from 0 and the end is the first word after the span.  Words are compared as they stand, white space does
    not count.  A null, empty or shorter text has no spans; rows equal in id and text are one document and have their
    spans once each.  An empty table gives an empty result.
    """
    keyed = _keyed(docs, id_col, text_col)
    matched = repeated(_records(keyed.select("doc", "text"), settings), "suffixes")
    places = matched.groupBy("doc").agg(F.collect_set("place").alias("places"))  # as many as a text has selected places
    around = places.join(keyed.select("doc", "text"), "doc").select("doc", "places", "text")
    windows = repeated(_windows(around, settings), "windows").distinct()
    order = Window.partitionBy("doc").orderBy("place")
    begins = (F.col("place") > F.coalesce(F.lag("place").over(order), F.lit(-1 - settings.width)) + settings.width).cast("int")
    runs = windows.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order))
    spans = runs.groupBy("doc", "run").agg(
        F.min("place").cast("long").alias("start_word"), (F.max("place") + settings.width).cast("long").alias("end_word"))
    return keyed.select("id", "doc").join(spans, "doc").select(
        F.col("id").alias(id_col), "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))


def passages(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The spans with the ``passage`` they stand for, its words joined by one space."""
    split = F.filter(F.split(text_of(text_col), SPACES), lambda w: w != "")
    return spans.join(docs.select(id_col, split.alias("all_words")), id_col).withColumn(
        "passage", F.array_join(F.slice("all_words", F.col("start_word").cast("int") + 1, F.col("n_words").cast("int")), " ")
    ).drop("all_words")
