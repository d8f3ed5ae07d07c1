"""Object reader: one row per object of every basket, still as raw XML text.

Objects are cut by nesting depth (see `cutter`), before any XML parsing, so a filter on class, basket or TID drops an object
before it is parsed.  Dialect and encoding are those of each file.  The same cutter reads every file:

* If all files of the folder are small, a row is a whole file, many files per task.
* Otherwise the text source cuts files into byte ranges at any tag, so one basket holding most of the data still
  spreads over many tasks.  A first scan surveys the ranges; the driver follows their changes, one small row
  for each range (as it keeps a task for each), and tells each range what is open where it begins.  The parts of an object
  that runs over a border are put together by a grouping that sees only such parts.  Records of the text source begin at tags that open a
  line, as most files have few tags to a record then; if the survey has not seen every byte, as a line is too long, they begin at any tag.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.errors import TransferError
from basketlens.functions.markup import IN_TAG, attribute
from basketlens.plans.catalog import Model
from basketlens.sources import cutter as cut
from basketlens.sources.session import fresh_path, small_batches

WHOLE_FILE_BYTES = 64 * 1024 * 1024

V23 = "2.3"
V24 = "2.4"

_HEAD = f"^<{IN_TAG}>"
_NAMES = ("file", "block", "kind", "owner", "basket_no", "pos", "basket_tag", "raw", "dialect", "plain_tag", "plain_tid",
          "plain_operation", "plain_basket", "plain_bid")
_TYPES = dict.fromkeys(_NAMES, "string") | {"block": "long", "owner": "long", "basket_no": "int", "pos": "int"}
_ROWS = ", ".join(f"{n} {t}" for n, t in _TYPES.items())
_ARROW = {"string": pa.binary(), "long": pa.int64(), "int": pa.int32()}
_BATCH_BYTES = 4 << 20

# Start tags that need no XML rules: no other attributes, no references in them.  All others are read by `attribute`.
_PLAIN_OBJECT = (r"""^<(?P<tag>[\w.:-]+)(?:[ \t\r\n]+(?:[\w.-]+:tid|TID)="(?P<tid>[^"&<]*)")?"""
                 r"""(?:[ \t\r\n]+(?:[\w.-]+:operation|OPERATION)="(?P<operation>[A-Z]*)")?[ \t\r\n]*/?>$""")
_PLAIN_BASKET = re.compile(rb"""<([\w.:-]+)(?:[ \t\r\n]+(?:[\w.-]+:bid|BID)="([^"&<]*)")?[ \t\r\n]*/?>""")


class Tags:
    """Names of classes and topics by tag, for one model; ``dialect`` None leaves it to each file."""

    def __init__(self, model: Model, dialect: str | None = None, prefixes: dict[str, str] | None = None):
        if dialect not in (None, V23, V24):
            raise TransferError(f"unknown transfer dialect: {dialect}")
        self.dialect = dialect
        self.prefixes = prefixes or {}
        self.by_tag: dict[str, list[str]] = {}
        for info in model.transferred():
            self.by_tag.setdefault(self.class_tag(info.fqn), []).append(info.fqn)
        self.models = sorted({c.model for c in model.transferred()} or {c.model for c in model.classes.values()})

    def prefix(self, model_name: str) -> str:
        return self.prefixes.get(model_name, model_name)

    def class_tag(self, fqn: str) -> str:
        """Tag of a class in the second dialect; in the first one it is the full name."""
        model_name, _, rest = fqn.partition(".")
        return f"{self.prefix(model_name)}:{rest.rpartition('.')[2]}"

    def _either(self, first: Column, second: Column) -> Column:
        if self.dialect is not None:
            return first if self.dialect == V23 else second
        return F.when(F.col("dialect") == V23, first).otherwise(second)

    def class_fqn(self, tag: Column, topic: Column) -> Column:
        """Full class name of an object tag inside a basket of ``topic``."""
        name = F.substring_index(tag, ":", -1)
        here = F.concat_ws(".", topic, name)
        second = here
        if self.by_tag:
            known = F.create_map(*[F.lit(x) for t, fqns in self.by_tag.items() for x in (t, "\x00".join(fqns))])[tag]
            candidates = F.split(known, "\x00")
            second = (
                F.when(candidates.isNull() | F.array_contains(candidates, here), here)
                .when(F.size(candidates) == 1, candidates[0])
                .otherwise(here))
        return self._either(tag, second)

    def topic(self, tag: Column) -> Column:
        owners = {self.prefix(m): m for m in self.models if self.prefix(m) != m}
        prefix = F.substring_index(tag, ":", 1)
        if owners:
            named = F.create_map(*[F.lit(x) for kv in owners.items() for x in kv])
            prefix = F.coalesce(named[prefix], prefix)
        return self._either(tag, F.concat_ws(".", prefix, F.substring_index(tag, ":", -1)))


def read_objects(
    spark: SparkSession,
    path: str,
    model: Model,
    dialect: str | None = None,
    prefixes: dict[str, str] | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    strict: bool = True,
) -> DataFrame:
    """(file, block, basket_no, pos, basket_tag, bid, topic, class_fqn, tid, operation, raw, dialect).

    ``pos`` orders objects within a basket of one block.  ``dialect`` reads only files of that dialect.  ``strict`` fails on a
    truncated file; otherwise complete objects before the damage are returned.
    """
    if not path:
        raise TransferError("path must not be empty")
    tags = Tags(model, dialect, prefixes)
    if largest_file(spark, path) <= whole_file_bytes:
        return objects_of_texts(whole_texts(spark, path), tags, strict)
    ranges = surveyed_ranges(spark, path, strict)
    whole = _cut_ranges(spark, path, ranges, (cut.OBJECT,))
    parts = _cut_ranges(spark, path, ranges, (cut.BEGUN, cut.CONTINUED, cut.ENDED))
    return _named(whole.unionByName(_stitched(parts)), tags)


def objects_by_class(objects: DataFrame) -> DataFrame:
    """Rows of `read_objects` (but for their places) stored in one folder per class, so that a filter on class reads only its own.

    For jobs that need several classes of a folder: it is cut once.
    """
    kept = objects.select("file", "bid", "tid", "operation", "raw", "dialect", "class_fqn")
    staged = fresh_path(objects.sparkSession, "objects")
    kept.write.partitionBy("class_fqn").parquet(staged)
    return objects.sparkSession.read.schema(kept.schema).parquet(staged)


def largest_file(spark: SparkSession, path: str) -> int:
    """Size of the largest input file; the listing reads no content."""
    found = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    if found is None:
        raise TransferError(f"no transfer file found: {path}")
    return found


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    small_batches(spark)
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("block"), "value"
    )


def objects_of_texts(texts: DataFrame, tags: Tags, strict: bool = True) -> DataFrame:
    """Objects of complete files; stateless, so it runs on a file stream as well."""
    return _named(_cut_files(texts, (cut.OBJECT,), strict), tags)


def read_documents(
    spark: SparkSession, path: str, model: Model, dialect: str | None = None, whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame | None:
    """Rows of `read_objects` and, in their places, rows of headers (``header``) and baskets; file after file, in order.

    None if a file is cut into ranges, whose parts are not in order.
    """
    if largest_file(spark, path) > whole_file_bytes:
        return None
    rows = _cut_files(whole_texts(spark, path), (cut.HEADER, cut.BASKET, cut.OBJECT), strict=True)
    is_object = F.col("kind") == cut.OBJECT
    shown = rows.withColumn("header", F.when(F.col("kind") == cut.HEADER, F.col("raw"))).withColumn(
        "raw", F.when(is_object, F.col("raw")))
    return _named(shown, Tags(model, dialect), "header")


def _named(rows: DataFrame, tags: Tags, *more: str) -> DataFrame:
    """Read the start tags of objects and baskets, but for those that the cutter has read."""
    if tags.dialect is not None:
        rows = rows.filter(F.col("dialect") == tags.dialect)
    plain, plain_basket = F.col("plain_tag").isNotNull(), F.col("plain_basket").isNotNull()
    tagged = rows.select(
        "*", F.when(~plain, F.regexp_extract("raw", _HEAD, 0)).alias("head"),
        F.when(plain, F.col("plain_tag")).otherwise(_tag_name(F.col("raw"))).alias("tag"),
        tags.topic(F.when(plain_basket, F.col("plain_basket")).otherwise(_tag_name(F.col("basket_tag")))).alias("topic"))
    operation = F.when(plain, F.col("plain_operation")).otherwise(F.upper(attribute(F.col("head"), "OPERATION")))
    return tagged.select(
        "file", "block", "basket_no", "pos", "basket_tag",
        F.when(plain_basket, F.col("plain_bid")).otherwise(attribute(F.col("basket_tag"), "BID")).alias("bid"), "topic",
        tags.class_fqn(F.col("tag"), F.col("topic")).alias("class_fqn"),
        F.when(plain, F.col("plain_tid")).otherwise(attribute(F.col("head"), "TID")).alias("tid"),
        F.coalesce(operation, F.lit("INSERT")).alias("operation"), "raw", "dialect", *more)


def _tag_name(start_tag: Column) -> Column:
    return F.regexp_extract(start_tag, r"^<([^\s/>]+)", 1)


# ---------------------------------------------------------------- cutting

def _dialect_of(root: bytes | None) -> str | None:
    """Dialect that a root tag belongs to (fixed names)."""
    name = b"" if root is None else cut.name_of(root)
    return V23 if name == b"TRANSFER" else V24 if name.endswith(b":transfer") else None


class _Rows:
    """Collects rows of the wanted kinds as batches of bounded size."""

    def __init__(self, kinds: Sequence[str]):
        self._kinds, self._rows, self._done, self._bytes = kinds, [], [], 0

    def add(self, file: str, data: bytes | None, source: cut.Cutter, encoding: str | None) -> Iterator[pa.RecordBatch]:
        """The rows of a stretch; of the end of a range if ``data`` is None."""
        found = source.rest() if data is None else source.runs(data)
        for row in found:
            if isinstance(row, cut.Run):
                if cut.OBJECT not in self._kinds:
                    continue
                if encoding is None:
                    self._close()
                    self._done.append(_of_run(file, data, row, source))
                    self._bytes += int(row.ends[-1] - row.starts[0])
                else:
                    self._rows += [self._row(file, r, source, encoding) for r in row.rows(data)]
            elif row.kind in self._kinds:
                self._rows.append(self._row(file, row, source, encoding))
            if self._bytes >= _BATCH_BYTES:
                yield self.batch()

    def _row(self, file: str, row: cut.Row, source: cut.Cutter, encoding: str | None) -> tuple:
        text = cut.recoded(row.text, encoding)
        if row.kind == cut.HEADER:
            text = _as_utf8(text)
        tag = None if row.basket_tag is None else cut.recoded(row.basket_tag, encoding)
        self._bytes += len(text)
        return (file, source.block, row.kind, row.owner, row.basket_no, row.pos, tag, text, _dialect_of(source.root),
                None, None, None, None, None)

    def _close(self) -> None:
        if self._rows:
            columns = zip(*self._rows, strict=True)
            self._done.append([pa.array(c, type=_ARROW[t]) for c, t in zip(columns, _TYPES.values(), strict=True)])
            self._rows = []

    def batch(self) -> pa.RecordBatch:
        self._close()
        done = self._done or [[pa.array([], type=_ARROW[t]) for t in _TYPES.values()]]
        self._done, self._bytes = [], 0
        arrays = [pa.concat_arrays(c) for c in zip(*done, strict=True)]
        try:
            arrays = [x.cast(pa.string()) if x.type == pa.binary() else x for x in arrays]
        except pa.ArrowInvalid:
            raise TransferError(f"text is not in the encoding that it names: {done[0][0][0].as_py().decode()}") from None
        return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _pieces(data: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts between places that follow one another."""
    places = np.column_stack([starts, ends]).ravel().astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
    return every.take(pa.array(np.arange(0, len(places) - 1, 2)))


def _of_run(file: str, data: bytes, run: cut.Run, source: cut.Cutter) -> list[pa.Array]:
    """The columns of whole objects."""
    n = len(run.starts)
    same = lambda value, kind="string": pa.repeat(pa.scalar(value, _ARROW[kind]), n)
    read = pc.extract_regex(_pieces(data, run.starts, run.heads), _PLAIN_OBJECT)
    tag, tid, operation = (pc.struct_field(read, k) for k in ("tag", "tid", "operation"))
    tid, operation = (pc.if_else(pc.equal(x, b""), pa.scalar(None, pa.binary()), x) for x in (tid, operation))
    basket = _PLAIN_BASKET.fullmatch(run.basket_tag or b"")
    name, bid = (basket.group(1), basket.group(2) or None) if basket else (None, None)
    return [
        same(file.encode()), same(source.block, "long"), same(cut.OBJECT.encode()), same(run.owner, "long"),
        same(run.basket_no, "int"), pa.array(np.arange(run.pos, run.pos + n, dtype=np.int32)), same(run.basket_tag),
        _pieces(data, run.starts, run.ends), same(d.encode() if (d := _dialect_of(source.root)) else None),
        tag, tid, operation, same(name), same(bid)]


def _as_utf8(header: bytes) -> bytes:
    """A header whose declaration names the encoding that is written."""
    head, mark, rest = header.partition(b"?>")
    known = cut.encoding_of(head + mark)
    if known is None:
        return header
    at = head.index(b"encoding")
    return head[:at] + b'encoding="UTF-8"' + mark + rest


def _checked(file: str, source: cut.Cutter, strict: bool) -> None:
    if strict and source.torn():
        raise TransferError(f"transfer is truncated or not well formed: {file}")
    if strict and _dialect_of(source.root) is None:
        raise TransferError(f"no transfer root element found: {file}")


def _cut_files(texts: DataFrame, kinds: Sequence[str], strict: bool) -> DataFrame:
    """Rows of whole files (file, block, value)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(kinds)
        for batch in batches:
            for file, block, value in zip(*batch.columns, strict=True):
                file, data = file.as_py(), value.as_py()
                if not data:  # what a task without rows has written; plain, it is not even read
                    continue
                encoding = cut.encoding_of(data[:512])
                if encoding in ("utf-16", "utf-32"):
                    data, encoding = cut.recoded(data, encoding), None
                source = cut.Cutter(block.as_py())
                for text in cut.stretches(data.removeprefix(cut.codecs.BOM_UTF8)):
                    yield from out.add(file, text, source, encoding)
                _checked(file, source, strict)
        yield out.batch()

    return texts.select("file", "block", F.col("value").cast("binary").alias("value")).mapInArrow(run, _ROWS)


# ---------------------------------------------------------------- large files

#: What records of ranges begin with: a tag that opens a line, of which a record holds so many bytes at most; or any tag.
_LINES, _TAGS = "\n<", "<"
_LINE_BYTES = 4 << 20
_PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


class Ranges(NamedTuple):
    """What is open where each range begins, as (open elements, mode, encoding) by file and block; and what records begin with."""

    states: dict[tuple[str, int], tuple]
    separator: str


def range_records(spark: SparkSession, path: str, separator: str = _TAGS) -> DataFrame:
    """(file, block, value): text between separators, in order within a byte range (``block`` is where it begins).

    A record belongs to the range its first byte lies in; the range sizes are those of the text source.  As a record is short,
    ``file`` is the number of its file, by `file_numbers`.  The reader leaves out lines of more than ``_LINE_BYTES``, so that none is held.
    """
    small_batches(spark)
    reader = spark.read
    if separator == _LINES:
        reader = reader.option("mapreduce.input.linerecordreader.line.maxlength", str(_LINE_BYTES))
    return reader.text(path, lineSep=separator).select(
        F.xxhash64(F.input_file_name()).alias("file"), F.input_file_block_start().alias("block"),
        F.col("value").cast("binary").alias("value"))


def file_numbers(spark: SparkSession, path: str) -> dict[int, tuple[str, int]]:
    """Name and size of the files by number; the listing reads no content."""
    listed = spark.read.format("binaryFile").load(path).select(
        F.xxhash64(F.input_file_name()).alias("number"), F.col("_metadata.file_path").alias("name"), "length").collect()
    found = {r.number: (r.name, r.length) for r in listed}
    if len(found) < len({r.name for r in listed}):
        raise TransferError(f"two files have the same number: {path}")
    return found


def _range_stretches(
    batches: Iterator[pa.RecordBatch], names: dict[int, tuple[str, int]], separator: str
) -> Iterator[tuple[tuple[str, int], bytes]]:
    """Stretches of each range, the separators back in front of their records."""
    current, held, size = None, [], 0
    for batch in batches:
        blocks = batch.column(1).to_numpy()
        numbers = batch.column(0).to_numpy()
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (numbers[1:] != numbers[:-1])) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)], strict=True):
            if begin == end:
                continue
            key = (names[int(numbers[begin])][0], int(blocks[begin]))
            bracketed = pc.binary_join_element_wise(b"", batch.column(2).slice(begin, end - begin), separator.encode())
            first, last = np.frombuffer(bracketed.buffers()[1], np.int32)[[bracketed.offset, bracketed.offset + len(bracketed)]]
            text = bracketed.buffers()[2].slice(first, last - first).to_pybytes()
            if key != current:
                if held:
                    yield current, b"".join(held)
                # Only the first record of a file follows no separator.
                current, held, size = key, [], 0
                text = text if key[1] else text[len(separator):]
            held.append(text)
            size += len(text)
            if size >= cut.STRETCH:
                yield current, b"".join(held)
                held, size = [], 0
    if held:
        yield current, b"".join(held)


def _survey(batches: Iterator[pa.RecordBatch], names: dict[int, tuple[str, int]], separator: str) -> Iterator[pa.RecordBatch]:
    for (file, block), group in groupby(_range_stretches(batches, names, separator), key=lambda x: x[0]):
        survey, head, size = cut.Survey(block), b"", 0
        for _, text in group:
            size += len(text)
            if not block and len(head) < 512:
                head += text[:512]
                text = text.removeprefix(cut.codecs.BOM_UTF8)
            survey.feed(text)
        yield pa.RecordBatch.from_pydict({
            "file": [file], "block": pa.array([block], pa.int64()), "head": pa.array([head], pa.binary()),
            "changes": pa.array([pickle.dumps([_plain(c) for c in survey.changes.values()])], pa.binary()),
            "size": pa.array([size], pa.int64())})


def _plain(change: cut.Change) -> tuple:
    return change.closes, [tuple(o) for o in change.opens], change.mode


def _surveyed(spark: SparkSession, path: str, names: dict[int, tuple[str, int]], separator: str) -> list:
    shared = spark.sparkContext.broadcast(names)
    return range_records(spark, path, separator).mapInArrow(
        lambda batches: _survey(batches, shared.value, separator),
        "file string, block long, head binary, changes binary, size long").collect()


def _all_seen(found: list, names: dict[int, tuple[str, int]]) -> bool:
    """Whether records have every byte of all files, but for a byte order mark, which the reader leaves out."""
    sizes = dict.fromkeys((name for name, _ in names.values()), 0)
    for row in found:
        sizes[row.file] += row.size
    return all(length - sizes[name] in (0, len(cut.codecs.BOM_UTF8)) for name, length in names.values())


def range_states(spark: SparkSession, path: str, strict: bool = True) -> dict[tuple[str, int], tuple]:
    return surveyed_ranges(spark, path, strict).states


def surveyed_ranges(spark: SparkSession, path: str, strict: bool = True) -> Ranges:
    """The ranges after a scan of the whole text."""
    names, separator, found = file_numbers(spark, path), _LINES, []
    if not any(name.endswith(_PACKED) for name, _ in names.values()):
        found = _surveyed(spark, path, names, separator)
    if not found or not _all_seen(found, names):
        separator = _TAGS
        found = _surveyed(spark, path, names, separator)
    states = {}
    for file, group in groupby(sorted(found, key=lambda r: (r.file, r.block)), key=lambda r: r.file):
        so_far, encoding = cut.Change(0, (), cut.CONTENT), None
        for row in group:
            if row.block == 0:
                encoding = cut.encoding_of(bytes(row.head))
                if encoding in ("utf-16", "utf-32"):
                    raise TransferError(f"a file of this encoding cannot be read in ranges; raise whole_file_bytes: {file}")
            states[file, row.block] = (so_far.opens, so_far.mode, encoding)
            closes, opens, mode = pickle.loads(row.changes)[so_far.mode]
            so_far = cut.followed(so_far, cut.Change(closes, tuple(cut.Open(*o) for o in opens), mode))
        if strict and (so_far.closes or so_far.opens or so_far.mode != cut.CONTENT):
            raise TransferError(f"transfer is truncated or not well formed: {file}")
    return Ranges(states, separator)


def _cut_ranges(spark: SparkSession, path: str, ranges: Ranges, kinds: Sequence[str]) -> DataFrame:
    shared, separator = spark.sparkContext.broadcast((ranges.states, file_numbers(spark, path))), ranges.separator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, (known, names) = _Rows(kinds), shared.value
        for (file, block), group in groupby(_range_stretches(batches, names, separator), key=lambda x: x[0]):
            opened, mode, encoding = known[file, block]
            source = cut.Cutter(block, opened, mode)
            for i, (_, text) in enumerate(group):
                if not block and not i:
                    text = text.removeprefix(cut.codecs.BOM_UTF8)
                yield from out.add(file, text, source, encoding)
            yield from out.add(file, None, source, encoding)
        yield out.batch()

    return range_records(spark, path, separator).mapInArrow(run, _ROWS)


def _stitched(parts: DataFrame) -> DataFrame:
    """Objects that run over range borders; one range begins at most one of them."""
    begun = F.max(F.when(F.col("kind") == cut.BEGUN, F.struct("basket_no", "pos", "basket_tag"))).alias("begun")
    joined = parts.groupBy("file", "owner").agg(
        begun, F.max(F.col("kind") == cut.ENDED).alias("ended"), F.max("dialect").alias("dialect"),
        F.array_sort(F.collect_list(F.struct("block", "raw"))).alias("parts"))
    return joined.filter("ended AND begun IS NOT NULL").select(
        "file", F.col("owner").alias("block"), F.lit(cut.OBJECT).alias("kind"), "owner", "begun.basket_no", "begun.pos",
        "begun.basket_tag", F.array_join("parts.raw", "").alias("raw"), "dialect",
        *(F.lit(None).cast("string").alias(n) for n in _NAMES if n.startswith("plain_")))


def read_layout(
    spark: SparkSession, path: str, model: Model, dialect: str | None = None, prefixes: dict[str, str] | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """(file, block, basket_no, basket_tag, header): the frame that objects stand in.

    One row per basket start, also of empty baskets, and one row per file and
    range (number -1) with the text before the first basket of the file.
    """
    kinds = (cut.BASKET, cut.HEADER)
    if largest_file(spark, path) <= whole_file_bytes:
        rows = _cut_files(whole_texts(spark, path), kinds, strict=False)
        blocks = None
    else:
        ranges = surveyed_ranges(spark, path, strict=False)
        rows = _cut_ranges(spark, path, ranges, kinds)
        blocks = spark.createDataFrame(list(ranges.states), "file string, block long")
    if dialect is not None:
        rows = rows.filter(F.col("dialect") == dialect)
    starts = rows.filter(F.col("kind") == cut.BASKET).select(
        "file", "block", "basket_no", "basket_tag", F.lit(None).cast("string").alias("header"))
    headers = rows.filter(F.col("kind") == cut.HEADER).select("file", "block", F.col("raw").alias("header"))
    if blocks is not None:
        headers = blocks.join(headers.drop("block"), "file", "left").withColumn("header", F.coalesce("header", F.raise_error(
            F.concat(F.lit("the header does not fit a byte range: "), F.col("file")))))
    return starts.unionByName(headers.select(
        "file", "block", F.lit(-1).alias("basket_no"), F.lit(None).cast("string").alias("basket_tag"), "header"))
