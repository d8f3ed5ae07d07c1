"""Transfer writer: objects to complete transfer files of bounded size.

Objects are already in the partitions they will be written from.  Each task
frames its objects into complete files (header, baskets, end tags) and starts a
new file at a size limit.  No basket is gathered anywhere: a large basket is
written as parts that carry the same basket id, in as many files as needed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.errors import TransferError
from basketlens.functions.markup import escape_attribute, escape_text
from basketlens.plans.catalog import ClassInfo, Model, PropertyInfo
from basketlens.sources.objects import V23
from basketlens.sources.parse import MAX_NESTING
from basketlens.sources.session import small_batches

TARGET_FILE_BYTES = 48 * 1024 * 1024


def header_text(dialect: str, models: Iterable[str], sender: str = "spark", namespace: str = "urn:transfer") -> str:
    """Header of a new transfer; an edited transfer keeps the header of its input."""
    if dialect == V23:
        listed = "".join(f'<MODEL NAME="{m}"/>' for m in models)
        return (
            f'<?xml version="1.0" encoding="UTF-8"?>\n<TRANSFER xmlns="{namespace}">'
            f'<HEADERSECTION SENDER="{sender}" VERSION="2.3"><MODELS>{listed}</MODELS></HEADERSECTION><DATASECTION>\n'
        )
    spaces = "".join(f' xmlns:{m}="{namespace}:{m}"' for m in models)
    listed = "".join(f"<ili:model>{m}</ili:model>" for m in models)
    return (
        f'<?xml version="1.0" encoding="UTF-8"?>\n<ili:transfer xmlns:ili="{namespace}" xmlns:geom="{namespace}:geom"'
        f"{spaces}><ili:headersection><ili:models>{listed}</ili:models><ili:sender>{sender}</ili:sender>"
        f"</ili:headersection><ili:datasection>\n"
    )


def footer_text(header: str) -> str:
    prefix = re.search(r"<([\w.-]+):transfer\b", header)
    if prefix is None:
        return "</DATASECTION></TRANSFER>"
    return f"</{prefix.group(1)}:datasection></{prefix.group(1)}:transfer>"


class Structure(NamedTuple):
    """A structure that an object has where ``present`` holds (None: always), with the values of its properties."""

    tag: str
    values: dict[str, Column | list]
    present: Column | None = None


class ObjectWriter:
    """XML text of objects of a class from canonical values (see `parse`).

    Values that are listed one by one come as a Python list: texts, or `Structure`, or targets of references, each with a column
    that is NULL where the value is missing.  Their text is a plain expression without arrays.
    """

    def __init__(self, model: Model, info: ClassInfo, dialect: str):
        self.model = model
        self.info = info
        self.dialect = dialect

    def _element(self, prop: PropertyInfo) -> str:
        return prop.name if self.dialect == V23 else f"{prop.owner_fqn.partition('.')[0]}:{prop.name}"

    def _tag(self, fqn: str) -> str:
        if self.dialect == V23:
            return fqn
        return f"{fqn.partition('.')[0]}:{fqn.rpartition('.')[2]}"

    def _attribute(self, name: str, value: Column) -> Column:
        shown = name if self.dialect == V23 else f"ili:{name.lower()}"
        return F.coalesce(F.concat(F.lit(f' {shown}="'), escape_attribute(value), F.lit('"')), F.lit(""))

    def object(self, values: dict[str, Column | list], tid: Column, operation: Column) -> Column:
        """``operation`` INSERT or NULL writes no attribute, as it is the default."""
        tag = self._tag(self.info.fqn)
        marked = F.when(operation != "INSERT", operation)
        body = [self.values(p, values[p.name]) for p in self.info.properties if p.name in values]
        return F.concat(
            F.lit(f"<{tag}"), self._attribute("TID", tid), self._attribute("OPERATION", marked), F.lit(">"),
            *body, F.lit(f"</{tag}>"))

    def values(self, prop: PropertyInfo, values: Column | list, depth: int = 0) -> Column:
        if isinstance(values, list):
            return self._listed(prop, values, depth)
        name = self._element(prop)
        members = []
        if prop.value_kind == "Structure" and depth < MAX_NESTING:
            members = self.model.concrete_structures(prop.target_class_fqn)

        def one(v: Column) -> Column:
            if prop.value_kind == "Reference":
                return F.concat(
                    F.lit(f"<{name}"), self._attribute("REF", v["ref"]), self._attribute("BID", v["bid"]),
                    self._attribute("ORDER_POS", v["order"]), F.lit("/>"))
            if members:
                chosen = None
                for m in members:
                    text = self._structure(m, v, depth)
                    chosen = F.when(v["_tag"] == m.fqn, text) if chosen is None else chosen.when(
                        v["_tag"] == m.fqn, text)
                return F.concat(F.lit(f"<{name}>"), chosen, F.lit(f"</{name}>"))
            text = v if prop.geometry is not None or prop.value_kind == "Structure" else escape_text(v)
            return F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>"))

        listed = F.array_join(F.transform(values, one), "")
        if members:
            listed = F.when(F.size(values) == 0, f"<{name}/>").otherwise(listed)
        return F.coalesce(listed, F.lit(""))

    def _structure(self, info: ClassInfo, value: Column | dict, depth: int) -> Column:
        tag = self._tag(info.fqn)
        body = [self.values(p, value[p.name], depth + 1) for p in info.properties]
        return F.concat(F.lit(f"<{tag}>"), *body, F.lit(f"</{tag}>"))

    def _listed(self, prop: PropertyInfo, values: list, depth: int) -> Column:
        name = self._element(prop)

        def one(v: Column | Structure) -> Column:
            if isinstance(v, Structure):
                text = F.concat(F.lit(f"<{name}>"), self._structure(self.model.classes[v.tag], v.values, depth), F.lit(f"</{name}>"))
                return text if v.present is None else F.when(v.present, text)
            if prop.value_kind == "Reference":
                return F.when(v.isNotNull(), F.concat(F.lit(f"<{name}"), self._attribute("REF", v), F.lit("/>")))
            return F.concat(F.lit(f"<{name}>"), v if prop.geometry is not None else escape_text(v), F.lit(f"</{name}>"))

        listed = F.concat(*(F.coalesce(one(v), F.lit("")) for v in values))
        if prop.value_kind == "Structure":
            listed = F.when(listed == "", f"<{name}/>").otherwise(listed)
        return listed


def basket_tag(dialect: str, topic: str, bid: Column) -> Column:
    if dialect == V23:
        return F.concat(F.lit(f'<{topic} BID="'), escape_attribute(bid), F.lit('">'))
    return F.concat(F.lit(f'<{topic.replace(".", ":")} ili:bid="'), escape_attribute(bid), F.lit('">'))


def write_transfer(
    rows: DataFrame, path: str, header: str | None = None, mode: str = "errorifexists",
    target_bytes: int | None = TARGET_FILE_BYTES, compression: str = "none",
) -> None:
    """Write (header, basket_no, basket_tag, raw) rows as transfer files.

    Rows of one basket should follow each other within a partition.  A row with
    a header starts a new file; rows without any need the ``header`` argument.  Without ``target_bytes`` each task
    streams its rows into one file, however large, which needs the argument too.
    """
    rows = rows.select("header", "basket_no", "basket_tag", "raw")
    small_batches(rows.sparkSession)
    if target_bytes is None:
        _save(rows.mapInArrow(_streamer(header), "value string"), path, mode, compression)
        return
    _save(rows.mapInArrow(_framer(header, target_bytes), "value string"), path, mode, compression, one_row=True)


def write_grouped(rows: DataFrame, path: str, header: str, target_bytes: int, compression: str = "none") -> None:
    """Write (basket_tag, raw) rows in any order as transfer files of about ``target_bytes`` of text.

    A task holds the objects of one file, basket by basket; nothing is sorted.
    """
    small_batches(rows.sparkSession, target_bytes)
    framed = rows.select("basket_tag", "raw").mapInArrow(_grouper(header, target_bytes), "value string")
    _save(framed, path, "errorifexists", compression, one_row=True)


def _save(texts: DataFrame, path: str, mode: str, compression: str, one_row: bool = False) -> None:
    writer = texts.write.mode(mode).option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    (writer.option("maxRecordsPerFile", 1) if one_row else writer).text(path)


#: Rows that a file can grow by before its size is looked at.
_SLICE_ROWS = 1000


def _grouper(header: str, target_bytes: int):
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        baskets: dict[str, list[bytes]] = {}
        size = 0

        def finished() -> pa.RecordBatch:
            parts = [header.encode()]
            for tag, texts in baskets.items():
                parts += [f"{tag}\n".encode(), *texts, f"{_end_tag(tag)}\n".encode()]
            parts.append(footer_text(header).encode())
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary()).cast(pa.string())], names=["value"])

        for batch in batches:
            for begin in range(0, batch.num_rows, _SLICE_ROWS):
                rows = pa.Table.from_batches([batch.slice(begin, _SLICE_ROWS)]).filter(pc.field("raw").is_valid())
                lines = pc.binary_join_element_wise(rows["raw"], "", "\n").combine_chunks()
                tags = rows["basket_tag"].combine_chunks().dictionary_encode()
                for number, tag in enumerate(tags.dictionary.to_pylist()):
                    own = b"".join(lines.filter(pc.equal(tags.indices, number)).cast(pa.binary()).to_pylist())
                    baskets.setdefault(tag, []).append(own)
                    size += len(own)
                if size >= target_bytes:
                    yield finished()
                    baskets, size = {}, 0
        if baskets:
            yield finished()

    return group


def _end_tag(start_tag: str) -> str:
    return "" if start_tag.endswith("/>") else f"</{re.match(r'<([^\s/>]+)', start_tag).group(1)}>"


def _streamer(header: str):
    """Lines of one file per task."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basket = None
        for batch in batches:
            out = [header] if basket is None and batch.num_rows else []
            for _, number, tag, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tag is not None and basket != (number, tag):
                    out += ([_end_tag(basket[1])] if basket else []) + [tag]
                    basket = (number, tag)
                if raw is not None:
                    out.append(raw)
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
        if basket is not None:
            yield pa.RecordBatch.from_pydict({"value": [_end_tag(basket[1]) + footer_text(header)]})

    return stream


def _framer(default_header: str | None, target_bytes: int):
    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header, parts, size, basket = default_header, [], 0, None

        def close_basket():
            parts.append(_end_tag(basket[1]) + "\n")

        def finished():
            if basket is not None:
                close_basket()
            parts.append(footer_text(header))
            return pa.RecordBatch.from_pydict({"value": ["".join(parts)]})

        for batch in batches:
            for new_header, number, tag, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if new_header is not None:
                    if parts:
                        yield finished()
                    header, parts, size, basket = new_header, [new_header], len(new_header), None
                elif not parts:
                    if header is None:
                        raise TransferError("rows without a transfer header")
                    parts.append(header)
                if tag is not None and basket != (number, tag):
                    if basket is not None:
                        close_basket()
                    basket = (number, tag)
                    parts.append(tag + "\n")
                if raw is not None:
                    parts.append(raw + "\n")
                    size += len(raw)
                    if size >= target_bytes:
                        yield finished()
                        parts, size, basket = [], 0, None
        if parts:
            yield finished()

    return frame
