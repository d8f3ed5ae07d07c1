"""Objects shredded into node rows, at any depth, and put together again from them.

A node is an element of an object: the object, a property, or a structure inside a property.  Its ``key`` is the path of child
numbers from the object down, so the order of keys is the order of the text.  ``path`` names the properties on the way and
``ordinals`` counts values of each of them, from 1.  Rows of one object come from one task; nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.markup import escape_attribute, escape_text
from basketlens.plans.catalog import Catalog, ClassInfo, Model, PropertyInfo
from basketlens.sources.objects import V23
from basketlens.sources.parse import MAX_NESTING
from basketlens.sources.tree import Element, parse

OBJECT_KEYS = ("file", "block", "basket_no", "pos", "bid", "tid", "class_fqn", "operation", "dialect", "basket_tag")
#: Which rows of one object belong together.
PLACE = ("file", "block", "basket_no", "pos")
OBJECT, STRUCTURE, BAG, VALUE, REFERENCE, GEOMETRY, UNKNOWN = (
    "object", "structure", "bag", "value", "reference", "geometry", "unknown")
NODE_SCHEMA = (
    "key array<int>, path string, ordinals array<int>, owner string, name string, kind string, tag string, value string, "
    "ref string, ref_bid string, order_pos string, counts map<string,int>")
_TYPES = {
    "key": pa.list_(pa.int32()), "path": pa.string(), "ordinals": pa.list_(pa.int32()), "owner": pa.string(), "name": pa.string(),
    "kind": pa.string(), "tag": pa.string(), "value": pa.string(), "ref": pa.string(), "ref_bid": pa.string(),
    "order_pos": pa.string(), "counts": pa.map_(pa.string(), pa.int32())}
_BATCH_ROWS = 8192


def nesting(model: Model, info: ClassInfo, below: tuple[str, ...] = ()) -> float:
    """Levels of structures below a class; infinite if a structure holds itself."""
    deepest = 0.0
    for prop in info.properties:
        if prop.value_kind == "Structure":
            for member in model.concrete_structures(prop.target_class_fqn):
                deepest = max(deepest, float("inf") if member.fqn in below else 1 + nesting(model, member, (*below, member.fqn)))
    return deepest


def is_deep(model: Model, info: ClassInfo) -> bool:
    """Whether objects can nest deeper than the reader's schema."""
    return nesting(model, info) > MAX_NESTING


@dataclass(frozen=True)
class _View:
    """What shredding needs of a catalog: kinds of properties by class, and structures by tag."""

    kinds: dict[str, dict[str, tuple[str, str | None]]]
    members: dict[str, dict[str, str]]

    @classmethod
    def of(cls, model: Model, classes: Iterable[str]) -> "_View":
        kinds, members, todo = {}, {}, [c for c in classes if c in model.classes]
        while todo:
            fqn = todo.pop()
            if fqn in kinds:
                continue
            kinds[fqn] = {}
            for p in model.classes[fqn].properties:
                kind = GEOMETRY if p.geometry is not None else {"Structure": BAG, "Reference": REFERENCE}.get(p.value_kind, VALUE)
                kinds[fqn][p.name] = (kind, p.target_class_fqn)
                if kind == BAG and p.target_class_fqn not in members:
                    found = model.concrete_structures(p.target_class_fqn)
                    members[p.target_class_fqn] = {tag: m.fqn for m in found for tag in (m.fqn, m.name)}
                    todo += [m.fqn for m in found]
        return cls(kinds, members)


def _nodes(data: bytes, class_fqn: str, view: _View) -> Iterator[tuple]:
    """Rows of one object in the order of its text."""
    def children(parent: Element, owner: str, key: tuple, path: str, ordinals: tuple) -> Iterator[tuple]:
        seen: dict[str, int] = {}
        rows = []
        for number, e in enumerate(parent.kids):
            kind, target = view.kinds[owner].get(e.name, (UNKNOWN, None))
            here, names = (*key, number), f"{path}.{e.name}" if path else e.name
            if kind == BAG:
                rows.append((here, names, ordinals, owner, e.name, BAG, e.tag, None, None, None, None, None))
                seen.setdefault(e.name, 0)
                for inside, s in enumerate(e.kids):
                    fqn = view.members[target].get(s.tag) or view.members[target].get(s.name)
                    if fqn is None:
                        rows.append(((*here, inside), names, ordinals, owner, e.name, UNKNOWN, s.tag, s.inner(data),
                                     None, None, None, None))
                        continue
                    seen[e.name] += 1
                    rows += structure(s, fqn, (*here, inside), names, (*ordinals, seen[e.name]), STRUCTURE)
                continue
            seen[e.name] = seen.get(e.name, 0) + 1
            at = (*ordinals, seen[e.name])
            if kind == REFERENCE:
                known = e.attributes(data)
                rows.append((here, names, at, owner, e.name, kind, e.tag, None, known.get("REF") or e.text(data), known.get("BID"),
                             known.get("ORDER_POS"), None))
            else:
                value = e.text(data) if kind == VALUE else e.inner(data)
                rows.append((here, names, at, owner, e.name, kind, e.tag, value, None, None, None, None))
        yield list(seen.items())
        yield from rows

    def structure(e: Element, fqn: str, key: tuple, path: str, ordinals: tuple, kind: str) -> Iterator[tuple]:
        below = children(e, fqn, key, path, ordinals)
        counts = next(below)
        yield (key, path, ordinals, fqn, None, kind, e.tag, None, None, None, None, counts)
        yield from below

    yield from structure(parse(data), class_fqn, (), "", (), OBJECT)


def node_rows(objects: DataFrame, catalog: Catalog, classes: Sequence[str]) -> DataFrame:
    """The objects' keys and `NODE_SCHEMA` for every element of objects of the given classes."""
    view = _View.of(catalog.model, classes)
    chosen = objects.filter(F.col("class_fqn").isin(*classes)).select(*OBJECT_KEYS, "raw")
    keys = chosen.drop("raw").schema
    names, fields = [f.name for f in keys], list(_TYPES.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws, kinds = batch.column("raw").to_pylist(), batch.column("class_fqn").to_pylist()
            rows, owners = [], []

            def made() -> pa.RecordBatch:
                own = pa.array(owners, type=pa.int64())
                columns = zip(*rows, strict=True) if rows else [()] * len(fields)
                arrays = [batch.column(n).take(own) for n in names]
                arrays += [pa.array(c, type=t) for c, (_, t) in zip(columns, fields, strict=True)]
                return pa.RecordBatch.from_arrays(arrays, names=[*names, *(n for n, _ in fields)])

            for i, (raw, kind) in enumerate(zip(raws, kinds, strict=True)):
                for row in _nodes(raw.encode(), kind, view):
                    rows.append(row)
                    owners.append(i)
                if len(rows) >= _BATCH_ROWS:
                    yield made()
                    rows, owners = [], []
            yield made()

    described = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    return chosen.mapInArrow(run, f"{described}, {NODE_SCHEMA}")


def property_json(model: Model, info: ClassInfo, prop: PropertyInfo, plain: bool) -> Column:
    """JSON text of a structure property, read from column ``raw`` at any depth; NULL if the property is missing.

    ``plain`` gives single values without their lists; otherwise a structure is its tag and its attributes, each a list.
    """
    view = _View.of(model, [info.fqn])
    single = {(fqn, p.name) for fqn in view.kinds for p in model.classes[fqn].properties if p.single}

    def structure(data: bytes, e: Element, fqn: str) -> dict:
        fields: dict[str, list] = {}
        for k in e.kids:
            if k.name in view.kinds[fqn]:
                fields.setdefault(k.name, []).extend(values(data, k, *view.kinds[fqn][k.name]))
        if not plain:
            return {"_tag": fqn, "_attrs": fields}
        return {n: v[0] if (fqn, n) in single else v for n, v in fields.items() if v or (fqn, n) not in single}

    def values(data: bytes, e: Element, kind: str, target: str | None) -> list:
        if kind == BAG:
            known = [(k, view.members[target].get(k.tag) or view.members[target].get(k.name)) for k in e.kids]
            return [structure(data, k, fqn) for k, fqn in known if fqn]
        if kind == REFERENCE:
            known = e.attributes(data)
            ref = known.get("REF") or e.text(data)
            if plain:
                return [ref]
            order = known.get("ORDER_POS", "")
            parts = {"_tag": target or e.name, "ref": ref, "bid": known.get("BID"), "order": int(order) if order.isdigit() else None}
            return [{**{n: v for n, v in parts.items() if v is not None}, "_attrs": {}}]
        return [e.text(data) if kind == VALUE else e.inner(data)]

    kind, target = view.kinds[info.fqn][prop.name]

    @F.arrow_udf("string")
    def text(raws: pa.Array) -> pa.Array:
        out = []
        for raw in raws:
            data = raw.as_py().encode() if raw.is_valid else b""
            own = [k for k in parse(data).kids if k.name == prop.name] if data else []
            found = [v for k in own for v in values(data, k, kind, target)]
            shown = (found[0] if found else None) if plain and prop.single else found
            out.append(json.dumps(shown, ensure_ascii=False, separators=(",", ":")) if own and shown is not None else None)
        return pa.array(out, pa.string())

    return text(F.when(F.col("class_fqn") == info.fqn, F.col("raw")))


def values_at(nodes: DataFrame, steps: Sequence) -> DataFrame:
    """``occurrence`` and ``value`` of the scalar nodes at a path, in the order of the text."""
    match = (F.col("kind") == VALUE) & (F.col("path") == ".".join(s.name for s in steps))
    for i, step in enumerate(steps):
        if not step.every:
            match = match & (F.col("ordinals")[i] == (step.index or 1))
    found = nodes.filter(match)
    if not any(s.every for s in steps):
        return found.withColumn("occurrence", F.lit(1))
    # Only matches are numbered, object by object.
    return found.withColumn("occurrence", F.row_number().over(Window.partitionBy(*PLACE).orderBy("key")))


def rebuilt(nodes: DataFrame) -> DataFrame:
    """Objects written anew from their nodes: `OBJECT_KEYS` and ``raw``.

    A node with content below it opens at its key and closes behind all keys that begin with it; the
    texts of one object, in that order, are the object.
    """
    def attribute(first: str, value: Column) -> Column:
        shown = F.when(F.col("dialect") == V23, F.lit(first)).otherwise(F.lit(f"ili:{first.lower()}"))
        return F.coalesce(F.concat(F.lit(" "), shown, F.lit('="'), escape_attribute(value), F.lit('"')), F.lit(""))

    tag, kind = F.col("tag"), F.col("kind")
    marked = F.when(F.col("operation") != "INSERT", F.col("operation"))
    opening = (
        F.when(kind == OBJECT, F.concat(F.lit("<"), tag, attribute("TID", F.col("tid")), attribute("OPERATION", marked), F.lit(">")))
        .when(kind.isin(STRUCTURE, BAG), F.concat(F.lit("<"), tag, F.lit(">")))
        .when(kind == REFERENCE, F.concat(
            F.lit("<"), tag, attribute("REF", F.col("ref")), attribute("BID", F.col("ref_bid")),
            attribute("ORDER_POS", F.col("order_pos")), F.lit("/>")))
        .otherwise(F.concat(F.lit("<"), tag, F.lit(">"), F.when(kind == VALUE, escape_text(F.col("value"))).otherwise(F.col("value")),
                            F.lit("</"), tag, F.lit(">"))))
    closing = F.when(kind.isin(OBJECT, STRUCTURE, BAG), F.concat(F.lit("</"), tag, F.lit(">")))
    behind = F.concat(F.col("key"), F.array(F.lit(2**31 - 1)))
    texts = nodes.select(*OBJECT_KEYS, F.explode(F.array(
        F.struct(F.col("key"), opening.alias("text")), F.struct(behind.alias("key"), closing.alias("text")))).alias("at"))
    return texts.filter(F.col("at.text").isNotNull()).groupBy(*OBJECT_KEYS).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("at")), lambda x: x["text"]), "").alias("raw"))
