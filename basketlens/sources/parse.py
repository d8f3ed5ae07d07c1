"""Parse the raw text of an object into one nested column per property.

Every leaf is an ``array<string>``: a property may be missing, empty or
repeated, and a value that does not fit its type must not lose the object.
Geometry keeps its inner XML, where element order matters.  Shapes:

* scalar     ``array<string>``
* geometry   ``array<string>`` (inner XML)
* reference  ``array<struct<ref, bid, order>>``
* structure  ``array<struct<_tag, one field per property>>``, wrappers removed
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.errors import TransferError
from basketlens.plans.catalog import ClassInfo, Model, PropertyInfo
from basketlens.sources.objects import V23, V24

# Structures can hold structures; deeper levels than this stay raw text.
MAX_NESTING = 5

_TEXTS = T.ArrayType(T.StringType())
OBJECT = "_obj"
UNKNOWN = "_unknown_values"

OPTIONS = {
    "mode": "FAILFAST",
    "ignoreNamespace": "true",
    # The reader trims by default; a lexical value is kept as it stands.
    "ignoreSurroundingSpaces": "false",
    "valueTag": "_VALUE",
    "wildcardColName": UNKNOWN,
}


class Parser:
    """Reader schema and canonical expressions of one class.

    Without a ``dialect`` the objects' own column ``dialect`` decides for each row; a parsed object then has a field for either.
    """

    def __init__(self, model: Model, info: ClassInfo, dialect: str | None = None, names: Iterable[str] | None = None,
                 keep_unknown: bool = False):
        self.model = model
        self.info = info
        self.dialect = dialect
        self.dialects = (V23, V24) if dialect is None else (dialect,)
        wanted = None if names is None else set(names)
        self.properties = [p for p in info.properties if wanted is None or p.name in wanted]
        self.keep_unknown = keep_unknown
        lowered = [p.name.lower() for p in self.properties]
        clash = sorted({n for n in lowered if lowered.count(n) > 1})
        if clash:
            raise TransferError(f"property names of {info.fqn} differ only in case: {clash[0]}")

    # -- reader schema

    def schema(self, dialect: str) -> T.StructType:
        fields = [T.StructField(p.name, self._read_type(p, 0, dialect)) for p in self.properties]
        if self.keep_unknown:
            fields.append(T.StructField(UNKNOWN, _TEXTS))
        if not fields:
            fields = [T.StructField(_attribute("TID", dialect), T.StringType())]
        return T.StructType(fields)

    def _read_type(self, prop: PropertyInfo, depth: int, dialect: str) -> T.DataType:
        if prop.value_kind == "Reference":
            names = [_attribute(n, dialect) for n in ("REF", "BID", "ORDER_POS")] + ["_VALUE"]
            return T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        if prop.value_kind == "Structure" and depth < MAX_NESTING:
            members = self.model.concrete_structures(prop.target_class_fqn)
            if members:
                return T.ArrayType(T.StructType([
                    T.StructField(_structure_tag(m, dialect), T.ArrayType(T.StructType(
                        [T.StructField(p.name, self._read_type(p, depth + 1, dialect)) for p in m.properties]
                        or [T.StructField("_none", T.StringType())]
                    ))) for m in members
                ]))
        return _TEXTS

    # -- canonical columns

    def parse(self, objects: DataFrame) -> DataFrame:
        """Add the parsed object as column ``_obj``.

        The generator makes it a plain column, so the text is parsed once
        however many expressions above read its fields.
        """
        return objects.select("*", F.inline(F.array(F.struct(self.from_xml(F.col("raw")).alias(OBJECT)))))

    def values(self, name: str) -> Column:
        """Canonical values of a property of the parsed object."""
        return self.values_in(F.col(OBJECT), name)

    def values_in(self, parsed: Column, name: str) -> Column:
        prop = self.info.property(name)
        return F.coalesce(*(self.canonical(prop, parsed[_field(d)][name], d) for d in self.dialects))

    def unknown_values(self) -> Column:
        return self.unknown_in(F.col(OBJECT))

    def unknown_in(self, parsed: Column) -> Column:
        return F.coalesce(*(parsed[_field(d)][UNKNOWN] for d in self.dialects))

    def from_xml(self, raw: Column) -> Column:
        """A struct with a field for each dialect; that of another dialect than the object's is NULL."""
        def read(dialect: str) -> Column:
            text = raw if self.dialect is not None else F.when(F.col("dialect") == dialect, raw)
            return F.from_xml(text, self.schema(dialect), OPTIONS).alias(_field(dialect))

        return F.struct(*(read(d) for d in self.dialects))

    def canonical(self, prop: PropertyInfo, value: Column, dialect: str, depth: int = 0) -> Column:
        if prop.value_kind == "Reference":
            ref, bid, order = (_attribute(n, dialect) for n in ("REF", "BID", "ORDER_POS"))
            return F.transform(value, lambda r: F.struct(
                F.coalesce(r[ref], r["_VALUE"], F.lit("")).alias("ref"), r[bid].alias("bid"), r[order].alias("order"),
            ))
        if prop.value_kind == "Structure" and depth < MAX_NESTING:
            members = self.model.concrete_structures(prop.target_class_fqn)
            if members:
                return self._flattened(members, value, dialect, depth)
        return value

    def _flattened(self, members: list[ClassInfo], wrappers: Column, dialect: str, depth: int) -> Column:
        fields = union_fields(members)
        element_type = canonical_type(self.model, members, depth)
        empty = F.array().cast(element_type)

        def builder(m: ClassInfo):
            def build(e: Column) -> Column:
                columns = [F.lit(m.fqn).alias("_tag")]
                for name, p in fields.items():
                    own = m.property(name)
                    columns.append(
                        (self.canonical(own, e[name], dialect, depth + 1) if own is not None
                         else F.lit(None).cast(property_type(self.model, p, depth + 1))).alias(name))
                return F.struct(*columns)

            return build

        def elements(wrapper: Column) -> Column:
            lists = [
                F.coalesce(F.transform(wrapper[_structure_tag(m, dialect)], builder(m)).cast(element_type), empty)
                for m in members
            ]
            return F.concat(*lists) if len(lists) > 1 else lists[0]

        return F.flatten(F.transform(wrappers, elements))


def _field(dialect: str) -> str:
    return "v" + dialect.replace(".", "")


def _attribute(name: str, dialect: str) -> str:
    return "_" + (name if dialect == V23 else name.lower())


def _structure_tag(info: ClassInfo, dialect: str) -> str:
    return info.fqn if dialect == V23 else info.name


def union_fields(members: list[ClassInfo]) -> dict[str, PropertyInfo]:
    fields: dict[str, PropertyInfo] = {}
    for m in members:
        for p in m.properties:
            fields.setdefault(p.name, p)
    return fields


def property_type(model: Model, prop: PropertyInfo, depth: int = 0) -> T.DataType:
    """Type of the canonical column of a property."""
    if prop.value_kind == "Reference":
        return T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("ref", "bid", "order")]))
    if prop.value_kind == "Structure" and depth < MAX_NESTING:
        members = model.concrete_structures(prop.target_class_fqn)
        if members:
            return canonical_type(model, members, depth)
    return _TEXTS


def canonical_type(model: Model, members: list[ClassInfo], depth: int) -> T.ArrayType:
    fields = [T.StructField("_tag", T.StringType())]
    fields += [
        T.StructField(name, property_type(model, p, depth + 1)) for name, p in union_fields(members).items()
    ]
    return T.ArrayType(T.StructType(fields))
