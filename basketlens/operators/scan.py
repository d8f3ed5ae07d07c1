"""Typed scans: one class as a table, associations, and all objects as JSON."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.errors import TransferError
from basketlens.functions import geometry as geo
from basketlens.functions import typing as typ
from basketlens.operators import nodes
from basketlens.plans.catalog import Catalog, ClassInfo, PropertyInfo
from basketlens.sources.cutter import children
from basketlens.sources.objects import read_objects
from basketlens.sources.parse import OBJECT, UNKNOWN, Parser

TECHNICAL = ("_bid", "_tid", "_class", "_operation", "_unsupported_json")
GEOMETRY_FORMS = ("wkb", "nested", "wkt", "raw")


def scan_class(
    spark: SparkSession,
    path: str,
    class_name: str,
    catalog: Catalog,
    geometry_errors: str = "error",
    arc_tolerance_override: float | None = None,
    columns: Sequence[str] | None = None,
    geometry: str = "wkb",
    temporal: bool = False,
    dialect: str | None = None,
    objects: DataFrame | None = None,
) -> DataFrame:
    """One row per object of exactly this class, with typed columns in transfer order.

    ``columns`` limits what is parsed: without ``_unsupported_json`` only the
    named properties are read from the XML.  ``objects`` reuses rows of
    `read_objects`, for instance a stored table, instead of reading ``path``.
    """
    info = catalog.model.require_class(class_name)
    if geometry_errors not in ("error", "null"):
        raise TransferError("geometry_errors must be 'error' or 'null'")
    if arc_tolerance_override is not None and arc_tolerance_override <= 0:
        raise TransferError("arc_tolerance_override must be positive")
    if geometry not in GEOMETRY_FORMS:
        raise TransferError(f"geometry must be one of {', '.join(GEOMETRY_FORMS)}")
    check_names(info)
    if objects is None:
        if not path:
            raise TransferError("path must not be empty")
        objects = read_objects(spark, path, catalog.model, dialect)
    shown = [p for p in info.properties if p.is_column]
    residual = columns is None or "_unsupported_json" in columns
    if columns is not None:
        unknown = set(columns) - {p.name for p in shown} - set(TECHNICAL)
        if unknown:
            raise TransferError(f"no such column of {class_name}: {sorted(unknown)[0]}")
        shown = [p for p in shown if p.name in columns]
    names = None if residual else [p.name for p in shown]
    parser = Parser(catalog.model, info, dialect, names, keep_unknown=residual)
    parsed = parser.parse(objects.filter(F.col("class_fqn") == class_name))

    decodable = [p for p in shown if p.geometry is not None and geometry != "raw"]
    parsed, decoded = _decode(parsed, parser, decodable, arc_tolerance_override)

    out: dict[str, Column] = {
        "_bid": F.col("bid"), "_tid": F.col("tid"), "_class": F.col("class_fqn"), "_operation": F.col("operation"),
    }
    for p in shown:
        out[p.name] = _column(p, parser, class_name, decoded.get(p.name), geometry, geometry_errors, temporal)
    if residual:
        out["_unsupported_json"] = _residual(parser, decoded)
    wanted = list(out) if columns is None else [c for c in out if c in columns]
    return parsed.select(*[out[c].alias(c) for c in wanted])


def _decode(
    parsed: DataFrame, parser: Parser, props: Sequence[PropertyInfo], tolerance: float | None = None
) -> tuple[DataFrame, dict[str, Column]]:
    """Add a decoded column per geometry property.

    As with the object itself, a generator keeps the decoding from being
    repeated for every use of its parts and its error.
    """
    decoded = {}
    for i, p in enumerate(props):
        text = typ.single(p, parser.values(p.name), parser.info.fqn)
        shape = geo.decode(text, p.geometry.kind, p.geometry.dimension, _tolerance(p, tolerance))
        parsed = parsed.select("*", F.inline(F.array(F.struct(shape.alias(f"_geometry_{i}")))))
        decoded[p.name] = F.col(f"_geometry_{i}")
    return parsed, decoded


def check_names(info: ClassInfo) -> None:
    """Refuse property names that cannot stand beside the technical columns."""
    seen: dict[str, str] = {}
    for p in info.properties:
        if not p.name or p.name.lower() in TECHNICAL:
            raise TransferError(f"property name collides with a reserved result column: {p.name}")
        if p.name.lower() in seen:
            raise TransferError(f"property names of {info.fqn} differ only in case: {seen[p.name.lower()]}, {p.name}")
        seen[p.name.lower()] = p.name


def _tolerance(prop: PropertyInfo, override: float | None) -> float:
    return override or prop.geometry.max_overlap or geo.DEFAULT_ARC_TOLERANCE


def _column(prop, parser, class_name, decoded, geometry, geometry_errors, temporal) -> Column:
    values = parser.values(prop.name)
    if prop.geometry is not None:
        if decoded is None:
            return typ.single(prop, values, class_name)
        parts = decoded["parts"]
        if geometry == "wkb":
            shape = geo.as_wkb(parts, prop.geometry.kind)
        elif geometry == "wkt":
            shape = geo.as_text(parts, prop.geometry.kind)
        else:
            shape = parts
        if geometry_errors == "null":
            return shape
        failed = F.raise_error(F.concat(typ.context(prop, class_name), F.lit(": "), decoded["error"]))
        return F.when(decoded["error"].isNotNull(), failed).otherwise(shape)
    if prop.value_kind == "Reference":
        ref = typ.single(prop, values, class_name)
        # A reference into another basket is not a local id.
        return F.when(ref["bid"].isNull(), ref["ref"])
    return typ.typed(prop, values, class_name, temporal)


# -------------------------------------------------------------- residual JSON

def json_values(parser: Parser, prop: PropertyInfo, values: Column, depth: int = 0) -> Column:
    """Values of a property in the residual form: texts, or objects with their attributes."""
    if prop.value_kind == "Reference":
        return F.transform(values, lambda r: F.struct(
            F.lit(prop.target_class_fqn or prop.name).alias("_tag"), r["ref"].alias("ref"), r["bid"].alias("bid"),
            r["order"].try_cast("bigint").alias("order"), F.create_map().cast("map<string,string>").alias("_attrs")))
    members = _structure_members(parser, prop, depth)
    if members:
        fields = {}
        for m in members:
            for p in m.properties:
                fields.setdefault(p.name, p)
        return F.transform(values, lambda e: F.struct(
            e["_tag"].alias("_tag"),
            F.struct(*[json_values(parser, p, e[n], depth + 1).alias(n) for n, p in fields.items()]
                     or [F.lit(None).cast("string").alias("_none")]).alias("_attrs")))
    return values


def _structure_members(parser: Parser, prop: PropertyInfo, depth: int) -> list[ClassInfo]:
    from basketlens.sources.parse import MAX_NESTING

    if prop.value_kind != "Structure" or depth >= MAX_NESTING:
        return []
    return parser.model.concrete_structures(prop.target_class_fqn)


def _residual(parser: Parser, decoded: dict[str, Column]) -> Column:
    """JSON of everything that has no column of its own, ``{}`` if nothing."""
    parts, texts = [], []
    deep = nodes.is_deep(parser.model, parser.info)
    for p in parser.properties:
        values = parser.values(p.name)
        if deep and p.value_kind == "Structure":
            texts.append(_named_json(parser, p))
        elif p.name in decoded:
            error = decoded[p.name]["error"]
            parts.append(F.when(error.isNotNull(), F.array(F.struct(error.alias("_error")))).alias(p.name))
        elif p.value_kind == "Reference" and p.is_column:
            away = F.get(values, F.lit(0))["bid"].isNotNull()
            parts.append(F.when(away, json_values(parser, p, values)).alias(p.name))
        elif not p.is_column:
            parts.append(json_values(parser, p, values).alias(p.name))
    known = reduce(_merge_json, texts, F.to_json(F.struct(*parts)) if parts else F.lit("{}"))
    return F.when(F.size(parser.unknown_values()) > 0, _merge_json(known, _unknown_json(parser))).otherwise(known)


def _named_json(parser: Parser, prop: PropertyInfo) -> Column:
    """``{"name": [...]}`` of a structure that nests deeper than the reader's schema."""
    text = nodes.property_json(parser.model, parser.info, prop, plain=False)
    return F.coalesce(F.concat(F.lit(f'{{"{prop.name}":'), text, F.lit("}")), F.lit("{}"))


def _unknown_json(parser: Parser) -> Column:
    """Properties the catalog does not know, by name, with their inner text.

    The reader keeps the values of unknown elements without their names.  The few objects that have any are
    cut once more, into the object's own children.
    """
    known = frozenset(p.name for p in parser.info.properties)

    @F.arrow_udf("string")
    def named(raws: pa.Array) -> pa.Array:
        out = []
        for raw in raws:
            found: dict[str, list[str]] = {}
            for name, text in children(raw.as_py().encode()) if raw.is_valid else ():
                if name not in known:
                    found.setdefault(name, []).append(text.decode())
            out.append(json.dumps(found, ensure_ascii=False, separators=(",", ":")))
        return pa.array(out, pa.string())

    return named(F.when(F.size(parser.unknown_values()) > 0, F.col("raw")))


def _merge_json(left: Column, right: Column) -> Column:
    return F.when(left == "{}", right).when(right == "{}", left).otherwise(
        F.concat(F.left(left, F.length(left) - 1), F.lit(","), F.substring(right, 2, 2**31 - 1)))


# ----------------------------------------------------- nested, roles, objects

def read_class(
    spark: SparkSession, path: str, class_name: str, catalog: Catalog, nested: str = "json",
    temporal: bool = True, dialect: str | None = None, geometry: str = "wkb",
) -> DataFrame:
    """A class with its structures and bags as columns: JSON text or nested values.

    A missing structure or bag is NULL; an empty bag is an empty list.
    References are named ``<role>_ref``.  JSON has all levels; a column type ends somewhere, and nested
    values hold what lies below its fifth level as raw text.
    """
    if nested not in ("json", "struct"):
        raise TransferError("nested must be 'json' or 'struct'")
    info = catalog.model.require_class(class_name)
    check_names(info)
    objects = read_objects(spark, path, catalog.model, dialect).filter(F.col("class_fqn") == class_name)
    return _class_columns(objects, info, catalog, nested, temporal, dialect, geometry)


def _class_columns(objects, info: ClassInfo, catalog: Catalog, nested, temporal, dialect, geometry) -> DataFrame:
    parser = Parser(catalog.model, info, dialect)
    parsed, decoded = _decode(
        parser.parse(objects), parser, [p for p in info.properties if p.geometry is not None and p.single])
    out = [F.col("bid").alias("xtf_bid"), F.col("tid").alias("xtf_tid"), F.col("class_fqn").alias("xtf_class")]
    for p in info.properties:
        values = parser.values(p.name)
        if p.value_kind == "Structure":
            value = F.get(values, F.lit(0)) if p.single else values
            if nested == "struct":
                out.append(plain(parser, p, value).alias(p.name))
            elif nodes.is_deep(catalog.model, info):
                out.append(nodes.property_json(catalog.model, info, p, plain=True).alias(f"{p.name}_json"))
            else:
                out.append(F.to_json(plain(parser, p, value)).alias(f"{p.name}_json"))
        elif p.value_kind == "Reference" and p.single:
            out.append(_column(p, parser, info.fqn, None, geometry, "error", temporal).alias(f"{p.name}_ref"))
        elif p.geometry is not None and p.single:
            out.append(_column(p, parser, info.fqn, decoded[p.name], geometry, "error", temporal).alias(p.name))
        elif p.is_column:
            out.append(typ.typed(p, values, info.fqn, temporal).alias(p.name))
        else:
            out.append(F.to_json(values).alias(f"{p.name}_json"))
    return parsed.select(*out)


def plain(parser: Parser, prop: PropertyInfo, value: Column, depth: int = 0) -> Column:
    """Structure values with single-valued leaves unwrapped from their arrays."""
    members = _structure_members(parser, prop, depth)
    if not members:
        return value
    fields: dict[str, PropertyInfo] = {}
    for m in members:
        for p in m.properties:
            fields.setdefault(p.name, p)

    def unwrap(e: Column) -> Column:
        columns = []
        for n, p in fields.items():
            v = e[n]
            if p.value_kind == "Structure":
                v = plain(parser, p, F.get(v, F.lit(0)) if p.single else v, depth + 1)
            elif p.value_kind == "Reference":
                v = F.get(v, F.lit(0))["ref"] if p.single else F.transform(v, lambda r: r["ref"])
            elif p.single:
                v = F.get(v, F.lit(0))
            columns.append(v.alias(n))
        return F.when(e.isNotNull(), F.struct(*columns)) if columns else F.when(e.isNotNull(), F.struct(e["_tag"]))

    return unwrap(value) if prop.single else F.transform(value, unwrap)


def bag_rows(
    spark: SparkSession, path: str, class_name: str, property_name: str, catalog: Catalog,
    dialect: str | None = None, outer: bool = False,
) -> DataFrame:
    """(bid, tid, pos, tag, fields...): one row per element of a bag or list."""
    info = catalog.model.require_class(class_name)
    prop = info.property(property_name)
    if prop is None or prop.value_kind != "Structure":
        raise TransferError(f"not a structure property: {class_name}.{property_name}")
    objects = read_objects(spark, path, catalog.model, dialect).filter(F.col("class_fqn") == class_name)
    parser = Parser(catalog.model, info, dialect, [property_name])
    explode = F.posexplode_outer if outer else F.posexplode
    rows = parser.parse(objects).select("bid", "tid", explode(parser.values(property_name)).alias("pos", "element"))
    fields: dict[str, PropertyInfo] = {}
    for m in parser.model.concrete_structures(prop.target_class_fqn):
        for p in m.properties:
            fields.setdefault(p.name, p)
    one = F.col("element")
    leaves = []
    for n, p in fields.items():
        if p.value_kind == "Structure":
            leaves.append(F.to_json(one[n]).alias(n))
        elif p.value_kind == "Reference":
            leaves.append(F.get(one[n], F.lit(0))["ref"].alias(n))
        else:
            leaves.append(typ.typed(p, one[n], class_name).alias(n))
    kept = rows.withColumn("file", F.lit(path))
    return kept.select("bid", "tid", "pos", one["_tag"].alias("tag"), *leaves)


def bag_sizes(
    spark: SparkSession, path: str, class_name: str, property_name: str, catalog: Catalog,
    dialect: str | None = None,
) -> DataFrame:
    """(bid, tid, n): number of elements per object; NULL for a missing bag."""
    info = catalog.model.require_class(class_name)
    if info.property(property_name) is None:
        raise TransferError(f"no such property: {class_name}.{property_name}")
    objects = read_objects(spark, path, catalog.model, dialect).filter(F.col("class_fqn") == class_name)
    parser = Parser(catalog.model, info, dialect, [property_name])
    values = parser.values(property_name)
    return parser.parse(objects).select(
        "bid", "tid", F.when(values.isNotNull(), F.size(values)).alias("n"))


def read_association(
    spark: SparkSession, path: str, association: str, catalog: Catalog, columns: Iterable[str] | None = None,
    dialect: str | None = None, objects: DataFrame | None = None,
) -> DataFrame:
    """An association as (xtf_tid, xtf_bid, <role>_ref..., attributes); ``objects`` as in `scan_class`."""
    info = catalog.model.require_class(association)
    if info.kind != "ASSOCIATION":
        raise TransferError(f"not an association: {association}")
    wanted = [p.name for p in info.properties if p.is_column and (columns is None or p.name in set(columns))]
    rows = scan_class(spark, path, association, catalog, columns=["_tid", "_bid", *wanted], dialect=dialect, objects=objects)
    names = [
        F.col(f"`{n}`").alias(f"{n}_ref" if info.property(n).value_kind == "Reference" else n) for n in wanted
    ]
    return rows.select(F.col("_tid").alias("xtf_tid"), F.col("_bid").alias("xtf_bid"), *names)


def read_all_objects(
    spark: SparkSession, path: str, catalog: Catalog, dialect: str | None = None, keys_only: bool = False
) -> DataFrame:
    """Every object of every class in one pass, with its contents as JSON.

    Attributes, references and geometries are separate JSON columns.  Objects
    of classes the catalog does not know keep only their raw text.
    ``keys_only`` leaves out the contents, which then are not parsed.
    """
    objects = read_objects(spark, path, catalog.model, dialect)
    keys = [
        F.col("bid").alias("xtf_bid"), F.col("topic").alias("xtf_topic"),
        F.substring_index("class_fqn", ".", -1).alias("xtf_class"), F.col("class_fqn").alias("xtf_class_fqn"),
        F.col("tid").alias("xtf_tid"), "operation", F.substring_index("class_fqn", ".", 1).alias("xtf_model"),
        "file", "pos",
    ]
    if keys_only:
        return objects.select(*keys)
    content = [
        (F.col("class_fqn") == c.fqn, _object_json(Parser(catalog.model, c, dialect)))
        for c in catalog.model.transferred()
    ]
    chosen = reduce(lambda acc, cv: acc.when(*cv), content[1:], F.when(*content[0])) if content else F.lit(None)
    empty = "struct<attributes_json:string,refs_json:string,geom_json:string>"
    named = objects.select("*", F.inline(F.array(F.struct(chosen.cast(empty).alias("content")))))
    return named.select(*keys, "content.*", F.col("raw").alias("raw_event_json"))


def _object_json(parser: Parser) -> Column:
    """Contents of one object of a known class; the text is parsed once."""
    def group(o: Column, test) -> Column:
        columns = [
            json_values(parser, p, parser.values_in(o, p.name)).alias(p.name) for p in parser.properties if test(p)
        ]
        return F.to_json(F.struct(*columns)) if columns else F.lit("{}")

    deep = [p for p in parser.properties if p.value_kind == "Structure"] if nodes.is_deep(parser.model, parser.info) else []

    def build(o: Column) -> Column:
        flat = group(o, lambda p: p.geometry is None and p.value_kind != "Reference" and p not in deep)
        return F.struct(
            flat.alias("attributes_json"),
            group(o, lambda p: p.value_kind == "Reference").alias("refs_json"),
            group(o, lambda p: p.geometry is not None).alias("geom_json"),
        )

    built = F.get(F.transform(F.array(parser.from_xml(F.col("raw"))), build), F.lit(0))
    texts = [_named_json(parser, p) for p in deep]
    return built.withField("attributes_json", reduce(_merge_json, texts, built["attributes_json"])) if texts else built
