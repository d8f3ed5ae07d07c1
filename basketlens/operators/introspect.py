"""Catalog queries: models, topics, classes, properties, geometry, enumerations, roles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.errors import TransferError
from basketlens.plans.catalog import CRS_SCHEMA, Catalog
from basketlens.sources.session import cut_lineage

AREA_KINDS = ("AREA", "MULTIAREA")
MULTI_KINDS = ("MULTICOORD", "MULTIPOLYLINE", "DIRECTED_MULTIPOLYLINE", "MULTISURFACE", "MULTIAREA")


def models(catalog: Catalog) -> DataFrame:
    shown = catalog.models
    if catalog.builtin_models:
        shown = shown.filter(~F.col("name").isin(*catalog.builtin_models))
    return shown.orderBy("seq").select("name", "version", "issuer", "language", "ili_version")


def classes(catalog: Catalog, model: str | None = None) -> DataFrame:
    """Classes in model, topic and declaration order."""
    shown = catalog.visible_classes()
    if model is not None:
        shown = shown.filter(F.col("model_name") == model)
    return shown.orderBy("seq", "class_fqn").select(
        "model_name", F.coalesce("topic_name", F.lit("")).alias("topic_name"), "class_name", "class_fqn",
        "kind", "is_abstract", "base_class_fqn",
    )


def topics(catalog: Catalog, model: str | None = None) -> DataFrame:
    shown = classes(catalog, model).filter(F.col("topic_name") != "")
    return shown.select("model_name", "topic_name", F.lit("TOPIC").alias("kind")).distinct()


def ancestors(catalog: Catalog, class_name: str | None = None) -> DataFrame:
    """(class_fqn, ancestor_fqn, depth): every class with itself and all its bases.

    Pointer doubling: each round joins what is known with pointers twice as long, so the number of rounds is the
    logarithm of the deepest hierarchy.  Every round is written.  A class that is its own base, however far up, is refused by name.
    """
    start = catalog.visible_classes().select("class_fqn", "topic_name", "class_name")
    if class_name:
        start = start.filter(_class_matches(class_name))
    return _all_ancestors(catalog).join(start.select("class_fqn").distinct(), "class_fqn", "left_semi")


def _all_ancestors(catalog: Catalog) -> DataFrame:
    """The table of all classes, worked out once for a catalog."""
    if catalog.known_ancestors is None:
        names = catalog.classes.select("class_fqn").distinct()
        links = catalog.classes.select("class_fqn", F.col("base_class_fqn").alias("far")).join(
            names.withColumnRenamed("class_fqn", "far"), "far").select("class_fqn", "far").distinct()
        known = names.select("class_fqn", F.col("class_fqn").alias("ancestor_fqn"), F.lit(0).alias("depth"))
        jump, length, size = cut_lineage(links, "bases"), 1, names.count()
        while not jump.isEmpty():
            if length >= size:  # a chain of so many bases names one of them twice
                raise TransferError(f"class is its own base: {jump.agg(F.min('class_fqn')).first()[0]}")
            further = known.join(jump.select(F.col("class_fqn").alias("ancestor_fqn"), "far"), "ancestor_fqn").select(
                "class_fqn", F.col("far").alias("ancestor_fqn"), (F.col("depth") + length).alias("depth"))
            known = cut_lineage(known.unionByName(further), "ancestors")
            jump = cut_lineage(jump.join(jump.select(F.col("class_fqn").alias("far"), F.col("far").alias("next")), "far").select(
                "class_fqn", F.col("next").alias("far")), "bases")
            length *= 2
        catalog.known_ancestors = known
    return catalog.known_ancestors


def _class_matches(class_name: str) -> Column:
    """Full name, short name, or Topic.Class."""
    return (
        (F.col("class_fqn") == class_name)
        | (F.col("class_name") == class_name)
        | (F.concat_ws(".", F.nullif("topic_name", F.lit("")), F.col("class_name")) == class_name)
    )


def transfer_order(catalog: Catalog, class_name: str | None = None) -> DataFrame:
    """Every class with its own and inherited properties, numbered in transfer order.

    Bases come first.  Within one class of the hierarchy, an association lists
    its roles before its attributes and any other class after them.  A property
    redefined further down keeps the first place and takes the last definition.
    """
    owners = catalog.classes.select(F.col("class_fqn").alias("owner_fqn"), F.col("kind").alias("owner_kind"))
    roles_first = F.col("owner_kind") == "ASSOCIATION"
    is_role = F.col("kind") == "ROLE"
    inherited = (
        ancestors(catalog, class_name)
        .withColumnRenamed("ancestor_fqn", "owner_fqn")
        .join(owners, "owner_fqn")
        .join(catalog.properties, "owner_fqn")
        .join(catalog.geometry, ["owner_fqn", "property_name"], "left")
        .withColumn("block", (is_role != roles_first).cast("int"))
    )
    same_name = W.partitionBy("class_fqn", "property_name")
    order = [F.desc("first_depth"), F.col("first_block"), F.col("first_seq")]
    first = F.min(F.struct(-F.col("depth"), "block", "seq")).over(same_name)
    return (
        inherited.withColumn("first", first)
        .withColumn("keep", F.row_number().over(same_name.orderBy("depth")))
        .filter("keep = 1")
        .select(
            "*", (-F.col("first.col1")).alias("first_depth"),
            F.col("first.block").alias("first_block"), F.col("first.seq").alias("first_seq"),
        )
        .withColumn("position", F.row_number().over(W.partitionBy("class_fqn").orderBy(*order)))
        .drop("keep", "first", "first_depth", "first_block", "first_seq", "block", "owner_kind", "seq")
    )


def column_type() -> Column:
    """SQL type the typed scan gives a property, by its value kind."""
    return (
        F.when(F.col("geometry_kind").isNotNull(), "GEOMETRY")
        .when(F.col("value_kind") == "Boolean", "BOOLEAN")
        .when(F.col("value_kind") == "Integer", "BIGINT")
        .when(F.col("value_kind") == "Double", "DOUBLE")
        .when(F.col("value_kind") == "Structure", "UNSUPPORTED_JSON")
        .otherwise("VARCHAR")
    )


def _property_fqn() -> Column:
    return F.concat_ws(".", "owner_fqn", "property_name")


def _in_class_order(catalog: Catalog, ordered: DataFrame) -> DataFrame:
    seq = catalog.classes.select("class_fqn", F.col("seq").alias("class_seq"))
    return ordered.join(seq, "class_fqn").orderBy("class_seq", "class_fqn", "position")


def properties(catalog: Catalog, class_name: str = "") -> DataFrame:
    """Twelve columns per property, in class and transfer order; '' means all classes."""
    return _in_class_order(catalog, transfer_order(catalog, class_name or None)).select(
        "class_fqn", "property_name", _property_fqn().alias("property_fqn"), "kind", "type_name",
        column_type().alias("column_type"), "is_mandatory", F.col("card_min").alias("cardinality_min"),
        F.col("card_max").alias("cardinality_max"), "is_transient", "is_embedded", "target_class_fqn",
    )


def geometry_properties(catalog: Catalog, class_name: str = "") -> DataFrame:
    ordered = transfer_order(catalog, class_name or None).filter("geometry_kind IS NOT NULL")
    return _in_class_order(catalog, ordered).select(
        "class_fqn", "property_name", _property_fqn().alias("property_fqn"), "geometry_kind",
        "coordinate_domain_fqn", "dimension", "max_overlap_lexical",
        F.expr("try_cast(max_overlap_lexical AS double)").alias("max_overlap"), "line_forms",
        _has_form("STRAIGHTS").alias("has_straights"), _has_form("ARCS").alias("has_arcs"),
        "has_custom_line_forms", "has_line_attributes",
    )


def _has_form(form: str) -> Column:
    return F.coalesce(F.array_contains("line_forms", form), F.lit(False))


def attributes(catalog: Catalog, model: str | None = None, class_name: str | None = None) -> DataFrame:
    listed = _in_class_order(catalog, transfer_order(catalog, class_name)).filter(F.col("kind") == "ATTRIBUTE")
    names = catalog.classes.select("class_fqn", "model_name", "topic_name", "class_name")
    listed = listed.join(names, "class_fqn")
    if model is not None:
        listed = listed.filter(F.col("model_name") == model)
    return listed.orderBy("class_seq", "class_fqn", "position").select(
        "model_name", "topic_name", "class_name", F.col("property_name").alias("attr_name"), "type_name",
        F.col("value_kind").alias("kind"), "is_mandatory", "card_min", "card_max",
    )


def enumerations(catalog: Catalog, model: str | None = None) -> DataFrame:
    """One row per declared enumeration element, in declaration order."""
    names = catalog.visible_classes().select(F.col("class_fqn").alias("owner_fqn"), "model_name", "seq")
    listed = catalog.properties.select(
        "owner_fqn", "property_name", "enum_values", F.col("seq").alias("prop_seq")
    ).join(names, "owner_fqn")
    if model is not None:
        listed = listed.filter(F.col("model_name") == model)
    return (
        listed.select("*", F.posexplode("enum_values").alias("element_pos", "element"))
        .orderBy("seq", "prop_seq", "element_pos")
        .select("model_name", F.concat_ws(".", "owner_fqn", "property_name").alias("enum_name"), "element")
    )


def roles(catalog: Catalog, class_name: str = "") -> DataFrame:
    return properties(catalog, class_name).filter(F.col("kind") == "ROLE")


def structures(catalog: Catalog, class_name: str) -> DataFrame:
    """Attributes of the structures that properties of ``class_name`` hold."""
    holders = (
        transfer_order(catalog, class_name)
        .filter((F.col("value_kind") == "Structure") & F.col("target_class_fqn").isNotNull())
        .select(F.col("class_fqn").alias("holder_fqn"), F.col("property_name").alias("holder_property"),
                F.col("target_class_fqn").alias("structure_name"))
    )
    parts = transfer_order(catalog).withColumnRenamed("class_fqn", "structure_name")
    return holders.join(parts, "structure_name").select(
        "holder_fqn", "holder_property", "structure_name", F.col("property_name").alias("attribute_name"),
        "type_name", column_type().alias("logical_type"), "kind", "card_min", "card_max",
        F.to_json("enum_values").alias("enum_values_json"),
    )


_CRS_ENTRY = re.compile(r"^\s*([^=\s]+)\s*=\s*([A-Za-z][\w-]*):([\w-]+)\s*$")


def parse_crs_map(text: str | None) -> list[tuple[str, str, str]]:
    """``Domain=AUTH:CODE;...`` as rows; a bad entry is an error, nothing is guessed."""
    rows: dict[str, tuple[str, str, str]] = {}
    for entry in (text or "").split(";"):
        if not entry.strip():
            continue
        match = _CRS_ENTRY.match(entry)
        if match is None:
            raise TransferError(f"invalid CRS map entry: {entry.strip()}")
        if match.group(1) in rows:
            raise TransferError(f"domain appears twice in the CRS map: {match.group(1)}")
        rows[match.group(1)] = match.groups()
    return list(rows.values())


def geometry_attributes(catalog: Catalog, model: str | None = None, class_name: str = "") -> DataFrame:
    """Geometry attributes with the mapped CRS and kind flags."""
    crs = catalog.spark.createDataFrame(parse_crs_map(catalog.crs_map), CRS_SCHEMA)
    names = catalog.classes.select("class_fqn", "model_name", "topic_name", "class_name")
    ordered = transfer_order(catalog, class_name or None).filter("geometry_kind IS NOT NULL")
    listed = _in_class_order(catalog, ordered).join(names, "class_fqn").join(crs, "coordinate_domain_fqn", "left")
    if model is not None:
        listed = listed.filter(F.col("model_name") == model)
    return listed.orderBy("class_seq", "class_fqn", "position").select(
        "model_name", "topic_name", "class_name", "class_fqn", F.col("property_name").alias("attribute_name"),
        _property_fqn().alias("attribute_fqn"), "geometry_kind", "dimension",
        F.substring_index("coordinate_domain_fqn", ".", -1).alias("coordinate_domain"), "coordinate_domain_fqn",
        "crs_auth_name", "crs_code",
        F.when(F.col("crs_auth_name") == "EPSG", F.expr("try_cast(crs_code AS int)")).alias("srid"),
        "is_mandatory", "card_min", "card_max", _has_form("ARCS").alias("supports_arcs"),
        F.col("geometry_kind").isin(*AREA_KINDS).alias("is_area_type"),
        F.col("geometry_kind").isin(*MULTI_KINDS).alias("is_multi_type"),
        F.lit("WKB").alias("transport_encoding"), F.lit("ST_GeomFromWKB").alias("spatial_function"),
    )
