"""Queries over the driver tables, each with equivalent SQL where SQL can say it.

The tables are rendered as transfers of the shop model (see `shop`); every query
reads them back through the library over the whole of its tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions import geometry as geo
from basketlens.functions import rings, wkb
from basketlens.operators import edits as ed
from basketlens.operators import importer, introspect, nodes, quality, scan, values
from basketlens.plans import shop
from basketlens.plans.catalog import (
    CLASSES_SCHEMA, GEOMETRY_SCHEMA, MODELS_SCHEMA, PROPERTIES_SCHEMA, Catalog,
)
from basketlens.plans.shop import CUSTOMER, LINE, ORDER, PLACED, TRACK
from basketlens.sources.files import file_digests
from basketlens.sources.objects import V23, V24, objects_by_class, read_objects
from basketlens.sources.parse import Parser
from basketlens.sources.session import cut_lineage, fresh_path
from basketlens.sources.writer import ObjectWriter
from basketlens.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _all_folders(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """One glob over several rendered folders of the same parent."""
    paths = [shop.folder(spark, sf_dir, n).removesuffix("/*") for n in names]
    parent = paths[0].rpartition("/")[0]
    return f"{parent}/{{{','.join(p.rpartition('/')[2] for p in paths)}}}/*"


def _scan(spark, sf_dir, name: str, cls: str, columns=None, dialect: str = V23, **options) -> DataFrame:
    return scan.scan_class(
        spark, shop.folder(spark, sf_dir, name), cls, shop.shared_catalog(spark), columns=columns, dialect=dialect,
        **options)


def _sum_cents(column: str):
    """Exact sum of amounts with two decimals."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


# Parts of SQL that several queries share.
_OPERATION = "CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'P' THEN 'UPDATE' ELSE 'INSERT' END"
_ORDER_BID = "'Y' || CAST(year(o_orderdate) AS VARCHAR)"
_ORDER_TIME = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g')"
_LINE_TID = "'l' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
_CHARGES = f"""
    SELECT {_LINE_TID} AS tid, 'F' || l_returnflag AS bid, u.*
    FROM lineitem, LATERAL (
        SELECT 0 AS pos, 'base' AS kind, l_extendedprice AS amount
        UNION ALL SELECT 1, 'discount', l_discount WHERE l_discount > 0
        UNION ALL SELECT CASE WHEN l_discount > 0 THEN 2 ELSE 1 END, 'tax', l_tax WHERE l_tax > 0
    ) u"""


# ------------------------------------------------------------- scans and types

@query(f"""
    SELECT {_ORDER_BID} AS _bid, 'o' || o_orderkey AS _tid, '{ORDER}' AS _class, {_OPERATION} AS _operation,
           o_orderstatus AS "Status", o_totalprice AS "Price", {_ORDER_TIME} AS "Placed", 'c' || o_custkey AS customer
    FROM orders""")
def scan_order_typed(spark, sf_dir):
    return _scan(spark, sf_dir, "sales", ORDER,
                 ["_bid", "_tid", "_class", "_operation", "Status", "Price", "Placed", "customer"])


@query(f"""
    SELECT 'N' || c_nationkey AS _bid, 'c' || c_custkey AS _tid, '{CUSTOMER}' AS _class, 'INSERT' AS _operation,
           c_name AS "Name", c_mktsegment AS "Segment", c_acctbal AS "Balance", CAST(c_nationkey AS BIGINT) AS "Nation",
           '{{}}' AS _unsupported_json
    FROM customer""")
def scan_customer_typed(spark, sf_dir):
    return _scan(spark, sf_dir, "sales", CUSTOMER)


@query(f"""
    SELECT {_LINE_TID} AS _tid, CAST(l_linenumber AS BIGINT) AS "Number", l_quantity AS "Quantity",
           l_extendedprice AS "Price", l_returnflag AS "Flag", strftime(l_shipdate, '%Y-%m-%d') AS "Shipped",
           'o' || l_orderkey AS "order"
    FROM lineitem""")
def scan_line_typed(spark, sf_dir):
    return _scan(spark, sf_dir, "stock", LINE, ["_tid", "Number", "Quantity", "Price", "Flag", "Shipped", "order"])


@query(f"""
    SELECT {_LINE_TID} AS _tid, CAST(l_shipdate AS DATE) AS "Shipped", CAST(year(l_shipdate) AS INTEGER) AS shipped_year
    FROM lineitem""")
def scan_temporal(spark, sf_dir):
    """Dates as DATE columns instead of text."""
    rows = _scan(spark, sf_dir, "stock", LINE, ["_tid", "Shipped"], temporal=True)
    return rows.select("_tid", "Shipped", F.year("Shipped").alias("shipped_year"))


@query(ORACLES["scan_order_typed"])
def scan_mixed_dialects(spark, sf_dir):
    """Orders of a folder whose files are in either dialect."""
    return _scan(spark, sf_dir, "mixed", ORDER,
                 ["_bid", "_tid", "_class", "_operation", "Status", "Price", "Placed", "customer"], dialect=None)


@query(ORACLES["scan_line_typed"])
def scan_line_ranges(spark, sf_dir):
    """Lines of two large files, cut into byte ranges of the text source."""
    catalog = shop.shared_catalog(spark)
    objects = read_objects(spark, shop.folder(spark, sf_dir, "stock1"), catalog.model, V23, whole_file_bytes=0)
    return scan.scan_class(
        spark, "", LINE, catalog, columns=["_tid", "Number", "Quantity", "Price", "Flag", "Shipped", "order"],
        dialect=V23, objects=objects)


@query("""
    SELECT 'Shop.Sales.Customer' AS class_fqn, 'N' || c_nationkey AS bid, 2 * count(*) AS n, 2 * count(*) AS with_tid
    FROM customer GROUP BY 2
    UNION ALL SELECT 'Shop.Sales.Order', 'Y' || CAST(year(o_orderdate) AS VARCHAR), 2 * count(*), 2 * count(*)
    FROM orders GROUP BY 2
    UNION ALL SELECT 'Shop.Sales.Placed', 'P' || o_orderstatus, 2 * count(*), 0 FROM orders GROUP BY 2""")
def unknown_objects(spark, sf_dir):
    """Objects in both dialects under a catalog that knows customers only; links have no id."""
    known = shop.shared_catalog(spark)
    catalog = Catalog(known.models, known.classes.filter(F.col("class_name").isin("Party", "Customer")),
                      known.properties, known.geometry)
    rows = scan.read_all_objects(spark, _all_folders(spark, sf_dir, "sales", "sales24"), catalog, keys_only=True)
    return rows.groupBy(F.col("xtf_class_fqn").alias("class_fqn"), F.col("xtf_bid").alias("bid")).agg(
        F.count("*").alias("n"), F.count("xtf_tid").alias("with_tid"))


@query("""
    SELECT 'Shop.Sales.Customer' AS class_fqn, count(*) AS n FROM customer
    UNION ALL SELECT 'Shop.Sales.Order', count(*) FROM orders
    UNION ALL SELECT 'Shop.Sales.Placed', count(*) FROM orders
    UNION ALL SELECT 'Shop.Stock.Line', count(*) FROM lineitem
    UNION ALL SELECT 'Shop.Tracks.Track', count(*) FROM embeddings""")
def object_counts(spark, sf_dir):
    path = _all_folders(spark, sf_dir, "sales", "stock", "tracks")
    objects = scan.read_all_objects(spark, path, shop.shared_catalog(spark), V23, keys_only=True)
    return objects.groupBy(F.col("xtf_class_fqn").alias("class_fqn")).agg(F.count("*").alias("n"))


@query(f"""
    SELECT 'o' || o_orderkey AS tid, 'Order' AS class_name, o_totalprice AS price, 'c' || o_custkey AS customer
    FROM orders
    UNION ALL SELECT 'c' || c_custkey, 'Customer', NULL, NULL FROM customer
    UNION ALL SELECT NULL, 'Placed', NULL, 'c' || o_custkey FROM orders""")
def all_objects_json(spark, sf_dir):
    """Every class in one pass; fields are taken from the JSON columns."""
    objects = scan.read_all_objects(spark, shop.folder(spark, sf_dir, "sales"), shop.shared_catalog(spark), V23)
    return objects.select(
        F.col("xtf_tid").alias("tid"), F.col("xtf_class").alias("class_name"),
        F.get_json_object("attributes_json", "$.Price[0]").try_cast("double").alias("price"),
        F.get_json_object("refs_json", "$.customer[0].ref").alias("customer"))


@query(f"SELECT {_OPERATION} AS operation, {_ORDER_BID} AS bid, count(*) AS n FROM orders GROUP BY 1, 2")
def operation_mix(spark, sf_dir):
    rows = _scan(spark, sf_dir, "sales", ORDER, ["_bid", "_operation"])
    return rows.groupBy(F.col("_operation").alias("operation"), F.col("_bid").alias("bid")).agg(
        F.count("*").alias("n"))


@query(f"""
    SELECT {_LINE_TID} AS tid, l_extendedprice AS base,
           CASE WHEN l_discount > 0 THEN 'discount' WHEN l_tax > 0 THEN 'tax' END AS second_kind,
           CAST(1 + (CASE WHEN l_discount > 0 THEN 1 ELSE 0 END) + (CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS INTEGER)
               AS charges
    FROM lineitem""")
def residual_json(spark, sf_dir):
    """What has no column of its own, taken out of the residual JSON."""
    rows = _scan(spark, sf_dir, "stock", LINE, ["_tid", "_unsupported_json"])
    json = F.col("_unsupported_json")
    return rows.select(
        F.col("_tid").alias("tid"),
        F.get_json_object(json, "$.Charges[0]._attrs.Amount[0]").cast("double").alias("base"),
        F.get_json_object(json, "$.Charges[1]._attrs.Kind[0]").alias("second_kind"),
        F.json_array_length(F.get_json_object(json, "$.Charges")).alias("charges"))


# -------------------------------------------------------------------- paths

@query(f"""
    SELECT 'N' || c_nationkey AS bid, 'c' || c_custkey AS tid, '{CUSTOMER}' AS class_name,
           CAST(1 AS INTEGER) AS occurrence, c_name AS value
    FROM customer""")
def values_simple(spark, sf_dir):
    return values.read_values(
        spark, shop.folder(spark, sf_dir, "sales"), CUSTOMER, "Name", shop.shared_catalog(spark), dialect=V23)


@query("SELECT 'o' || o_orderkey AS tid, CAST(1 AS INTEGER) AS occurrence, o_orderpriority AS value FROM orders")
def values_nested(spark, sf_dir):
    rows = values.read_values(
        spark, shop.folder(spark, sf_dir, "sales"), ORDER, "Terms.Priority", shop.shared_catalog(spark), dialect=V23)
    return rows.select("tid", "occurrence", "value")


@query(f"SELECT tid, CAST(1 AS INTEGER) AS occurrence, kind AS value FROM ({_CHARGES}) WHERE pos = 1")
def values_index(spark, sf_dir):
    rows = values.read_values(
        spark, shop.folder(spark, sf_dir, "stock"), LINE, "Charges[2].Kind", shop.shared_catalog(spark), dialect=V23)
    return rows.select("tid", "occurrence", "value")


@query(f"SELECT bid, tid, CAST(pos + 1 AS INTEGER) AS occurrence, amount AS value FROM ({_CHARGES})")
def values_wildcard(spark, sf_dir):
    rows = values.read_values(
        spark, shop.folder(spark, sf_dir, "stock"), LINE, "Charges[*].Amount", shop.shared_catalog(spark), dialect=V23)
    return rows.select("bid", "tid", "occurrence", F.col("value").cast("double").alias("value"))


@query(f"SELECT tid, CAST(pos + 1 AS INTEGER) AS occurrence, kind AS value FROM ({_CHARGES}) WHERE bid = 'FN'")
def values_of_basket(spark, sf_dir):
    """The basket selection of the operator."""
    rows = values.read_values(
        spark, shop.folder(spark, sf_dir, "stock"), LINE, "Charges[*].Kind", shop.shared_catalog(spark), bid="FN",
        dialect=V23)
    return rows.select("tid", "occurrence", "value")


@query("""
    SELECT 'o' || o_orderkey AS _tid, o_orderstatus = 'F' AS "Flag",
           printf('%02d:%02d:30', CAST(o_orderkey % 24 AS INTEGER), CAST(o_orderkey % 60 AS INTEGER)) AS "At",
           CAST(o_totalprice AS DECIMAL(15,2)) AS "Amount",
           CASE WHEN o_orderpriority LIKE '1%' THEN NULL WHEN o_orderpriority LIKE '2%' THEN '' ELSE o_orderpriority END AS "Note",
           '{"Twice":["1","2"],"Extra":["e' || o_custkey || '"],"Box":["<Extra>e' || o_custkey || '</Extra>"]}' AS residual
    FROM orders""")
def scan_scalars(spark, sf_dir):
    """Boolean, time, decimal; missing and empty text; unknown properties, direct children only."""
    rows = scan.scan_class(
        spark, shop.folder(spark, sf_dir, "scalars"), shop.SAMPLE, shop.scalar_catalog(spark), temporal=True, geometry_errors="null")
    return rows.select("_tid", "Flag", "At", "Amount", "Note", F.regexp_replace(
        "_unsupported_json", r'"Line":\[\{"_error":"[^"]*"\}\],?', "").alias("residual"))


@query("""
    SELECT 'o' || o_orderkey AS tid, o_orderkey % 2 = 1 AS decoded,
           CASE WHEN o_orderkey % 2 = 0 THEN 'unsupported geometry element SPLINE' END AS error
    FROM orders""")
def geometry_unsupported(spark, sf_dir):
    """A line form that is not supported is never NULL without a word."""
    rows = scan.scan_class(
        spark, shop.folder(spark, sf_dir, "scalars"), shop.SAMPLE, shop.scalar_catalog(spark), geometry_errors="null",
        columns=["_tid", "Line", "_unsupported_json"])
    return rows.select(F.col("_tid").alias("tid"), F.col("Line").isNotNull().alias("decoded"),
                       F.get_json_object("_unsupported_json", "$.Line[0]._error").alias("error"))


_ERRORS = [
    ("boolean", "property=Note invalid boolean lexical value"),
    ("several", "property=Twice expected one value but found 2"),
    ("class", "class_name is not a model class: Shop.Scalars.Other"),
    ("short class", "class_name must be fully qualified as Model.Topic.Class: Sample"),
    ("path", "invalid path_expression 'Note['"),
    ("target", "path target is not primitive: Root"),
    ("reserved", "property name collides with a reserved result column: _tid"),
    ("same folder", "input and output must be different files"),
    ("empty output", "input and output must not be empty"),
]


@query("SELECT * FROM (VALUES " + ", ".join(
    f"('{case}', '{message.replace(chr(39), chr(39) * 2)}')" for case, message in _ERRORS) + ") v(kind, message)")
def error_messages(spark, sf_dir):
    """What a scan, a path and an edit of the whole folder say when they refuse."""
    path = shop.folder(spark, sf_dir, "scalars")
    sample = lambda **kinds: scan.scan_class(
        spark, path, shop.SAMPLE, shop.scalar_catalog(spark, **kinds), columns=[n for n in kinds]).agg(
        *(F.max(F.col(n)) for n in kinds)).collect()
    edits = _order_edits(spark, sf_dir)
    apply = lambda output: ed.apply_edits(spark, path, output, edits, shop.scalar_catalog(spark))
    tries = {
        "boolean": lambda: sample(Note="Boolean"), "several": lambda: sample(Twice="String"),
        "class": lambda: scan.scan_class(spark, path, "Shop.Scalars.Other", shop.scalar_catalog(spark)),
        "short class": lambda: scan.scan_class(spark, path, "Sample", shop.scalar_catalog(spark)),
        "path": lambda: values.read_values(spark, path, shop.SAMPLE, "Note[", shop.scalar_catalog(spark)),
        "target": lambda: values.read_values(spark, path, shop.CHAIN, "Root", shop.deep_catalog(spark)),
        "reserved": lambda: scan.scan_class(spark, path, shop.SAMPLE, shop.scalar_catalog(spark, _tid="String")),
        "same folder": lambda: apply(path), "empty output": lambda: apply(""),
    }
    told = []
    for kind, attempt in tries.items():
        expected = dict(_ERRORS)[kind]
        try:
            attempt()
            message = "no error"
        except Exception as error:  # the message is the result
            message = expected if expected in str(error) else str(error)[:500]
        told.append((kind, message))
    return spark.createDataFrame(told, "kind string, message string")


# -------------------------------------------------------------- deep objects

_SEVENTH = "Root" + ".Next" * 6


def _deep_objects(spark, sf_dir):
    catalog = shop.deep_catalog(spark)
    return catalog, read_objects(spark, shop.folder(spark, sf_dir, "deep"), catalog.model)


@query("SELECT 'N' || c_nationkey AS bid, 'd' || c_custkey AS tid, 1 AS occurrence, c_name || '-7' AS value FROM customer")
def values_deep(spark, sf_dir):
    """Texts on the seventh level of a structure that holds itself."""
    return values.read_values(
        spark, shop.folder(spark, sf_dir, "deep"), shop.CHAIN, f"{_SEVENTH}.Label", shop.deep_catalog(spark)).drop("class_name")


@query("""
    SELECT 'd' || c_custkey AS tid, CAST(i AS INTEGER) AS occurrence, 'm & ' || i AS value
    FROM customer, generate_series(1, 3) s(i) WHERE i <= c_custkey % 3 + 1""")
def values_deep_bag(spark, sf_dir):
    rows = values.read_values(
        spark, shop.folder(spark, sf_dir, "deep"), shop.CHAIN, f"{_SEVENTH}.Marks[*].Text", shop.deep_catalog(spark))
    return rows.select("tid", "occurrence", "value")


@query("SELECT 'd' || c_custkey AS tid, c_name || '-7' AS label, c_mktsegment AS segment, c_custkey % 3 + 1 AS marks FROM customer")
def structure_json_deep(spark, sf_dir):
    """The JSON of a structure has all its levels."""
    rows = scan.read_class(spark, shop.folder(spark, sf_dir, "deep"), shop.CHAIN, shop.deep_catalog(spark))
    below = "$" + ".Next" * 6
    return rows.select(
        F.col("xtf_tid").alias("tid"), F.get_json_object("Root_json", f"{below}.Label").alias("label"), F.col("Segment").alias("segment"),
        F.json_array_length(F.get_json_object("Root_json", f"{below}.Marks")).cast("long").alias("marks"))


@query(f"""
    SELECT 'd' || c_custkey AS tid, '{_SEVENTH}.Balance' AS attribute, 'RANGE' AS code FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT 'd' || c_custkey, '{_SEVENTH}.Marks', 'MULTIPLICITY' FROM customer WHERE c_custkey % 3 = 2""")
def quality_deep(spark, sf_dir):
    """Faults on the seventh level."""
    catalog, objects = _deep_objects(spark, sf_dir)
    report = quality.validate(spark, "", catalog, objects=objects, checks={"RANGE", "TYPE", "LENGTH", "MULTIPLICITY"})
    return report.select(F.col("xtf_tid").alias("tid"), F.col("attribute_name").alias("attribute"), "code")


@query(f"""
    SELECT 'd' || c.c_custkey AS tid, '{_SEVENTH}.peer' AS attribute,
           'no object d' || (c.c_custkey + 1) || ' of class {shop.CHAIN} in basket N' || c.c_nationkey AS message
    FROM customer c LEFT JOIN customer t ON t.c_custkey = c.c_custkey + 1 AND t.c_nationkey = c.c_nationkey
    WHERE t.c_custkey IS NULL""")
def quality_reference_baskets(spark, sf_dir):
    """References inside structures that name a basket: the target must stand there."""
    catalog, objects = _deep_objects(spark, sf_dir)
    report = quality.validate(spark, "", catalog, objects=objects, checks={"REFERENCE"})
    return report.select(F.col("xtf_tid").alias("tid"), F.col("attribute_name").alias("attribute"), "message")


@query(ORACLES["values_deep"])
def roundtrip_deep(spark, sf_dir):
    """Objects shredded into nodes, put together from them, written and read again."""
    catalog, objects = _deep_objects(spark, sf_dir)
    anew = nodes.rebuilt(nodes.node_rows(objects, catalog, [shop.CHAIN]))
    output = fresh_path(spark, "deep")
    shop.write_objects(anew.select("basket_tag", "raw"), output)
    return values.read_values(spark, output, shop.CHAIN, f"{_SEVENTH}.Label", catalog).drop("class_name")


@query("""
    SELECT 'd' || c_custkey AS tid, l.i AS level, CASE WHEN l.i IN (3, 7) THEN 'x' || l.i || c_custkey ELSE c_name || '-' || l.i END AS label
    FROM customer, (SELECT CAST(i AS INTEGER) AS i FROM generate_series(2, 7) s(i)) l""")
def edit_deep(spark, sf_dir):
    """Labels on two levels of a structure that holds itself, edited; the other levels stay."""
    catalog = shop.deep_catalog(spark)
    path = shop.folder(spark, sf_dir, "deep")
    tid = F.concat(F.lit("d"), F.col("c_custkey").cast("string"))
    none = F.lit(None).cast("string")
    parts = [
        spark.read.parquet(f"{sf_dir}/customer.parquet").select(
            F.concat(tid, F.lit(f"/{level}")).alias("edit_id"), F.lit(shop.CHAIN).alias("class_name"), tid.alias("tid"), none.alias("bid"),
            F.lit("Root" + ".Next" * (level - 1) + ".Label").alias("path_expression"),
            F.concat(F.lit(f"x{level}"), F.col("c_custkey").cast("string")).alias("value"), none.alias("expected"))
        for level in (3, 7)]
    audit = cut_lineage(ed.audit_edits(spark, path, parts[0].unionByName(parts[1]), catalog), "audit")
    rows = nodes.node_rows(ed.edited_objects(spark, path, audit, catalog), catalog, [shop.CHAIN])
    level = F.size("ordinals") - 1
    return rows.filter((F.col("name") == "Label") & (level > 1)).select("tid", level.alias("level"), F.col("value").alias("label"))


# ------------------------------------------------------- structures and bags

@query(f"SELECT bid, tid, CAST(pos AS INTEGER) AS pos, kind AS \"Kind\", amount AS \"Amount\" FROM ({_CHARGES})")
def bag_rows(spark, sf_dir):
    rows = scan.bag_rows(
        spark, shop.folder(spark, sf_dir, "stock"), LINE, "Charges", shop.shared_catalog(spark), V23)
    return rows.select("bid", "tid", "pos", "Kind", "Amount")


@query(f"""
    SELECT {_LINE_TID} AS tid,
           CAST(1 + (CASE WHEN l_discount > 0 THEN 1 ELSE 0 END) + (CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS INTEGER) AS n
    FROM lineitem""")
def bag_sizes(spark, sf_dir):
    return scan.bag_sizes(
        spark, shop.folder(spark, sf_dir, "stock"), LINE, "Charges", shop.shared_catalog(spark), V23).select("tid", "n")


@query(f"""
    SELECT 'o' || o_orderkey AS tid, o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS placed_year
    FROM orders""")
def structure_struct(spark, sf_dir):
    rows = scan.read_class(
        spark, shop.folder(spark, sf_dir, "sales"), ORDER, shop.shared_catalog(spark), nested="struct", dialect=V23)
    return rows.select(F.col("xtf_tid").alias("tid"), F.col("Terms.Priority").alias("priority"),
                       F.year(F.left("Terms.Placed", F.lit(10)).cast("date")).alias("placed_year"))


@query("""
    SELECT 'o' || o_orderkey AS tid, o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed,
           'c' || o_custkey AS customer_ref
    FROM orders""")
def structure_json(spark, sf_dir):
    rows = scan.read_class(
        spark, shop.folder(spark, sf_dir, "sales"), ORDER, shop.shared_catalog(spark), dialect=V23)
    return rows.select(F.col("xtf_tid").alias("tid"), F.get_json_object("Terms_json", "$.Priority").alias("priority"),
                       F.date_format("Placed", "yyyy-MM-dd HH:mm:ss").alias("placed"), "customer_ref")


# ----------------------------------------------------- associations and joins

def _links(spark, sf_dir, objects: DataFrame | None = None):
    return scan.read_association(
        spark, shop.folder(spark, sf_dir, "sales"), PLACED, shop.shared_catalog(spark), dialect=V23, objects=objects)


def _sales(spark, sf_dir, *classes: str) -> DataFrame:
    """Stored objects of several classes, cut once for all that read them."""
    objects = read_objects(spark, shop.folder(spark, sf_dir, "sales"), shop.shared_catalog(spark).model, V23)
    return objects_by_class(objects.filter(F.col("class_fqn").isin(*classes)))


@query("""
    SELECT CAST(NULL AS VARCHAR) AS xtf_tid, 'P' || o_orderstatus AS xtf_bid, 'c' || o_custkey AS customer_ref,
           'o' || o_orderkey AS order_ref,
           CAST(CASE WHEN o_orderpriority LIKE '1%' THEN 100 ELSE 50 END AS BIGINT) AS "Share"
    FROM orders""")
def association_scan(spark, sf_dir):
    return _links(spark, sf_dir)


@query(ORACLES["association_scan"])
def links_v24(spark, sf_dir):
    """Links of the second dialect; they have no id, and their name is a property's too."""
    return scan.read_association(spark, shop.folder(spark, sf_dir, "sales24"), PLACED, shop.shared_catalog(spark))


@query("""
    SELECT c_name AS "Name", c_mktsegment AS "Segment", o_totalprice AS "Price"
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def association_join(spark, sf_dir):
    objects = _sales(spark, sf_dir, CUSTOMER, ORDER, PLACED)
    people = _scan(spark, sf_dir, "sales", CUSTOMER, ["_tid", "Name", "Segment"], objects=objects)
    sold = _scan(spark, sf_dir, "sales", ORDER, ["_tid", "Price"], objects=objects)
    return (
        _links(spark, sf_dir, objects)
        .join(people.withColumnRenamed("_tid", "customer_ref"), "customer_ref")
        .join(sold.withColumnRenamed("_tid", "order_ref"), "order_ref")
        .select("Name", "Segment", "Price"))


@query("""
    SELECT 'o' || o_orderkey AS order_ref,
           o_totalprice * (CASE WHEN o_orderpriority LIKE '1%' THEN 100 ELSE 50 END) / 100 AS paid
    FROM orders""")
def association_arith(spark, sf_dir):
    objects = _sales(spark, sf_dir, ORDER, PLACED)
    sold = _scan(spark, sf_dir, "sales", ORDER, ["_tid", "Price"], objects=objects).withColumnRenamed("_tid", "order_ref")
    return _links(spark, sf_dir, objects).join(sold, "order_ref").select(
        "order_ref", (F.col("Price") * F.col("Share") / 100).alias("paid"))


@query("""
    SELECT c_mktsegment AS segment, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment""")
def segment_revenue(spark, sf_dir):
    """Orders joined to customers by reference; orders are summed before the join."""
    per_customer = _scan(spark, sf_dir, "sales", ORDER, ["Price", "customer"]).groupBy("customer").agg(
        F.count("*").alias("orders"), F.sum(F.col("Price").cast("decimal(18,2)")).alias("revenue"))
    people = _scan(spark, sf_dir, "sales", CUSTOMER, ["_tid", "Segment"])
    return (
        per_customer.join(people.withColumnRenamed("_tid", "customer"), "customer")
        .groupBy(F.col("Segment").alias("segment"))
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").cast("double").alias("revenue")))


@query(f"""
    SELECT 'o' || o_orderkey AS order_ref, count(l_orderkey) AS lines,
           coalesce(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS amount
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey""")
def lines_per_order(spark, sf_dir):
    """Lines are summed per order before they meet the orders."""
    sold = _scan(spark, sf_dir, "sales", ORDER, ["_tid"]).select(F.col("_tid").alias("order_ref"))
    items = _scan(spark, sf_dir, "stock", LINE, ["Price", "order"]).groupBy(F.col("order").alias("order_ref")).agg(
        F.count("*").alias("lines"), _sum_cents("Price").alias("amount"))
    return sold.join(items, "order_ref", "left").select(
        "order_ref", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("amount", F.lit(0.0)).alias("amount"))


# --------------------------------------------------------------------- edits

def _order_edits(spark, sf_dir) -> DataFrame:
    """One edit per order of its status, one of its priority, and one that cannot be done."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    tid = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    none = F.lit(None).cast("string")

    def edit(kind: str, path: str, value, expected=none, bid=none):
        return F.struct(
            F.concat(F.lit(kind), F.col("o_orderkey").cast("string")).alias("edit_id"),
            F.lit(ORDER).alias("class_name"), tid.alias("tid"), bid.alias("bid"),
            F.lit(path).alias("path_expression"), value.alias("value"), expected.alias("expected"))

    bid = F.concat(F.lit("Y"), F.year("o_orderdate").cast("string"))
    return orders.select(F.inline(F.array(
        edit("s", "Status", F.lit("X"), expected=F.lit("O")),
        edit("p", "Terms.Priority", F.substring("o_orderpriority", 3, 20), bid=bid),
        edit("r", "customer", F.lit("c0")))))


_AUDITS: dict[tuple[str, str], DataFrame] = {}


def _order_audit(spark, sf_dir) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _AUDITS:
        _AUDITS[key] = cut_lineage(ed.audit_edits(
            spark, shop.folder(spark, sf_dir, "sales"), _order_edits(spark, sf_dir), shop.shared_catalog(spark), V23))
    return _AUDITS[key]


@query(f"""
    SELECT 's' || o_orderkey AS edit_id, {_ORDER_BID} AS bid, 'o' || o_orderkey AS tid, 'Status' AS path_expression,
           o_orderstatus AS old_value, 'X' AS new_value,
           CASE WHEN o_orderstatus = 'O' THEN 'UPDATED' ELSE 'REJECTED' END AS status,
           CASE WHEN o_orderstatus = 'O' THEN 'one primitive value rewritten'
                ELSE 'expected value does not match' END AS message
    FROM orders
    UNION ALL
    SELECT 'p' || o_orderkey, {_ORDER_BID}, 'o' || o_orderkey, 'Terms.Priority', o_orderpriority,
           substr(o_orderpriority, 3), 'UPDATED', 'one primitive value rewritten'
    FROM orders
    UNION ALL
    SELECT 'r' || o_orderkey, NULL, 'o' || o_orderkey, 'customer', NULL, 'c0', 'REJECTED',
           'roles are not supported: customer'
    FROM orders""")
def edit_audit(spark, sf_dir):
    audit = ed.audit_edits(
        spark, shop.folder(spark, sf_dir, "sales"), _order_edits(spark, sf_dir), shop.shared_catalog(spark), V23)
    return audit.drop("class_name")


_EDITED = f"""
    SELECT 'o' || o_orderkey AS tid, {_ORDER_BID} AS bid, {_OPERATION} AS operation,
           CASE WHEN o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS status,
           o_totalprice AS price, substr(o_orderpriority, 3) AS priority, 'c' || o_custkey AS customer
    FROM orders"""


def _edited_columns(rows: DataFrame) -> DataFrame:
    json = F.col("_unsupported_json")
    return rows.select(
        F.col("_tid").alias("tid"), F.col("_bid").alias("bid"), F.col("_operation").alias("operation"),
        F.col("Status").alias("status"), F.col("Price").alias("price"),
        F.get_json_object(json, "$.Terms[0]._attrs.Priority[0]").alias("priority"), "customer")


@query(_EDITED)
def edit_apply(spark, sf_dir):
    """Objects with their accepted edits, typed straight from the edited text."""
    edited = ed.edited_objects(
        spark, shop.folder(spark, sf_dir, "sales"), _order_audit(spark, sf_dir), shop.shared_catalog(spark), V23)
    return _edited_columns(scan.scan_class(spark, "", ORDER, shop.shared_catalog(spark), dialect=V23, objects=edited))


@query(_EDITED)
def edit_written(spark, sf_dir):
    """The edited transfer written as files and read again."""
    output = fresh_path(spark, "edited")
    ed.apply_edits(spark, shop.folder(spark, sf_dir, "sales").removesuffix("/*") + "/*", output,
                   _order_edits(spark, sf_dir), shop.shared_catalog(spark), strict=False, dialect=V23)
    return _edited_columns(scan.scan_class(spark, output, ORDER, shop.shared_catalog(spark), dialect=V23))


#: Paths that cannot be edited, by remainder of the order key, and what the audit says of them.
_REJECTED = [
    (ORDER, "customer", "roles are not supported: customer"),
    (ORDER, "Terms", "target property is not primitive: Terms"),
    (ORDER, "Terms[*].Priority", "path_expression must not contain a wildcard"),
    (ORDER, "Color", f"target property does not exist: {ORDER}.Color"),
    (ORDER, "Terms.Color", "target property does not exist: Terms.Color"),
    (ORDER, "customer.Name", "nested path must start with one structure: customer.Name"),
    (ORDER, "Price.", "invalid path_expression 'Price.'"),
    ("Shop.Sales.Offer", "Price", "class_name is not a model class: Shop.Sales.Offer"),
    (ORDER, "", "class_name, tid and path_expression must not be empty"),
    (LINE, "Charges.Kind", "nested path must start with one structure: Charges.Kind"),
]


@query(f"""
    SELECT 'o' || o_orderkey AS edit_id, CASE o_orderkey % {len(_REJECTED)} """
       + " ".join(f"WHEN {i} THEN '{message.replace(chr(39), chr(39) * 2)}'" for i, (_, _, message) in enumerate(_REJECTED))
       + " END AS message, 'REJECTED' AS status FROM orders")
def edit_rejects(spark, sf_dir):
    """An edit per order whose target is not allowed, of every kind there is."""
    kind = F.col("o_orderkey") % len(_REJECTED)
    listed = lambda i: F.array(*[F.lit(x[i]) for x in _REJECTED])[kind.cast("int")]
    tid, none = F.concat(F.lit("o"), F.col("o_orderkey").cast("string")), F.lit(None).cast("string")
    edits = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        tid.alias("edit_id"), listed(0).alias("class_name"), tid.alias("tid"), none.alias("bid"),
        listed(1).alias("path_expression"), F.lit("1").alias("value"), none.alias("expected"))
    audit = ed.audit_edits(spark, shop.folder(spark, sf_dir, "sales"), edits, shop.shared_catalog(spark))
    return audit.select("edit_id", "message", "status")


@query(f"""
    SELECT tid, CASE WHEN n = 0 THEN 'found no matching object: TID=' || tid
                     WHEN n > 1 THEN 'matched more than one object: TID=' || tid
                     ELSE 'one primitive value rewritten' END AS message
    FROM (
        SELECT k.tid, count(l.tid) AS n
        FROM (SELECT DISTINCT 'l' || l_orderkey || '-' || (l_linenumber + d) AS tid
              FROM lineitem, (VALUES (0), (1)) v(d)) k
        LEFT JOIN (SELECT {_LINE_TID} AS tid FROM lineitem) l ON l.tid = k.tid
        GROUP BY k.tid)""")
def edit_conflict(spark, sf_dir):
    """Edits of line ids, of which some occur several times and some never."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.explode(F.array(F.col("l_linenumber"), F.col("l_linenumber") + 1)).alias("number")
    keys = items.select("l_orderkey", number).distinct().select(
        F.concat_ws("-", F.concat(F.lit("l"), F.col("l_orderkey").cast("string")), F.col("number").cast("string"))
        .alias("tid"))
    none = F.lit(None).cast("string")
    edits = keys.select(
        F.col("tid").alias("edit_id"), F.lit(LINE).alias("class_name"), "tid", none.alias("bid"),
        F.lit("Quantity").alias("path_expression"), F.lit("1.0").alias("value"), none.alias("expected"))
    audit = ed.audit_edits(spark, shop.folder(spark, sf_dir, "stock"), edits, shop.shared_catalog(spark), V23)
    return audit.select("tid", "message")


@query("SELECT true AS input_same, true AS output_differs FROM orders LIMIT 1")
def input_unchanged(spark, sf_dir):
    """Digests of all files before and after an edit that writes another folder."""
    path, output = shop.folder(spark, sf_dir, "sales"), fresh_path(spark, "edited")
    before = cut_lineage(file_digests(spark, path), "digests")
    ed.apply_edits(spark, path, output, _order_edits(spark, sf_dir), shop.shared_catalog(spark), strict=False, dialect=V23)
    same = before.join(file_digests(spark, path), ["file", "length", "md5"], "full_outer")
    kept = before.join(file_digests(spark, output).select("md5"), "md5", "left_semi")
    files = before.count()
    return same.agg((F.count("*") == files).alias("input_same")).select(
        "input_same", F.lit(kept.count() < files).alias("output_differs"))


@query("SELECT least(100, count(*)) AS shown, count(*) AS total FROM customer WHERE c_acctbal < 0")
def quality_capped(spark, sf_dir):
    """At most so many messages are shown, the total stays."""
    report = _faults(spark, sf_dir, "sales", "RANGE")
    return quality.capped(report, 100).agg(F.count("*").alias("shown")).select("shown", F.lit(report.count()).alias("total"))


@query(f"""
    SELECT 'o' || o_orderkey AS _tid, o_totalprice AS "Price" FROM orders ORDER BY o_totalprice DESC, 'o' || o_orderkey LIMIT 25""")
def sort_limit(spark, sf_dir):
    rows = _scan(spark, sf_dir, "sales", ORDER, ["_tid", "Price"])
    return rows.orderBy(F.col("Price").desc(), "_tid").limit(25)


@query("""
    SELECT 'sales__customer' AS table_name, 2 * count(*) AS n FROM customer
    UNION ALL SELECT 'sales__order', 2 * count(*) FROM orders UNION ALL SELECT 'sales__placed', 2 * count(*) FROM orders""")
def import_schema(spark, sf_dir):
    """Tables of a schema: created, left alone by a second creation, appended to."""
    location = fresh_path(spark, "schema")
    schema = "imported_" + location.rpartition("-")[2]
    spark.sql(f"CREATE SCHEMA `{schema}` LOCATION '{location}'")
    path, catalog = shop.folder(spark, sf_dir, "sales"), shop.shared_catalog(spark)
    for mode in ("create", "create", "append"):
        importer.import_transfer(spark, path, catalog, schema, mode=mode, dialect=V23)
    parts = [spark.table(f"`{schema}`.`{t}`").agg(F.lit(t).alias("table_name"), F.count("*").alias("n"))
             for t in ("sales__customer", "sales__order", "sales__placed")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ----------------------------------------------------- writing, import, ingest

@query(ORACLES["scan_order_typed"])
def write_scan_roundtrip(spark, sf_dir):
    """Orders parsed, rendered anew from their parsed values, written and scanned again."""
    catalog = shop.shared_catalog(spark)
    info = catalog.model.classes[ORDER]
    parser, writer = Parser(catalog.model, info, V23), ObjectWriter(catalog.model, info, V23)
    objects = read_objects(spark, shop.folder(spark, sf_dir, "sales"), catalog.model, V23).filter(
        F.col("class_fqn") == ORDER)
    text = writer.object({p.name: parser.values(p.name) for p in info.properties}, F.col("tid"), F.col("operation"))
    output = fresh_path(spark, "roundtrip")
    shop.write_objects(parser.parse(objects).select("basket_tag", text.alias("raw")), output)
    return scan.scan_class(
        spark, output, ORDER, catalog, dialect=V23,
        columns=["_bid", "_tid", "_class", "_operation", "Status", "Price", "Placed", "customer"])


@query("""
    SELECT 'sales__customer' AS table_name, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM customer
    UNION ALL SELECT 'sales__order', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders
    UNION ALL SELECT 'sales__placed', count(*),
        CAST(sum(CASE WHEN o_orderpriority LIKE '1%' THEN 100 ELSE 50 END) AS DOUBLE) FROM orders
    UNION ALL SELECT 'stock__line', count(*), CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem""")
def import_tables(spark, sf_dir):
    """One typed table per class, written and totalled."""
    written = importer.import_files(
        spark, _all_folders(spark, sf_dir, "sales", "stock"), shop.shared_catalog(spark), fresh_path(spark, "import"),
        dialect=V23)
    amounts = {"sales__customer": "balance", "sales__order": "price", "sales__placed": "share", "stock__line": "price"}
    parts = [
        spark.read.parquet(written[name]).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n"), _sum_cents(column).alias("total"))
        for name, column in amounts.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"SELECT '{LINE}' AS class_fqn, 'F' || l_returnflag AS bid, count(*) AS n FROM lineitem GROUP BY 2")
def incremental_ingest(spark, sf_dir):
    """Files of the folder taken in by a stream; a second run finds nothing new."""
    output, checkpoint = fresh_path(spark, "ingest"), fresh_path(spark, "ingest-state")
    for _ in range(2):
        run = streaming.ingest(
            spark, shop.folder(spark, sf_dir, "stock"), output, checkpoint, shop.shared_catalog(spark), V23)
        run.awaitTermination()
    return spark.read.parquet(output).groupBy("class_fqn", "bid").agg(F.count("*").alias("n"))


# ------------------------------------------- catalog queries over table-made catalogs

_CATALOGS: dict[tuple[str, str], Catalog] = {}


def table_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """A catalog that grows with the tables.

    Regions are models, nations are topics, suppliers are classes in a tree, and
    customers are the properties of the suppliers.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CATALOGS:
        read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
        models = read("region").selectExpr(
            "r_name AS name", "'1' AS version", "'urn:' || r_name AS issuer", "'en' AS language",
            "'2.3' AS ili_version", "CAST(r_regionkey AS int) AS seq")
        placed = (
            read("supplier").join(read("nation"), F.expr("s_nationkey = n_nationkey"))
            .join(read("region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr("s_suppkey", "s_acctbal", "r_name", "n_name", "s_name",
                        "r_name || '.' || n_name || '.' || s_name AS fqn"))
        bases = placed.selectExpr("s_suppkey AS base_key", "fqn AS base_class_fqn")
        parent = F.expr("IF(s_suppkey > 0, (s_suppkey - 1) div 2, NULL)")
        classes = placed.withColumn("base_key", parent).join(bases, "base_key", "left").selectExpr(
            "r_name AS model_name", "n_name AS topic_name", "s_name AS class_name", "fqn AS class_fqn",
            "IF(s_acctbal >= 5000, 'ASSOCIATION', 'CLASS') AS kind", "s_acctbal < 0 AS is_abstract",
            "base_class_fqn", "CAST(s_suppkey AS int) AS seq")
        owned = (
            read("customer").withColumn("owner_key", F.expr("c_custkey div 15"))
            .join(placed.selectExpr("s_suppkey AS owner_key", "fqn AS owner_fqn"), "owner_key"))
        kind = "IF(c_mktsegment = 'HOUSEHOLD', 'ROLE', 'ATTRIBUTE')"
        value_kind = (
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Integer' WHEN 'BUILDING' THEN 'Double' "
            "WHEN 'HOUSEHOLD' THEN 'Reference' WHEN 'MACHINERY' THEN 'Geometry' ELSE 'String' END")
        name = "'p' || CAST(c_custkey % 40 AS string)"
        properties = owned.selectExpr(
            "owner_fqn", f"{name} AS property_name", f"{kind} AS kind", f"{value_kind} AS value_kind",
            "c_mktsegment AS type_name", "c_acctbal > 0 AS is_mandatory",
            "CAST(IF(c_acctbal > 0, 1, 0) AS bigint) AS card_min", "CAST(1 AS bigint) AS card_max",
            "false AS is_transient", "false AS is_embedded", "IF(c_mktsegment = 'HOUSEHOLD', owner_fqn, NULL) AS "
            "target_class_fqn", "CAST(NULL AS double) AS min_value", "c_acctbal AS max_value",
            "CAST(NULL AS int) AS max_len", "IF(c_mktsegment = 'FURNITURE', array(c_name, c_mktsegment), NULL) AS "
            "enum_values", "CAST(c_custkey AS int) AS seq")
        geometry = owned.filter("c_mktsegment = 'MACHINERY'").selectExpr(
            "owner_fqn", f"{name} AS property_name", "IF(c_acctbal > 0, 'SURFACE', 'POLYLINE') AS geometry_kind",
            "split(owner_fqn, '[.]')[0] || '.Coord' AS coordinate_domain_fqn", "CAST(2 AS int) AS dimension",
            "IF(c_acctbal > 0, '0.5', NULL) AS max_overlap_lexical",
            "IF(c_acctbal > 5000, array('STRAIGHTS', 'ARCS'), array('STRAIGHTS')) AS line_forms",
            "false AS has_custom_line_forms", "false AS has_line_attributes")
        to = lambda df, ddl: df.select(*[F.col(f.split()[0]) for f in ddl.split(", ")])
        _CATALOGS[key] = Catalog(
            to(models, MODELS_SCHEMA), to(classes, CLASSES_SCHEMA), to(properties, PROPERTIES_SCHEMA),
            to(geometry, GEOMETRY_SCHEMA), crs_map="EUROPE.Coord=EPSG:2056;ASIA.Coord=LOCAL:9")
    return _CATALOGS[key]


_CATALOG_SQL = """
    WITH RECURSIVE placed AS (
        SELECT s_suppkey, s_acctbal, r_name, n_name, s_name, r_name || '.' || n_name || '.' || s_name AS fqn
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    classes AS (
        SELECT p.*, b.fqn AS base_fqn, CASE WHEN p.s_acctbal >= 5000 THEN 'ASSOCIATION' ELSE 'CLASS' END AS class_kind
        FROM placed p LEFT JOIN placed b ON p.s_suppkey > 0 AND b.s_suppkey = (p.s_suppkey - 1) // 2),
    props AS (
        SELECT fqn AS owner_fqn, 'p' || (c_custkey % 40) AS property_name, customer.*,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ROLE' ELSE 'ATTRIBUTE' END AS kind
        FROM customer JOIN placed ON s_suppkey = c_custkey // 15),
    up AS (
        SELECT fqn AS class_fqn, fqn AS ancestor_fqn, base_fqn AS next_fqn, 0 AS depth FROM classes
        UNION ALL
        SELECT up.class_fqn, c.fqn, c.base_fqn, up.depth + 1 FROM up JOIN classes c ON c.fqn = up.next_fqn),
    every AS (
        SELECT up.class_fqn, up.depth, p.*,
               CASE WHEN (p.kind = 'ROLE') <> (c.class_kind = 'ASSOCIATION') THEN 1 ELSE 0 END AS block
        FROM up JOIN classes c ON c.fqn = up.ancestor_fqn JOIN props p ON p.owner_fqn = up.ancestor_fqn),
    kept AS (
        SELECT *, first_value(struct_pack(d := -depth, b := block, s := c_custkey))
                      OVER (PARTITION BY class_fqn, property_name ORDER BY depth DESC) AS first_place
        FROM every QUALIFY row_number() OVER (PARTITION BY class_fqn, property_name ORDER BY depth) = 1),
    ordered AS (
        SELECT *, CAST(row_number() OVER (
            PARTITION BY class_fqn ORDER BY first_place.d, first_place.b, first_place.s) AS INTEGER) AS position
        FROM kept)
"""


@query("SELECT r_name AS name, '1' AS version, 'urn:' || r_name AS issuer, 'en' AS language, '2.3' AS ili_version "
       "FROM region")
def catalog_models(spark, sf_dir):
    return introspect.models(table_catalog(spark, sf_dir))


@query(_CATALOG_SQL + """
    SELECT r_name AS model_name, n_name AS topic_name, s_name AS class_name, fqn AS class_fqn, class_kind AS kind,
           s_acctbal < 0 AS is_abstract, base_fqn AS base_class_fqn
    FROM classes""")
def catalog_classes(spark, sf_dir):
    return introspect.classes(table_catalog(spark, sf_dir))


@query(_CATALOG_SQL + "SELECT DISTINCT r_name AS model_name, n_name AS topic_name, 'TOPIC' AS kind FROM classes")
def catalog_topics(spark, sf_dir):
    return introspect.topics(table_catalog(spark, sf_dir))


@query(_CATALOG_SQL + "SELECT class_fqn, ancestor_fqn, depth FROM up")
def catalog_ancestors(spark, sf_dir):
    return introspect.ancestors(table_catalog(spark, sf_dir))


@query(_CATALOG_SQL + "SELECT class_fqn, property_name, owner_fqn, position FROM ordered")
def catalog_transfer_order(spark, sf_dir):
    return introspect.transfer_order(table_catalog(spark, sf_dir)).select(
        "class_fqn", "property_name", "owner_fqn", "position")


@query(_CATALOG_SQL + """
    SELECT class_fqn, property_name, owner_fqn || '.' || property_name AS property_fqn, kind, c_mktsegment AS type_name,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'GEOMETRY' WHEN 'AUTOMOBILE' THEN 'BIGINT'
                WHEN 'BUILDING' THEN 'DOUBLE' ELSE 'VARCHAR' END AS column_type,
           c_acctbal > 0 AS is_mandatory, CAST(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS BIGINT) AS cardinality_min,
           CAST(1 AS BIGINT) AS cardinality_max, false AS is_transient, false AS is_embedded,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN owner_fqn END AS target_class_fqn
    FROM ordered""")
def catalog_properties(spark, sf_dir):
    return introspect.properties(table_catalog(spark, sf_dir))


@query(ORACLES["catalog_properties"])
def catalog_saved(spark, sf_dir):
    """The catalog written as tables and loaded from them, one source named twice."""
    path = fresh_path(spark, "catalog")
    table_catalog(spark, sf_dir).save(path)
    return introspect.properties(Catalog.load(spark, [path, f"{path}/"]))


@query(_CATALOG_SQL + """
    SELECT h.class_fqn AS holder_fqn, h.property_name AS holder_property, h.owner_fqn AS structure_name,
           p.property_name AS attribute_name, p.c_mktsegment AS type_name,
           CASE p.c_mktsegment WHEN 'MACHINERY' THEN 'GEOMETRY' WHEN 'AUTOMOBILE' THEN 'BIGINT' WHEN 'BUILDING' THEN 'DOUBLE'
                WHEN 'FURNITURE' THEN 'UNSUPPORTED_JSON' ELSE 'VARCHAR' END AS logical_type, p.kind,
           CAST(CASE WHEN p.c_acctbal > 0 THEN 1 ELSE 0 END AS BIGINT) AS card_min, CAST(1 AS BIGINT) AS card_max,
           CASE WHEN p.c_mktsegment = 'FURNITURE' THEN '["' || p.c_name || '","FURNITURE"]' END AS enum_values_json
    FROM ordered h JOIN ordered p ON p.class_fqn = h.owner_fqn WHERE h.c_mktsegment = 'FURNITURE'""")
def catalog_structures(spark, sf_dir):
    """Attributes of the structures that properties hold; furniture customers are such properties."""
    known = table_catalog(spark, sf_dir)
    holds = F.col("type_name") == "FURNITURE"
    properties = known.properties.withColumn("value_kind", F.when(holds, "Structure").otherwise(F.col("value_kind"))).withColumn(
        "target_class_fqn", F.when(holds, F.col("owner_fqn")).otherwise(F.col("target_class_fqn")))
    return introspect.structures(Catalog(known.models, known.classes, properties, known.geometry), "")


@query(_CATALOG_SQL + """
    SELECT class_fqn, property_name, owner_fqn || '.' || property_name AS property_fqn,
           CASE WHEN c_acctbal > 0 THEN 'SURFACE' ELSE 'POLYLINE' END AS geometry_kind,
           split_part(owner_fqn, '.', 1) || '.Coord' AS coordinate_domain_fqn, CAST(2 AS INTEGER) AS dimension,
           CASE WHEN c_acctbal > 0 THEN '0.5' END AS max_overlap_lexical,
           CASE WHEN c_acctbal > 0 THEN CAST(0.5 AS DOUBLE) END AS max_overlap,
           CASE WHEN c_acctbal > 5000 THEN 'STRAIGHTS,ARCS' ELSE 'STRAIGHTS' END AS line_forms,
           true AS has_straights, c_acctbal > 5000 AS has_arcs, false AS has_custom_line_forms,
           false AS has_line_attributes
    FROM ordered WHERE c_mktsegment = 'MACHINERY'""")
def catalog_geometry(spark, sf_dir):
    rows = introspect.geometry_properties(table_catalog(spark, sf_dir))
    return rows.withColumn("line_forms", F.array_join("line_forms", ","))


@query(_CATALOG_SQL + """
    SELECT class_fqn, property_name AS attribute_name, split_part(owner_fqn, '.', 1) AS domain_model,
           CASE split_part(owner_fqn, '.', 1) WHEN 'EUROPE' THEN 'EPSG' WHEN 'ASIA' THEN 'LOCAL' END AS crs_auth_name,
           CAST(CASE split_part(owner_fqn, '.', 1) WHEN 'EUROPE' THEN 2056 END AS INTEGER) AS srid,
           c_acctbal > 5000 AS supports_arcs, false AS is_area_type
    FROM ordered WHERE c_mktsegment = 'MACHINERY'""")
def catalog_geometry_crs(spark, sf_dir):
    return introspect.geometry_attributes(table_catalog(spark, sf_dir)).select(
        "class_fqn", "attribute_name", F.substring_index("coordinate_domain_fqn", ".", 1).alias("domain_model"),
        "crs_auth_name", "srid", "supports_arcs", "is_area_type")


@query(_CATALOG_SQL + """
    SELECT r_name AS model_name, owner_fqn || '.' || property_name AS enum_name, e.element
    FROM props JOIN placed ON fqn = owner_fqn, LATERAL (SELECT unnest([c_name, c_mktsegment]) AS element) e
    WHERE c_mktsegment = 'FURNITURE'""")
def catalog_enums(spark, sf_dir):
    return introspect.enumerations(table_catalog(spark, sf_dir))


@query(_CATALOG_SQL + "SELECT class_fqn, property_name, owner_fqn AS target_class_fqn FROM ordered WHERE kind = 'ROLE'")
def catalog_roles(spark, sf_dir):
    return introspect.roles(table_catalog(spark, sf_dir)).select("class_fqn", "property_name", "target_class_fqn")


@query(_CATALOG_SQL + """
    SELECT r_name AS model_name, n_name AS topic_name, s_name AS class_name, property_name AS attr_name,
           c_mktsegment AS type_name, c_acctbal > 0 AS is_mandatory
    FROM ordered JOIN placed ON fqn = class_fqn WHERE kind = 'ATTRIBUTE'""")
def catalog_attributes(spark, sf_dir):
    return introspect.attributes(table_catalog(spark, sf_dir)).select(
        "model_name", "topic_name", "class_name", "attr_name", "type_name", "is_mandatory")


# ------------------------------------------------------------------- quality

def _faults(spark, sf_dir, folder: str, *codes: str) -> DataFrame:
    report = quality.validate(
        spark, shop.folder(spark, sf_dir, folder), shop.shared_catalog(spark, strict=True), dialect=V23,
        checks=set(codes))
    return report.select("code", "class_name", "attribute_name", F.col("xtf_tid").alias("tid"), "raw")


@query(f"""
    SELECT 'MULTIPLICITY' AS code, '{LINE}' AS class_name, 'Discount' AS attribute_name, {_LINE_TID} AS tid
    FROM lineitem WHERE NOT l_discount > 0
    UNION ALL
    SELECT 'MULTIPLICITY', '{LINE}', 'Charges', {_LINE_TID} FROM lineitem WHERE l_discount > 0 AND l_tax > 0""")
def quality_multiplicity(spark, sf_dir):
    """The strict model wants a discount and at most two charges."""
    return _faults(spark, sf_dir, "stock", "MULTIPLICITY").drop("raw")


@query(f"""
    SELECT 'TYPE' AS code, '{ORDER}' AS class_name, 'Terms.Priority' AS attribute_name, 'o' || o_orderkey AS tid,
           o_orderpriority AS raw
    FROM orders""")
def quality_type(spark, sf_dir):
    """The strict model wants a number inside the structure."""
    return _faults(spark, sf_dir, "sales", "TYPE")


@query(f"""
    SELECT 'RANGE' AS code, '{CUSTOMER}' AS class_name, 'Balance' AS attribute_name, 'c' || c_custkey AS tid
    FROM customer WHERE c_acctbal < 0""")
def quality_range(spark, sf_dir):
    return _faults(spark, sf_dir, "sales", "RANGE").drop("raw")


@query(f"""
    SELECT 'ENUMERATION' AS code, '{CUSTOMER}' AS class_name, 'Segment' AS attribute_name, 'c' || c_custkey AS tid,
           c_mktsegment AS raw
    FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def quality_enum(spark, sf_dir):
    return _faults(spark, sf_dir, "sales", "ENUMERATION")


@query(f"""
    SELECT 'REFERENCE' AS code, '{LINE}' AS class_name, 'next' AS attribute_name, {_LINE_TID} AS tid,
           'l' || l_orderkey || '-' || (l_linenumber + 1) AS raw
    FROM lineitem a
    WHERE NOT EXISTS (SELECT 1 FROM lineitem b
                      WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)""")
def quality_reference(spark, sf_dir):
    """Lines whose next line is missing; orders are found in the other folder."""
    report = quality.validate(
        spark, _all_folders(spark, sf_dir, "sales", "stock"), shop.shared_catalog(spark, strict=True), dialect=V23,
        checks={"REFERENCE"})
    return report.select("code", "class_name", "attribute_name", F.col("xtf_tid").alias("tid"), "raw")


@query(f"""
    SELECT 'l' || l_orderkey || '-' || l_linenumber AS tid, 'object id occurs ' || count(*) || ' times' AS message
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def quality_duplicate(spark, sf_dir):
    report = quality.validate(
        spark, shop.folder(spark, sf_dir, "stock"), shop.shared_catalog(spark, strict=True), dialect=V23,
        checks={"DUPLICATE_TID"})
    return report.select(F.col("xtf_tid").alias("tid"), "message")


@query(f"""
    SELECT 'GEOMETRY' AS code, '{TRACK}' AS class_name, 'Stub' AS attribute_name, 't' || vec_id AS tid,
           'POLYLINE requires at least two coordinates' AS message
    FROM embeddings WHERE label = 0""")
def quality_geometry(spark, sf_dir):
    report = quality.validate(
        spark, shop.folder(spark, sf_dir, "tracks"), shop.shared_catalog(spark), dialect=V23, checks={"GEOMETRY"})
    return report.select("code", "class_name", "attribute_name", F.col("xtf_tid").alias("tid"), "message")


_SALES_FAULTS = f"""
    SELECT '{CUSTOMER}' AS class_name FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT '{CUSTOMER}' FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT '{ORDER}' FROM orders"""


@query(f"""
    SELECT count(*) = 0 AS valid, count(*) AS error_count, CAST(0 AS BIGINT) AS warning_count,
           CAST(0 AS BIGINT) AS info_count
    FROM ({_SALES_FAULTS})""")
def quality_summary(spark, sf_dir):
    """All checks of the full profile, totalled."""
    return quality.summary(quality.validate(
        spark, shop.folder(spark, sf_dir, "sales"), shop.shared_catalog(spark, strict=True), "full", V23))


@query(f"SELECT class_name, count(*) AS message_count FROM ({_SALES_FAULTS}) GROUP BY class_name")
def quality_per_class(spark, sf_dir):
    return quality.counts_per_class(quality.validate(
        spark, shop.folder(spark, sf_dir, "sales"), shop.shared_catalog(spark, strict=True), "full", V23))


# ------------------------------------------------------------------ geometry

def _shapes(spark, sf_dir, *columns: str, dialect: str = V23, form: str = "nested", errors: str = "error"):
    folder = "tracks" if dialect == V23 else "tracks24"
    return _scan(spark, sf_dir, folder, TRACK, ["_tid", *columns], dialect, geometry=form, geometry_errors=errors)


def _ord(i: int) -> str:
    return f"CAST(embedding[{i}] AS DOUBLE)"


_TRACK_POINTS = f"""
    SELECT 't' || vec_id AS tid, CAST(len(embedding) // 2 AS INTEGER) AS n, {_ord(1)} AS x, {_ord(2)} AS y
    FROM embeddings"""


@query(_TRACK_POINTS)
def geometry_points(spark, sf_dir):
    path = F.col("Path")
    return _shapes(spark, sf_dir, "Path").select(
        F.col("_tid").alias("tid"), geo.num_points(path).alias("n"), geo.x(path).alias("x"), geo.y(path).alias("y"))


@query(_TRACK_POINTS)
def geometry_points_v24(spark, sf_dir):
    """The same tracks in the second dialect."""
    path = F.col("Path")
    return _shapes(spark, sf_dir, "Path", dialect=V24).select(
        F.col("_tid").alias("tid"), geo.num_points(path).alias("n"), geo.x(path).alias("x"), geo.y(path).alias("y"))


@query("""
    SELECT 't' || vec_id AS tid, round(list_sum(list_transform(range(1, len(embedding) // 2), lambda i: sqrt(
        pow(CAST(embedding[2*i+1] AS DOUBLE) - CAST(embedding[2*i-1] AS DOUBLE), 2)
        + pow(CAST(embedding[2*i+2] AS DOUBLE) - CAST(embedding[2*i] AS DOUBLE), 2)))), 6) AS length
    FROM embeddings""")
def geometry_length(spark, sf_dir):
    return _shapes(spark, sf_dir, "Path").select(
        F.col("_tid").alias("tid"), F.round(geo.length(F.col("Path")), 6).alias("length"))


@query(f"""
    SELECT 't' || vec_id AS tid, round(pow(2 * ({_ord(3)} + 10), 2) - 4, 6) AS area, CAST(1 AS INTEGER) AS holes,
           CAST(1 AS INTEGER) AS parts
    FROM embeddings""")
def geometry_area(spark, sf_dir):
    zone = F.col("Zone")
    return _shapes(spark, sf_dir, "Zone").select(
        F.col("_tid").alias("tid"), F.round(geo.area(zone), 6).alias("area"),
        geo.num_interior_rings(zone).alias("holes"), geo.num_geometries(zone).alias("parts"))


@query(f"""
    SELECT 't' || vec_id AS tid, {_ord(3)} AS z, true AS has_z,
           round({_ord(1)} - ({_ord(3)} + 10), 6) AS min_x, round({_ord(2)} + ({_ord(3)} + 10), 6) AS max_y
    FROM embeddings""")
def geometry_bbox_z(spark, sf_dir):
    peak, zone = F.col("Peak"), geo.bounds(F.col("Zone"))
    return _shapes(spark, sf_dir, "Peak", "Zone").select(
        F.col("_tid").alias("tid"), geo.z(peak).alias("z"), geo.has_z(peak).alias("has_z"),
        F.round(zone["min_x"], 6).alias("min_x"), F.round(zone["max_y"], 6).alias("max_y"))


@query(f"""
    SELECT 't' || vec_id AS tid, round(sqrt(pow({_ord(1)} - 5, 2) + pow({_ord(2)} - 5, 2)), 6) AS peak_distance,
           round(least(
               sqrt(pow({_ord(1)} - 5, 2) + pow({_ord(2)} - 5, 2)),
               sqrt(pow({_ord(3)} - 5, 2) + pow({_ord(4)} - 5, 2)),
               sqrt(pow({_ord(5)} - 5, 2) + pow({_ord(6)} - 5, 2))), 6) AS spots_distance,
           round(100 - ({_ord(1)} + {_ord(3)} + 10), 6) AS zone_distance
    FROM embeddings""")
def geometry_distance(spark, sf_dir):
    five = F.lit(5.0)
    return _shapes(spark, sf_dir, "Peak", "Spots", "Zone").select(
        F.col("_tid").alias("tid"),
        F.round(geo.distance_to_point(F.col("Peak"), five, five), 6).alias("peak_distance"),
        F.round(geo.distance_to_point(F.col("Spots"), five, five), 6).alias("spots_distance"),
        F.round(geo.distance_to_point(F.col("Zone"), F.lit(100.0), F.lit(0.0), True), 6).alias("zone_distance"))


@query("""
    SELECT 't' || vec_id AS tid, label = 0 AS is_null,
           CASE WHEN label = 0 THEN 'POLYLINE requires at least two coordinates' END AS error,
           CAST(CASE WHEN label > 0 THEN least(label + 1, len(embedding) // 2) END AS INTEGER) AS n
    FROM embeddings""")
def geometry_error_policy(spark, sf_dir):
    """Lines of one point become NULL, with the reason in the residual JSON."""
    rows = _shapes(spark, sf_dir, "Stub", "_unsupported_json", errors="null")
    return rows.select(
        F.col("_tid").alias("tid"), F.col("Stub").isNull().alias("is_null"),
        F.get_json_object("_unsupported_json", "$.Stub[0]._error").alias("error"),
        F.when(F.col("Stub").isNotNull(), geo.num_points(F.col("Stub"))).alias("n"))


_BOW = f"""
    SELECT vec_id, 1 + abs({_ord(3)}) AS r, ceil(pi() / (2 * acos(1 - 0.1 / (1 + abs({_ord(3)}))))) AS steps
    FROM embeddings"""


@query(f"""
    SELECT 't' || vec_id AS tid, CAST(steps + 1 AS INTEGER) AS n,
           round(steps * 2 * r * sin(pi() / (2 * steps)), 6) AS length
    FROM ({_BOW})""")
def geometry_arc_stroke(spark, sf_dir):
    """Half circles as lines, by the default tolerance."""
    bow = F.col("Bow")
    return _shapes(spark, sf_dir, "Bow").select(
        F.col("_tid").alias("tid"), geo.num_points(bow).alias("n"), F.round(geo.length(bow), 6).alias("length"))


@query("SELECT 't' || vec_id AS tid, label <> 0 AS valid, true AS zone_valid FROM embeddings")
def geometry_validity(spark, sf_dir):
    return _shapes(spark, sf_dir, "Knot", "Zone").select(
        F.col("_tid").alias("tid"), geo.is_valid(F.col("Knot"), "SURFACE").alias("valid"),
        geo.is_valid(F.col("Zone"), "SURFACE").alias("zone_valid"))


@query("""
    SELECT 't' || vec_id AS tid, '01E9030000' AS peak_head, '010200000020000000' AS path_head,
           CAST(5 + 24 AS INTEGER) AS peak_bytes, CAST(9 + 16 * (len(embedding) // 2) AS INTEGER) AS path_bytes,
           CAST(9 + 2 * (4 + 5 * 16) AS INTEGER) AS zone_bytes
    FROM embeddings""")
def geometry_wkb(spark, sf_dir):
    rows = _shapes(spark, sf_dir, "Peak", "Path", "Zone", form="wkb")
    return rows.select(
        F.col("_tid").alias("tid"), F.left(F.hex("Peak"), F.lit(10)).alias("peak_head"),
        F.left(F.hex("Path"), F.lit(18)).alias("path_head"), F.length("Peak").alias("peak_bytes"),
        F.length("Path").alias("path_bytes"), F.length("Zone").alias("zone_bytes"))


@query(f"""
    SELECT 't' || vec_id AS tid, 'path' AS shape, CAST(i AS INTEGER) AS i, CAST(embedding[2 * i + 1] AS DOUBLE) AS x,
           CAST(embedding[2 * i + 2] AS DOUBLE) AS y, CAST(NULL AS DOUBLE) AS z
    FROM embeddings, LATERAL (SELECT unnest(generate_series(0, len(embedding) // 2 - 1)) AS i)
    UNION ALL
    SELECT 't' || vec_id, 'peak', 0, {_ord(1)}, {_ord(2)}, {_ord(3)} FROM embeddings""")
def geometry_wkb_read(spark, sf_dir):
    """Every ordinate of binary lines and points, read back from the bytes."""
    rows = _shapes(spark, sf_dir, "Peak", "Path", form="wkb")

    def points(name: str, column: str):
        line = F.get(F.get(wkb.from_wkb(F.col(column)), F.lit(0)), F.lit(0))
        return rows.select(F.col("_tid").alias("tid"), F.lit(name).alias("shape"), F.posexplode(line).alias("i", "p")).select(
            "tid", "shape", "i", "p.x", "p.y", "p.z")

    return points("path", "Path").unionByName(points("peak", "Peak"))


@query("""
    SELECT 't' || vec_id AS tid, CASE WHEN label = 0 THEN 'ring touches itself' END AS within,
           CASE WHEN label = 0 THEN 'ring touches itself' ELSE 'inner ring is not inside the outer one' END AS around,
           CASE WHEN label = 0 THEN 'ring touches itself' ELSE 'parts overlap' END AS beside
    FROM embeddings""")
def geometry_nesting(spark, sf_dir):
    """The outer rings of two surfaces as hole, as shell and as two parts of one geometry; the first rule that breaks."""
    outer = lambda name: F.get(F.get(F.col(name), F.lit(0)), F.lit(0))
    zone, knot = outer("Zone"), outer("Knot")
    return _shapes(spark, sf_dir, "Knot", "Zone").select(
        F.col("_tid").alias("tid"), rings.why_invalid(F.array(F.array(zone, knot))).alias("within"),
        rings.why_invalid(F.array(F.array(knot, zone))).alias("around"),
        rings.why_invalid(F.array(F.array(zone), F.array(knot))).alias("beside"))


@query(f"""
    SELECT 't' || vec_id AS tid, 'POINT Z' AS shape, round({_ord(1)}, 9) AS x, round({_ord(2)}, 9) AS y,
           round({_ord(3)}, 9) AS z
    FROM embeddings""")
def geometry_text(spark, sf_dir):
    """Well-known text, taken apart again."""
    number = r"(-?[0-9.E-]+)"
    pattern = rf"^(POINT Z) \({number} {number} {number}\)$"
    part = lambda i: F.regexp_extract("Peak", pattern, i)
    return _shapes(spark, sf_dir, "Peak", form="wkt").select(
        F.col("_tid").alias("tid"), part(1).alias("shape"), F.round(part(2).cast("double"), 9).alias("x"),
        F.round(part(3).cast("double"), 9).alias("y"), F.round(part(4).cast("double"), 9).alias("z"))
