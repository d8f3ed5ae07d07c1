"""A shop model, and the driver tables rendered as transfers of that model.

Every object comes from one table row, so rendering needs no shuffle and a key
that holds most of the rows changes nothing.  Basket ids come from a column of
the row; a basket may hold most of a table and is then written as many parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.plans.catalog import Catalog, ClassInfo
from basketlens.sources.objects import V23, V24
from basketlens.sources.session import fresh_path
from basketlens.sources.writer import ObjectWriter, Structure, basket_tag, header_text, write_grouped, write_transfer

SMALL_FILE_BYTES = 4 * 1024 * 1024
LARGE_FILE_BYTES = 16 * 1024 * 1024
LARGE_FILE_ROWS = 1_000_000

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FLAGS = ["A", "N", "R"]

CUSTOMER, ORDER, PLACED = "Shop.Sales.Customer", "Shop.Sales.Order", "Shop.Sales.Placed"
LINE, TRACK = "Shop.Stock.Line", "Shop.Tracks.Track"


def _class(topic: str, name: str, kind: str, seq: int, abstract: bool = False, base: str | None = None):
    return ("Shop", topic, name, ".".join(x for x in ("Shop", topic, name) if x), kind, abstract, base, seq)


def _prop(owner, name, seq, value_kind, role=False, low=0, high=1, target=None, bounds=(None, None), enum=None,
          max_len=None):
    return (owner, name, "ROLE" if role else "ATTRIBUTE", value_kind, f"{value_kind}Type", low > 0, low, high, False,
            False, target, *bounds, max_len, enum, seq)


def _geometry(name, kind, dimension=2, forms=("STRAIGHTS",)):
    return (TRACK, name, kind, f"Shop.Coord{dimension}", dimension, None, list(forms), False, False)


def shop_catalog(spark: SparkSession, strict: bool = False) -> Catalog:
    """The model; ``strict`` narrows it so that part of the data violates it."""
    classes = [
        _class("", "Charge", "STRUCTURE", 1),
        _class("", "Terms", "STRUCTURE", 2),
        _class("Sales", "Party", "CLASS", 3, abstract=True),
        _class("Sales", "Customer", "CLASS", 4, base="Shop.Sales.Party"),
        _class("Sales", "Order", "CLASS", 5),
        _class("Sales", "Placed", "ASSOCIATION", 6),
        _class("Stock", "Line", "CLASS", 7),
        _class("Tracks", "Track", "CLASS", 8),
    ]
    segments = [s for s in SEGMENTS if not (strict and s == "MACHINERY")]
    properties = [
        _prop("Shop.Charge", "Kind", 1, "Enumeration", low=1, enum=["base", "discount", "tax"]),
        _prop("Shop.Charge", "Amount", 2, "Double"),
        _prop("Shop.Terms", "Priority", 1, "Integer" if strict else "String"),
        _prop("Shop.Terms", "Placed", 2, "DateTime"),
        _prop("Shop.Sales.Party", "Name", 1, "String", low=1, max_len=25),
        _prop(CUSTOMER, "Segment", 1, "Enumeration", enum=segments),
        _prop(CUSTOMER, "Balance", 2, "Double", bounds=(0.0 if strict else None, None)),
        _prop(CUSTOMER, "Nation", 3, "Integer"),
        _prop(ORDER, "Status", 1, "String", max_len=1),
        _prop(ORDER, "Price", 2, "Double"),
        _prop(ORDER, "Placed", 3, "DateTime"),
        _prop(ORDER, "Terms", 4, "Structure", target="Shop.Terms"),
        _prop(ORDER, "customer", 5, "Reference", role=True, low=1, target=CUSTOMER),
        _prop(PLACED, "Share", 1, "Integer", bounds=(0.0, 100.0)),
        _prop(PLACED, "customer", 2, "Reference", role=True, low=1, target=CUSTOMER),
        _prop(PLACED, "order", 3, "Reference", role=True, low=1, target=ORDER),
        _prop(LINE, "Number", 1, "Integer", bounds=(1.0, 7.0)),
        _prop(LINE, "Quantity", 2, "Double"),
        _prop(LINE, "Price", 3, "Double"),
        _prop(LINE, "Flag", 4, "Enumeration", enum=FLAGS),
        _prop(LINE, "Shipped", 5, "Date"),
        _prop(LINE, "Discount", 6, "Double", low=1 if strict else 0),
        _prop(LINE, "Charges", 7, "Structure", high=2 if strict else None, target="Shop.Charge"),
        _prop(LINE, "order", 8, "Reference", role=True, low=1, target=ORDER),
        _prop(LINE, "next", 9, "Reference", role=True, target=LINE),
        _prop(TRACK, "Label", 1, "Integer"),
        _prop(TRACK, "Path", 2, "Geometry"),
        _prop(TRACK, "Peak", 3, "Geometry"),
        _prop(TRACK, "Zone", 4, "Geometry"),
        _prop(TRACK, "Spots", 5, "Geometry"),
        _prop(TRACK, "Stub", 6, "Geometry"),
        _prop(TRACK, "Bow", 7, "Geometry"),
        _prop(TRACK, "Knot", 8, "Geometry"),
    ]
    geometry = [
        _geometry("Path", "POLYLINE"),
        _geometry("Peak", "COORD", 3),
        _geometry("Zone", "SURFACE"),
        _geometry("Spots", "MULTICOORD"),
        _geometry("Stub", "POLYLINE"),
        _geometry("Bow", "POLYLINE", forms=("STRAIGHTS", "ARCS")),
        _geometry("Knot", "SURFACE"),
    ]
    models = [("Shop", "1", "urn:shop", "en", "2.3", 1)]
    return Catalog.from_rows(
        spark, models, classes, properties, geometry, crs_map="Shop.Coord2=EPSG:2056;Shop.Coord3=EPSG:2056")


CHAIN, LINK, DEPTH = "Shop.Deep.Chain", "Shop.Link", 7


def deep_catalog(spark: SparkSession) -> Catalog:
    """A class whose structure holds itself; `chains` nests it ``DEPTH`` levels deep."""
    classes = [
        _class("", "Mark", "STRUCTURE", 1), _class("", "Link", "STRUCTURE", 2), _class("Deep", "Chain", "CLASS", 3)]
    properties = [
        _prop("Shop.Mark", "Text", 1, "String", low=1),
        _prop(LINK, "Label", 1, "String", low=1, max_len=40),
        _prop(LINK, "Balance", 2, "Double", bounds=(0.0, None)),
        _prop(LINK, "Marks", 3, "Structure", high=2, target="Shop.Mark"),
        _prop(LINK, "Next", 4, "Structure", target=LINK),
        _prop(LINK, "peer", 5, "Reference", role=True, target=CHAIN),
        _prop(CHAIN, "Root", 1, "Structure", low=1, target=LINK),
        _prop(CHAIN, "Segment", 2, "String"),
    ]
    return Catalog.from_rows(spark, [("Shop", "1", "urn:shop", "en", "2.3", 1)], classes, properties, [])


SAMPLE = "Shop.Scalars.Sample"


def scalar_catalog(spark: SparkSession, **kinds: str) -> Catalog:
    """A class with values of every scalar kind; ``kinds`` replaces some of them."""
    known = {"Flag": "Boolean", "At": "Time", "Amount": "Decimal", "Note": "String", "Twice": "String", "Line": "Geometry"} | kinds
    properties = [_prop(SAMPLE, n, i, k) for i, (n, k) in enumerate(known.items(), 1) if n != "Twice" or kinds.get("Twice")]
    properties = [(*p[:4], "decimal(15,2)", *p[5:]) if p[3] == "Decimal" else p for p in properties]
    line = (SAMPLE, "Line", "POLYLINE", "Shop.Coord2", 2, None, ["STRAIGHTS"], False, False)
    return Catalog.from_rows(
        spark, [("Shop", "1", "urn:shop", "en", "2.3", 1)], [_class("Scalars", "Sample", "CLASS", 1)], properties, [line])


# ------------------------------------------------------------------ rendering

def _texts(*values: Column) -> list[Column]:
    """Canonical scalar values, or targets of references; NULL means that the value is missing."""
    return [v.cast("string") for v in values]


def _tid(letter: str, *keys: str) -> Column:
    return F.concat(F.lit(letter), F.concat_ws("-", *[F.col(k).cast("string") for k in keys]))


def _bid(letter: str, value: Column) -> Column:
    return F.concat(F.lit(letter), F.coalesce(value.cast("string"), F.lit("none")))


def datetime_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def customers(df: DataFrame) -> dict:
    return dict(
        info=CUSTOMER, tid=_tid("c", "c_custkey"), bid=_bid("N", F.col("c_nationkey")),
        values={"Name": _texts(F.col("c_name")), "Segment": _texts(F.col("c_mktsegment")),
                "Balance": _texts(F.col("c_acctbal")), "Nation": _texts(F.col("c_nationkey"))}, rows=df)


def orders(df: DataFrame) -> dict:
    terms = [Structure("Shop.Terms", {
        "Priority": _texts(F.col("o_orderpriority")), "Placed": _texts(datetime_text(F.col("o_orderdate")))})]
    operation = F.when(F.col("o_orderstatus") == "F", "DELETE").when(F.col("o_orderstatus") == "P", "UPDATE")
    return dict(
        info=ORDER, tid=_tid("o", "o_orderkey"), bid=_bid("Y", F.year("o_orderdate")), operation=operation,
        values={"Status": _texts(F.col("o_orderstatus")), "Price": _texts(F.col("o_totalprice")),
                "Placed": _texts(datetime_text(F.col("o_orderdate"))), "Terms": terms,
                "customer": _texts(_tid("c", "o_custkey"))}, rows=df)


def placed(df: DataFrame) -> dict:
    share = F.when(F.col("o_orderpriority").startswith("1"), 100).otherwise(50)
    return dict(
        info=PLACED, tid=F.lit(None).cast("string"), bid=_bid("P", F.col("o_orderstatus")),
        values={"Share": _texts(share), "customer": _texts(_tid("c", "o_custkey")),
                "order": _texts(_tid("o", "o_orderkey"))}, rows=df)


def lines(df: DataFrame) -> dict:
    def charge(kind: str, amount: Column, present: Column | None = None) -> Structure:
        return Structure("Shop.Charge", {"Kind": _texts(F.lit(kind)), "Amount": _texts(amount)}, present)

    charges = [charge("base", F.col("l_extendedprice")),
               charge("discount", F.col("l_discount"), F.col("l_discount") > 0),
               charge("tax", F.col("l_tax"), F.col("l_tax") > 0)]
    following = F.concat(F.lit("l"), F.col("l_orderkey").cast("string"), F.lit("-"),
                         (F.col("l_linenumber") + 1).cast("string"))
    return dict(
        info=LINE, tid=_tid("l", "l_orderkey", "l_linenumber"), bid=_bid("F", F.col("l_returnflag")),
        values={"Number": _texts(F.col("l_linenumber")), "Quantity": _texts(F.col("l_quantity")),
                "Price": _texts(F.col("l_extendedprice")), "Flag": _texts(F.col("l_returnflag")),
                "Shipped": _texts(F.date_format("l_shipdate", "yyyy-MM-dd")),
                "Discount": _texts(F.when(F.col("l_discount") > 0, F.col("l_discount"))), "Charges": charges,
                "order": _texts(_tid("o", "l_orderkey")), "next": _texts(following)}, rows=df)


def tracks(df: DataFrame, dialect: str = V23) -> dict:
    def tag(name: str) -> tuple[str, str]:
        shown = name if dialect == V23 else f"geom:{name.lower()}"
        return f"<{shown}>", f"</{shown}>"

    def wrap(name: str, *body: Column) -> Column:
        start, end = tag(name)
        return F.concat(F.lit(start), *body, F.lit(end))

    def ordinates(**values: Column) -> Column:
        return F.concat(*[wrap(n, v.cast("string")) for n, v in values.items()])

    def coord(x: Column, y: Column, z: Column | None = None) -> Column:
        return wrap("COORD", ordinates(C1=x, C2=y, **({} if z is None else {"C3": z})))

    e = F.transform("embedding", lambda v: v.cast("double"))
    v = lambda i: F.get(e, F.lit(i))

    def path(count: Column) -> Column:
        return F.array_join(F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: coord(F.get(e, 2 * i), F.get(e, 2 * i + 1))), "")

    def square(x: Column, y: Column, half: Column) -> Column:
        corners = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
        return wrap("POLYLINE", *[coord(x + half * dx, y + half * dy) for dx, dy in corners])

    points = F.floor(F.size("embedding") / 2).cast("int")
    outer, inner = ("BOUNDARY", "BOUNDARY") if dialect == V23 else ("EXTERIOR", "INTERIOR")
    zone = wrap("SURFACE", wrap(outer, square(v(0), v(1), v(2) + 10)),
                wrap(inner, square(v(0), v(1), F.lit(1.0))))
    # A bow-tie for label 0, a square for the others.
    knot_points = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    tied = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
    ring = lambda shape: wrap("POLYLINE", *[coord(v(0) + dx, v(1) + dy) for dx, dy in shape])
    knot = wrap("SURFACE", wrap(outer, F.when(F.col("label") == 0, ring(tied)).otherwise(ring(knot_points))))
    radius = 1 + F.abs(v(2))
    bow = wrap("POLYLINE", coord(v(0), v(1)), wrap("ARC", ordinates(
        C1=v(0) + 2 * radius, C2=v(1), A1=v(0) + radius, A2=v(1) + radius)))
    stub = F.least(F.col("label") + 1, points)
    return dict(
        info=TRACK, tid=_tid("t", "vec_id"), bid=_bid("L", F.col("label")),
        values={"Label": _texts(F.col("label")), "Path": _texts(wrap("POLYLINE", path(points))),
                "Peak": _texts(coord(v(0), v(1), v(2))), "Zone": _texts(zone),
                "Spots": _texts(wrap("MULTICOORD", coord(v(0), v(1)), coord(v(2), v(3)), coord(v(4), v(5)))),
                "Stub": _texts(wrap("POLYLINE", path(stub))), "Bow": _texts(bow), "Knot": _texts(knot)}, rows=df)


def chains(df: DataFrame) -> DataFrame:
    """(basket_tag, raw) of a chain of links per customer; the last one has all the properties."""
    def element(name: str, *body: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), *body, F.lit(f"</{name}>"))

    marks = F.array_join(F.transform(
        F.sequence(F.lit(1), F.pmod("c_custkey", F.lit(3)) + 1),
        lambda i: element("Marks", element("Shop.Mark", element("Text", F.concat(F.lit("m &amp; "), i.cast("string")))))), "")
    peer = F.concat(F.lit('<peer REF="d'), (F.col("c_custkey") + 1).cast("string"), F.lit('" BID="N'),
                    F.col("c_nationkey").cast("string"), F.lit('"/>'))
    inner = F.concat(element("Balance", F.col("c_acctbal").cast("string")), marks, peer)
    for level in range(DEPTH, 0, -1):
        label = element("Label", F.concat("c_name", F.lit(f"-{level}")))
        inner = element(LINK, label, inner)
        inner = element("Root" if level == 1 else "Next", inner)
    raw = F.concat(F.lit(f'<{CHAIN} TID="d'), F.col("c_custkey").cast("string"), F.lit('">'), inner,
                   element("Segment", F.col("c_mktsegment")), F.lit(f"</{CHAIN}>"))
    return df.select(basket_tag(V23, "Shop.Deep", _bid("N", F.col("c_nationkey"))).alias("basket_tag"), raw.alias("raw"))


def samples(df: DataFrame) -> DataFrame:
    """(basket_tag, raw) of an object per order: missing and empty values, unknown elements, a line form that is not known."""
    key = F.col("o_orderkey")

    def element(name: str, body: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), body, F.lit(f"</{name}>"))

    note = F.when(F.startswith("o_orderpriority", F.lit("1")), "").otherwise(
        F.when(F.startswith("o_orderpriority", F.lit("2")), "<Note/>").otherwise(element("Note", F.col("o_orderpriority"))))
    extra = element("Extra", F.concat(F.lit("e"), F.col("o_custkey").cast("string")))
    line = F.when(key % 2 == 0, "<POLYLINE><SPLINE/></POLYLINE>").otherwise(
        "<POLYLINE><COORD><C1>0</C1><C2>0</C2></COORD><COORD><C1>1</C1><C2>2</C2></COORD></POLYLINE>")
    raw = F.concat(
        F.lit(f'<{SAMPLE} TID="o'), key.cast("string"), F.lit('">'), element("Flag", (F.col("o_orderstatus") == "F").cast("string")),
        element("At", F.format_string("%02d:%02d:30", key % 24, key % 60)),
        element("Amount", F.col("o_totalprice").cast("decimal(15,2)").cast("string")), note,
        element("Twice", F.lit("1")), element("Twice", F.lit("2")), extra, element("Box", extra), element("Line", line),
        F.lit(f"</{SAMPLE}>"))
    return df.select(basket_tag(V23, "Shop.Scalars", _bid("Y", F.year("o_orderdate"))).alias("basket_tag"), raw.alias("raw"))


def rendered(source: dict, catalog: Catalog, dialect: str) -> DataFrame:
    """(basket_tag, raw) of a table described by one of the functions above."""
    info: ClassInfo = catalog.model.classes[source["info"]]
    writer = ObjectWriter(catalog.model, info, dialect)
    operation = source.get("operation", F.lit(None).cast("string"))
    return source["rows"].select(
        basket_tag(dialect, f"{info.model}.{info.topic}", source["bid"]).alias("basket_tag"),
        writer.object(source["values"], source["tid"], operation).alias("raw"))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for an input of few splits; larger inputs keep their splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_objects(rows: DataFrame, path: str, dialect: str = V23) -> None:
    """Write (basket_tag, raw) rows as compressed transfer files, each with its objects basket by basket.

    A file is read by one task, so a small input gets small files to keep all
    cores busy and a large one gets larger files.
    """
    few_splits = rows.rdd.getNumPartitions() <= 4 * rows.sparkSession.sparkContext.defaultParallelism
    target = SMALL_FILE_BYTES if few_splits else LARGE_FILE_BYTES
    write_grouped(rows, path, header_text(dialect, ["Shop"]), target, "gzip")


def write_large_files(source: dict, path: str, catalog: Catalog, dialect: str) -> None:
    """Write a table as plain files that are too large for a task to read whole, but not for one to write.

    Two files at least; rows are dealt out and put in order of baskets before they become text.
    """
    files = max(2, -(-source["rows"].count() // LARGE_FILE_ROWS))
    rows = source["rows"].repartition(files).sortWithinPartitions(source["bid"])
    framed = rendered(source | {"rows": rows}, catalog, dialect).select(
        F.lit(None).cast("string").alias("header"), F.lit(0).alias("basket_no"), "basket_tag", "raw")
    write_transfer(framed, path, header_text(dialect, ["Shop"]), target_bytes=None)


#: Topics that are rendered, and their dialect; ``mixed`` has orders in either one, ``stock1`` large files.
FOLDERS = {"sales": V23, "sales24": V24, "mixed": None, "deep": V23, "scalars": V23, "stock": V23, "stock1": V23, "tracks": V23, "tracks24": V24}
_RENDERED: dict[tuple[str, str, str], str] = {}


def folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a rendered topic, written once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _RENDERED:
        catalog = shared_catalog(spark)
        path = fresh_path(spark, f"shop-{name}")
        table = lambda t: spread(spark.read.parquet(f"{sf_dir}/{t}.parquet"))
        dialect = FOLDERS[name]
        if name in ("sales", "sales24"):
            parts = [(p, dialect) for p in (customers(table("customer")), orders(table("orders")), placed(table("orders")))]
        elif name == "mixed":
            parts = [(orders(table("orders").filter(F.col("o_custkey") % 2 == i)), d) for i, d in enumerate((V23, V24))]
        elif name in ("stock", "stock1"):
            parts = [(lines(table("lineitem")), dialect)]
        elif name in ("deep", "scalars"):
            write_objects(chains(table("customer")) if name == "deep" else samples(table("orders")), f"{path}/part0")
            parts = []
        else:
            parts = [(tracks(table("embeddings"), dialect), dialect)]
        # One write per class: a union of them would be one job too, but the
        # files of a class then could not be told by their order.
        for i, (p, d) in enumerate(parts):
            if name == "stock1":
                write_large_files(p, f"{path}/part{i}", catalog, d)
            else:
                write_objects(rendered(p, catalog, d), f"{path}/part{i}", d)
        _RENDERED[key] = f"{path}/*"
    return _RENDERED[key]


_CATALOGS: dict[tuple[str, bool], Catalog] = {}


def shared_catalog(spark: SparkSession, strict: bool = False) -> Catalog:
    key = (spark.sparkContext.applicationId, strict)
    if key not in _CATALOGS:
        _CATALOGS[key] = shop_catalog(spark, strict)
    return _CATALOGS[key]
