import datetime
import json

import pytest
from pyspark.sql import functions as F

import small_inputs as si
from basketlens import Catalog, TransferError
from basketlens.operators import importer, introspect, quality, scan, values
from basketlens.streaming import ingest as streaming

HOUSE, OWNS, OWNER = "Town.Plan.House", "Town.Plan.Owns", "Town.Plan.Owner"


def house(body, tid="h"):
    return si.v23(si.plan("b", si.obj("House", tid, body)))


# ---------------------------------------------------------------- typed scan

def test_typed_scan(spark, town, write):
    df = scan.scan_class(spark, write(a=si.TOWN), HOUSE, town, geometry="wkt").orderBy("_tid")
    assert df.columns == ["_bid", "_tid", "_class", "_operation", "Name", "State", "Point", "Built", "Height",
                          "Line", "Floors", "Heated", "holder", "_unsupported_json"]
    assert dict(df.dtypes)["Floors"] == "bigint" and dict(df.dtypes)["Height"] == "double"
    one, two, three = df.collect()
    assert tuple(one)[:13] == ("b1", "h1", HOUSE, "INSERT", "mill & barn", "built", "POINT (612.5 88.25)",
                               "2020-02-29", 11.75, "LINESTRING (612.5 88.25, 615 91, 619.5 90.75)", 3, False, "o1")
    assert json.loads(one._unsupported_json) == {
        "Place": [{"_tag": "Town.Address", "_attrs": {"Street": ["Lane <1>"], "Zip": ["4500"]}}],
        "Labels": [{"_tag": "Town.Label", "_attrs": {"Text": ["north gate"]}},
                   {"_tag": "Town.Label", "_attrs": {"Text": ["listed"]}}]}
    assert two.Name == "" and two.Height is None
    assert three._operation == "DELETE" and three.Name is None and three._unsupported_json == "{}"


def test_same_class_name_in_two_topics(spark, town, write):
    path = write(a=si.TOWN)
    assert [r._tid for r in scan.scan_class(spark, path, "Town.Notes.Owner", town).collect()] == ["o1"]
    assert scan.scan_class(spark, path, OWNER, town).count() == 2
    path = write(a=si.TOWN24)
    assert [r.Name for r in scan.scan_class(spark, path, OWNER, town).collect()] == ["Cy"]


def test_pruned_columns_do_not_parse_the_rest(spark, town, write):
    df = scan.scan_class(spark, write(a=si.TOWN), HOUSE, town, columns=["_tid", "Floors"])
    assert df.columns == ["_tid", "Floors"]
    assert "Height" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("body, message", [
    ("<Heated>1</Heated>", "invalid boolean lexical value '1'"),
    ("<Floors> 12</Floors>", "invalid integer lexical value ' 12'"),
    ("<Floors>+1</Floors>", "invalid integer"),
    ("<Floors>99999999999999999999</Floors>", "invalid integer"),
    ("<Height>1,5</Height>", "invalid double"),
    ("<Floors>12\n</Floors>", "invalid integer"),
    ("<Height>1.5\n</Height>", "invalid double"),
    ("<Name>a</Name><Name>b</Name>", "expected one value but found 2"),
])
def test_bad_values_fail_with_their_place(spark, town, write, body, message):
    with pytest.raises(Exception) as error:
        scan.scan_class(spark, write(a=house(body)), HOUSE, town).collect()
    assert message in str(error.value) and "TID=h" in str(error.value) and "BID=b" in str(error.value)


def test_unknown_properties_reach_the_residual(spark, town, write):
    path = write(a=house("<Name>n</Name><Extra>007</Extra><More><X>1</X></More>"))
    residual = json.loads(scan.scan_class(spark, path, HOUSE, town).first()._unsupported_json)
    assert residual == {"Extra": ["007"], "More": ["<X>1</X>"]}


def test_reference_into_another_basket(spark, town, write):
    row = scan.scan_class(spark, write(a=house('<holder REF="o" BID="far"/>')), HOUSE, town).first()
    assert row.holder is None
    assert json.loads(row._unsupported_json)["holder"][0]["bid"] == "far"


def test_class_name_checks(spark, town, write):
    path = write(a=si.TOWN)
    for name in ("", "House", "Plan.House", "Town.Plan.Nothing"):
        with pytest.raises(TransferError):
            scan.scan_class(spark, path, name, town)
    for options in ({"geometry_errors": "skip"}, {"arc_tolerance_override": 0}, {"columns": ["Nope"]}):
        with pytest.raises(TransferError):
            scan.scan_class(spark, path, HOUSE, town, **options)


def test_reserved_and_keyword_names(spark, write):
    def catalog(*names):
        return Catalog.from_rows(
            spark, [("M", "1", None, None, "2.3", 1)], [("M", "T", "C", "M.T.C", "CLASS", False, None, 1)],
            [si.prop("M.T.C", n, i) for i, n in enumerate(names)])

    text = ('<TRANSFER><DATASECTION><M.T BID="b"><M.T.C TID="1"><select>s</select><limit>l</limit><pos>p</pos></M.T.C>'
            "</M.T></DATASECTION></TRANSFER>")
    row = scan.scan_class(spark, write(a=text), "M.T.C", catalog("select", "limit", "pos", "file")).first()
    assert (row["select"], row["limit"], row["pos"], row["file"]) == ("s", "l", "p", None)
    for names in (["_tid"], ["Name", "name"]):
        with pytest.raises(TransferError):
            scan.scan_class(spark, write(a=text), "M.T.C", catalog(*names))


def test_temporal_types(spark, town, write):
    path = write(a=house("<Built>2020-02-29</Built>"))
    assert scan.scan_class(spark, path, HOUSE, town, temporal=True).first().Built == datetime.date(2020, 2, 29)
    with pytest.raises(Exception, match="invalid date"):
        scan.scan_class(spark, write(a=house("<Built>2021-02-29</Built>")), HOUSE, town, temporal=True).collect()


# --------------------------------------------------------- values, bags, roles

@pytest.mark.parametrize("path, expected", [
    ("Name", [("h1", 1, "mill & barn"), ("h2", 1, "")]),
    ("Place.Street", [("h1", 1, "Lane <1>")]),
    ("Labels.Text", [("h1", 1, "north gate"), ("h2", 1, "a")]),
    ("Labels[2].Text", [("h1", 1, "listed")]),
    ("Labels[*].Text", [("h1", 1, "north gate"), ("h1", 2, "listed"), ("h2", 1, "a")]),
    ("Labels[9].Text", []),
    ("Unknown", []),
])
def test_path_values(spark, town, write, path, expected):
    rows = values.read_values(spark, write(a=si.TOWN), HOUSE, path, town).collect()
    assert sorted((r.tid, r.occurrence, r.value) for r in rows) == expected


def test_path_selection_and_errors(spark, town, write):
    path = write(a=si.TOWN)
    assert values.read_values(spark, path, HOUSE, "Name", town, tid="h1", bid="b1").count() == 1
    assert values.read_values(spark, path, HOUSE, "Name", town, tid="none").count() == 0
    assert values.read_values(spark, path, OWNS, "Share", town).count() == 0
    for bad in ("Place", "holder", "Line", "", "a..b", "Labels[0].Text", "a[x]"):
        with pytest.raises(TransferError):
            values.read_values(spark, path, HOUSE, bad, town)


def test_bags_and_structures(spark, town, write):
    path = write(a=si.TOWN)
    assert sorted((r.tid, r.n) for r in scan.bag_sizes(spark, path, HOUSE, "Labels", town).collect() if r.n) == [
        ("h1", 2), ("h2", 2)]
    rows = scan.bag_rows(spark, path, HOUSE, "Labels", town).collect()
    assert sorted((r.tid, r.pos, r.Text or "") for r in rows) == [("h1", 0, "north gate"), ("h1", 1, "listed"), ("h2", 0, "a"),
                                                                  ("h2", 1, "")]
    one_wrapper = write(a=house("<Labels><Town.Label><Text>p</Text></Town.Label><Town.Label><Text>q</Text></Town.Label>"
                                "</Labels>"), b=house("<Labels/>", "empty"), c=house("<Name>x</Name>", "none"))
    assert sorted((r.tid, r.n) for r in scan.bag_sizes(spark, one_wrapper, HOUSE, "Labels", town).collect()
                  if r.n is not None) == [("empty", 0), ("h", 2)]
    struct = scan.read_class(spark, path, HOUSE, town, nested="struct").filter("xtf_tid = 'h1'").first()
    assert struct.Place.Zip == "4500" and [x.Text for x in struct.Labels] == ["north gate", "listed"]
    text = scan.read_class(spark, path, HOUSE, town).filter("xtf_tid = 'h2'").first()
    assert text.Place_json is None and json.loads(text.Labels_json) == [{"Text": "a"}, {}]


def test_association_join(spark, town, write):
    path = write(a=si.TOWN)
    links = scan.read_association(spark, path, OWNS, town)
    assert links.columns == ["xtf_tid", "xtf_bid", "Share", "owner_ref", "house_ref"] or set(links.columns) == {
        "xtf_tid", "xtf_bid", "Share", "owner_ref", "house_ref"}
    owners = scan.scan_class(spark, path, OWNER, town, columns=["_tid", "Name"])
    joined = links.join(owners, links.owner_ref == owners._tid).groupBy("Name").agg(F.sum("Share").alias("s"))
    assert sorted(map(tuple, joined.collect())) == [("Ann", 60), ("Bo", 140)]
    with pytest.raises(TransferError):
        scan.read_association(spark, path, OWNER, town)


def test_all_objects(spark, town, write):
    rows = {(r.xtf_class_fqn, r.xtf_tid): r for r in scan.read_all_objects(spark, write(a=si.TOWN), town).collect()}
    assert len(rows) == 7
    assert json.loads(rows[(HOUSE, "h1")].attributes_json)["Floors"] == ["3"]
    assert json.loads(rows[(HOUSE, "h1")].refs_json)["holder"][0]["ref"] == "o1"
    assert "POLYLINE" in rows[(HOUSE, "h1")].geom_json


# ------------------------------------------------------------------- catalog

def test_catalog_queries(spark, town):
    assert [r.name for r in introspect.models(town).collect()] == ["Town"]
    kinds = {r.class_name: r.kind for r in introspect.classes(town, "Town").collect()}
    assert kinds["Owns"] == "ASSOCIATION" and kinds["Address"] == "STRUCTURE"
    for name in (HOUSE, "House", "Plan.House"):
        names = [r.property_name for r in introspect.properties(town, name).collect()]
        assert names[0] == "Name" and names[-1] == "holder" and len(names) == 11
    assert [r.property_name for r in introspect.properties(town, OWNS).collect()] == ["owner", "house", "Share"]
    ordered = introspect.transfer_order(town).collect()
    for info in town.model.classes.values():
        found = sorted((r.position, r.property_name) for r in ordered if r.class_fqn == info.fqn)
        assert [n for _, n in found] == [p.name for p in info.properties]
    assert [r.element for r in introspect.enumerations(town).collect()] == ["planned", "built"]
    curve = introspect.geometry_properties(town, "Shape").filter("property_name = 'Curve'").first()
    assert curve.has_arcs and curve.max_overlap == 0.001
    crs = {r.attribute_name: r for r in introspect.geometry_attributes(town, class_name="Shape").collect()}
    assert crs["Curve"].srid == 2056 and crs["Peak"].srid is None and crs["Faces"].is_multi_type
    parts = introspect.structures(town, HOUSE).filter("holder_property = 'Place'").collect()
    assert sorted(r.attribute_name for r in parts) == ["Street", "Zip"]
    assert {r.topic_name for r in introspect.topics(town).collect()} == {"Plan", "Notes"}
    assert introspect.roles(town, "House").count() == 1
    assert introspect.attributes(town, "Town", "Owns").count() == 1
    with pytest.raises(TransferError):
        introspect.parse_crs_map("Town.Coord2=2056")


def test_catalog_load(spark, town, tmp_path):
    town.save(str(tmp_path / "cat"))
    again = Catalog.load(spark, [str(tmp_path / "cat"), str(tmp_path / "cat") + "/"])
    assert again.model.classes.keys() == town.model.classes.keys()
    for bad in ([], [None], ["http://example.invalid/x"]):
        with pytest.raises(TransferError):
            Catalog.load(spark, bad)
    with pytest.raises(Exception):
        Catalog.load(spark, [str(tmp_path / "missing")]).model


# ------------------------------------------------------------------- quality

def test_quality_report(spark, town, write):
    bad = si.v23(si.plan(
        "b", si.obj("House", "h1", "<Floors>101</Floors><State>odd</State><Heated>x</Heated>"
                    "<Place><Town.Address><Zip>5</Zip></Town.Address></Place>"),
        si.obj("House", "h2", "<Name>a name that is long</Name><Point><COORD><C1>x</C1><C2>1</C2></COORD></Point>"),
        si.obj("House", "h2", "<Name>n</Name><Name>m</Name>"), si.obj("House", "gone", operation="DELETE"),
        si.obj("Owns", body='<owner REF="nobody"/><house REF="h1"/>')))
    path = write(a=bad)
    report = quality.validate(spark, path, town)
    assert tuple(report.columns) == quality.REPORT_COLUMNS
    found = sorted((r.code, r.xtf_tid or "", r.attribute_name or "") for r in report.collect())
    assert found == [
        ("DUPLICATE_TID", "h2", ""), ("ENUMERATION", "h1", "State"), ("GEOMETRY", "h2", "Point"),
        ("LENGTH", "h2", "Name"), ("MULTIPLICITY", "h1", "Name"), ("MULTIPLICITY", "h2", "Name"),
        ("RANGE", "h1", "Floors"), ("RANGE", "h1", "Place.Zip"), ("REFERENCE", "", "owner"), ("TYPE", "h1", "Heated")]
    total = quality.summary(report).first()
    assert (total.valid, total.error_count, total.info_count) == (False, 10, 0)
    assert quality.capped(report, 1).count() == 1
    assert quality.counts_per_class(report).first().class_name == HOUSE
    fast = quality.validate(spark, path, town, "fast")
    assert {r.code for r in fast.collect()} == {"MULTIPLICITY"}
    with pytest.raises(TransferError):
        quality.validate(spark, path, town, "strictest")
    assert quality.summary(quality.validate(spark, write(a=si.v23(si.plan("b", si.OWNERS))), town)).first().valid


# ----------------------------------------------------------- import and stream

def test_import_into_tables(spark, town, write, tmp_path):
    path = write(a=si.TOWN)
    out = importer.import_files(spark, path, town, str(tmp_path / "tables"))
    assert sorted(out) == ["notes__owner", "plan__house", "plan__owner", "plan__owns", "plan__shape"]
    houses = spark.read.parquet(out["plan__house"])
    assert houses.count() == 3 and dict(houses.dtypes)["floors"] == "bigint" and dict(houses.dtypes)["built"] == "date"
    assert houses.selectExpr("sum(floors + 1)").first()[0] == 21
    with pytest.raises(TransferError):
        importer.import_files(spark, path, town, str(tmp_path / "x"), mapping="polymorphic")
    with pytest.raises(TransferError):
        importer.import_transfer(spark, path, town, "s", mode="merge")


def test_import_modes(spark, town, write):
    path = write(a=si.v23(si.plan("b", si.OWNERS)))
    count = lambda: spark.table("town_import.plan__owner").count()
    assert "town_import.plan__owner" in importer.import_transfer(spark, path, town, "town_import")
    assert importer.import_transfer(spark, path, town, "town_import") == [] and count() == 2
    importer.import_transfer(spark, path, town, "town_import", mode="append")
    assert count() == 4
    importer.import_transfer(spark, path, town, "town_import", mode="replace")
    assert count() == 2


def test_stream_takes_each_file_once(spark, town, write, tmp_path):
    path = write(a=si.TOWN)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for expected in (9, 9, 18):
        if expected == 18:
            with open(f"{path}/late.xml", "w") as f:
                f.write(si.TOWN)
        streaming.ingest(spark, path, out, state, town, "2.3").awaitTermination()
        assert spark.read.parquet(out).count() == expected
