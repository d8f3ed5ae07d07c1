import hashlib
import math
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import small_inputs as si
from basketlens import TransferError
from basketlens.functions import geometry as geo
from basketlens.operators import edits as ed
from basketlens.operators import scan, values
from basketlens.plans import shop
from basketlens.sources.objects import read_objects
from basketlens.sources.parse import Parser
from basketlens.sources.writer import ObjectWriter

HOUSE, SHAPE, OWNER = "Town.Plan.House", "Town.Plan.Shape", "Town.Plan.Owner"


def coord(*ordinates):
    return "<COORD>" + "".join(f"<C{i + 1}>{o}</C{i + 1}>" for i, o in enumerate(ordinates)) + "</COORD>"


def line(*points):
    return "<POLYLINE>" + "".join(coord(*p) for p in points) + "</POLYLINE>"


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
BOWTIE = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]


def surface(*rings):
    return "<SURFACE>" + "".join(f"<BOUNDARY>{line(*r)}</BOUNDARY>" for r in rings) + "</SURFACE>"


def shapes(spark, town, write, body, form="nested", **options):
    text = si.v23(si.plan("b", si.obj("Shape", "s", body)))
    return scan.scan_class(spark, write(a=text), SHAPE, town, geometry=form, **options)


def test_kinds_as_text(spark, town, write):
    body = (f"<Lines><MULTIPOLYLINE>{line((0, 0), (1, 1))}{line((2, 2), (3, 3))}</MULTIPOLYLINE></Lines>"
            f"<Spots><MULTICOORD>{coord(1, 2)}{coord(3, 4)}</MULTICOORD></Spots><Face>{surface(SQUARE, HOLE)}</Face>"
            f"<Faces><MULTISURFACE>{surface(SQUARE)}{surface([(x + 9, y) for x, y in SQUARE])}</MULTISURFACE></Faces>"
            f"<Peak>{coord('-71.5', '42.125', '8848.86')}</Peak>")
    row = shapes(spark, town, write, body, "wkt").first()
    assert row.Lines == "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))"
    assert row.Spots == "MULTIPOINT (1 2, 3 4)"
    assert row.Face == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    assert row.Faces.startswith("MULTIPOLYGON (((0 0, 4 0") and row.Faces.count("((") == 2
    assert row.Peak == "POINT Z (-71.5 42.125 8848.86)"
    wkb = shapes(spark, town, write, body, "wkb").first()
    assert bytes(wkb.Peak) == struct.pack("<BI3d", 1, 1001, -71.5, 42.125, 8848.86)
    assert bytes(wkb.Face)[:13] == struct.pack("<BIII", 1, 3, 2, 5)
    assert bytes(wkb.Spots) == struct.pack("<BII", 1, 4, 2) + b"".join(
        struct.pack("<BI2d", 1, 1, x, y) for x, y in ((1, 2), (3, 4)))
    assert len(bytes(wkb.Faces)) == 9 + 2 * (9 + 4 + 80) and len(bytes(wkb.Lines)) == 9 + 2 * (9 + 32)
    face, faces = F.col("Face"), F.col("Faces")
    got = shapes(spark, town, write, body).select(
        geo.area(face), geo.area(faces), geo.num_geometries(faces), geo.num_interior_rings(face), geo.num_points(face),
        geo.distance_to_point(face, F.lit(1.5), F.lit(1.5), True), geo.distance_to_point(face, F.lit(3.0), F.lit(3.0), True),
        geo.distance_to_point(face, F.lit(7.0), F.lit(8.0), True), geo.is_valid(face, "SURFACE")).first()
    assert tuple(got) == (15.0, 32.0, 2, 1, 10, 0.5, 0.0, 5.0, True)


def test_bow_tie_is_not_valid(spark, town, write):
    df = shapes(spark, town, write, f"<Face>{surface(BOWTIE)}</Face>", columns=["Face"])
    assert df.select(geo.is_valid(F.col("Face"), "SURFACE")).first()[0] is False


def on_circle(degrees, x=700, y=300, radius=20):
    return x + radius * math.cos(math.radians(degrees)), y + radius * math.sin(math.radians(degrees))


def test_arc_within_tolerance(spark, town, write):
    """A third of a circle: the chord of one stroke is at most the tolerance (0.001 in the catalog) off."""
    def curve(through, last=(640, 300)):
        first, end = on_circle(0), on_circle(120)
        arc = "<ARC><C1>%r</C1><C2>%r</C2><A1>%r</A1><A2>%r</A2></ARC>" % (*end, *on_circle(through))
        return f"<Curve><POLYLINE>{coord(*first)}{arc}{coord(*last)}</POLYLINE></Curve>"

    def strokes(sweep, tolerance):
        return math.ceil(math.radians(sweep) / (2 * math.acos(1 - tolerance / 20)))

    points = shapes(spark, town, write, curve(50), columns=["Curve"]).first().Curve[0][0]
    assert len(points) == strokes(120, 0.001) + 2
    for p in points[:-1]:
        assert math.hypot(p.x - 700, p.y - 300) == pytest.approx(20, abs=1e-6)
    assert (points[-1].x, points[-1].y) == (640, 300)
    coarse = shapes(spark, town, write, curve(50), arc_tolerance_override=2.0, columns=["Curve"]).first().Curve[0][0]
    assert len(coarse) == strokes(120, 2.0) + 2
    # The other way round the circle.
    long = shapes(spark, town, write, curve(250), columns=["Curve"]).first().Curve[0][0]
    assert len(long) == strokes(240, 0.001) + 2 and min(p.y for p in long) < 281


@pytest.mark.parametrize("body, message", [
    (f"<Curve>{line((1, 2))}</Curve>", "POLYLINE requires at least two coordinates"),
    (f"<Curve>{line((1, 'x'), (2, 3))}</Curve>", "non-numeric ordinate"),
    (f"<Curve>{coord(1, 2)}</Curve>", "expected POLYLINE but found COORD"),
    (f"<Face>{surface(SQUARE[:4])}</Face>", "ring is not closed"),
    (f"<Face>{surface(SQUARE[:3])}</Face>", "ring requires at least four coordinates"),
    ("<Curve>text</Curve>", "geometry value is not an object"),
    ("<Curve><POLYLINE><CLIPPED/></POLYLINE></Curve>", "clipped geometry is not supported"),
    ("<Curve><POLYLINE><SPLINE><C1>1</C1></SPLINE></POLYLINE></Curve>", "unsupported geometry element SPLINE"),
    (f"<Peak>{coord(1, 2)}</Peak>", "missing or non-numeric ordinate"),
])
def test_geometry_policy(spark, town, write, body, message):
    name = body[1:body.index(">")]
    row = shapes(spark, town, write, body, "wkb", geometry_errors="null", columns=[name, "_unsupported_json"]).first()
    assert row[name] is None and message in row._unsupported_json
    with pytest.raises(Exception, match=message):
        shapes(spark, town, write, body, "wkb", columns=[name]).collect()


# --------------------------------------------------------------------- edits

def edit_table(spark, *rows):
    filled = [(str(i), *r, *[None] * (6 - len(r))) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        [(i, c, t, b, p, v, e) for i, c, t, p, v, b, e in filled], ed.EDIT_SCHEMA)


def digest(path):
    return hashlib.md5(open(f"{path}/a.xml", "rb").read()).hexdigest()


def test_one_edit(spark, town, write, tmp_path):
    path, out = write(a=si.TOWN), str(tmp_path / "out")
    before = digest(path)
    edits = edit_table(spark, (HOUSE, "h1", "Name", "new & <old>", "b1", "mill & barn"),
                       (HOUSE, "h1", "Place.Street", "other"))
    audit = {r.path_expression: r for r in ed.apply_edits(spark, path, out, edits, town).collect()}
    name = audit["Name"]
    assert (name.bid, name.tid, name.class_name, name.old_value, name.new_value, name.status, name.message) == (
        "b1", "h1", HOUSE, "mill & barn", "new & <old>", "UPDATED", "one primitive value rewritten")
    assert digest(path) == before
    old, new = (scan.scan_class(spark, p, HOUSE, town, geometry="wkt").orderBy("_tid").collect() for p in (path, out))
    assert new[0].Name == "new & <old>" and new[0].Line == old[0].Line and new[1:] == old[1:]
    assert values.read_values(spark, out, HOUSE, "Place.Street", town).first().value == "other"
    raws = [sorted(r.raw for r in read_objects(spark, p, town.model).filter("tid IS NULL OR tid <> 'h1'").collect())
            for p in (path, out)]
    assert raws[0] == raws[1]
    with pytest.raises(TransferError, match="output already exists"):
        ed.apply_edits(spark, path, out, edits, town)
    ed.apply_edits(spark, path, out, edit_table(spark, (HOUSE, "h1", "Name", "again")), town, overwrite=True)
    assert scan.scan_class(spark, out, HOUSE, town).filter("_tid = 'h1'").first().Name == "again"
    for bad in (path, path + "/", path + "/inner"):
        with pytest.raises(TransferError, match="different files"):
            ed.apply_edits(spark, path, bad, edits, town)


def test_output_among_the_inputs_is_refused(spark, town, write, tmp_path):
    for name in ("p0", "p1"):
        (tmp_path / "g" / name).mkdir(parents=True)
        (tmp_path / "g" / name / "a.xml").write_text(si.TOWN, encoding="utf-8")
    with pytest.raises(TransferError, match="different files"):
        ed.apply_edits(spark, f"{tmp_path}/g/*", f"{tmp_path}/g/p0", edit_table(spark, (HOUSE, "h1", "Name", "x")), town,
                       overwrite=True)
    assert (tmp_path / "g" / "p0" / "a.xml").read_text(encoding="utf-8") == si.TOWN


def test_object_of_a_basket_without_id(spark, town, write, tmp_path):
    text = si.v23('<Town.Plan BID="">' + si.HOUSE2 + "</Town.Plan>")
    out = str(tmp_path / "out")
    audit = ed.apply_edits(spark, write(a=text), out, edit_table(spark, (HOUSE, "h2", "Floors", "5")), town)
    assert [r.status for r in audit.collect()] == ["UPDATED"]
    assert scan.scan_class(spark, out, HOUSE, town).first().Floors == 5
    twice = edit_table(spark, (HOUSE, "h2", "Floors", "5"), (HOUSE, "h2", "Floors", "6", ""))
    assert [r.status for r in ed.audit_edits(spark, write(b=text), twice, town).collect()] == ["REJECTED"] * 2


def test_very_many_paths(spark, town, write):
    edits = edit_table(spark, (HOUSE, "h1", "Name", "fine"), *((HOUSE, "h1", f"Nothing{i}", "v") for i in range(1500)))
    counts = {r.status: r["count"] for r in ed.audit_edits(spark, write(a=si.TOWN), edits, town).groupBy("status").count().collect()}
    assert counts == {"UPDATED": 1, "REJECTED": 1500}


def test_second_dialect_edit_keeps_the_rest(spark, town, write, tmp_path):
    path, out = write(a=si.TOWN24), str(tmp_path / "out")
    ed.apply_edits(spark, path, out, edit_table(spark, (HOUSE, "h24", "Name", "n2", "b24", "tower")), town)
    assert scan.scan_class(spark, out, HOUSE, town).first().Name == "n2"
    text = "".join(r.value for r in spark.read.text(out, wholetext=True).collect())
    assert "geom:coord" in text and '<Town:Notes ili:bid="n24">' in text and text.count("tower") == 0


def test_refusals(spark, town, write):
    twice = si.v23(si.plan("b", si.OWNERS, si.obj("Owner", "o1", "<Name>x</Name>"), si.HOUSE1, si.HOUSE2))
    cases = [
        ((OWNER, "o1", "Name", "v"), "matched more than one object: TID=o1"),
        ((OWNER, "none", "Name", "v"), "found no matching object: TID=none"),
        ((OWNER, "o2", "Name", "v", "wrong"), "found no matching object: TID=o2"),
        ((OWNER, "o2", "Name", "v", None, "other"), "expected value does not match"),
        ((HOUSE, "h1", "holder", "v"), "roles are not supported: holder"),
        ((HOUSE, "h1", "Line", "v"), "geometries are not supported: Line"),
        ((HOUSE, "h1", "Labels", "v"), "target property is not primitive: Labels"),
        ((HOUSE, "h1", "Labels[1].Text", "v"), "nested path must start with one structure: Labels[1].Text"),
        ((HOUSE, "h1", "Labels[*].Text", "v"), "path_expression must not contain a wildcard"),
        ((HOUSE, "h1", "Nothing", "v"), f"target property does not exist: {HOUSE}.Nothing"),
        ((HOUSE, "h2", "Floors", None), "value must not be NULL"),
        ((HOUSE, "h2", "Height", "1"), "path matches no value"),
        ((HOUSE, "", "Name", "v"), "class_name, tid and path_expression must not be empty"),
        ((HOUSE, "h1", "Floors", "1"), "more than one edit for the same value"),
        ((HOUSE, "h1", "Floors", "2", "b"), "more than one edit for the same value"),
        ((HOUSE, "h1", "Name", "fine"), "one primitive value rewritten"),
    ]
    audit = ed.audit_edits(spark, write(a=twice), edit_table(spark, *[c for c, _ in cases]), town)
    got = {int(r.edit_id): r.message for r in audit.collect()}
    assert got == {i: message for i, (_, message) in enumerate(cases)}


def test_same_name_at_two_levels_is_told_apart_by_place(spark, write, tmp_path):
    from basketlens import Catalog

    catalog = Catalog.from_rows(
        spark, [("M", "1", None, None, "2.3", 1)],
        [("M", "", "S", "M.S", "STRUCTURE", False, None, 1), ("M", "T", "C", "M.T.C", "CLASS", False, None, 2)],
        [si.prop("M.S", "Name", 1), si.prop("M.T.C", "In", 1, "Structure", target="M.S"), si.prop("M.T.C", "Name", 2)])
    body = "<In><M.S><Name>a</Name></M.S></In><Name>b</Name>"
    text = lambda b: f'<TRANSFER><DATASECTION><M.T BID="b"><M.T.C TID="1">{b}</M.T.C></M.T></DATASECTION></TRANSFER>'
    path = write(a=text(body))
    ed.apply_edits(spark, path, str(tmp_path / "o"), edit_table(spark, ("M.T.C", "1", "Name", "new")), catalog)
    assert read_objects(spark, str(tmp_path / "o"), catalog.model).first().raw == (
        f'<M.T.C TID="1">{body.replace(">b<", ">new<")}</M.T.C>')
    odd = body + "<Odd><Name>b</Name></Odd>"
    ed.apply_edits(spark, write(a=text(odd)), str(tmp_path / "p"), edit_table(spark, ("M.T.C", "1", "Name", "new")), catalog)
    assert read_objects(spark, str(tmp_path / "p"), catalog.model).first().raw == (
        f'<M.T.C TID="1">{odd.replace(">b<", ">new<", 1)}</M.T.C>')


# --------------------------------------------------------------- round trip

_TEXT = st.text(st.characters(codec="utf-8", categories=("L", "N", "P", "S", "Zs"), include_characters="&<>\"'\t\n "),
                max_size=12)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_TEXT, st.lists(_TEXT, max_size=3)), min_size=1, max_size=8))
def test_written_objects_are_read_back(spark, town, tmp_path_factory, items):
    out = str(tmp_path_factory.mktemp("w") / "t")
    info = town.model.classes[HOUSE]
    rows = spark.createDataFrame([(i, n, l) for i, (n, l) in enumerate(items)], "i int, n string, l array<string>")
    labels = F.transform("l", lambda t: F.struct(F.lit("Town.Label").alias("_tag"), F.array(t).alias("Text")))
    text = ObjectWriter(town.model, info, "2.3").object(
        {"Name": F.array("n"), "Labels": labels}, F.concat(F.lit("t"), F.col("i").cast("string")), F.lit("UPDATE"))
    shop.write_objects(rows.select(F.lit('<Town.Plan BID="b">').alias("basket_tag"), text.alias("raw")), out)
    parser = Parser(town.model, info, "2.3")
    back = parser.parse(read_objects(spark, out, town.model)).select(
        "tid", "operation", parser.values("Name")[0].alias("n"),
        F.transform(parser.values("Labels"), lambda e: e["Text"][0]).alias("l"))
    assert {r.tid: (r.operation, r.n, r.l) for r in back.collect()} == {
        f"t{i}": ("UPDATE", n, l) for i, (n, l) in enumerate(items)}


def test_large_basket_is_written_in_parts(spark, town, tmp_path):
    out = str(tmp_path / "parts")
    rows = spark.range(200).select(
        F.lit('<Town.Plan BID="b">').alias("basket_tag"),
        F.concat(F.lit('<Town.Plan.Owner TID="o'), F.col("id").cast("string"), F.lit('"><Name>n</Name></Town.Plan.Owner>'))
        .alias("raw")).select(F.lit(None).cast("string").alias("header"), F.lit(0).alias("basket_no"), "basket_tag", "raw")
    from basketlens.sources.writer import header_text, write_transfer

    write_transfer(rows.coalesce(1), out, header_text("2.3", ["Town"]), target_bytes=1000)
    assert spark.read.format("binaryFile").load(out).count() > 5
    found = read_objects(spark, out, town.model)
    assert found.count() == 200 and found.select("bid").distinct().count() == 1


def test_paths_of_structures_in_each_other(spark, write):
    """Fifteen structures with two members each and one that holds itself: as many rounds as the longest path has steps."""
    from basketlens import Catalog

    names = [f"S{i}" for i in range(15)]
    classes = [("M", "", n, f"M.{n}", "STRUCTURE", False, None, i) for i, n in enumerate(names)]
    classes += [("M", "", "R", "M.R", "STRUCTURE", False, None, 20), ("M", "T", "C", "M.T.C", "CLASS", False, None, 21)]
    properties = [si.prop(f"M.{a}", m, k, "Structure", target=f"M.{b}") for a, b in zip(names, names[1:], strict=False)
                  for k, m in enumerate(("Left", "Right"))]
    properties += [si.prop("M.S14", "Value", 1), si.prop("M.R", "Next", 1, "Structure", target="M.R"), si.prop("M.R", "Label", 2),
                   si.prop("M.T.C", "Top", 1, "Structure", target="M.S0"), si.prop("M.T.C", "Root", 2, "Structure", target="M.R")]
    catalog = Catalog.from_rows(spark, [("M", "1", None, None, "2.3", 1)], classes, properties)
    assert ed.properties_by_context(spark, catalog).count() < 100
    sides = lambda i: ".".join("Left" if i >> k & 1 else "Right" for k in range(14))
    paths = [f"Top.{sides(i)}.Value" for i in range(5000)] + ["Root.Next.Next.Label", "Root.Next.Next", "Root.Next.Nope", "Top.Left.Value"]
    judged = {r.path_expression: r.fault for r in ed.judged_paths(
        catalog, edit_table(spark, *(("M.T.C", "1", p, "x") for p in paths))).collect()}
    assert len(judged) == 5004 and all(judged[p] is None for p in paths[:5001])
    assert judged["Root.Next.Next"] == "target property is not primitive: Next"
    assert judged["Root.Next.Nope"] == "target property does not exist: Root.Next.Nope"
    assert judged["Top.Left.Value"] == "target property does not exist: Top.Left.Value"


def test_two_paths_to_one_value_contradict(spark, town, write):
    audit = ed.audit_edits(spark, write(a=si.TOWN), edit_table(
        spark, (HOUSE, "h1", "Place.Street", "x"), (HOUSE, "h1", "Place[1].Street", "y")), town)
    assert {r.message for r in audit.collect()} == {"more than one edit for the same value"}


def test_transfers_are_compressed_and_grouped_without_a_sort(spark, town, tmp_path):
    out = str(tmp_path / "grouped")
    rows = spark.range(5000).coalesce(1).select(
        F.concat(F.lit('<Town.Plan BID="b'), (F.col("id") % 3).cast("string"), F.lit('">')).alias("basket_tag"),
        F.concat(F.lit('<Town.Plan.Owner TID="o'), F.col("id").cast("string"), F.lit('"><Name>n</Name></Town.Plan.Owner>')).alias("raw"))
    shop.write_objects(rows, out)
    files = [r.path for r in spark.read.format("binaryFile").load(out).collect()]
    assert files and all(f.endswith(".gz") for f in files)
    text = spark.read.text(out, wholetext=True).first().value
    assert [text.count(f'BID="b{i}"') for i in range(3)] == [1, 1, 1]
    found = read_objects(spark, out, town.model)
    assert {(r.tid, r.bid) for r in found.collect()} == {(f"o{i}", f"b{i % 3}") for i in range(5000)}


def test_large_files_are_as_many_as_the_rows_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shop, "LARGE_FILE_ROWS", 10)
    catalog = shop.shop_catalog(spark)
    rows = spark.range(45).selectExpr("id AS c_custkey", "id % 2 AS c_nationkey", "'n' AS c_name", "'s' AS c_mktsegment", "1.5D AS c_acctbal")
    shop.write_large_files(shop.customers(rows), str(tmp_path / "large"), catalog, "2.3")
    found = read_objects(spark, str(tmp_path / "large"), catalog.model, whole_file_bytes=0)
    assert {r.tid for r in found.collect()} == {f"c{i}" for i in range(45)}
    assert spark.read.format("binaryFile").load(str(tmp_path / "large")).count() == 5


def test_values_go_to_many_edits_not_texts(spark, town, write, monkeypatch):
    """With many edits of few paths the objects' texts meet no join; the audit is the same."""
    path = write(a=si.TOWN, b=si.TOWN.replace('TID="h1"', 'TID="h9"'))
    edits = edit_table(spark, (HOUSE, "h1", "Place.Street", "x"), (HOUSE, "h9", "Name", "y"), (HOUSE, "none", "Name", "z"),
                       (HOUSE, "h2", "Name", "w"), (OWNER, "o1", "Name", "v"), (HOUSE, "h1", "Name", "u"))
    few = sorted(map(str, ed.audit_edits(spark, path, edits, town).collect()))
    plans, look = [], ed._values_at
    monkeypatch.setattr(ed, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(ed, "_values_at", lambda df: plans.append(df._jdf.queryExecution().analyzed().toString()) or look(df))
    assert sorted(map(str, ed.audit_edits(spark, path, edits, town).collect())) == few
    assert len(plans) == 1 and "Join" not in plans[0]


def test_edits_keep_the_compression_of_their_input(spark, town, write, tmp_path):
    rows = spark.createDataFrame([('<Town.Plan BID="b">', '<Town.Plan.Owner TID="o1"><Name>n</Name></Town.Plan.Owner>')], "basket_tag string, raw string")
    shop.write_objects(rows, str(tmp_path / "in"))
    for source, end in ((str(tmp_path / "in"), ".gz"), (write(a=si.v23(si.plan("b", si.obj("Owner", "o1", "<Name>n</Name>")))), ".txt")):
        out = str(tmp_path / f"out{end}")
        ed.apply_edits(spark, source, out, edit_table(spark, (OWNER, "o1", "Name", "m")), town)
        assert all(r.path.endswith(end) for r in spark.read.format("binaryFile").load(out).select("path").collect())
        assert [r.Name for r in scan.scan_class(spark, out, OWNER, town).collect()] == ["m"]


def test_listed_values_are_written_like_arrays(spark):
    """Values that are listed one by one give the text that arrays of them give; missing ones give none."""
    from basketlens.plans import shop
    from basketlens.sources.writer import Structure

    catalog = shop.shop_catalog(spark)
    info, text = catalog.model.classes[shop.LINE], lambda *v: F.array_compact(F.array(*v))
    writer = ObjectWriter(catalog.model, info, "2.3")
    rows = spark.createDataFrame([("a<b", "1", True), (None, None, None), ("", "&", False)], "x string, y string, z boolean")
    x, y, z, none = F.col("x"), F.col("y"), F.col("z"), F.lit(None).cast("string")
    charge = F.struct(F.lit("Shop.Charge").alias("_tag"), text(x).alias("Kind"), text(y).alias("Amount"))
    listed = {"Number": [y], "Flag": [x], "order": [x], "Charges": [Structure("Shop.Charge", {"Kind": [x], "Amount": [y]}, z)]}
    arrays = {"Number": text(y), "Flag": text(x), "Charges": F.filter(F.array(F.when(z, charge)), lambda c: c.isNotNull()),
              "order": F.filter(F.array(F.struct(x.alias("ref"), none.alias("bid"), none.alias("order"))), lambda r: r["ref"].isNotNull())}
    found = rows.select(*(writer.object(v, F.lit("t"), none).alias(n) for n, v in (("one", listed), ("two", arrays)))).collect()
    assert [r.one for r in found] == [r.two for r in found] and "<Charges/>" in found[1].one and "<order" not in found[1].one
