"""Node rows: any depth, and back to text."""

import json

import pytest
import small_inputs as si

from basketlens.operators import nodes, quality, scan, values
from basketlens.plans import shop
from basketlens.sources import tree
from basketlens.sources.objects import read_objects

HOUSE, OWNER, OWNS = f"{si.T}.House", f"{si.T}.Owner", f"{si.T}.Owns"


def test_keys_paths_and_kinds(spark, town, write):
    rows = nodes.node_rows(read_objects(spark, write(a=si.TOWN), town.model), town, [HOUSE]).filter("tid = 'h1'").collect()
    found = {(tuple(r.key), r.path, tuple(r.ordinals), r.kind): r for r in rows}
    assert found[(), "", (), "object"].counts["Labels"] == 2
    assert found[(3, 0, 0), "Labels.Text", (2, 1), "value"].value == "listed"
    assert found[(0,), "Name", (1,), "value"].value == "mill & barn"
    assert found[(7,), "holder", (1,), "reference"].ref == "o1"
    assert found[(4,), "Point", (1,), "geometry"].value.startswith("<COORD>")
    assert found[(8, 0), "Place", (1,), "structure"].owner == "Town.Address"


@pytest.mark.parametrize("text", ["TOWN", "TOWN24"])
def test_rebuilt_objects_scan_alike(spark, town, write, text, tmp_path):
    path = write(a=getattr(si, text))
    objects = read_objects(spark, path, town.model)
    anew = nodes.rebuilt(nodes.node_rows(objects, town, [HOUSE, OWNER, OWNS]))
    for cls in (HOUSE, OWNS):
        before, after = (
            sorted(map(str, scan.scan_class(spark, "", cls, town, objects=o, geometry="wkt").collect())) for o in (objects, anew))
        assert before == after and before


def test_values_of_nodes_are_those_of_the_parser(spark, town, write):
    path = write(a=si.TOWN, b=si.TOWN24)
    rows = nodes.node_rows(read_objects(spark, path, town.model), town, [HOUSE])
    for expression in ("Labels[*].Text", "Labels[2].Text", "Place.Street", "Name"):
        want = values.read_values(spark, path, HOUSE, expression, town).select("tid", "occurrence", "value")
        got = nodes.values_at(rows, values.parse_path(expression)).select("tid", "occurrence", "value")
        assert sorted(got.collect()) == sorted(want.collect()), expression


def chain(levels, inner="", tid="1"):
    body = inner
    for level in range(levels, 0, -1):
        name = "Root" if level == 1 else "Next"
        body = f"<{name}><Shop.Link><Label>a &amp; {level}</Label>{body}</Shop.Link></{name}>"
    return f'<{shop.CHAIN} TID="{tid}">{body}</{shop.CHAIN}>'


def test_seven_levels_of_a_structure_that_holds_itself(spark, write):
    catalog = shop.deep_catalog(spark)
    bad = "<Balance>-1</Balance><Balance>x</Balance><peer REF='1' BID='no'/><peer REF='1' BID='b'/>"
    path = write(a=si.v23(f'<Shop.Deep BID="b">{chain(7, bad)}{chain(2, tid="2")}<{shop.CHAIN} TID="3"/></Shop.Deep>'))
    at = "Root" + ".Next" * 6
    read = lambda e: [r.value for r in values.read_values(spark, path, shop.CHAIN, e, catalog).collect()]
    assert read(f"{at}.Label") == ["a & 7"] and read(f"{at}.Next.Label") == [] and read("Root.Next[1].Label") == ["a & 2"] * 2
    faults = {(r.xtf_tid, r.attribute_name, r.code) for r in quality.validate(spark, path, catalog).collect()}
    assert faults == {("1", f"{at}.Balance", "RANGE"), ("1", f"{at}.Balance", "TYPE"), ("1", f"{at}.Balance", "MULTIPLICITY"),
                      ("1", f"{at}.peer", "MULTIPLICITY"), ("1", f"{at}.peer", "REFERENCE"), ("3", "Root", "MULTIPLICITY")}
    told = {r.xtf_tid: r.Root_json for r in scan.read_class(spark, path, shop.CHAIN, catalog).collect()}
    below = json.loads(told["1"])
    for level in range(1, 8):
        assert below["Label"] == f"a & {level}"
        below = below.get("Next")
    assert told["3"] is None
    residual = scan.scan_class(spark, path, shop.CHAIN, catalog).filter("_tid = '2'").first()._unsupported_json
    assert json.loads(residual)["Root"][0]["_attrs"]["Next"][0] == {"_tag": "Shop.Link", "_attrs": {"Label": ["a & 2"]}}


def test_references_into_baskets(spark, town, write):
    links = (si.obj("Owns", body='<owner REF="o1" BID="b1"/><house REF="h1"/><Share>60</Share>')
             + si.obj("Owns", body='<owner REF="o1" BID="b2"/><house REF="h9"/><Share>60</Share>'))
    path = write(a=si.v23(si.plan("b1", si.HOUSE1, si.OWNERS) + si.plan("b2", links)))
    report = quality.validate(spark, path, town, checks={"REFERENCE"})
    assert sorted(r.message for r in report.collect()) == [
        "no object h9 of class Town.Plan.House", "no object o1 of class Town.Plan.Owner in basket b2"]


def test_text_places():
    data = b"<a><b x='1'/><c>1 &lt; <!-- - --><![CDATA[<&>]]>&#x41;</c><d><c/></d></a>"
    root = tree.parse(data)
    assert [k.name for k in root.kids] == ["b", "c", "d"] and root.kids[0].attributes(data) == {"X": "1"}
    assert tree.plain("1 &lt; <![CDATA[<&>]]>&#x41;&#66;") == "1 < <&>AB"
    assert tree.replaced(data, [(root.kids[2].kids[0], "x<"), (root.kids[0], "y")]) == (
        data.replace(b"<c/>", b"<c>x&lt;</c>").replace(b"<b x='1'/>", b"<b x='1'>y</b>"))



def test_forest_finds_what_trees_find():
    """Values and places of paths in many objects at once are those of each object's tree."""
    import numpy as np
    import pyarrow as pa
    from basketlens.operators import edits as ed
    from basketlens.operators.values import parse_path
    from basketlens.sources.forest import Forest, bytes_of, first_of

    texts = [
        b'<A><N>1 &lt; 2</N><N x="a>b">z</N><m:S><T><N>in</N><N/></T><U><N>u</N></U></m:S></A>',
        b'<m:A TID="1"/>', b'<A><N><![CDATA[<N>]]>&#65;</N><!-- <N> --><S/><S><T/></S><S><T><N>\xc3\xa9</N></T></S></A>',
        b'<A><NN>no</NN><N><k/>&amp;</N><N ></N><q:N>p</q:N><S a="1"><T><N>x</N></T></S></A>']
    raws = pa.array([t.decode() for t in texts])
    data, bounds = bytes_of(raws.slice(1))
    wood = Forest(data, bounds)
    assert wood.whole and data == b"".join(texts[1:])
    wood = Forest(*bytes_of(raws))
    rows = np.array([3, 0, 1, 2, 0])
    for path in ("N", "N[2]", "N[3]", "N[*]", "S.N", "S[2].N", "S.N[2]", "S[*].N[*]", "Z", "S.Z.N"):
        level, found, owner = wood.at_path(rows, parse_path(path))
        hits, first = first_of(owner, len(rows))
        for i, row in enumerate(rows.tolist()):
            own = tree.at_path(tree.parse(texts[row]), parse_path(path))
            place = wood.level(level)
            mine = [j for j, o in zip(found.tolist(), owner.tolist()) if o == i]
            offset = int(bytes_of(raws)[1][row])
            assert [(int(place.start[j]) - offset, int(place.stop[j]) - offset) for j in mine] == [(e.start, e.stop) for e in own]
            assert hits[i] == len(own)
            assert [wood.texts(level, np.array([j]))[0].as_py() for j in mine] == [e.text(texts[row]) for e in own]
    assert not Forest(b"<A/><B/>", np.array([0, 8])).whole
    kind = pa.list_(pa.struct([("path", pa.string()), ("value", pa.string())]))
    edits = pa.array([[("N", "a&b"), ("S.N[2]", "n")], None, [("N", "")], [("N[2]", "é"), ("S.N", "y")]], kind)
    given = pa.array([texts[0].decode(), None, texts[2].decode(), texts[3].decode()])
    splice = ed._spliced.func if hasattr(ed._spliced, "func") else ed._spliced
    assert splice(given, edits).to_pylist() == ed._spliced_one_by_one(given, edits).to_pylist()
    assert splice(given.slice(1), edits.slice(1)).to_pylist() == ed._spliced_one_by_one(given.slice(1), edits.slice(1)).to_pylist()
