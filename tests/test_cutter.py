"""Cutting by depth: against an XML parser, over range borders, in both dialects and other encodings."""

import contextlib
import random
import xml.etree.ElementTree as ET

import pyarrow as pa
import pytest
import small_inputs as si

from basketlens import TransferError
from basketlens.operators import edits, scan
from basketlens.operators.values import parse_path
from basketlens.sources import cutter, tree
from basketlens.sources import objects as ob

KEYS = ["bid", "class_fqn", "tid", "operation", "raw"]


def rows(df):
    return sorted(map(tuple, df.select(*KEYS).collect()), key=str)


@contextlib.contextmanager
def split_bytes(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def odd_transfer(seed, baskets=5, objects=30):
    """Objects without TID, of unknown classes, empty ones, names inside each other, and markup that is none."""
    rng = random.Random(seed)
    noise = ["<!-- a > b </Town.Plan> <Town.Plan BID='c'> -->", "<![CDATA[ <x> </Town.Plan.Owner> ]]>", "<?do <that> ?>",
             "<Next><Next><Next a='1>2' b=\"it's\"/></Next></Next>", "text &lt; &amp; ]]", "<Town.Plan.Owner><Town.Plan.Owner/></Town.Plan.Owner>"]
    parts = []
    for b in range(baskets):
        inner = []
        for i in range(rng.randrange(objects)):
            name = rng.choice(["Town.Plan.Owner", "Town.Plan.Owns", "New.Topic.Link", "Odd", "Town.Plan"])
            tid = rng.choice([f' TID="o{b}-{i}"', "", f" NOTE='x>y \"q\"' TID='p{i}'"])
            body = "".join(rng.choice(noise) for _ in range(rng.randrange(5)))
            inner.append(f"<{name}{tid}>{body}</{name}>" if rng.random() < 0.8 else f"<{name}{tid}/>")
            inner.append(rng.choice(["", "\n", noise[0], noise[2]]))
        parts.append(rng.choice([f'<Town.Plan BID="b{b}">{"".join(inner)}</Town.Plan>', f"<Town.Plan BID='e{b}'/>", noise[0]]))
    return si.v23("".join(parts))


def parsed(text):
    """(basket id, tag, tid) of every object, by an XML parser."""
    root = ET.fromstring(text.encode())
    local = lambda e: e.tag.rpartition("}")[2]
    return [(b.get("BID"), local(o), o.get("TID")) for s in root if local(s) == "DATASECTION" for b in s for o in b]


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("size", [1, 40, 10**6])
def test_stretches_give_the_objects_of_an_xml_parser(seed, size, monkeypatch):
    monkeypatch.setattr(cutter, "STRETCH", size)
    text = odd_transfer(seed).encode()
    source = cutter.Cutter()
    found = [row for part in cutter.stretches(text) for row in source.feed(part)]
    assert not source.torn()
    objects = [r for r in found if r.kind == cutter.OBJECT]
    shown = []
    for row in objects:
        o = tree.parse(row.text)
        shown.append((tree.parse(row.basket_tag.removesuffix(b"/>").removesuffix(b">") + b"/>").attributes(
            row.basket_tag)["BID"], o.tag, o.attributes(row.text).get("TID")))
        assert b"<!--" not in row.text or b"<![CDATA[" in row.text
    assert shown == parsed(text.decode())
    assert next(r.text for r in found if r.kind == cutter.HEADER).startswith(b"<?xml")


@pytest.mark.parametrize("seed", range(4))
def test_changes_follow_one_another_associatively(seed):
    text = odd_transfer(seed).encode()
    pieces = [p if i == 0 else b"<" + p for i, p in enumerate(text.split(b"<"))]
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(pieces)), min(6, len(pieces) - 1)))
    ranges = [b"".join(pieces[a:b]) for a, b in zip([0, *cuts], [*cuts, len(pieces)], strict=True)]
    surveys = []
    for block, part in enumerate(ranges):
        survey = cutter.Survey(block)
        survey.feed(part)
        surveys.append(survey.changes)
    state = cutter.Change(0, (), cutter.CONTENT)
    found = []
    for block, part in enumerate(ranges):
        source = cutter.Cutter(block, state.opens, state.mode)
        found += [*source.feed(part), *source.rest()]
        assert [o.tag for o in state.opens[:1]] == ([source.root] if block else [])
        state = cutter.followed(state, surveys[block][state.mode])
    assert state == cutter.Change(0, (), cutter.CONTENT)
    whole = [r.text for r in found if r.kind == cutter.OBJECT]
    parts = {}
    for r in found:
        if r.kind in (cutter.BEGUN, cutter.CONTINUED, cutter.ENDED):
            parts[r.owner] = parts.get(r.owner, b"") + r.text
    one = cutter.Cutter()
    want = [r.text for r in one.feed(text) if r.kind == cutter.OBJECT]
    assert sorted(whole + list(parts.values())) == sorted(want)
    # Any bracketing of the ranges is the same change.
    a, b, c = (surveys[i][cutter.CONTENT] for i in range(3))
    b, c = surveys[1][a.mode], surveys[2][surveys[1][a.mode].mode]
    assert cutter.followed(cutter.followed(a, b), c) == cutter.followed(a, cutter.followed(b, c))


@pytest.mark.parametrize("size", [600, 1500])
def test_comments_and_sections_over_range_borders(spark, town, write, size):
    """Tags inside comments and CDATA sections are none, also where these run over a border."""
    hidden = "<Town.Plan BID='no'><Town.Plan.Owner TID='no'>" * 40
    body = [si.obj("Owner", f"o{i}", f"<Name><![CDATA[{hidden if i % 3 == 0 else i}]]></Name>") + f"<!-- {hidden} -->" for i in range(12)]
    path = write(a=si.v23(si.plan("b", *body)), b=odd_transfer(3))
    whole = rows(ob.read_objects(spark, path, town.model))
    assert sum(r[2] is not None and r[2].startswith("o") and r[0] == "b" for r in whole) == 12
    with split_bytes(spark, size):
        assert len(ob.range_states(spark, path)) > 8
        assert rows(ob.read_objects(spark, path, town.model, whole_file_bytes=0)) == whole


def test_objects_without_id_of_unknown_classes(spark, town, write):
    link = "<New.Topic.Link><a REF='1'/><b REF='2'/></New.Topic.Link>"
    body = f"<New.Topic BID='x'><New.Topic.Thing TID='q'/>{link}{link}</New.Topic>"
    found = ob.read_objects(spark, write(a=si.v23(body)), town.model)
    assert sorted((r.class_fqn, r.tid or "") for r in found.collect()) == [
        ("New.Topic.Link", ""), ("New.Topic.Link", ""), ("New.Topic.Thing", "q")]
    text = si.TOWN24.replace("</Town:Plan>", "<Town:Name><Town:x>1</Town:x></Town:Name></Town:Plan>")
    found = ob.read_objects(spark, write(a=text), town.model).filter("class_fqn = 'Town.Plan.Name'")
    assert [r.raw for r in found.collect()] == ["<Town:Name><Town:x>1</Town:x></Town:Name>"]


def test_files_of_both_dialects(spark, town, write):
    path = write(a=si.TOWN, b=si.TOWN24)
    houses = scan.scan_class(spark, path, f"{si.T}.House", town).select("_tid", "Name", "Floors", "holder", "Height")
    assert sorted(map(tuple, houses.collect()))[2:] == [("h24", "tower", 19, "o24", 61.2), ("h3", None, None, None, None)]
    links = scan.read_association(spark, path, f"{si.T}.Owns", town)
    assert sorted((r.house_ref, r.Share) for r in links.collect()) == [("h1", 40), ("h1", 60), ("h2", 100), ("h24", 5)]
    assert ob.read_objects(spark, path, town.model, "2.4").count() == 4


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "windows-1252", "utf-8", "utf-16"])
def test_the_declared_encoding_is_read(spark, town, tmp_path, encoding):
    text = si.v23(si.plan("bäsket", si.obj("Owner", "ö1", "<Name>Zürich – €</Name>" if "8859" not in encoding else "<Name>Zürich</Name>")))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_bytes(text.replace("UTF-8", encoding).encode(encoding))
    found = scan.scan_class(spark, str(tmp_path / "in"), f"{si.T}.Owner", town)
    assert [(r._bid, r._tid, r.Name[:6]) for r in found.collect()] == [("bäsket", "ö1", "Zürich")]
    if encoding != "utf-16":
        with split_bytes(spark, 250):
            ranges = ob.read_objects(spark, str(tmp_path / "in"), town.model, whole_file_bytes=0)
            assert [(r.bid, r.tid) for r in ranges.collect()] == [("bäsket", "ö1")]


def test_text_that_is_not_in_its_encoding(spark, town, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_bytes(si.v23(si.plan("b", si.obj("Owner", "1", "<Name>Zürich</Name>"))).encode("latin-1"))
    with pytest.raises(Exception, match="not in the encoding"):
        ob.read_objects(spark, str(tmp_path / "in"), town.model).collect()


def test_no_transfer(spark, town, write):
    with pytest.raises(Exception, match="no transfer root"):
        ob.read_objects(spark, write(a="<other><a/></other>"), town.model).collect()
    with pytest.raises(TransferError, match="unknown transfer dialect"):
        ob.read_objects(spark, write(a=si.TOWN), town.model, "3")


def test_unknown_properties_are_direct_children(spark, town, write):
    """A name that also stands deeper is listed with its own text only."""
    owner = si.obj("Owner", "o", "<Name>n</Name><Extra>1</Extra><Box><Extra>inside</Extra></Box><Extra/>")
    found = scan.scan_class(spark, write(a=si.v23(si.plan("b", owner))), f"{si.T}.Owner", town)
    assert found.first()._unsupported_json == '{"Extra":["1",""],"Box":["<Extra>inside</Extra>"]}'


def test_objects_of_a_basket_come_as_one_run():
    objects = [f'<C TID="{i}"><v>x</v></C>'.encode() if i % 3 else f'<C TID="{i}"/>'.encode() for i in range(50)]
    text = b"<TRANSFER><DATASECTION>" + b"".join(b'<B BID="%d">' % b + b"\n".join(objects) + b"</B>" for b in range(2)) + b"</DATASECTION></TRANSFER>"
    found = [r for r in cutter.Cutter().runs(text) if isinstance(r, cutter.Run)]
    assert [(r.basket_no, r.pos, len(r.starts)) for r in found] == [(1, 1, 50), (2, 1, 50)]
    assert [r.text for run in found for r in run.rows(text)] == objects * 2


def _shape(element):
    return (element.tag, element.start, element.begin, element.stop, element.end, [_shape(k) for k in element.kids])


@pytest.mark.parametrize("text", [
    b'<A TID="1"><B>x</B><C/><m:D><E  q=\'a > b\'>1 > 0</E></m:D></A>',
    b'<A TID="a/>"><B k="it\'s"/><B k=\'"\'></B></A>',
    b"<A\n TID='1'\t><B></B ></A>",
])
def test_short_texts_need_no_arrays(text, monkeypatch):
    """The tags of an object are found by one expression, and are those of the long way."""
    short = _shape(tree.parse(text))
    found = cutter.tags(text)
    begun = [(int(s), int(e)) for s, e, k in zip(found.starts, found.ends, found.kinds, strict=True) if k >= 0]
    spans = lambda e: [(e[1], e[2]), *(s for k in e[5] for s in spans(k))]
    assert spans(short) == begun
    monkeypatch.setattr(tree, "tags", None)
    assert _shape(tree.parse(text)) == short


def test_hidden_brackets_take_the_long_way():
    root = tree.parse(b"<A><!-- <B> --><C><![CDATA[<D>]]></C><?x <E>?></A>")
    assert [k.tag for k in root.kids] == ["C"]


def test_paths_of_edits_are_parsed_once(monkeypatch):
    calls = []
    monkeypatch.setattr(edits, "parse_path", lambda p: calls.append(p) or parse_path(p))
    raws = pa.array(["<A><B>1</B></A>", None, "<A><B>é</B></A>"])
    change = [{"path": "B", "value": "<2"}]
    out = edits._spliced.func(raws, pa.array([change, None, change], pa.list_(pa.struct([("path", pa.string()), ("value", pa.string())]))))
    assert out.to_pylist() == ["<A><B>&lt;2</B></A>", None, "<A><B>&lt;2</B></A>"]
    assert calls == ["B"]
