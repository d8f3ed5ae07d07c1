import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import small_inputs as si
from basketlens import TransferError
from basketlens.sources import objects as ob

KEYS = ["bid", "class_fqn", "tid", "operation", "raw"]


def rows(df):
    return sorted(map(tuple, df.select(*KEYS).collect()), key=str)


def test_baskets_and_objects(spark, town, write):
    found = ob.read_objects(spark, write(a=si.TOWN), town.model)
    assert [(r.bid, r.class_fqn, r.tid, r.operation) for r in found.orderBy("basket_no", "pos").collect()] == [
        ("b1", "Town.Plan.House", "h1", "INSERT"),
        ("b1", "Town.Plan.House", "h2", "INSERT"),
        ("b1", "Town.Plan.House", "h3", "DELETE"),
        ("b1", "Town.Plan.Owner", "o1", "INSERT"),
        ("b1", "Town.Plan.Owner", "o2", "INSERT"),
        ("b2", "Town.Plan.Owns", None, "INSERT"),
        ("b2", "Town.Plan.Owns", None, "INSERT"),
        ("b2", "Town.Plan.Owns", None, "INSERT"),
        ("n", "Town.Notes.Owner", "o1", "INSERT"),
    ]


def test_second_dialect(spark, town, write):
    found = ob.read_objects(spark, write(a=si.TOWN24), town.model)
    assert sorted((r.bid, r.class_fqn, r.tid or "") for r in found.collect()) == [
        ("b24", "Town.Plan.House", "h24"), ("b24", "Town.Plan.Owner", "o24"), ("b24", "Town.Plan.Owns", ""),
        ("n24", "Town.Notes.Owner", "o24"),
    ]


def test_foreign_prefix_is_mapped(spark, town, write):
    text = si.TOWN24.replace("Town:", "t:").replace("xmlns:t:", "xmlns:").replace("xmlns:Town=", "xmlns:t=")
    found = ob.read_objects(spark, write(a=text), town.model, prefixes={"Town": "t"})
    assert sorted(r.class_fqn for r in found.collect())[-1] == "Town.Plan.Owns"


def test_unknown_class_and_basket_are_kept(spark, town, write):
    text = si.v23('<New.Topic BID="x"><New.Topic.Thing TID="q"><A>1</A></New.Topic.Thing></New.Topic>')
    assert rows(ob.read_objects(spark, write(a=text), town.model)) == [
        ("x", "New.Topic.Thing", "q", "INSERT", '<New.Topic.Thing TID="q"><A>1</A></New.Topic.Thing>')]


def test_entities_in_ids_and_single_quotes(spark, town, write):
    text = si.v23("<Town.Plan BID='a&amp;b'><Town.Plan.Owner TID='x&lt;1'><Name>n</Name></Town.Plan.Owner></Town.Plan>")
    assert [(r.bid, r.tid) for r in ob.read_objects(spark, write(a=text), town.model).collect()] == [("a&b", "x<1")]


def test_cdata_and_comments(spark, town, write):
    body = si.obj("Owner", "o", "<Name><![CDATA[a <!-- b --> c]]></Name><!-- gone -->")
    raw = ob.read_objects(spark, write(a=si.v23(si.plan("b", body))), town.model).first().raw
    assert "a <!-- b --> c" in raw and "gone" not in raw


@pytest.mark.parametrize("cut", [40, 300])
def test_truncated_file_fails(spark, town, write, cut):
    path = write(a=si.TOWN[:-cut])
    with pytest.raises(Exception, match="truncated"):
        ob.read_objects(spark, path, town.model).collect()
    assert ob.read_objects(spark, path, town.model, strict=False).count() > 0


def test_missing_path_and_empty_path(spark, town, tmp_path):
    with pytest.raises(Exception):
        ob.read_objects(spark, str(tmp_path / "none"), town.model, "2.3")
    with pytest.raises(TransferError):
        ob.read_objects(spark, "", town.model)


def many(n, fat=1):
    """Baskets of uneven size whose objects hold structures with the model prefix."""
    parts = []
    for b in range(4):
        objects = []
        for i in range(n if b == 1 else 3):
            labels = "".join(f"<Labels><Town.Label><Text>{b}-{i}-{k}</Text></Town.Label></Labels>" for k in range(3 * fat))
            objects.append(si.obj("House", f"h{b}-{i}", f"<Name>n{i}</Name>{labels}"))
            if i % 5 == 0:
                objects.append(f'<{si.T}.House TID="d{b}-{i}" OPERATION="DELETE"/>')
            if i % 7 == 0:
                objects.append(si.obj("Owns", body='<owner REF="o"/><house REF="h"/>'))
        parts.append(si.plan(f"b{b}", *objects))
    return si.v23("".join(parts) + si.NOTES)


@pytest.mark.parametrize("split_bytes", [900, 4000])
@pytest.mark.parametrize("fat", [1, 12])
def test_large_file_route_gives_the_same_objects(spark, town, write, split_bytes, fat):
    path = write(a=many(40, fat), b=many(5, fat))
    whole = rows(ob.read_objects(spark, path, town.model))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = ob.read_objects(spark, path, town.model, whole_file_bytes=100)
        assert len(ob.range_states(spark, path)) > 5
        assert rows(split) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_large_file_route_second_dialect(spark, town, write):
    body = "".join(
        f'<Town:House ili:tid="h{i}"><Town:Name>n{i}</Town:Name></Town:House>' for i in range(60))
    text = si.TOWN24.replace('<Town:House ili:tid="h24">', body + '<Town:House ili:tid="h24">')
    path = write(a=text)
    whole = rows(ob.read_objects(spark, path, town.model))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert rows(ob.read_objects(spark, path, town.model, whole_file_bytes=100)) == whole
        with pytest.raises(Exception, match="truncated"):
            ob.read_objects(spark, write(a=text[:-30]), town.model, whole_file_bytes=100).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_filter_comes_before_the_xml_parser(spark, town, write):
    """Objects are cut in one pass; a class scan parses the objects that its filter leaves."""
    plan = ob.read_objects(spark, write(a=si.TOWN), town.model).filter(F.col("tid") == "h1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "from_xml" not in text and text.count("MapInArrow") == 1 and "Exchange" not in text
    assert plan.count() == 1


def test_names_that_begin_alike_and_quoted_brackets(spark, town, write):
    """An object ends at its own end tag; attribute values may hold brackets, other attributes and numeric references."""
    body = ('<Town.Plan NOTE="a>b BID=\'no\'" BID="b&#45;1">'
            '<Town.Plan.Owner NOTE="c>d" TID="o&#x2D;1"><Name>x</Name><OwnerNo>7</OwnerNo></Town.Plan.Owner>'
            "<Town.Plan.Owns><Town.Plan.OwnsMore>y</Town.Plan.OwnsMore><Share>1</Share></Town.Plan.Owns></Town.Plan>")
    rows = ob.read_objects(spark, write(a=si.v23(body)), town.model, "2.3").collect()
    assert [(r.bid, r.tid) for r in rows] == [("b-1", "o-1"), ("b-1", None)]
    assert rows[0].raw.endswith("</OwnerNo></Town.Plan.Owner>") and rows[1].raw.endswith("<Share>1</Share></Town.Plan.Owns>")


def test_second_dialect_names_that_begin_alike(spark, town, write):
    text = si.TOWN24.replace("<Town:Name>Cy</Town:Name>", "<Town:OwnerNo>4</Town:OwnerNo><Town:Name>Cy</Town:Name>")
    raw = [r.raw for r in ob.read_objects(spark, write(a=text), town.model).filter("tid = 'o24'").collect()]
    assert all(r.endswith("</Town:Owner>") for r in raw) and any("Cy" in r for r in raw)


def test_start_tags_read_by_the_cutter_are_those_of_the_expressions(spark, town, write):
    """Odd start tags are left to the expressions; all of them say the same."""
    tags = ['TID="1"', 'TID="2" OPERATION="DELETE"', "TID='3'", 'TID="4" OPERATION="update"', 'OPERATION="UPDATE"', 'TID="a&amp;b"',
            'TID=""', 'OPERATION="UPDATE" TID="5"', 'x="1" TID="6"', 'TID = "7"', 'TID="&#233;"', 'TID="é"', "", 'p:tid="8"']
    body = "".join(f"<Town.Plan.Owner {t}><Name>n</Name></Town.Plan.Owner>" for t in tags)
    path = write(a=si.v23(f'<Town.Plan BID="b">{body}</Town.Plan><Town.Plan BID="x&lt;y"><Town.Plan.Owner TID="9"/></Town.Plan>'))
    cut_rows = ob._cut_files(ob.whole_texts(spark, path), (ob.cut.OBJECT,), True)
    assert cut_rows.filter("plain_tag IS NOT NULL").count() == 8
    none = F.lit(None).cast("string")
    bare = cut_rows.select(*(none.alias(c) if c.startswith("plain_") else c for c in cut_rows.columns))
    names = ob.Tags(town.model)
    fast, slow = (sorted(map(str, ob._named(x, names).collect())) for x in (cut_rows, bare))
    assert fast == slow and len(fast) == 15


def test_files_come_in_small_batches(spark, town, write):
    """A batch is not all the files of a task."""
    path = write(**{f"f{i}": si.v23(si.plan("b", si.obj("Owner", "o", f"<Name>{'n' * 3_000_000}</Name>"))) for i in range(8)})
    sizes = ob.whole_texts(spark, path).coalesce(1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert max(r.n for r in sizes) < 16_000_000


def test_records_of_ranges_hold_lines(spark, town, write):
    """Ranges of any size give the text back, with far fewer records than tags; a line that is too long is read tag by tag."""
    body = "".join(si.obj("Owner", f"o{i}", f"<Name>n {i}</Name>") + "\n" * (i % 3) for i in range(12))
    path = write(a=si.v23(si.plan("b", body)).replace("<Town.Plan ", "\n\n<Town.Plan "), b="\ufeff" + si.v23(si.plan("c", body)
                 + "\n" + si.plan("d", "")))
    whole = rows(ob.read_objects(spark, path, town.model))
    before, most = spark.conf.get("spark.sql.files.maxPartitionBytes"), ob._LINE_BYTES
    try:
        for size in (50, 53, 10_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            ranges = ob.surveyed_ranges(spark, path)
            assert ranges.separator == "\n<"
            assert rows(ob.read_objects(spark, path, town.model, whole_file_bytes=0)) == whole
        assert 3 * ob.range_records(spark, path, ranges.separator).count() < ob.range_records(spark, path).count()
        ob._LINE_BYTES = 100
        for size in (60, 10_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            assert ob.surveyed_ranges(spark, path).separator == "<"
            assert rows(ob.read_objects(spark, path, town.model, whole_file_bytes=0)) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        ob._LINE_BYTES = most
