"""Jobs that need the objects of a folder several times cut and parse them once."""

import pytest
from pyspark.sql import functions as F

import small_inputs as si
from basketlens.operators import importer, quality, scan
from basketlens.plans import shop
from basketlens.sources.objects import objects_by_class, read_objects


@pytest.fixture()
def counted(spark):
    """Rows as they are, and how many of them have been made so far."""
    def watch(rows):
        made = spark.sparkContext.accumulator(0)

        def run(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        return rows.mapInArrow(run, rows.schema), made

    return watch


def _sorted(report):
    return sorted(map(tuple, report.drop("filename").collect()), key=repr)


def test_all_checks_take_one_pass(spark, town, write, counted):
    body = si.plan("b", si.HOUSE1, si.HOUSE1, si.HOUSE2, si.OWNERS, si.obj("Owner", "o3"),
                   si.obj("House", "h4", '<Name>far too long a name</Name><Height>tall</Height><holder REF="o9"/><Floors>101</Floors>'),
                   si.obj("House", None, "<Name>x</Name><State>ruin</State>")) + si.plan("c", si.LINKS)
    path = write(a=si.v23(body))
    objects = read_objects(spark, path, town.model)
    seen, made = counted(objects)
    together = _sorted(quality.validate(spark, "", town, objects=seen))
    assert made.value == objects.count()
    alone = sum((_sorted(quality.validate(spark, path, town, checks={c})) for c in quality.PROFILES["full"]), [])
    assert together == sorted(alone, key=repr)
    assert {r[1] for r in together} == {"MULTIPLICITY", "TYPE", "DUPLICATE_TID", "RANGE", "LENGTH", "ENUMERATION", "REFERENCE"}


def test_deep_classes_take_no_flat_pass(spark, counted, tmp_path):
    people = spark.createDataFrame(
        [(i, f"name{i}", i % 3, float(50 - i), "S") for i in range(40, 60)],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    shop.write_objects(shop.chains(people), str(tmp_path / "deep"))
    catalog = shop.deep_catalog(spark)
    seen, made = counted(read_objects(spark, str(tmp_path / "deep"), catalog.model))
    found = quality.validate(spark, "", catalog, objects=seen, checks={"RANGE", "TYPE", "LENGTH", "MULTIPLICITY"}).collect()
    assert made.value == 20
    assert sum(r.code == "RANGE" for r in found) == 9


def test_a_creation_without_missing_tables_reads_nothing(spark, town, write, tmp_path):
    path = write(a=si.TOWN)
    assert "town_once.plan__owner" in importer.import_transfer(spark, path, town, "town_once")
    torn = write(a=si.TOWN[:-40])
    assert importer.import_transfer(spark, torn, town, "town_once") == []
    # A table that is missing is made again, the others stay.
    spark.sql("DROP TABLE town_once.plan__owner")
    assert importer.import_transfer(spark, path, town, "town_once") == ["town_once.plan__owner"]
    assert spark.table("town_once.plan__owner").count() == 2


def test_stored_objects_serve_several_scans(spark, town, write, counted):
    path = write(a=si.TOWN)
    objects = read_objects(spark, path, town.model)
    seen, made = counted(objects)
    stored = objects_by_class(seen)
    links = scan.read_association(spark, "", "Town.Plan.Owns", town, objects=stored)
    owners = scan.scan_class(spark, "", "Town.Plan.Owner", town, columns=["_tid", "Name"], objects=stored)
    joined = links.join(owners, links.owner_ref == F.col("_tid")).collect()
    assert sorted((r.house_ref, r.Name, r.Share) for r in joined) == [("h1", "Ann", 60), ("h1", "Bo", 40), ("h2", "Bo", 100)]
    assert made.value == objects.count()
    plain = scan.read_association(spark, path, "Town.Plan.Owns", town)
    assert sorted(map(repr, links.collect())) == sorted(map(repr, plain.collect()))
