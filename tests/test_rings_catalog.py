"""Ring nesting, binary geometries and long class hierarchies."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens import Catalog, TransferError
from basketlens.functions import geometry as geo
from basketlens.functions import rings, wkb
from basketlens.operators import introspect


def square(x, y, half, turn=1):
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1)][::turn]
    return np.array([(x + half * a, y + half * b) for a, b in [*corners, corners[0]]], dtype=float)


BOW_TIE = np.array([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)], dtype=float)


@pytest.mark.parametrize("parts, reason", [
    ([[square(0, 0, 5)]], None),
    ([[square(0, 0, 5), square(1, 1, 1, -1), square(-2, -2, 1)]], None),
    ([[BOW_TIE]], "ring touches itself"),
    ([[square(0, 0, 5)[:3]]], "ring has fewer than four points"),
    ([[np.array([(0, 0), (1, 0), (1, 1), (0, 1)], dtype=float)]], "ring is not closed"),
    ([[square(0, 0, 5), square(9, 9, 1)]], "inner ring is not inside the outer one"),
    ([[square(0, 0, 1), square(0, 0, 5)]], "inner ring is not inside the outer one"),
    ([[square(0, 0, 5), square(5, 0, 1)]], "rings cross"),
    ([[square(0, 0, 5), square(0, 0, 3), square(0, 0, 1)]], "inner ring lies in another one"),
    ([[square(0, 0, 5)], [square(20, 0, 5)]], None),
    ([[square(0, 0, 5)], [square(3, 3, 4)]], "parts overlap"),
    ([[square(0, 0, 5)], [square(0, 0, 1)]], "parts overlap"),
    ([[square(0, 0, 5), square(0, 0, 3)], [square(0, 0, 1)]], None),
    ([[square(0, 0, 5), square(4, 4, 1)]], None),  # touches the outer ring at a corner and along it
])
def test_rules_of_rings(parts, reason):
    assert rings.fault(parts) == reason


def test_self_contact_is_what_all_pairs_of_edges_say():
    rng = random.Random(3)

    def meet(p, q, r, s):
        side = lambda o, a, b: np.sign((a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0]))
        on = lambda x, a, b: all(min(a[k], b[k]) <= x[k] <= max(a[k], b[k]) for k in (0, 1))
        s1, s2, s3, s4 = side(p, q, r), side(p, q, s), side(r, s, p), side(r, s, q)
        return (s1 * s2 < 0 and s3 * s4 < 0) or (s1 == 0 and on(r, p, q)) or (s2 == 0 and on(s, p, q)) or (
            s3 == 0 and on(p, r, s)) or (s4 == 0 and on(q, r, s))

    seen = set()
    for _ in range(200):
        n = rng.randint(3, 12)
        points = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(n)] if rng.random() < 0.5 else [
            (10 * math.cos(6.28 * k / n) + rng.random(), 10 * math.sin(6.28 * k / n)) for k in range(n)]
        line = np.array([*points, points[0]], dtype=float)
        edges = list(zip(line[:-1], line[1:], strict=True))
        want = any(meet(*edges[i], *edges[j]) for i, j in itertools.combinations(range(n), 2) if j > i + 1 and not (i == 0 and j == n - 1))
        assert (rings.fault([[line]]) == "ring touches itself") == want
        seen.add(want)
    assert seen == {True, False}


def test_a_ring_of_a_hundred_thousand_points():
    n = 100_000
    t = np.linspace(0, 2 * np.pi, n + 1)
    radius = 100 + np.sin(40 * t)
    ring = np.column_stack([radius * np.cos(t), radius * np.sin(t)])
    ring[-1] = ring[0]
    started = time.time()
    assert rings.fault([[ring]]) is None
    crossed = ring.copy()
    crossed[n // 2] = crossed[10] * 1.1
    assert rings.fault([[crossed]]) == "ring touches itself"
    assert time.time() - started < 20


@pytest.mark.parametrize("kind", ["COORD", "MULTICOORD", "POLYLINE", "MULTIPOLYLINE", "SURFACE", "MULTISURFACE"])
@pytest.mark.parametrize("z", [None, 7.25])
def test_binary_geometries_are_read_back(spark, kind, z):
    line = lambda *xy: [(float(x), float(y), z) for x, y in xy]
    parts = {
        "COORD": [[line((1, 2))]], "MULTICOORD": [[line((1, 2))], [line((3, 4))]], "POLYLINE": [[line((0, 0), (1.5, -2))]],
        "MULTIPOLYLINE": [[line((0, 0), (1, 1))], [line((5, 5), (6, 6), (7, 1e300))]],
        "SURFACE": [[line((0, 0), (9, 0), (9, 9), (0, 0)), line((1, 1), (2, 1), (2, 2), (1, 1))]],
        "MULTISURFACE": [[line((0, 0), (9, 0), (9, 9), (0, 0))], [line((20, 0), (29, 0), (29, 9), (20, 0))]]}[kind]
    df = spark.createDataFrame([(parts,), (None,), (parts,)], f"p {geo.PARTS}")
    back = df.select("p", wkb.from_wkb(geo.as_wkb(F.col("p"), kind)).alias("q")).collect()
    assert [r.p for r in back] == [r.q for r in back] and back[1].q is None
    big = df.limit(1).select(wkb.from_wkb(F.unhex(F.lit("00000003E93FF000000000000040000000000000004008000000000000"))).alias("q"))
    assert big.first().q == [[[(1.0, 2.0, 3.0)]]]
    with pytest.raises(Exception, match="behind its end"):
        df.limit(1).select(wkb.from_wkb(F.unhex(F.lit("01010000000000000000000000000000000000000000"))).alias("q")).collect()


def chain(spark, n, loop=None):
    links = [(f"M.T.C{i}", None if i == 0 and loop is None else f"M.T.C{loop if i == 0 else i - 1}") for i in range(n)]
    table = spark.createDataFrame([("M", "T", c.rpartition(".")[2], c, "CLASS", False, b, i) for i, (c, b) in enumerate(links)],
                                  "model_name string, topic_name string, class_name string, class_fqn string, kind string, "
                                  "is_abstract boolean, base_class_fqn string, seq int")
    empty = Catalog.from_rows(spark)
    return Catalog(empty.models, table, empty.properties, empty.geometry)


def test_ancestors_of_a_long_chain(spark):
    found = introspect.ancestors(chain(spark, 70), "M.T.C69").orderBy("depth").collect()
    assert [(r.ancestor_fqn, r.depth) for r in found] == [(f"M.T.C{69 - d}", d) for d in range(70)]


def test_a_cycle_of_bases_is_refused_by_name(spark):
    with pytest.raises(TransferError, match=r"class is its own base: M.T.C0"):
        introspect.ancestors(chain(spark, 5, loop=3))


def test_a_hundred_thousand_classes(spark):
    wide = spark.range(100_000).selectExpr(
        "'M' AS model_name", "'T' AS topic_name", "'C' || id AS class_name", "'M.T.C' || id AS class_fqn", "'CLASS' AS kind",
        "false AS is_abstract", "if(id = 0, null, 'M.T.C' || (id - 1) div 2) AS base_class_fqn", "cast(id AS int) AS seq")
    empty = Catalog.from_rows(spark)
    found = introspect.ancestors(Catalog(empty.models, wide, empty.properties, empty.geometry))
    assert found.agg(F.count("*"), F.max("depth")).first() == (sum(int(math.log2(i + 1)) + 1 for i in range(100_000)), 16)
