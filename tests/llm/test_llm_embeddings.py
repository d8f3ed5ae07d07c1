"""Near vectors against all cosines."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, kept string"


def planted(seed=4, n=1500, dims=24):
    """Unit-free vectors: noise, pairs, a large tight group with a halo, odd cases, repeated rows."""
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(dims) * rng.uniform(0.1, 50) for _ in range(n)]
    spot = rng.standard_normal(dims)
    spot /= np.linalg.norm(spot)

    def beside(x, cosine):
        away = rng.standard_normal(len(x))
        x = x / np.linalg.norm(x)
        away -= away @ x * x
        return 3 * (cosine * x + math.sqrt(1 - cosine ** 2) * away / np.linalg.norm(away))

    rows += [beside(spot, rng.uniform(0.994, 0.9999)) for _ in range(700)]
    rows += [beside(spot, rng.uniform(0.90, 0.985)) for _ in range(60)]
    rows += [beside(rows[rng.integers(0, n)], rng.uniform(0.93, 0.999)) for _ in range(300)]
    rows = [[float(np.float32(v)) for v in row] for row in rows]
    rows += [rows[0], rows[0], [0.0] * dims, None, [], [1.0, None] * (dims // 2), [math.inf] + [0.0] * (dims - 1),
             [math.nan] * dims, [1.0, 0.0], [2.0, 0.1], [-1.0, 0.0], [5.0], [1e-30] * dims, [1e30] * dims]
    table = [(i * 3, row, 1, "x") for i, row in enumerate(rows)]
    return table + [table[5], table[5], (None, rows[7], 2, None), (9, rows[n], 2, None)]


def plain(rows, cosine):
    """Links and components over all pairs; rows are numbered."""
    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    up, links, close = list(range(len(rows))), [0] * len(rows), 0

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    by_length = {}
    for i, row in enumerate(rows):
        if usable(row[1]):
            by_length.setdefault(len(row[1]), []).append(i)
    for members in by_length.values():
        x = np.array([rows[i][1] for i in members], dtype=np.float32).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, row in enumerate(x @ x.T):
            for b in np.flatnonzero(row >= cosine):
                if a != b:
                    links[members[a]] += 1
                    up[root(members[a])] = root(members[int(b)])
                    close += 1
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[root(i)] = min(least.get(root(i), row[0]), row[0])
    return [(row[0], links[i], least.get(root(i))) for i, row in enumerate(rows)]


def key(row):
    return tuple(-1 if v is None else v for v in row)


def test_links_match_all_cosines(spark):
    rows = planted()
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = ed.near_vectors(vectors, carry=["vec_id", "label"]).collect()
    want = plain(rows, 0.95)
    found = sorted(key((r.vec_id, r.n_links, r.component_id)) for r in got)
    assert len(found) == len(want) and [f[0] for f in found] == [w[0] for w in sorted(map(key, want))]
    # No link that is none, and at least 98 of 100 of the links.
    made, there = sum(r.n_links for r in got), sum(w[1] for w in want)
    assert 0.98 * there <= made <= there
    exact = dict(((w[0], w[1]), w) for w in want)
    for r in got:
        if (r.vec_id, r.n_links) in exact and r.n_links == 0:
            assert r.component_id == r.vec_id
        assert r.kept == (r.vec_id == r.component_id)
    # The tight group is counted whole.
    same = sum(f == w for f, w in zip(found, sorted(map(key, want)), strict=True))
    assert same >= 0.97 * len(want)


def test_without_an_index_every_link_is_found(spark, monkeypatch):
    monkeypatch.setattr(ed, "BUCKET", 1 << 20)  # one cell, cut into blocks that meet pairwise
    monkeypatch.setattr(ed, "BLOCK", 100)
    rows = planted(seed=9, n=300)
    got = ed.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), cosine=0.9)
    assert got.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    assert sorted(key((r.vec_id, r.n_links, r.component_id)) for r in got.collect()) == sorted(map(key, plain(rows, 0.9)))


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    sample = ed.unit(rng.standard_normal((4000, 64)) + 0.3)
    coder = ed.fit(sample, 1 << 22, 0.95, 0.98)
    left, right = ed._made_pairs(ed.unit(rng.standard_normal((4000, 64)) + 0.3), 0.95, rng)
    flips = coder.bits(left) != coder.bits(right)
    meet = (~flips[:, :coder.tables * coder.width].reshape(len(left), coder.tables, coder.width).any(axis=2)).any(axis=1)
    assert coder.width == 14 and (meet & (flips.sum(axis=1) <= coder.radius)).mean() >= 0.95
    bits = coder.bits(sample)
    assert abs(bits.mean(axis=0) - 0.5).max() < 0.01


@pytest.mark.parametrize("rows", [[], [(1, None, 0, None)], [(1, [1.0, 2.0], 0, None)], [(2, [1.0], 0, None), (1, [4.0], 0, None)]])
def test_few_rows(spark, rows):
    got = ed.near_vectors(spark.createDataFrame(rows, SCHEMA), carry=["vec_id"])
    assert sorted(tuple(r) for r in got.select("vec_id", "n_links", "component_id").collect()) == sorted(plain(rows, 0.95))


def test_a_hot_core_is_counted(spark):
    rng = np.random.default_rng(6)
    spot = rng.standard_normal(16)
    spot /= np.linalg.norm(spot)
    rows = [(i, (spot + rng.standard_normal(16) * 0.002).tolist(), 0, None) for i in range(20000)]
    rows += [(20000 + i, rng.standard_normal(16).tolist(), 0, None) for i in range(50)]
    got = ed.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(8), carry=["vec_id"])
    summed = got.filter("n_links > 0").agg(F.count("*"), F.min("n_links"), F.max("component_id")).collect()[0]
    assert tuple(summed) == (20000, 19999, 0)
