"""Exact dedup, n-gram join and repeated passages against plain versions."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import SCHEMA, corpus, near_groups, repeated_spans
from pyspark.sql import functions as F

from basketlens.llm import components, exact_dedup, jaccard_join, suffix_dedup


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_matches_groups(docs, rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    pick = max if keep == "largest" else min
    got = exact_dedup.exact_dedup(docs, keep=keep).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    kept = Counter()
    for r in got:
        group = groups[r.text or ""]
        ids = [i for i in group if i is not None]
        assert (r.keep_id, r.group_size) == (pick(ids) if ids else None, len(group))
        assert r.text_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        kept[r.text or ""] += r.kept
    assert set(kept.values()) == {1}


def test_exact_dedup_of_one_hot_text(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same words").otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup.exact_dedup(docs, keep="largest")
    assert got.filter("text = 'same words'").select("keep_id", "group_size").distinct().collect() == [(4999, 3333)]
    assert got.filter("kept").count() == 5000 - 3332


def test_exact_dedup_normaliser_clashes_and_empty(spark):
    docs = spark.createDataFrame([(1, "A", 7), (2, "a", 8)], "doc_id long, text string, kept int")
    got = exact_dedup.exact_dedup(docs, normalise=F.lower).orderBy("doc_id").collect()
    assert [(r.keep_id, r.kept) for r in got] == [(1, True), (1, False)]
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_near_groups_match_all_pairs(docs, rows):
    got = jaccard_join.near_duplicates(docs.withColumn("bucket", F.lit(1)).withColumn("n_links", F.lit("x")))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got.collect()) == Counter(near_groups(rows))
    assert "bucket" in got.columns


def test_near_groups_keep_one(docs, rows):
    kept = jaccard_join.near_duplicates(docs).filter("kept").collect()
    want = {c for _, n, c, _ in near_groups(rows) if n}
    assert {r.component_id for r in kept if r.n_shingles} == want
    # Id 7 stands for two texts that do not link.
    assert len({(r.doc_id, r.text) for r in kept if r.n_shingles}) == len(want) + 1


def test_near_groups_of_a_large_group(spark):
    """Near copies of one text, most of them near only through the first, and a passage many others share."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 250):
        text = list(base)
        for at in rng.choice(150, rng.integers(0, 5), replace=False):
            text[at] = f"x{i}-{at}"
        rows.append((i, " ".join(text)))
    for i in range(250, 330):
        rows.append((i, " ".join([*(f"y{i}-{k}" for k in range(30)), *base[:60]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_duplicates(docs, carry=["doc_id"]).drop("kept").collect()
    assert {tuple(r) for r in got} == set(near_groups(rows))


def test_near_groups_small_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 300)
    got = jaccard_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    assert Counter(map(tuple, got)) == Counter(near_groups(rows))


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > 0.1], rng.integers(0, 2**63, 3).astype(np.uint64))))
        band = jaccard_join.band_of(len(a))
        x, y = (set(jaccard_join.chunk_hashes(s, band).tolist()) for s in (a, b))
        apart = len(set(a.tolist()) ^ set(b.tolist()))
        assert len(x - y) <= apart and len(y - x) <= apart


def test_near_texts_share_spare_buckets():
    rng = np.random.default_rng(5)
    none = np.zeros(0, dtype=np.uint64)
    for n in (*range(1, 40), 63, 64, 70, 250, 256, 300, 1100):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for lost in {0, n // 10, n // 5}:  # the rest is at least 80 % of both together
            swapped = min(lost, n // 9)
            for b in (a[lost:], np.unique(np.concatenate((a[swapped:], rng.integers(0, 2**63, swapped).astype(np.uint64))))):
                x, y = (set(jaccard_join._signatures(s, 80, none, none).tolist()) for s in (a, b))
                both = Counter(v & 31 for v in x & y)
                few = any(v >> 5 == jaccard_join.FEW for v in x & y)
                assert few or any(times > jaccard_join.spare(band, 80) for band, times in both.items())


def test_a_passage_of_two_texts_makes_no_candidates(spark):
    def words(i, n=200):
        return [f"w{i}-{k}" for k in range(n)]

    rows = []
    for i in range(0, 60, 2):
        passage = words(f"p{i}", 10)
        rows += [(i, " ".join(words(i) + passage)), (i + 1, " ".join(passage + words(i + 1)))]
    rows += [(100, " ".join(words("near"))), (101, " ".join(words("near")[4:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    signed = jaccard_join._sign(docs, none, 80, 5).selectExpr("explode(buckets) bucket", "cls").distinct()
    met = signed.groupBy("bucket").agg(F.count("*").alias("size"), F.collect_list("cls").alias("met")).filter("size > 1")
    assert met.select(F.explode("met")).distinct().count() > 10
    found = jaccard_join._candidates(signed, 80)
    assert found.count() == found.select("hub").distinct().count() + 1 == 2
    got = jaccard_join.near_duplicates(docs, carry=["doc_id"]).drop("kept").collect()
    assert {tuple(r) for r in got} == set(near_groups(rows))


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert suffix_dedup.repeated_spans(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}


def test_repeated_spans_match_all_windows(docs, rows):
    spans = defaultdict(list)
    for r in suffix_dedup.repeated_spans(docs.dropDuplicates(["doc_id", "text"])).collect():
        spans[r.doc_id].append((r.start_word, r.end_word))
    want = defaultdict(list)
    for (doc_id, _), found in repeated_spans(rows).items():
        want[doc_id] += found
    assert {k: sorted(v) for k, v in spans.items()} == {k: sorted(v) for k, v in want.items() if v}


def test_passages_give_the_words(spark):
    shared = " ".join(f"p{i}" for i in range(55))
    docs = spark.createDataFrame([(1, "a b  c\n" + shared), (2, shared + " d")], "doc_id long, text string")
    spans = suffix_dedup.repeated_spans(docs)
    assert {tuple(r) for r in spans.collect()} == {(1, 3, 58, 55), (2, 0, 55, 55)}
    assert {r.passage for r in suffix_dedup.passages(docs, spans).collect()} == {shared}
