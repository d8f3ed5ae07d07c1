"""The pipeline against plain versions of its stages."""

from collections import Counter

import corpus_pipeline
from brute import SCHEMA, corpus, near_groups
from pyspark.sql import functions as F

from basketlens.llm import mixing, quality


def test_stages_in_order(spark, tmp_path):
    rows = [r for r in corpus(seed=3, n=120) if r[0] is not None]
    rows = list({r[0]: r for r in reversed(rows)}.values())
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", extra int")
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == 5

    kept = steps["quality rules"](spark, docs, str(tmp_path))
    judged = {r.doc_id for r in quality.judge(docs, quality.learn(docs)).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == judged and kept.columns == docs.columns

    single = steps["exact dedup"](spark, kept, str(tmp_path))
    first = {}
    for r in sorted(kept.collect(), key=lambda r: r.doc_id):
        first.setdefault(r.text, r.doc_id)
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values()) and single.columns == docs.columns

    near = steps["n-gram Jaccard join"](spark, single, str(tmp_path))
    want = {c for _, _, c, _ in near_groups([(r.doc_id, r.text) for r in single.collect()])}
    assert {r.doc_id for r in near.collect()} == want and near.columns == docs.columns

    mixed = steps["mixing sources to target weights"](spark, near, str(tmp_path))
    copies = {r.doc_id: r.copies for r in mixing.mix(near).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(copies) and mixed.columns == docs.columns

    final = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r.doc_id for r in final.collect()) == Counter(copies)
    assert final.filter(F.col("n_tokens") > 0).count() == sum(copies.values())
