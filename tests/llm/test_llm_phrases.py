"""Collocations against plain counting, and the double-array trie."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, text string, rank long, phrase string"


def plain(rows, least, top=2000):
    total, counts = Counter(), defaultdict(Counter)
    for lang, text, *_ in rows:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in range(1, 5):
                counts[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        around = Counter()
        for g, a in candidates.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    around[g[i:i + m]] = max(around[g[i:i + m]], a)
        found = []
        for g, a in candidates.items():
            if 100 * around[g] < 80 * a:
                score, _, left, right = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts(seed=8, n=300):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abCdéß漢🙂-") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    fixed = [[rng.choice(vocab) for _ in range(k)] for k in (2, 3, 4, 4, 6)]

    def text(size):
        out = []
        while len(out) < size:
            out += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice(vocab)]
            out[-1] += rng.choice(["", "", "", ".", ",", "!\n", "\r", "\x0b", "\t", "  "])
        return rng.choice(["", " ", ". "]) + " ".join(out)

    rows = [(rng.choice(["en", "en", "de", None, ""]), text(rng.choice([0, 1, 3, 40])), 1, "x") for _ in range(n)]
    rows += [("en", None, 1, "x"), (None, "", 2, None), ("fr", "x y", 1, None), ("en", text(20000), 1, "x")]
    return rows + rows[:40] + [rows[5]] * 20


@pytest.mark.parametrize("shard", [co.SHARD, 25])
def test_collocations_match_plain_counts(spark, monkeypatch, shard):
    monkeypatch.setattr(co, "SHARD", shard)
    rows = texts()
    got = co.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), least=8, top=50)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 8, 50)


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    a, both = 9_000_000_000_000_000_000, 9_000_000_000_000_000_000 + 7
    row = spark.range(1).select(
        F.expr(f"(cast(2000000 as decimal(10,0)) * cast({a} as decimal(20,0))) div (cast({both} as decimal(20,0)) + cast({a} as decimal(20,0)))").alias("v"))
    assert row.first().v == 2_000_000 * a // (both + a)


@pytest.mark.parametrize("rows", [[], [("en", None, 1, "x")], [("en", "one two", 1, "x")] * 3])
def test_nothing_frequent(spark, rows):
    assert co.collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_trie_holds_exactly_its_sequences():
    rng = np.random.default_rng(0)
    rows = np.unique(np.append(rng.integers(0, 40, (3000, 3)), rng.integers(0, 1 << 31, (500, 3)), axis=0), axis=0)
    made = co.phrase_trie(rows, np.arange(len(rows)))
    text = np.append(rng.integers(-1, 40, 20000), rows[:200].ravel())
    place = {tuple(r): i for i, r in enumerate(rows.tolist())}
    want = [place.get(tuple(text[i:i + 3].tolist()), -1) for i in range(len(text) - 2)] + [-1, -1]
    assert co.accepted(text, 3, made).tolist() == want


def test_words_by_their_bytes():
    words = ["a", "ab", "abc", "b", "é", "漢字", "-"]
    names, made = co.word_trie(pa.array(["x"] * 6 + ["y"]), pa.array(words), np.arange(7))
    asked = pa.array(["ab", "abcd", "", "漢字", "漢", "-", "é", "b"])
    assert co.find_words(asked, names["x"], made).tolist() == [1, -1, -1, 5, -1, -1, 4, 3]
    assert co.find_words(asked, names["y"], made).tolist() == [-1] * 5 + [6, -1, -1]
    assert co.find_words(asked, None, made).tolist() == [-1] * 8


def test_word_numbers_are_held_in_small_groups(spark, monkeypatch):
    """However large a task's part of the text is, a row group of its word numbers is small, and so is what a reader holds of it."""
    import glob

    import pyarrow.parquet as pq

    from basketlens.llm import collocations as co

    monkeypatch.setattr(co, "GROUP", 1 << 20)
    texts = [(f"{'abcd'[i % 4]} " + " ".join(f"w{(i * 7 + j * j) % 5003}" for j in range(20_000)),) for i in range(120)]
    docs = spark.createDataFrame(texts, "text string").selectExpr("'en' AS lang", "text").coalesce(1)
    words = [f"w{i}" for i in range(5003)]
    import numpy as np
    import pyarrow as pa

    ids = co._numbers(docs, [lambda: co.word_trie(pa.array(["en"] * 5003), pa.array(words).cast(pa.binary()), np.arange(5003))])
    groups = [pq.ParquetFile(f).metadata.row_group(g) for name in ids.inputFiles() for f in glob.glob(name.removeprefix("file://"))
              for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    # A group ends with the row that reaches the bound.
    assert max(g.total_byte_size for g in groups) <= 2 << 20 and sum(g.total_byte_size for g in groups) > 3 << 20
    assert ids.selectExpr("sum(size(filter(ids, i -> i >= 0))) AS n").first().n == 120 * 20_000
