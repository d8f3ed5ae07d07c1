"""Page text, language, language model, encoding, quality, licenses and mixing."""

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import SCHEMA, base_scores, corpus, quality_counts, remainder, targets, words
from pyspark.sql import functions as F

from basketlens.llm import byte_bpe, hmm_lm, html_text, language_id, license_scan, mixing, quality
from basketlens.llm.text_arrays import chunks, words as array_words


@pytest.fixture(scope="module")
def rows():
    return corpus(seed=9)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def test_words_of_chunks(rows):
    import pyarrow as pa

    column = pa.array([r[1] for r in rows])
    seen = {}
    for chunk in chunks(column, 2000):
        found = array_words(chunk)
        for i in range(len(chunk)):
            part = found.of(i)
            text = rows[chunk.first + i][1]
            cut = [chunk.data[a:b].tobytes().decode() for a, b in zip(found.starts[part], found.ends[part])]
            assert cut == words(text, lower=False)
            for word, h in zip(cut, found.hashes[part].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


# -- main text -----------------------------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="top"><a href="/">Home of the site</a></header><nav><ul><li><a href="/a">One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site to make it better for everybody who comes here to read things.</p></div>
<main><h1>Title &amp; more</h1><p>First  paragraph of the\n story with <b>bold</b> words and <a href="x">one link</a> in it, long enough to read.
<p>Second &lt;p&gt; paragraph.<br>Line two</p><ul><li>A point that the story makes</li></ul>
<div class="ad">Buy this now, it is the best of all things that you ever saw in your whole life, really it is.</div>
<p>Third one.</p></main><aside class="sidebar"><p>Other stories that you may want to read because they are so very good and long as well.</p></aside>
<form><p>Your name please</p><input name=a></form><section id="comments"><p>I think that this is a story that I liked a lot when I read it.</p></section>
<footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_blocks(PAGE)[0] == [
        "Title & more", "First paragraph of the story with bold words and one link in it, long enough to read.",
        "Second <p> paragraph. Line two", "A point that the story makes", "Third one."]


def test_main_text_without_marked_article():
    page = ("<body><div class='menu'><a>One</a> <a>Two</a></div><div class='c1'>" + "<p>" + "Some words of a story that goes on. " * 4
            + "</p><p>Short.</p><p>" + "More of this story, told at length here. " * 4 + "</p></div><div class='footer'>Imprint</div>")
    assert [t[:9] for t in html_text.main_blocks(page)[0]] == ["Some word", "Short.", "More of t"]


@pytest.mark.parametrize("page", ["", "<", "<p", "<!-- open", "<script>x", "no markup", "<p a='x>y", "</div></p>", "<a<b>c", "&#0;&bad;"])
def test_broken_pages_do_not_fail(page):
    html_text.main_blocks(page)


def test_minimum_cut_against_all_labellings():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        joined = [(a, b, rng.uniform(0, 1.5)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(side):
            return (sum(abs(s) for s, x in zip(scores, side) if (s > 0) != x)
                    + sum(w for a, b, w in joined if side[a] != side[b]))

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_text.minimum_cut(scores, joined)) == pytest.approx(best)


def test_extract_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (3, "u", "", "y"), (4, "u", "<nav>Menu</nav>", "z")],
        "page_id long, url string, html string, n_chars string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", *html_text.RESULTS]
    found = sorted((r.page_id, len(r.text), r.n_chars) for r in got.collect())
    assert found[0] == found[1] and found[0][1] == found[0][2] > 100
    assert found[2:] == [(2, 0, 0), (3, 0, 0), (4, 0, 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


# -- encoding ------------------------------------------------------------------------------------------------------------


def test_encoding_equals_the_merges(spark, docs, rows, ranks):
    own = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(4)
    texts = ["".join(rng.choice("abé漢🙂0 \n'ths_<|>") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += ["a" * 4000, "ab" * 2000, " " * 3000 + "x", "🙂" * 900, "<|endoftext|>", "thethethe" * 300]
    for text in texts:
        assert own.encode(text) == other.encode_ordinary(text)
    both = byte_bpe.decode(byte_bpe.encode(docs.withColumn("IDS", F.lit(1)), ranks, public_tokenizers.PATTERN), ranks,
                           public_tokenizers.PATTERN).select("doc_id", "text", "ids", "decoded", *byte_bpe.digests())
    got = both.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    for r in got:
        ids = other.encode_ordinary(r.text or "")
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == (r.text or "").encode()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert byte_bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    once = byte_bpe.round_trip(docs.withColumn("IDS", F.lit(1)), ranks, public_tokenizers.PATTERN)
    assert once.columns == ["doc_id", "lang", "source", "ids", "decoded"]
    assert Counter(map(str, once.select("doc_id", *byte_bpe.digests()).collect())) == Counter(
        map(str, both.select("doc_id", *byte_bpe.digests()).collect()))
    assert byte_bpe.round_trip(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_pairs_of_tokens_are_decided_as_the_merges_do(ranks):
    own = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng = random.Random(7)
    tokens, none = list(own.ranks), len(own.ranks)
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(20000)]
    pairs += [(t[:k], t[k:]) for t in rng.sample(tokens, 4000) for k in range(1, len(t)) if t[:k] in own.ranks and t[k:] in own.ranks]
    seen = set()
    for before, token in pairs:
        want = own.merged(before + token, none) == [before, token]
        assert own.may_follow(before, token) == want
        seen.add(want)
    assert seen == {True, False}


# -- quality -------------------------------------------------------------------------------------------------------------


def test_quality_counts_and_rules(docs, rows):
    got = quality.judge(docs.withColumn("kept", F.lit(3)), quality.learn(docs)).collect()
    want = defaultdict(list)
    for r in rows:
        want[(r[0], r[1])].append(quality_counts(r[1]))
    assert len(got) == len(rows)
    for r in got:
        counts = want[(r.doc_id, r.text)][0]
        assert tuple(r[c] for c in quality.COUNTS) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)


def test_quality_rejects_what_no_language_looks_like(spark):
    rng = random.Random(3)
    common = "the of and to in that is was he for it with as his on be at by".split()
    rare = ["".join(rng.choice("abcdefghilmnoprstuw") for _ in range(7)) for _ in range(3000)]

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(n)) + "."

    rows = [(i, prose(200), "en") for i in range(60)]
    rows += [(100, " ".join("#$%*" + w + "***" for w in prose(150).split()), "en"), (101, " ".join(rng.choice(rare) for _ in range(300)), "en"),
             (102, prose(12), "en"), (103, prose(80), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.judge(docs, quality.learn(docs)).filter("kept").collect()}
    assert kept == {*range(60), 102, 103}
    assert quality.judge(docs.limit(0), quality.learn(docs.limit(0))).count() == 0


def test_distance_is_zero_to_one():
    p, q = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]]), np.array([0.5, 0.5, 0.0])
    assert quality.distance(p, q).tolist() == pytest.approx([0.0, 1.0])


# -- mixing --------------------------------------------------------------------------------------------------------------


def test_mix_meets_targets(docs, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = targets(sizes)
    got = mixing.mix(docs.withColumn("size", F.lit("x"))).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == len(words(r.text)) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for source in sizes:
        largest = max(len(words(r[1])) for r in rows if r[3] == source)
        assert abs(taken[source] - want[source]) <= largest
    again = mixing.mix(docs.repartition(2)).select("doc_id", "text", "copies").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.text, r.copies) for r in got)


def test_mix_rows_and_empty(spark, docs):
    copies = {(r.doc_id, r.text): r.n for r in mixing.mix(docs).groupBy("doc_id", "text").agg(F.sum("copies").alias("n")).collect() if r.n}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(copies)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert [r.target for r in mixing.mix(spark.createDataFrame([(1, None, "a")], "doc_id long, text string, source string")).collect()] == [0.0]


# -- language ------------------------------------------------------------------------------------------------------------


def _languages(n, seed=0):
    rng = random.Random(seed)
    letters = {"aa": "abcde ", "bb": "cdefg ", "cc": "aeiouß "}
    return [(i, "".join(rng.choice(letters[lang]) for _ in range(rng.randint(20, 200))), lang)
            for i, lang in enumerate(itertools.islice(itertools.cycle(letters), n))]


def test_language_held_out_accuracy(spark):
    rows = _languages(900) + [(1000, None, "aa"), (1001, "123 .. ", "bb"), (1002, "", "cc"), (1003, "abc", None), (1004, "²³ ①", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    settings = language_id.Settings(sample=400, calibration=100)
    model = language_id.train(docs, F.crc32(F.col("doc_id").cast("string")) % 3 != 1, settings=settings)
    assert (model.weights == 0).mean() > 0.5
    got = {r.doc_id: r for r in language_id.predict(docs, model, settings=settings).collect()}
    held = [r for r in rows if r[2] and r[0] < 1000 and remainder(r[0], 3) == 1]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1004)] == ["und"] * 4
    again = language_id.train(docs.repartition(7), F.crc32(F.col("doc_id").cast("string")) % 3 != 1, settings=settings)
    assert np.array_equal(model.weights, again.weights)


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language_id.train(docs, F.lit(True)) is None
    assert [r.lang_pred for r in language_id.predict(docs, None).collect()] == ["und"]
    assert language_id.predict(docs.limit(0), None).count() == 0


def test_calibration_softens_wrong_confidence():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 400)
    logits = np.zeros((400, 2))
    logits[np.arange(400), np.where(rng.random(400) < 0.8, labels, 1 - labels)] = 10.0
    assert language_id.calibrate(logits, labels) == pytest.approx(10 / math.log(4), rel=0.2)


# -- language model ------------------------------------------------------------------------------------------------------

SMALL = hmm_lm.Settings(head=60, classes=8, states=3, rounds=2, segment=16, grouped=30)


def test_base_scores(spark, docs, rows):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    got = hmm_lm.score(docs, ~held, settings=SMALL, carry=["doc_id", "text"]).collect()
    want = defaultdict(list)
    for r, s in zip(rows, base_scores(rows, lambda r: remainder(r[0], 7) == 2)):
        want[(r[0], r[1])].append(s)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    for r in got:
        n, known, total, base = want[(r.doc_id, r.text)][0]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_forward_equals_the_sum_over_paths():
    rng = np.random.default_rng(1)
    emits = rng.random((5, 2))
    model = hmm_lm.Model(np.array([0.3, 0.7]), np.array([[0.9, 0.1], [0.4, 0.6]]), emits / emits.sum(axis=0))
    texts = [np.array([0]), np.array([1, 2, 4, 0, 3]), np.array([2, 2])]
    for text, got in zip(texts, hmm_lm.likelihoods(texts, model)):
        total = 0.0
        for path in itertools.product(range(2), repeat=len(text)):
            p = model.start[path[0]] * model.emits[text[0], path[0]]
            for (a, b), symbol in zip(zip(path, path[1:]), text[1:]):
                p *= model.moves[a, b] * model.emits[symbol, b]
            total += p
        assert got == pytest.approx(math.log(total))


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(2)
    emits = rng.random((6, 2))
    model = hmm_lm.Model(np.array([0.5, 0.5]), np.array([[0.8, 0.2], [0.3, 0.7]]), emits / emits.sum(axis=0))
    texts = [rng.integers(0, 3, 20) if i % 2 else rng.integers(3, 6, rng.integers(5, 20)) for i in range(30)]
    table = np.full((30, 20), -1)
    for i, t in enumerate(texts):
        table[i, :len(t)] = t
    before = hmm_lm.likelihoods(texts, model).sum()
    for _ in range(4):
        counts, moves, start = hmm_lm.expected_counts(table.T, model)
        assert counts.sum() == pytest.approx(sum(map(len, texts))) and start.sum() == pytest.approx(30)
        assert moves.sum() == pytest.approx(sum(map(len, texts)) - 30)
        model = hmm_lm.Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), counts / counts.sum(axis=0))
        after = hmm_lm.likelihoods(texts, model).sum()
        assert after >= before - 1e-9
        before = after


def test_model_without_training_rows(docs):
    got = hmm_lm.score(docs.limit(5), F.lit(False), settings=SMALL).collect()
    assert all(r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in got)
    assert hmm_lm.score(docs.limit(0), F.lit(True), settings=SMALL).count() == 0


# -- licenses ------------------------------------------------------------------------------------------------------------


def test_licenses_are_found_in_place(spark):
    filler = " ".join(f"word{i}" for i in range(70))
    notice = "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, f"{filler} {notice} {filler}"), (2, "Licensed under CC BY-NC 4.0."), (3, filler), (4, None), (5, ""),
            (6, f"{notice} {filler} {notice}"), (7, "(c) x. All\nrights reserved."), (8, "Released under the Mit license, this"),
            (9, "the license was released to all the rights of the public")]
    got = defaultdict(list)
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].append((r.license, r.start_word, r.end_word))
    assert got == {1: [("GPL", 70, 82)], 2: [("CC-BY-NC", 0, 5)], 6: [("GPL", 0, 12), ("GPL", 82, 94)],
                   7: [("reserved", 2, 5)], 8: [("MIT", 0, 5)]}


def test_full_notices_with_changed_words():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.MIN_COVERAGE)
    for name, text in license_scan.TEMPLATES.items():
        found = text.split()
        if len(found) > 20:
            found[5], found[15] = "changed", "also"
            hits = scanner.scan("before this " + " ".join(found) + " and after it")
            assert [h[0] for h in hits] == [name] and hits[0][1] >= 0.9


def test_alignment_is_increasing_and_equal():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))]
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert license_scan.align(list("xxabcyy"), list("abc")) == [(2, 0), (3, 1), (4, 2)]
