"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import (
    byte_bpe,
    collocations,
    conversation_repair,
    embedding_dedup,
    exact_dedup,
    hmm_lm,
    html_text,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    quality,
    suffix_dedup,
)
from basketlens.llm.common import documents

#: The vocabulary file of the encoder; a path that Spark can read.
RANK_FILE = "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken")


def remainder(modulus: int):
    """crc32 of the id as text, by modulus: which documents are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(documents(spark, sf_dir).select("doc_id", "text"), keep="largest")
    return found.select("doc_id", *exact_dedup.RESULTS)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op4_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", (remainder(7) == 2).alias("held_out"), "text")
    return hmm_lm.score(docs, ~F.col("held_out"), carry=["doc_id", "held_out"])


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), carry=["doc_id"])
    return found.drop("kept")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.train(docs, remainder(3) != 1)
    return language_id.predict(
        docs.select("doc_id", (remainder(3) == 1).alias("held_out"), "text"), model).drop("text")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(spark, RANK_FILE)
    both = byte_bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", *byte_bpe.digests())


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(documents(spark, sf_dir).select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"), carry=["doc_id"])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs.select("doc_id", "text"), quality.learn(docs)).drop("text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir).select("lang", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    repair = conversation_repair.Repair(conversation_repair.damage(turns))
    figures, digests = repair.figures(), conversation_repair.digests(repair.edits())
    same = F.col("conv").eqNullSafe(F.col("conv_id"))
    found = turns.select("conv_id").distinct().join(figures, same, "left").drop("conv").join(digests, same, "left").drop("conv")
    return found.select(
        "conv_id", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return embedding_dedup.near_vectors(vectors, carry=["vec_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_html_text": op3_html_text,
    "op4_hmm_lm": op4_hmm_lm,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_language_id": op6_language_id,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_embedding_dedup": op13_embedding_dedup,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op9_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS print
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS weight
            FROM sized GROUP BY source),
        lined AS (
            SELECT *, sum(3.0::DOUBLE * source_size) OVER before AS stopped, sum(weight) OVER after AS open_weight,
                   sum(source_size) OVER () AS total
            FROM sources
            WINDOW before AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   after AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        share AS (
            SELECT arg_min((total::DOUBLE - coalesce(stopped, 0)) / open_weight, 3.0 * source_size / weight) FILTER (
                       (total::DOUBLE - coalesce(stopped, 0)) / open_weight * weight <= 3.0::DOUBLE * source_size) AS share
            FROM lined),
        targets AS (
            SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * share) AS target,
                   CASE WHEN source_size > 0 THEN least(3.0::DOUBLE * source_size, weight * share) / source_size ELSE 0 END AS rate,
                   ('0x' || substr(md5('mix/' || coalesce(source, '')), 1, 15))::BIGINT::DOUBLE / 1152921504606846976.0::DOUBLE AS start
            FROM sources, share),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, print, doc_id) - 1 AS place FROM sized),
        mixed AS (
            SELECT doc_id, size, source_size, target,
                   CAST(floor(rate) + floor(start + (rate - floor(rate)) * (place + 1))
                        - floor(start + (rate - floor(rate)) * place) AS BIGINT) AS copies
            FROM ranked JOIN targets ON ranked.source IS NOT DISTINCT FROM targets.source)
        SELECT *, copies * size AS taken FROM mixed""",
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        spoken AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM spoken GROUP BY lang),
        placed AS (
            SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
            FROM spoken, (VALUES (1), (2), (3), (4)) size(k) WHERE len(ws) >= k),
        counted AS (
            SELECT lang, ws[i:i + k - 1] AS g, any_value(k) AS k, count(*) AS f FROM placed GROUP BY lang, ws[i:i + k - 1] HAVING count(*) >= 30),
        inner_parts AS (
            SELECT lang, f, g, k, m, unnest(generate_series(1, k - m + 1)) AS i
            FROM counted, (VALUES (2), (3)) size(m) WHERE m < k),
        around AS (SELECT lang, g[i:i + m - 1] AS g, max(f) AS f FROM inner_parts GROUP BY lang, g[i:i + m - 1]),
        kept AS (
            SELECT c.lang, c.g, c.k, c.f AS a FROM counted c LEFT JOIN around o ON o.lang = c.lang AND o.g = c.g
            WHERE c.k > 1 AND (o.f IS NULL OR 100::HUGEINT * o.f < 80::HUGEINT * c.f)),
        cuts AS (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM kept),
        scored AS (
            SELECT c.*, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
            FROM cuts c JOIN counted x ON x.lang = c.lang AND x.g = c.g[1:cut]
                        JOIN counted y ON y.lang = c.lang AND y.g = c.g[cut + 1:c.k]),
        best AS (
            SELECT *, array_to_string(g, ' ') AS phrase FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
        JOIN totals USING (lang) WHERE rank <= 2000""",
    "op12_conversation_repair": r"""
        WITH RECURSIVE fated AS (
            SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(4294967295, list_reduce(
                       list_concat([4294967295::BIGINT], list_transform(string_split(
                           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                           lambda x: CAST(unicode(x) AS BIGINT))),
                       lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                             lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS fate
            FROM conversations),
        damaged AS (
            SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                   CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM fated, range(2) r(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) - 1 AS rank,
                   regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail
            FROM damaged),
        lines AS (
            SELECT *, left(role, 1) AS letter, CASE
                       WHEN tail = '' THEN 1
                       WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY rank) > 1 THEN 2
                       WHEN tail NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY rank) AS before
            FROM ranked),
        figures AS (
            SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                   count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
            FROM lines GROUP BY conv),
        -- Cost, edits and repaired lines of the best way to each state, turn by turn.
        ways AS (
            SELECT conv, 0 AS i, {'c': 0, 'e': '', 't': ''} AS q, NULL::STRUCT(c INTEGER, e VARCHAR, t VARCHAR) AS s,
                   NULL::STRUCT(c INTEGER, e VARCHAR, t VARCHAR) AS u, NULL::STRUCT(c INTEGER, e VARCHAR, t VARCHAR) AS a
            FROM figures
            UNION ALL
            SELECT conv, i + 1,
                   {'c': q.c + 3, 'e': q.e || 'D', 't': q.t},
                   list_sort(list_filter([
                       CASE WHEN s IS NOT NULL THEN {'c': s.c + 3, 'e': s.e || 'D', 't': s.t} END,
                       CASE WHEN letter = 's' AND sound THEN {'c': q.c + more, 'e': q.e || 'K', 't': q.t || line} END],
                       lambda x: x IS NOT NULL))[1],
                   list_sort(list_filter([
                       {'c': u.c + 3, 'e': u.e || 'D', 't': u.t},
                       CASE WHEN letter = 'u' AND sound THEN {'c': q.c + more, 'e': q.e || 'K', 't': q.t || line} END,
                       CASE WHEN letter = 'u' AND sound AND s IS NOT NULL THEN {'c': s.c + more, 'e': s.e || 'K', 't': s.t || line} END,
                       CASE WHEN letter = 'u' AND sound THEN {'c': a.c + more, 'e': a.e || 'K', 't': a.t || line} END,
                       CASE WHEN sound THEN {'c': q.c + 2 + more, 'e': q.e || 'R', 't': q.t || chr(10) || 'user:' || text} END,
                       CASE WHEN sound AND s IS NOT NULL THEN {'c': s.c + 2 + more, 'e': s.e || 'R', 't': s.t || chr(10) || 'user:' || text} END,
                       CASE WHEN sound THEN {'c': a.c + 2 + more, 'e': a.e || 'R', 't': a.t || chr(10) || 'user:' || text} END],
                       lambda x: x IS NOT NULL))[1],
                   list_sort(list_filter([
                       {'c': a.c + 3, 'e': a.e || 'D', 't': a.t},
                       CASE WHEN letter = 'a' AND sound THEN {'c': u.c + more, 'e': u.e || 'K', 't': u.t || line} END,
                       CASE WHEN sound THEN {'c': u.c + 2 + more, 'e': u.e || 'R', 't': u.t || chr(10) || 'assistant:' || text} END],
                       lambda x: x IS NOT NULL))[1]
            FROM (
                SELECT w.conv, w.i, w.q, w.s, w.u, list_sort(list_filter([w.a0,
                           {'c': w.u.c + 2, 'e': w.u.e || 'I', 't': w.u.t || chr(10) || 'assistant:'}], lambda x: x IS NOT NULL))[1] AS a,
                       l.letter, l.text, l.fault IN (0, 3) AS sound, CAST(l.fault = 3 AS INTEGER) AS more,
                       chr(10) || l.role || ':' || l.text AS line
                FROM (
                    SELECT conv, i, q, s, a AS a0, list_sort(list_filter([u,
                               {'c': q.c + 2, 'e': q.e || 'I', 't': q.t || chr(10) || 'user:'},
                               CASE WHEN s IS NOT NULL THEN {'c': s.c + 2, 'e': s.e || 'I', 't': s.t || chr(10) || 'user:'} END,
                               CASE WHEN a IS NOT NULL THEN {'c': a.c + 2, 'e': a.e || 'I', 't': a.t || chr(10) || 'user:'} END],
                               lambda x: x IS NOT NULL))[1] AS u
                    FROM ways) w
                JOIN lines l ON l.conv IS NOT DISTINCT FROM w.conv AND l.rank = w.i)),
        repaired AS (
            SELECT w.conv, list_sort(list_filter([q, a,
                       CASE WHEN u IS NOT NULL THEN {'c': u.c + 2, 'e': u.e || 'I', 't': u.t || chr(10) || 'assistant:'} END,
                       CASE WHEN s IS NOT NULL THEN
                           {'c': s.c + 4, 'e': s.e || 'II', 't': s.t || chr(10) || 'user:' || chr(10) || 'assistant:'} END],
                       lambda x: x IS NOT NULL))[1] AS best
            FROM ways w JOIN figures f ON f.conv IS NOT DISTINCT FROM w.conv AND f.n = w.i)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
               coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN figures f ON f.conv IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN repaired r ON r.conv IS NOT DISTINCT FROM o.conv_id""",
    "op13_embedding_dedup": """
        WITH RECURSIVE sound AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
        reach AS (
            SELECT vec_id AS id, vec_id AS other FROM embeddings
            UNION SELECT id, y FROM reach JOIN links ON other = x),
        counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT id AS vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, id = min(other) AS kept
        FROM reach LEFT JOIN counted ON id = x GROUP BY id""",
}
