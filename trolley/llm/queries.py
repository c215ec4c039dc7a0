"""One query per operator, each over a whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import bpe, exact_dedup, fim, jaccard_join, language_id, license_scan, mixing, phrases, pii, quality_rules, top_k, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(table(spark, folder, "documents"))
    counts = [F.col("counts")[i].alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, "spans")


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


ORACLES["op3_warc"] = """
WITH payloads AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM firsts
"""


@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(table(spark, folder, "documents"))


@query
def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = top_k.whole_components(table(spark, folder, "embeddings"))
    return top_k.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


ORACLES["op5_top_k"] = """
WITH vectors AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents"))


@query
def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


ORACLES["op9_exact_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
    FROM documents
), chosen AS (
    SELECT doc_id, norm,
           first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id NULLS LAST) AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size
    FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM chosen
"""


@query
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(table(spark, folder, "documents")).select("doc_id", *bpe.digests())


@query
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    examples = fim.fill_in_middle(table(spark, folder, "documents"))
    return examples.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *fim.digests())


ORACLES["op11_fill_in_middle"] = r"""
WITH tokens AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS parts,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), drawn AS (
    SELECT doc_id, text, parts, CAST(len(parts) AS BIGINT) AS n,
           CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(parts) + 1) AS cut1,
           CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(parts) + 1) AS cut2,
           CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS plain_draw,
           CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS order_draw
    FROM tokens
), cut AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR plain_draw >= 90 THEN 'plain'
                WHEN order_draw < 20 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(parts[1 : least(cut1, cut2)], '') AS prefix,
           array_to_string(parts[least(cut1, cut2) + 1 : greatest(cut1, cut2)], '') AS middle,
           array_to_string(parts[greatest(cut1, cut2) + 1 : n], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


@query
def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def _quality_sql() -> str:
    """The rules and cutoffs as SQL; policies are proven by the same binomial test."""
    rejects = [
        " OR ".join(f"100 * {part} > {quality_rules.CUTOFFS[rule][j]} * {whole}" for rule, (part, whole) in quality_rules.RULES.items())
        for j in range(quality_rules.POLICIES)
    ]
    level = " ".join(f"WHEN {r} THEN {j + 1}" for j, r in enumerate(rejects))
    risk, most = quality_rules.RISK, quality_rules.POLICIES
    return rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS text FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM texts
), windows AS (
    SELECT r, i, array_to_string(words[i : i + 7], ' ') AS phrase
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM worded)
), again AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, phrase) > 1
), covered AS (
    SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, unnest(range(i, i + 8)) AS place FROM again) GROUP BY r
), measured AS (
    SELECT doc_id, stratum, md5(text) AS digest,
           CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           len(lines) AS n_lines,
           len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
           len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters,
           len(regexp_extract_all(text, '[!?]')) AS n_marks
    FROM worded LEFT JOIN covered USING (r)
), levelled AS (
    SELECT *, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed,
           CASE {level} ELSE {most + 1} END AS level
    FROM measured
), good AS (
    SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL
    GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1
), held AS (
    SELECT DISTINCT stratum, digest, level FROM levelled JOIN good USING (doc_id)
    WHERE NOT base_failed
      AND CAST('0x' || substr(md5('{quality_rules.AUDIT_SEED}|' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % {quality_rules.AUDIT_SHARE} <> 0
), counted AS (
    SELECT stratum, j, count(*) AS n, count(*) FILTER (level <= j) AS k
    FROM held, range(1, {most + 1}) AS p(j) GROUP BY stratum, j
), tested AS (
    SELECT stratum, j, k < {risk} * n AND
           (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))
            FROM range(0, k + 1) AS t(i)) <= {quality_rules.DELTA} / (SELECT count(DISTINCT stratum) FROM levelled) AS proven
    FROM counted
), chosen AS (
    SELECT stratum, coalesce(min(j) FILTER (NOT proven) - 1, {most}) AS policy FROM tested GROUP BY stratum
)
SELECT doc_id, {", ".join(quality_rules.BASE)}, base_failed,
       NOT base_failed AND level > coalesce(policy, 0) AS kept
FROM levelled LEFT JOIN chosen USING (stratum)
"""


ORACLES["op12_quality_rules"] = _quality_sql()


@query
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


ORACLES["op13_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, regexp_extract_all(part, '[^\x20\x09]+') AS words
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS part
        FROM documents
    )
), places AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), counts AS (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, CAST(count(*) AS BIGINT) AS f
    FROM places, (VALUES (1), (2), (3)) AS s(size)
    WHERE i + size - 1 <= len(words)
    GROUP BY ALL
), sizes AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS parts FROM counts WHERE size > 1 AND f >= 10
), longer AS (
    SELECT lang, phrase, max(a) AS most
    FROM (SELECT lang, a, unnest([array_to_string(parts[1:2], ' '), array_to_string(parts[2:3], ' ')]) AS phrase
          FROM candidates WHERE size = 3)
    GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, a, k, h.f AS l, t.f AS r,
           CAST(1000000 AS HUGEINT) * a * a // (CAST(h.f AS HUGEINT) * t.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counts h ON h.lang = c.lang AND h.phrase = array_to_string(c.parts[1:k], ' ')
    JOIN counts t ON t.lang = c.lang AND t.phrase = array_to_string(c.parts[k + 1 : c.size], ' ')
    LEFT JOIN longer o ON o.lang = c.lang AND o.phrase = c.phrase
    WHERE coalesce(100 * o.most < 50 * a, TRUE)
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang)
WHERE rank <= 2000
"""
