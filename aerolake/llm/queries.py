"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import (
    ann, decontam, extract, langid, licenses, mixing, neardup, periodic, secrets, token_records,
    toxicity, warc, whitening,
)
from aerolake.llm.common import table


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of each document."""
    return mixing.words_taken(mixing.mix(table(spark, sf_dir, "documents")))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of all pages, written and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of all documents with benchmark items."""
    found = decontam.contaminated(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "benchmark"))
    return found.drop("digest")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    classes = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size")


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents in binary records, written and read back."""
    return token_records.encode_to_records(table(spark, sf_dir, "documents"),
                                           token_records.default_tokenizer())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return (extract.extract(table(spark, sf_dir, "pages"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned once for each distinct text."""
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities and decision for every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every vector.

    ``deviation`` is null where it exceeds a long (``whitening.whiten`` has all its digits).
    """
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.col("deviation").try_cast("bigint"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    return periodic.report_runs(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_warc, op3_decontamination, op4_near_duplicates, op5_token_records,
    op6_language_id, op7_html_text, op8_secret_scan,
    op9_nearest, op10_toxicity, op11_whitening, op12_licenses, op13_periodic_runs)}


def licenses_sql() -> str:
    """op12 in SQL: counts words block by block, without any filter of candidates."""
    quoted = lambda *values: "(" + ", ".join(f"'{v}'" for v in values) + ")"
    templates = ", ".join(quoted(i, *t) for i, t in enumerate(licenses.TEMPLATES))
    return f"""
    WITH texts AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
      FROM documents),
    words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM texts),
    following AS (
      SELECT r, pos, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2
      FROM words WINDOW o AS (PARTITION BY r ORDER BY pos)),
    base AS (
      SELECT r, pos, CASE WHEN w = 'cc' AND w1 = 'by' THEN 'cc-by'
        WHEN w = 'general' AND w1 = 'public' AND w2 = 'license' THEN 'gpl'
        WHEN w = 'all' AND w1 = 'rights' AND w2 = 'reserved' THEN 'reserved' END AS label
      FROM following),
    base_rows AS (
      SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM base WHERE label IS NOT NULL GROUP BY r),
    given(id, label, t) AS (VALUES {templates}),
    template_words AS (
      SELECT id, label, unnest(regexp_extract_all(lower(t), '[a-z0-9]+')) AS w FROM given),
    longest AS (
      SELECT max(n) AS step FROM (SELECT count(*) AS n FROM template_words GROUP BY id)),
    template_sets AS (SELECT DISTINCT id, label, w FROM template_words),
    sizes AS (SELECT id, count(*) AS size FROM template_sets GROUP BY id),
    block_words AS (
      SELECT DISTINCT w.r, w.w, unnest([
        greatest(least(pos // step, greatest((len(ws) + step - 1) // step - 2, 0) + 1) - 1, 0),
        least(pos // step, greatest((len(ws) + step - 1) // step - 2, 0))]) AS block
      FROM words w JOIN texts USING (r), longest WHERE w.w IN (SELECT w FROM template_sets)),
    hits AS (
      SELECT r, label, count(*) / any_value(size) AS score
      FROM block_words JOIN template_sets USING (w) JOIN sizes USING (id)
      GROUP BY r, block, id, label
      HAVING count(*) >= ceil({licenses.THRESHOLD} * any_value(size) - 1e-9)),
    best AS (SELECT r, max(score) AS score FROM hits GROUP BY r),
    labelled AS (
      SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
        (SELECT r, label FROM base WHERE label IS NOT NULL UNION SELECT r, label FROM hits) GROUP BY r),
    base_labelled AS (
      SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base
      WHERE label IS NOT NULL GROUP BY r)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
      CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
      coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
      CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.score, 0)::DOUBLE END AS score
    FROM texts LEFT JOIN base_rows USING (r) LEFT JOIN best USING (r)
      LEFT JOIN labelled l USING (r) LEFT JOIN base_labelled b USING (r)
    """


ORACLE_SQL: dict[str, str] = {
    # the row of the largest page_id of an equal payload of 1000 bytes and more is the response
    "op2_warc": """
    WITH p AS (
      SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest
      FROM pages),
    q AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS latest FROM p)
    SELECT page_id, url, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
      CASE WHEN n >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN n >= 1000 AND page_id < latest THEN latest END AS refers_to
    FROM q""",
    "op12_licenses": licenses_sql(),
}
