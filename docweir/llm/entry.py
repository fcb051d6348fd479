"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from docweir.llm.token_files import token_file_digest, write_token_files
    from docweir.storage import new_path

    path = new_path(spark, "token-files")
    write_token_files(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_file_digest(spark, path)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.sharding import shard_documents

    return shard_documents(_documents(spark, sf_dir))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from docweir.llm.bpe import bpe_round_trip

    return bpe_round_trip(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.exact_dedup import exact_dedup

    return exact_dedup(_documents(spark, sf_dir)).drop("row_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.toxicity import score_documents

    return score_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.simhash import simhash_groups

    return simhash_groups(_documents(spark, sf_dir)).drop("component", "row_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from docweir.llm.token_counts import token_counts

    return token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.embedding_dedup import embedding_groups

    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("row_id")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.quality import score_documents

    return score_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from docweir.llm.packing import pack_documents

    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.source_divergence import source_divergence

    return source_divergence(_documents(spark, sf_dir))


def op12_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from docweir.llm.tiered_packing import pack_documents_in_tiers

    return pack_documents_in_tiers(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweir.llm.hard_negatives import hard_negatives

    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("anchor_row", "place")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_sharding": op2_sharding,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_tiered_packing": op12_tiered_packing,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM t
        WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id NULLS LAST)
    """,
    "op11_source_divergence": r"""
        WITH t AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), kept AS (
            SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM t) GROUP BY ALL HAVING count(*) >= 30
        ), v AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY ALL
        ), groups AS (
            SELECT DISTINCT lang, source FROM t
        ), occurring AS (
            SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM t) SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), dense AS (
            SELECT lang, source, term, coalesce(n, 0) AS n, v
            FROM groups JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN occurring USING (lang, source, term)
        ), shares AS (
            SELECT *, CAST(1 + CAST(n + 5 AS HUGEINT) * 1000000000 // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS BIGINT) AS p
            FROM dense
        ), whole AS (
            SELECT lang, term, CAST(1 + CAST(n + 5 AS HUGEINT) * 1000000000 // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS BIGINT) AS q
            FROM (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM dense GROUP BY lang, term)
        ), apart AS (
            SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        ), every_one AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every_one)
        WHERE part = 'pair' OR rank <= 50
    """,
    "op13_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS item, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, item AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, item) <= 5
        )
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, item AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, item)
        QUALIFY row_number() OVER w <= 3
    """,
}
