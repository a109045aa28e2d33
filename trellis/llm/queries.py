"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm import decontam, digest, langid, pii, pieces, quality, simhash, suffixes, tokens, urls

TOKEN_LIMIT = 1024
QUALITY_THRESHOLD = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(parts: int):
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), TOKEN_LIMIT)


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.FactorisationMachine:
    """Fitted on rows outside the held-out fold only."""
    return quality.fit(docs, _table(spark, sf_dir, "labels").filter(_fold(5) != 0))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, sf_dir, docs), QUALITY_THRESHOLD)
    return scored.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip_digest(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    trees = langid.fit(docs.filter(_fold(4) != 2))
    out = langid.predict(docs, trees)
    return out.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(_table(spark, sf_dir, "pages"), urls.RULES)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogate_digest(_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_bytes(_table(spark, sf_dir, "documents"))


def op10_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.document_digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_quality, op3_simhash, op4_pieces, op5_decontamination, op6_language, op7_url_filter, op8_pii, op9_suffix_dedup, op10_digest)
}

ORACLE_SQL: dict[str, str] = {
    "op7_url_filter": r"""
        WITH parsed AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), rules(verdict, rule, r_host, r_path) AS (
            VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
                   ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
                   ('block', 'com/de/', 'com', '/de/')
        )
        SELECT p.page_id, p.host, p.path,
               (SELECT r.rule FROM rules r WHERE (p.host = r.r_host OR ends_with(p.host, '.' || r.r_host)) AND starts_with(p.path, r.r_path)
                ORDER BY length(r.rule) DESC LIMIT 1) AS rule,
               coalesce((SELECT r.verdict FROM rules r WHERE (p.host = r.r_host OR ends_with(p.host, '.' || r.r_host)) AND starts_with(p.path, r.r_path)
                ORDER BY length(r.rule) DESC LIMIT 1), 'allow') AS verdict
        FROM parsed p
    """,
}
