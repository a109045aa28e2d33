"""A training-data pipeline over ``documents``: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return the columns of
``documents``; the last adds the piece ids and the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trellis.llm import decontam, pieces, pii, queries, quality, simhash
from trellis.llm.common import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_quality(docs, queries.quality_model(spark, sf_dir, docs), queries.QUALITY_THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest doc_id stays."""
    return simhash.near_dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, reordered or not, go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars stays that of the source text."""
    return pii.replace_pii(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents, their piece ids and the text decoded from them."""
    return pieces.with_pieces(docs, queries.tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("SentencePiece encoding and decoding", pieces_stage),
]

#: SQL has no hashed learner, fingerprint or tokenizer.  The tests compare each stage's operator with plain Python on
#: fixtures, but of run() only what every result must have (unique ids, decoded text, no benchmark text left).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{k}")
    return docs
