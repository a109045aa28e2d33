"""The queries over whole tables leave no row out."""

from pyspark.sql import functions as F

from trellis.plans import text_queries
from trellis.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_dense_ids_of_all_documents(spark):
    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    got = {r["doc_id"]: r["dense_id"] for r in QUERIES["dense_ids_whole"](spark, SF).collect()}
    assert got == {i: f"DOC-{k:05d}" for k, i in enumerate(ids, 1)}


def test_dense_ids_of_six_digits(spark):
    out = text_queries._dense_ids(spark.range(100_002).select(F.col("id").alias("doc_id")))
    assert {r["dense_id"] for r in out.filter("doc_id >= 99998").collect()} == {"DOC-99999", "DOC-100000", "DOC-100001", "DOC-100002"}


def test_match_ratio_rows(spark):
    """Every supplier with a line is a row of the knowledge side."""
    suppliers = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_suppkey").distinct().count()
    assert QUERIES["match_ratio_whole"](spark, SF).select("row_id").distinct().count() == suppliers


def test_review_and_tiers_of_all_rows(spark):
    merged = QUERIES["review_merge_whole"](spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert sorted(r["o_orderkey"] for r in merged.collect()) == sorted(r["o_orderkey"] for r in orders.collect())
    assert {r["action"] for r in merged.select("action").distinct().collect()} == {"kept", "insert", "unchanged", "replace", "supersede", "conflict"}
    assert QUERIES["tiered_match_whole"](spark, SF).count() == spark.read.parquet(f"{SF}/part.parquet").count()
