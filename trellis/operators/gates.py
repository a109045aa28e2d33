"""Admission gates and the match ratio of a case against knowledge rows (contract inferred from public test tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

MATCH_RATIO, MATCH_LEAST = 0.30, 2


def age_gate(age: Column, group: Column) -> Column:
    """False where a disease group can't be: pediatric from 16, adult under 16, mature under 40; no age, no filter."""
    drop = ((group == "pediatric") & (age >= 16)) | ((group == "adult") & (age < 16)) | ((group == "mature") & (age < 40))
    return ~F.coalesce(drop, F.lit(False))


def sex_gate(sex: Column, only: Column) -> Column:
    """False where a disease is of the other sex; undeclared is no filter."""
    return ~F.coalesce(sex != only, F.lit(False))


def match_ratio(cases: DataFrame, fields: DataFrame, case: str, term: str, row: str) -> DataFrame:
    """Rows that a case passes: at least two matched fields and 0.30 of the row's observable fields."""
    total = fields.select(row, term).distinct().groupBy(row).agg(F.count("*").alias("observable"))
    hit = cases.select(case, term).distinct().join(fields.select(row, term).distinct(), term).groupBy(case, row).agg(F.count("*").alias("matched"))
    out = hit.join(total, row).withColumn("ratio", F.col("matched") / F.col("observable"))
    return out.filter((F.col("matched") >= MATCH_LEAST) & (F.col("ratio") >= MATCH_RATIO))


def synonyms(clusters: DataFrame, name: str = "name", cluster: str = "cluster") -> DataFrame:
    """(a, b) of different names in one cluster, parentheses ignored."""
    key = F.trim(F.regexp_replace(F.lower(F.col(name)), r"\([^)]*\)", ""))
    c = clusters.select(cluster, key.alias("k")).distinct()
    return c.alias("x").join(c.alias("y"), cluster).filter("x.k <> y.k").select(F.col("x.k").alias("a"), F.col("y.k").alias("b"))
