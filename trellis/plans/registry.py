"""All registered queries: name to a function of (spark, sf_dir), and the SQL that must agree."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "kg_related_terms"


def query(sql: str | None = None):
    def register(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def cases(name: str, build: Callable[..., Column], pairs: list[tuple[str | None, str | None]]) -> None:
    """Register an operator on texts over all events: event k has the input of the pair k modulo their number.

    The SQL states the result of each pair.
    """
    text = lambda s: "NULL" if s is None else "'" + s.replace("'", "''") + "'"
    whens = " ".join(f"WHEN {k} THEN {text(want)}" for k, (_, want) in enumerate(pairs))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        given = F.array(*[F.lit(given).cast("string") for given, _ in pairs])
        events = table(spark, sf_dir, "events").select("event_id", F.element_at(given, (F.col("event_id") % len(pairs) + 1).cast("int")).alias("given"))
        return events.select("event_id", build(F.col("given")).cast("string").alias("result"))

    run.__name__ = name
    query(f"SELECT event_id, CASE event_id % {len(pairs)} {whens} END AS result FROM events")(run)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from trellis.plans import clean_queries, diagnose_queries, graph_queries, link_queries, merge_queries, pattern_queries, review_queries, text_queries  # noqa: E402, F401
