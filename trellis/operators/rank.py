"""Ranking: IDF and BM25 scores, deterministic tops, retrieval metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

# Parameters of the sparse index.
K1, B = 1.35, 0.72
MAX_POSTING, MIN_IDF = 2500, 0.25
BIGRAM_DOC, BIGRAM_QUERY = 1.35, 1.25
EXACT_BONUS = 10_000.0


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k)


def grounded_score(hits: DataFrame, group: str, term: str, item: str) -> DataFrame:
    """For (term, item, group) hits: matched terms of each group plus the sum of 1 / df over them.

    df is the number of distinct groups that a term reaches.
    """
    df = hits.groupBy(term).agg(F.count_distinct(group).alias("df"))
    pairs = hits.select(group, term).distinct().join(df, term)
    return pairs.groupBy(group).agg(F.count("*").alias("matched"), F.sum(1.0 / F.col("df")).alias("idf")).withColumn("score", F.col("matched") + F.col("idf"))


def _is_bigram(c: str = "feature") -> Column:
    return F.col(c).startswith("b:")


@dataclass
class Bm25Index:
    """Postings (doc, feature, tf) and document frequencies of the features that queries ask for, and all lengths."""

    postings: DataFrame
    features: DataFrame
    lengths: DataFrame


def bm25_index(docs: DataFrame, doc: str, fields: dict[str, tuple[Column, float]], wanted: DataFrame) -> Bm25Index:
    """Index of documents whose ``fields`` are feature arrays with boosts, for the ``wanted`` (feature) rows.

    A document's length needs the numbers of its features only.  Features that no query has are left out where they
    are exploded, before anything is shuffled.
    """
    weight = lambda c: F.when(c.startswith("b:"), BIGRAM_DOC).otherwise(1.0)
    rows, size = None, F.lit(0.0)
    for features, boost in fields.values():
        pairs = F.size(F.filter(features, lambda f: f.startswith("b:")))
        size = size + boost * ((F.size(features) - pairs) + BIGRAM_DOC * pairs)
        part = docs.select(doc, F.explode(features).alias("feature")).withColumn("boost", F.lit(boost))
        rows = part if rows is None else rows.unionByName(part)
    asked = wanted.select("feature").distinct()
    postings = rows.join(asked, "feature", "left_semi").groupBy(doc, "feature").agg(F.sum(F.col("boost") * weight(F.col("feature"))).alias("tf"))
    lengths = docs.select(doc, size.alias("length")).groupBy(doc).agg(F.sum("length").alias("length")).select(doc, F.when(F.col("length") > 0, F.col("length")).otherwise(1.0).alias("length"))
    stats = lengths.agg(F.count("*").alias("n"))
    idf = F.log(1.0 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    df = postings.groupBy("feature").agg(F.count("*").alias("df")).crossJoin(F.broadcast(stats)).select("feature", "df", idf.alias("idf"))  # one row of totals
    return Bm25Index(postings, df, lengths)


def query_features(queries: DataFrame, query: str, fields: dict[str, tuple[Column, float, int]]) -> DataFrame:
    """(query, field, feature, boost, most): a row for each feature of each field."""
    rows = None
    for name, (features, boost, limit) in fields.items():
        part = queries.select(query, F.lit(name).alias("field"), F.explode(features).alias("feature")).withColumns({"boost": F.lit(boost), "most": F.lit(limit)})
        rows = part if rows is None else rows.unionByName(part)
    return rows


def bm25_plan(asked: DataFrame, index: Bm25Index, query: str, least: int = 2, budget: int = 72) -> DataFrame:
    """(query, feature, idf, multiplier): the rarest features of each field, at least two, then within a global budget."""
    counts = asked.groupBy(query, "field", "feature", "boost", "most").agg(F.count("*").alias("qf"))
    known = index.features.filter((F.col("df") <= MAX_POSTING) & (F.col("idf") >= MIN_IDF))
    multiplier = F.col("boost") * (1.0 + F.log("qf")) * F.when(_is_bigram(), BIGRAM_QUERY).otherwise(1.0)
    ranked = counts.join(known, "feature").withColumn("multiplier", multiplier).withColumn("priority", F.col("multiplier") * F.col("idf"))
    in_field = Window.partitionBy(query, "field").orderBy(F.desc("priority"), "feature")
    ranked = ranked.withColumn("nth", F.row_number().over(in_field)).filter(F.col("nth") <= F.col("most"))
    kept = F.col("nth") <= least
    order = Window.partitionBy(query).orderBy(F.when(kept, 0).otherwise(1), F.desc("priority"), "field", "feature")
    chosen = ranked.withColumn("place", F.row_number().over(order)).filter(kept | (F.col("place") <= budget))
    return chosen.groupBy(query, "feature").agg(F.sum("multiplier").alias("multiplier"), F.first("idf").alias("idf"))


def bm25_top(plan: DataFrame, index: Bm25Index, query: str, doc: str, k: int = 5, exact: DataFrame | None = None) -> DataFrame:
    """The best k documents of each query by rounded score, ties by document; ``exact`` has (query, doc, hits) bonuses."""
    mean = index.lengths.agg(F.avg("length").alias("mean"))
    norm = K1 * (1.0 - B + B * F.col("length") / F.col("mean"))
    met = plan.join(index.postings, "feature").join(index.lengths, doc).crossJoin(F.broadcast(mean))  # one row of totals
    impact = F.col("idf") * F.col("tf") * (K1 + 1.0) / (F.col("tf") + norm)
    total = met.groupBy(query, doc).agg(F.sum(F.col("multiplier") * impact).alias("bm25"))
    if exact is not None:
        total = total.join(exact, [query, doc], "full").select(query, doc, F.coalesce("bm25", F.lit(0.0)).alias("bm25"), (F.coalesce("hits", F.lit(0)) * EXACT_BONUS).alias("bonus"))
    else:
        total = total.withColumn("bonus", F.lit(0.0))
    scored = total.withColumn("score", F.round(F.col("bm25") + F.col("bonus"), 6))
    return top_k(scored, [query], [F.desc("score"), F.col(doc)], k).select(query, doc, "score", "rank")


def recall_at_k(ranked: DataFrame, relevant: DataFrame, query: str, item: str, k: int) -> DataFrame:
    """One row: queries with a relevant item, those that have one in the first k, and the share."""
    hit = ranked.filter(F.col("rank") <= k).join(relevant, [query, item], "left_semi").select(query).distinct().withColumn("hit", F.lit(1))
    return relevant.select(query).distinct().join(hit, query, "left").agg(F.count("*").alias("queries"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits")).withColumn("recall", F.round(F.col("hits") / F.col("queries"), 6))


def shown(names: Column, most: int = 5) -> Column:
    """The first names, and how many more there are."""
    more = F.size(names) - most
    return F.concat(F.array_join(F.slice(names, 1, most), ", "), F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(")"))).otherwise(""))


def gold_report(ranked: DataFrame, cases: DataFrame, case: str, item: str, k: int) -> DataFrame:
    """One row: recall at k, forbidden items that were ranked, expected ones that weren't, and the median rank.

    ``cases`` has (case, kind, item): ``recall`` must be in the first k, ``forbid`` must not be ranked, ``expect`` must.
    """
    joined = cases.join(ranked.select(case, item, "rank"), [case, item], "left")
    of = lambda kind: F.col("kind") == kind
    return joined.agg(
        F.count_if(of("recall")).alias("recalls"),
        F.count_if(of("recall") & (F.col("rank") <= k)).alias("hits"),
        F.count_if(of("forbid") & F.col("rank").isNotNull()).alias("forbidden"),
        F.count_if(of("expect") & F.col("rank").isNull()).alias("missing"),
        F.median(F.when(of("recall"), F.col("rank"))).alias("median_rank"),
    )


def in_order(df: DataFrame, order: list[Column], place: str = "place") -> DataFrame:
    """``df`` with the place of each row in a total order; for reports and queues of a size that one task can hold."""
    return df.withColumn(place, F.row_number().over(Window.orderBy(*order)))
