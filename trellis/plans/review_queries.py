"""Lookups, reviews, accuracy and budgets on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.operators import review
from trellis.plans.registry import query, table


@query("""SELECT c_custkey, CASE WHEN regexp_matches(t, '^[=+@-]') THEN '''' || t ELSE t END AS cell
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '=' || c_name WHEN c_acctbal < 0 THEN c_acctbal::BIGINT::VARCHAR ELSE c_name END AS t FROM customer)""")
def csv_formula_guard(spark, d):
    cell = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("="), "c_name")).when(F.col("c_acctbal") < 0, F.rint("c_acctbal").cast("long").cast("string")).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", review.formula_guard(cell).alias("cell"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS alias FROM part""")
def trailing_alias(spark, d):
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit(" (x) ("), "p_brand", F.lit(") "))).otherwise(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") end")))
    return table(spark, d, "part").select("p_partkey", review.trailing_alias(name).alias("alias"))


@query("""SELECT c_custkey, n_name, n_nationkey AS code FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS n_name, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey)
    UNION ALL SELECT -1, 'nowhere', NULL""")
def dictionary_lookup(spark, d):
    nation = table(spark, d, "nation")
    name = F.when(F.col("c_custkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("n_name")
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", name)
    rows = rows.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("c_custkey"), F.lit("nowhere").alias("n_name")))
    return review.dictionary_lookup(rows, nation.select("n_name", F.col("n_nationkey").alias("code")), "n_name", "code")


@query("""WITH known AS (SELECT * FROM part WHERE p_type = 'SMALL'), a AS (SELECT p_brand, p_size, min(p_partkey) AS v FROM known GROUP BY ALL), b AS (SELECT p_brand, min(p_partkey) AS v FROM known GROUP BY ALL)
    SELECT p.p_partkey, p.p_brand, p.p_size, coalesce(a.v, b.v) AS pick, CASE WHEN a.v IS NOT NULL THEN 0 WHEN b.v IS NOT NULL THEN 1 END AS tier
    FROM part p LEFT JOIN a ON a.p_brand = p.p_brand AND a.p_size = p.p_size LEFT JOIN b ON b.p_brand = p.p_brand""")
def tiered_match_whole(spark, d):
    """Every part is looked up among those of one type."""
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    known = table(spark, d, "part").filter("p_type = 'SMALL'").select("p_partkey", "p_brand", "p_size").withColumn("pick", F.col("p_partkey"))
    return review.tiered_match(part, known, [["p_brand", "p_size"], ["p_brand"]], "pick", "p_partkey")


@query("""WITH old AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' OR o_orderkey % 7 = 0 THEN 'pending' ELSE o_orderstatus END AS a FROM orders WHERE o_orderpriority NOT LIKE '5%'),
    new AS (SELECT o_orderkey AS k, o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' AS s, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE 'seen' END AS note, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'O' END AS b FROM orders WHERE o_orderpriority NOT LIKE '4%'),
    m AS (SELECT coalesce(old.k, new.k) AS k, a, b, CASE WHEN b IS NULL THEN 'kept' WHEN a IS NULL THEN 'insert' WHEN a = b THEN 'unchanged' WHEN a = 'pending' THEN 'replace' WHEN s AND trim(note) <> '' THEN 'supersede' ELSE 'conflict' END AS action FROM old FULL JOIN new ON old.k = new.k)
    SELECT k AS o_orderkey, action, CASE WHEN action IN ('kept', 'unchanged', 'conflict') THEN a ELSE b END AS decision FROM m""")
def review_merge_whole(spark, d):
    """Sides by priority: the lowest is new, the one before it only stored, all others are on both sides."""
    orders = table(spark, d, "orders")
    return _review_merge(orders.filter("o_orderpriority not like '5%'"), orders.filter("o_orderpriority not like '4%'"))


def _review_merge(old, new):
    stored = old.select("o_orderkey", F.expr("CASE WHEN o_orderstatus = 'P' OR o_orderkey % 7 = 0 THEN 'pending' ELSE o_orderstatus END").alias("decision"))
    urgent = F.col("o_orderpriority").startswith("1") | F.col("o_orderpriority").startswith("2")
    note = F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise("seen")
    decision = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise("O")
    incoming = new.select("o_orderkey", decision.alias("decision"), urgent.alias("supersedes"), note.alias("note"))
    return review.review_merge(stored, incoming, "o_orderkey")


@query("""SELECT 'flag' AS field, count(*) AS labelled, count(*) FILTER (WHERE l_returnflag = CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'A' END) AS "right", "right" / count(*) AS accuracy FROM lineitem
    UNION ALL SELECT 'size', count(*) FILTER (WHERE l_quantity > 10), count(*) FILTER (WHERE l_quantity > 10 AND l_linenumber = 1), count(*) FILTER (WHERE l_quantity > 10 AND l_linenumber = 1) / count(*) FILTER (WHERE l_quantity > 10) FROM lineitem""")
def field_accuracy(spark, d):
    guess = F.when(F.col("l_linestatus") == "O", "N").otherwise("A")
    size_label = F.when(F.col("l_quantity") > 10, F.lit(1))
    pairs = table(spark, d, "lineitem").select(guess.alias("flag"), F.col("l_returnflag").alias("flag_label"), F.col("l_linenumber").alias("size"), size_label.alias("size_label"))
    return review.field_accuracy(pairs, ["flag", "size"])


@query("""WITH r AS (SELECT p_brand, p_type, p_retailprice, p_partkey, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC, p_partkey) AS k FROM part),
    s AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN k <= 2 THEN 0 ELSE 1 END, p_retailprice DESC, p_partkey) AS n FROM r)
    SELECT p_brand, p_type, p_retailprice, p_partkey FROM s WHERE k <= 2 OR n <= 15""")
def feature_budget(spark, d):
    part = table(spark, d, "part").select("p_brand", "p_type", "p_retailprice", "p_partkey")
    return review.feature_budget(part, "p_brand", "p_type", "p_retailprice", "p_partkey", 2, 15)


@query("""SELECT o_orderkey, n, greatest(2, (3 * n + 9) // 10)::INT AS before, greatest(2, (3 * (n + extra) + 9) // 10)::INT AS after, greatest(2, (3 * (n + extra) + 9) // 10) > greatest(2, (3 * n + 9) // 10) AS at_risk
    FROM (SELECT l_orderkey AS o_orderkey, count(*) AS n, count(*) FILTER (WHERE l_quantity > 25) AS extra FROM lineitem GROUP BY l_orderkey)""")
def split_risk(spark, d):
    counts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 25).alias("extra"))
    before, after = review.match_need(F.col("n")), review.match_need(F.col("n") + F.col("extra"))
    return counts.select("o_orderkey", "n", before.alias("before"), after.alias("after"), (after > before).alias("at_risk"))
