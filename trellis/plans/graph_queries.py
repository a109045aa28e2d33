"""Graph patterns on the star schema: an order is a syndrome, its status the edge scope, a part a symptom."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions.text import drop_redundant
from trellis.functions.textkeys import array_key, letter_bounded
from trellis.operators import graph as G
from trellis.operators import mutate, rank
from trellis.plans.registry import query, table

#: Lower-case terms of the registered term queries.
TERMS = ["red", "bolt"]


def _members(spark, d):
    """(o_orderkey, scope, p_name): parts of each order with the order's status as scope."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    orders = table(spark, d, "orders").select(F.col("o_orderkey"), F.col("o_orderstatus").alias("scope"))
    return lines.join(parts, lines.l_partkey == parts.p_partkey).join(orders, lines.l_orderkey == orders.o_orderkey).select("o_orderkey", "scope", "p_name")


def _seeds(spark, d):
    return table(spark, d, "part").filter(letter_bounded(F.col("p_name"), TERMS[0])).select("p_name").distinct()


_MEMBERS = """members AS (SELECT o_orderkey, o_orderstatus AS scope, p_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
    seeds AS (SELECT DISTINCT p_name FROM part WHERE regexp_matches(lower(p_name), '(^|[^\\p{L}])red($|[^\\p{L}])'))"""
_SCOPED = f"""WITH {_MEMBERS},
    hit AS (SELECT DISTINCT o_orderkey, scope FROM members JOIN seeds USING (p_name))
    SELECT p_name, count(DISTINCT o_orderkey) AS frequency FROM members JOIN hit USING (o_orderkey, scope)
    WHERE p_name NOT IN (SELECT p_name FROM seeds) GROUP BY p_name ORDER BY frequency DESC, p_name LIMIT 100"""


@query(_SCOPED)
def kg_cooccurrence_scoped(spark, d):
    return G.cooccurrence(_members(spark, d), _seeds(spark, d), ["o_orderkey", "scope"], "p_name", "o_orderkey", 100)


@query(_SCOPED.replace("o_orderkey, scope FROM members JOIN seeds", "o_orderkey FROM members JOIN seeds").replace("(o_orderkey, scope)", "(o_orderkey)"))
def kg_cooccurrence_unscoped(spark, d):
    return G.cooccurrence(_members(spark, d), _seeds(spark, d), ["o_orderkey"], "p_name", "o_orderkey", 100)


_FOLD = f"""WITH RECURSIVE {_MEMBERS}, hit AS (SELECT DISTINCT o_orderkey, scope FROM members JOIN seeds USING (p_name)),
    top AS (SELECT p_name, row_number() OVER (ORDER BY n DESC, p_name) AS k FROM (SELECT p_name, count(DISTINCT o_orderkey) AS n FROM members JOIN hit USING (o_orderkey, scope) WHERE p_name NOT IN (SELECT p_name FROM seeds) GROUP BY p_name ORDER BY n DESC, p_name LIMIT 100)),
    fold(k, kept) AS (SELECT 0::BIGINT, []::VARCHAR[] UNION ALL SELECT top.k, CASE WHEN len(kept) >= 30 OR regexp_matches(p_name, '[0-9]') OR list_contains(kept, p_name) OR len(list_filter(kept, lambda x: contains(x, ' ') AND contains(p_name, x))) > 0 THEN kept ELSE list_append(kept, p_name) END FROM fold JOIN top ON top.k = fold.k + 1)
    SELECT unnest(kept) AS p_name, generate_subscripts(kept, 1) - 1 AS place FROM (SELECT kept FROM fold ORDER BY k DESC LIMIT 1)"""


@query(_FOLD)
def kg_related_terms(spark, d):
    """Flagship: names that co-occur in scope (out of scope where there are none), in order, without redundant ones, at most 30."""
    found = G.related_terms(_members(spark, d), _seeds(spark, d), ["o_orderkey", "scope"], ["o_orderkey"], "p_name", "o_orderkey")
    ordered = found.agg(F.sort_array(F.collect_list(F.struct((-F.col("frequency")).alias("f"), "p_name"))).alias("xs"))  # 100 rows at most
    names = ordered.select(drop_redundant(F.col("xs.p_name")).alias("names"))
    return names.select(F.posexplode("names").alias("place", "p_name"))


@query("""SELECT n_name, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS segments, count(DISTINCT o_orderkey) AS orders
    FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
    JOIN lineitem ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus GROUP BY n_name""")
def kg_scoped_multihop(spark, d):
    orders = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus")
    hops = table(spark, d, "nation").join(table(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey")).join(orders, F.col("o_custkey") == F.col("c_custkey"))
    scoped = hops.join(lines, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_linestatus") == F.col("o_orderstatus")))
    return scoped.groupBy("n_name").agg(array_key(F.collect_set("c_mktsegment")).alias("segments"), F.count_distinct("o_orderkey").alias("orders"))


@query("""WITH f AS (SELECT s_suppkey, s_nationkey, p_type, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands
    FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_quantity >= 2 LEFT JOIN part ON p_partkey = l_partkey AND p_size < 50 GROUP BY ALL)
    SELECT n_name, coalesce(string_agg(DISTINCT p_type || ':' || coalesce(brands, ''), '|' ORDER BY p_type || ':' || coalesce(brands, '')), '') AS formulas, count(DISTINCT s_suppkey) AS suppliers
    FROM nation LEFT JOIN f ON s_nationkey = n_nationkey AND n_regionkey < 4 GROUP BY n_name""")
def kg_optional_collect(spark, d):
    lines = table(spark, d, "lineitem").filter("l_quantity >= 2").select("l_suppkey", "l_partkey")
    parts = table(spark, d, "part").filter("p_size < 50").select("p_partkey", "p_type", "p_brand")
    s = G.optional_match(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), lines, F.col("l_suppkey") == F.col("s_suppkey"))
    s = G.optional_match(s, parts, F.col("p_partkey") == F.col("l_partkey"))
    inner = s.groupBy("s_suppkey", "s_nationkey", "p_type").agg(F.array_join(F.sort_array(F.collect_set("p_brand")), ",").alias("brands"))
    out = G.optional_match(table(spark, d, "nation"), inner, (F.col("s_nationkey") == F.col("n_nationkey")) & (F.col("n_regionkey") < 4))
    pair = F.when(F.col("p_type").isNotNull(), F.concat("p_type", F.lit(":"), "brands"))
    return out.groupBy("n_name").agg(array_key(F.collect_set(pair)).alias("formulas"), F.count_distinct("s_suppkey").alias("suppliers"))


@query("""SELECT lower(p_name) AS name_key, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY lower(p_name) ORDER BY (p_brand = 'Brand#3') DESC, p_name, p_partkey) AS k FROM part) WHERE k = 1""")
def kg_best_variant_limit1(spark, d):
    parts = table(spark, d, "part").select(F.lower("p_name").alias("name_key"), "p_name", "p_brand", "p_partkey")
    best = rank.top_k(parts, ["name_key"], [(F.col("p_brand") == "Brand#3").desc(), F.col("p_name"), F.col("p_partkey")], 1)
    return best.select("name_key", "p_partkey")


@query(f"""WITH t(term) AS (VALUES ('{TERMS[0]}'), ('{TERMS[1]}')),
    n AS (SELECT DISTINCT p_name FROM part), m AS (SELECT p_name, term FROM n, t WHERE regexp_matches(lower(p_name), '(^|[^\\p{{L}}])' || term || '($|[^\\p{{L}}])')),
    hits AS (SELECT DISTINCT l_orderkey, term FROM lineitem JOIN part ON l_partkey = p_partkey JOIN m USING (p_name))
    SELECT l_orderkey FROM hits GROUP BY l_orderkey HAVING count(DISTINCT term) = 2""")
def kg_and_terms(spark, d):
    terms = spark.createDataFrame([(t,) for t in TERMS], "term string")
    names = table(spark, d, "part").select("p_name").distinct()
    matched = G.matching_terms(terms, names, "term", "p_name")
    parts = table(spark, d, "part").select("p_partkey", "p_name").join(matched, "p_name")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return G.with_all_terms(rows, ["l_orderkey"], "term", len(TERMS))


@query(r"""WITH h AS (SELECT doc_id, regexp_matches(lower(text), '(^|[^\p{L}])thand($|[^\p{L}])')::INT + regexp_matches(lower(text), '(^|[^\p{L}])onthsh($|[^\p{L}])')::INT AS n FROM documents)
    SELECT doc_id FROM h WHERE n > 0 AND (n = 2 OR (SELECT max(n) FROM h) < 2)""")
def kg_all_else_any(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    hits = sum((letter_bounded(F.col("text"), t).cast("int") for t in ("thand", "onthsh")), F.lit(0))
    return G.all_else_any(docs, hits, 2).select("doc_id")


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def kg_orphans(spark, d):
    edges = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), F.lit(-1).cast("long").alias("dst"))
    return G.orphans(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), edges)


@query("SELECT c_custkey AS id, count(o_orderkey) AS degree FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def kg_degree(spark, d):
    edges = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), F.lit(None).cast("long").alias("dst"))
    return G.degree(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), edges)


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, '') = coalesce(CASE WHEN o_orderstatus = 'F' THEN 'R' END, ''))""")
def kg_not_exists_nullsafe(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.when(F.col("o_orderstatus") == "F", "R").alias("scope"), "o_orderkey")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("k"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("scope"))
    return G.not_exists(orders, lines, ["k", "scope"]).select("o_orderkey")


@query("SELECT user_id, count(*) AS n, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS types FROM events WHERE event_type IN ('click', 'purchase', 'signup') GROUP BY user_id")
def kg_type_alternation(spark, d):
    edges = table(spark, d, "events").select(F.col("user_id").alias("src"), F.col("event_id").alias("dst"), F.col("event_type").alias("type"))
    hop = G.Graph({}, edges).hop("click", "purchase", "signup")
    return hop.groupBy(F.col("src").alias("user_id")).agg(F.count("*").alias("n"), array_key(F.collect_set("type")).alias("types"))


@query("SELECT 'edges' AS part, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'parts', count(*) FROM part")
def kg_counts(spark, d):
    edges = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))
    return G.Graph({"orders": table(spark, d, "orders"), "parts": table(spark, d, "part")}, edges).counts()


@query(r"""SELECT lang, count(*) AS rows_n, count(*) FILTER (WHERE regexp_matches(text, '[0-9(]')) AS dirty, count(*) FILTER (WHERE length(text) > 4000) AS long_n,
    count(*) FILTER (WHERE trim(text) = '') AS blank, count(DISTINCT source) > 1 AS several_sources FROM documents GROUP BY lang""")
def kg_quality_report(spark, d):
    docs = table(spark, d, "documents")
    return docs.groupBy("lang").agg(
        F.count("*").alias("rows_n"), F.count_if(F.col("text").rlike("[0-9(]")).alias("dirty"), F.count_if(F.length("text") > 4000).alias("long_n"),
        F.count_if(F.trim("text") == "").alias("blank"), (F.count_distinct("source") > 1).alias("several_sources"),
    )


@query("""WITH c AS (SELECT lower(p_name) AS k, count(*) AS n, count(DISTINCT p_brand) AS brands FROM part GROUP BY 1 HAVING count(*) > 1)
    SELECT count(*) AS dup_groups, sum(n - 1)::BIGINT AS redundant, max(brands) AS most_brands FROM c""")
def kg_duplicate_groups(spark, d):
    groups = table(spark, d, "part").groupBy(F.lower("p_name").alias("k")).agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("brands")).filter("n > 1")
    return groups.agg(F.count("*").alias("dup_groups"), F.sum(F.col("n") - 1).alias("redundant"), F.max("brands").alias("most_brands"))


@query("""SELECT o_custkey, count(DISTINCT o_orderkey) + count(DISTINCT l_partkey) AS score FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey ORDER BY score DESC, o_custkey LIMIT 10""")
def disease_rank_top10(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    scored = rows.groupBy("o_custkey").agg((F.count_distinct("o_orderkey") + F.count_distinct("l_partkey")).alias("score"))
    return scored.orderBy(F.desc("score"), "o_custkey").limit(10)


_GROUNDED = ["thand", "onthsh", "erhe", "mitder", "queres"]


@query("WITH t(term) AS (VALUES " + ", ".join(f"('{t}')" for t in _GROUNDED) + r"""),
    h AS (SELECT DISTINCT term, source || '-' || lang AS grp FROM documents JOIN t ON regexp_matches(lower(text), '(^|[^\p{L}])' || term || '($|[^\p{L}])')),
    df AS (SELECT term, count(DISTINCT grp) AS df FROM h GROUP BY term)
    SELECT grp, round(count(*) + sum(1.0 / df), 6) AS score FROM h JOIN df USING (term) GROUP BY grp ORDER BY score DESC, grp LIMIT 20""")
def grounded_score(spark, d):
    docs = table(spark, d, "documents").select(F.concat_ws("-", "source", "lang").alias("grp"), "doc_id", F.explode(F.filter(F.array(*[F.when(letter_bounded(F.col("text"), t), t) for t in _GROUNDED]), lambda x: x.isNotNull())).alias("term"))
    scored = rank.grounded_score(docs, "grp", "term", "doc_id")
    return scored.select("grp", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "grp").limit(20)


@query("""WITH k AS (SELECT c_custkey, first_value(c_custkey) OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY coalesce(n, 0) DESC, c_custkey) AS canonical
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)
    SELECT canonical AS src, o_orderpriority AS prop, count(*) AS n FROM (SELECT DISTINCT canonical, o_orderkey, o_orderpriority FROM orders JOIN k ON c_custkey = o_custkey) GROUP BY ALL""")
def node_merge_repoint(spark, d):
    nodes = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat_ws("|", "c_mktsegment", "c_nationkey").alias("key"))
    edges = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), (-F.col("o_orderkey") - 1).alias("dst"), F.lit("order").alias("type"), F.col("o_orderpriority").alias("prop"))
    plan = mutate.merge_plan(nodes, edges, "key")
    return mutate.repoint(edges, plan).groupBy("src", "prop").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_mktsegment, c_nationkey) AS canonical FROM customer)
    SELECT canonical AS src, o_orderstatus AS dst, min(o_orderpriority) AS prop FROM orders JOIN k ON c_custkey = o_custkey GROUP BY ALL""")
def node_merge_lossy(spark, d):
    c = table(spark, d, "customer")
    plan = c.join(c.groupBy("c_mktsegment", "c_nationkey").agg(F.min("c_custkey").alias("canonical")), ["c_mktsegment", "c_nationkey"]).select(F.col("c_custkey").cast("string").alias("id"), F.col("canonical").cast("string").alias("canonical"))
    edges = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("src"), F.col("o_orderstatus").alias("dst"), F.lit("order").alias("type"), F.col("o_orderpriority").alias("prop"))
    return mutate.repoint(edges, plan, keep_properties=False).select(F.col("src").cast("long").alias("src"), "dst", "prop")


@query("""WITH f AS (SELECT DISTINCT p_name, unnest(string_split(p_name, ' ')) AS fragment FROM part)
    SELECT fragment, count(*) AS n FROM (SELECT DISTINCT l_orderkey, fragment FROM lineitem JOIN part ON p_partkey = l_partkey JOIN f USING (p_name)) GROUP BY fragment""")
def node_split(spark, d):
    edges = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").cast("string").alias("src"), F.col("p_name").alias("dst"))
    fragments = table(spark, d, "part").select("p_name").distinct().select(F.col("p_name").alias("id"), F.explode(F.split("p_name", " ")).alias("fragment"))
    return mutate.split_node_edges(edges, fragments).groupBy(F.col("dst").alias("fragment")).agg(F.count("*").alias("n"))


@query("""SELECT DISTINCT least(a.n_name, b.n_name) AS a, greatest(a.n_name, b.n_name) AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name""")
def symmetric_pairs(spark, d):
    groups = table(spark, d, "nation").groupBy("n_regionkey").agg(F.collect_set("n_name").alias("names"))
    return mutate.pair_relations(groups.select("names", F.col("names").alias("again")), "names", "again")


@query("""WITH m AS (SELECT n_name, r_name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND r_name LIKE 'A%')
    SELECT n_name, coalesce(string_agg(DISTINCT r_name, '|' ORDER BY r_name), '') AS facets FROM m GROUP BY n_name""")
def facet_lookup(spark, d):
    facets = table(spark, d, "region").filter(F.col("r_name").startswith("A"))
    out = G.optional_match(table(spark, d, "nation"), facets, F.col("r_regionkey") == F.col("n_regionkey"))
    return out.groupBy("n_name").agg(array_key(F.collect_set("r_name")).alias("facets"))


@query("""SELECT count(DISTINCT l_orderkey) AS bridged FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey IN (SELECT c_nationkey FROM customer)""")
def kg_bridge_whole(spark, d):
    return _three_hops(spark, d, "true", "true")


def _three_hops(spark, d, of_parts, of_customers):
    parts = table(spark, d, "part").filter(of_parts).select("p_partkey")
    nations = table(spark, d, "customer").filter(of_customers).select("c_nationkey").distinct()
    sup = table(spark, d, "supplier").join(nations, F.col("c_nationkey") == F.col("s_nationkey"), "left_semi").select("s_suppkey")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").join(parts, F.col("p_partkey") == F.col("l_partkey"), "left_semi").join(sup, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
    return lines.agg(F.count_distinct("l_orderkey").alias("bridged"))
