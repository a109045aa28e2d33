"""Scans, predicates, joins, reports and orders on the star schema as a graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions import clean
from trellis.functions.text import drop_redundant
from trellis.operators import graph as G
from trellis.operators import link, mutate, rank, review
from trellis.plans.registry import query, table

joined = lambda c: F.array_join(c, "|")


def _parts(spark, d):
    p = table(spark, d, "part")
    name = F.when(F.col("p_size") % 7 == 0, F.concat("p_name", F.lit(" (x)"))).when(F.col("p_size") % 7 == 1, F.concat("p_name", F.lit(" 2"))).otherwise(F.col("p_name"))
    flag = F.when(F.col("p_size") % 5 == 0, True).when(F.col("p_size") % 5 == 1, False)
    return p.select(F.col("p_partkey").alias("id"), name.alias("name"), flag.alias("flagged"))


def _orders_of(spark, d):
    """Edges from customers to orders, of the order's status as type."""
    return table(spark, d, "orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"), F.col("o_orderstatus").alias("type"), "o_orderpriority")


def _customers(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"), "c_nationkey")


_PART_NAMES = "SELECT p_partkey AS id, CASE p_size % 7 WHEN 0 THEN p_name || ' (x)' WHEN 1 THEN p_name || ' 2' ELSE p_name END AS name, CASE p_size % 5 WHEN 0 THEN true WHEN 1 THEN false END AS flagged FROM part"


@query(f"SELECT id, name FROM ({_PART_NAMES}) ORDER BY name, id")
def label_scan(spark, d):
    return G.Graph({"part": _parts(spark, d)}, _orders_of(spark, d)).scan("part").select("id", "name")


@query(f"SELECT id, name FROM ({_PART_NAMES}) WHERE NOT regexp_matches(name, '[0-9(]') AND NOT coalesce(flagged, false)")
def clean_label_names(spark, d):
    return G.Graph({"part": _parts(spark, d)}, _orders_of(spark, d)).clean_names("part", "flagged").select("id", "name")


@query("""SELECT p_partkey, name IS NULL OR trim(name) = '' OR length(name) > 40 OR regexp_matches(name, '[0-9]') OR regexp_matches(name, '\\(.*\\)') OR contains(name, ' do ') AS dirty FROM (SELECT p_partkey,
    CASE p_size % 8 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN p_name || repeat('x', 40) WHEN 3 THEN p_name || '7' WHEN 4 THEN p_name || ' (a)' WHEN 5 THEN 'a do ' || p_name WHEN 6 THEN 'do ' || p_name ELSE p_name END AS name FROM part)""")
def dirty_names(spark, d):
    name = F.expr("CASE p_size % 8 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN p_name || repeat('x', 40) WHEN 3 THEN p_name || '7' WHEN 4 THEN p_name || ' (a)' WHEN 5 THEN 'a do ' || p_name WHEN 6 THEN 'do ' || p_name ELSE p_name END")
    return table(spark, d, "part").select("p_partkey", G.is_dirty_name(name).alias("dirty"))


@query("SELECT c_custkey, 'some' AS asked FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') UNION ALL SELECT c_custkey, 'all' FROM customer")
def optional_parameter(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    some = G.optional_in(c, "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey", F.lit("some").alias("asked"))
    return some.unionByName(G.optional_in(c, "c_mktsegment", None).select("c_custkey", F.lit("all").alias("asked")))


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 470000 OR o_totalprice < 30000)")
def nodes_without_type(spark, d):
    kind = F.when(F.col("o_totalprice") > 470000, "large").when(F.col("o_totalprice") < 30000, "small").otherwise("usual")
    edges = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), kind.alias("type"))
    return G.without_edge(_customers(spark, d), edges, ["large", "small"]).select("id")


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def urgent_orphans(spark, d):
    """Nodes without an edge in either direction, of two edge sets."""
    urgent = _orders_of(spark, d).filter("o_orderpriority = '1-URGENT'").select("src", (-F.col("dst") - 1).alias("dst"))
    ties = table(spark, d, "supplier").select((-F.col("s_suppkey") - 1).alias("src"), F.col("s_suppkey").alias("dst"))
    return G.orphans(_customers(spark, d), urgent.unionByName(ties)).select("id")


@query("SELECT o_orderkey AS src, o_custkey AS dst FROM orders WHERE o_orderstatus = 'F'")
def reverse_hop(spark, d):
    return G.Graph({}, _orders_of(spark, d)).hop("F", reverse=True).select("src", "dst")


@query("SELECT r.asked, c_custkey AS id, o_orderkey AS neighbour FROM (VALUES ('building'), ('Furniture')) r(asked) JOIN customer ON lower(c_mktsegment) = lower(r.asked) JOIN orders ON o_custkey = c_custkey")
def unscoped_neighbours(spark, d):
    asked = spark.createDataFrame([("building",), ("Furniture",)], "asked string")
    return G.neighbours(_customers(spark, d), _orders_of(spark, d), asked, "asked")


@query("""SELECT strftime(l_shipdate, '%Y-%m') AS syndrome, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS diseases FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE CASE WHEN l_linenumber < 5 THEN l_returnflag END = l_returnflag AND regexp_matches(p_name, '(^|[^a-z])(ring|bolt)($|[^a-z])') GROUP BY 1""")
def term_syndromes(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    edges = rows.select("p_name", F.date_format("l_shipdate", "yyyy-MM").alias("syndrome"), F.col("l_returnflag").alias("disease"), F.when(F.col("l_linenumber") < 5, F.col("l_returnflag")).alias("scope"))
    terms = spark.createDataFrame([("ring",), ("bolt",)], "term string")
    return G.syndrome_diseases(terms, edges, "term", "p_name", "syndrome", "disease", "scope").select("syndrome", joined(F.col("diseases")).alias("diseases"))


@query("""WITH a(asked) AS (VALUES ('BUILDING'), ('building'), ('Machinery'), ('nothing')), n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS name FROM customer),
    m AS (SELECT asked, id, name = asked AS exact FROM a JOIN n ON lower(name) = lower(asked)), c AS (SELECT asked, id FROM m QUALIFY NOT bool_or(exact) OVER (PARTITION BY asked) OR exact)
    SELECT a.asked, coalesce(string_agg(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, '|' ORDER BY CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END), '') AS organs,
    coalesce(string_agg(DISTINCT CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, '|' ORDER BY CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END), '') AS tags FROM a LEFT JOIN c USING (asked) LEFT JOIN orders ON o_custkey = id GROUP BY a.asked""")
def facets_exact_first(spark, d):
    name = F.when(F.col("id") % 2 == 0, F.lower("name")).otherwise(F.col("name"))
    edges = _orders_of(spark, d).select("src", F.when(F.col("type") == "F", "organ").otherwise("tag").alias("kind"), F.col("o_orderpriority").alias("facet"))
    asked = spark.createDataFrame([("BUILDING",), ("building",), ("Machinery",), ("nothing",)], "asked string")
    return G.facets(asked, _customers(spark, d).withColumn("name", name), edges, "asked").select("asked", joined(F.col("organs")).alias("organs"), joined(F.col("tags")).alias("tags"))


@query("""SELECT c_custkey AS id, coalesce(string_agg(o_orderstatus || '/' || o_orderkey || '/' || o_orderpriority, '|' ORDER BY o_orderstatus, o_orderkey, o_orderpriority), '') AS outgoing FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def node_snapshots(spark, d):
    snap = G.snapshot(_customers(spark, d), _orders_of(spark, d), ["o_orderpriority"])
    row = lambda e: F.concat_ws("/", e["type"], e["other"].cast("string"), e["o_orderpriority"])
    return snap.select("id", F.coalesce(F.array_join(F.transform("outgoing", row), "|"), F.lit("")).alias("outgoing"))


@query("""WITH a(asked) AS (VALUES ('BUILDING'), ('building'), ('machinery')), n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS name, coalesce(n, 0) AS degree FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)
    SELECT asked, id FROM (SELECT asked, id, row_number() OVER (PARTITION BY asked ORDER BY (name = asked) DESC, degree DESC, id) AS k FROM a JOIN n ON lower(name) = lower(asked)) WHERE k = 1""")
def best_case_variant(spark, d):
    nodes = _customers(spark, d).withColumn("name", F.when(F.col("id") % 3 == 0, F.lower("name")).otherwise(F.col("name")))
    edges = _orders_of(spark, d).select("src", F.lit(None).cast("long").alias("dst"))
    return G.best_variant(nodes, edges, spark.createDataFrame([("BUILDING",), ("building",), ("machinery",)], "asked string"), "asked")


@query("""WITH a AS (SELECT DISTINCT p_partkey % 50 AS k, p_brand AS b FROM part), x AS (SELECT DISTINCT s_suppkey % 60 AS k, 'Brand#' || s_nationkey AS b FROM supplier)
    SELECT coalesce(a.k, x.k) AS k, coalesce(a.b, x.b) AS b, CASE WHEN x.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS side FROM a FULL JOIN x ON a.k = x.k AND a.b = x.b""")
def keyed_comparison(spark, d):
    a = table(spark, d, "part").select((F.col("p_partkey") % 50).alias("k"), F.col("p_brand").alias("b"))
    x = table(spark, d, "supplier").select((F.col("s_suppkey") % 60).alias("k"), F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")).alias("b"))
    return G.keyed_comparison(a, x, ["k", "b"])


@query("""SELECT DISTINCT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name""")
def directed_pairs(spark, d):
    groups = table(spark, d, "nation").groupBy("n_regionkey").agg(F.collect_set("n_name").alias("names"))
    return mutate.pair_relations(groups.select("names", F.col("names").alias("again")), "names", "again", directed=True)


@query("""WITH a AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS needle FROM part), b AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS hay FROM part), m AS (SELECT needle, hay FROM a JOIN b ON contains(' ' || hay || ' ', ' ' || needle || ' ') WHERE length(needle) >= 3)
    SELECT needle, hay, rank FROM (SELECT *, row_number() OVER (PARTITION BY needle ORDER BY length(hay), hay) AS rank FROM m) WHERE rank <= 3""")
def contains_shortest(spark, d):
    p = table(spark, d, "part")
    return link.contains_best(p.select(F.split("p_name", " ")[0].alias("needle")), p.select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("hay")), "needle", "hay", 3)


@query("""SELECT lower(name) AS k, string_agg(DISTINCT name, '|' ORDER BY name) AS names, count(DISTINCT name) AS n FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS name FROM customer) GROUP BY 1 HAVING count(DISTINCT name) > 1""")
def case_groups(spark, d):
    name = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    groups = table(spark, d, "customer").select(name.alias("name")).groupBy(F.lower("name").alias("k")).agg(F.sort_array(F.collect_set("name")).alias("xs"))
    return groups.filter(F.size("xs") > 1).select("k", joined(F.col("xs")).alias("names"), F.size("xs").cast("long").alias("n"))


@query("""WITH t AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, o_custkey) AS k FROM t)
    SELECT string_agg(o_custkey::VARCHAR, ', ' ORDER BY k) FILTER (WHERE k <= 5) || CASE WHEN count(*) > 5 THEN ' (+' || count(*) - 5 || ')' ELSE '' END AS shown FROM r""")
def shown_ranking(spark, d):
    top = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)
    names = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "o_custkey"))).alias("xs"))  # ten rows
    return names.select(rank.shown(F.transform("xs", lambda x: x["o_custkey"].cast("string"))).alias("shown"))


@query("SELECT c_mktsegment AS role, c_name AS username, row_number() OVER (ORDER BY c_mktsegment, c_name) AS place FROM customer")
def users_in_order(spark, d):
    return rank.in_order(table(spark, d, "customer").select(F.col("c_mktsegment").alias("role"), F.col("c_name").alias("username")), [F.col("role"), F.col("username")])


@query("""SELECT s_suppkey, row_number() OVER (ORDER BY wrong DESC, s_suppkey) AS place FROM (SELECT s_suppkey, -s_acctbal / 1000 AS wrong FROM supplier WHERE s_acctbal < 5000)""")
def magnitude_order(spark, d):
    s = table(spark, d, "supplier").filter("s_acctbal < 5000").select("s_suppkey", (-F.col("s_acctbal") / 1000).alias("wrong"))
    return rank.in_order(s, [F.desc("wrong"), F.col("s_suppkey")]).select("s_suppkey", "place")


@query("""SELECT p_partkey, row_number() OVER (ORDER BY CASE WHEN p_size % 3 = 0 THEN 'P0' WHEN p_size % 3 = 1 THEN 'P1' ELSE 'P2' END, lower(p_name), p_partkey) AS place FROM part""")
def review_queue(spark, d):
    priority = F.when(F.col("p_size") % 3 == 0, "P0").when(F.col("p_size") % 3 == 1, "P1").otherwise("P2")
    return rank.in_order(table(spark, d, "part").select("p_partkey", "p_name", priority.alias("priority")), [F.col("priority"), F.lower("p_name"), F.col("p_partkey")]).select("p_partkey", "place")


@query("""WITH d AS (SELECT o_orderstatus AS disease, o_orderkey FROM orders), f AS (SELECT disease, p_brand AS formula, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS herbs FROM d JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL)
    SELECT disease, formula, herbs, row_number() OVER (ORDER BY disease, formula) AS place FROM f""")
def overview_order(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("disease")).join(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
    out = rows.groupBy("disease", F.col("p_brand").alias("formula")).agg(F.array_join(F.sort_array(F.collect_set("p_type")), ",").alias("herbs"))
    return rank.in_order(out, [F.col("disease"), F.asc_nulls_last("formula")])


@query("""WITH r AS (SELECT s_nationkey AS c, p_brand, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey GROUP BY ALL),
    k AS (SELECT c, p_brand, row_number() OVER (PARTITION BY c ORDER BY n DESC, p_brand) AS rank FROM r), c AS (SELECT n_nationkey AS c, kind, 'Brand#' || (n_nationkey % 9 + o) AS p_brand FROM nation, (VALUES ('recall', 1), ('forbid', 2), ('expect', 3)) x(kind, o)), j AS (SELECT c.*, rank FROM c LEFT JOIN k USING (c, p_brand))
    SELECT count(*) FILTER (WHERE kind = 'recall') AS recalls, count(*) FILTER (WHERE kind = 'recall' AND rank <= 3) AS hits, count(*) FILTER (WHERE kind = 'forbid' AND rank IS NOT NULL) AS forbidden, count(*) FILTER (WHERE kind = 'expect' AND rank IS NULL) AS missing, median(rank) FILTER (WHERE kind = 'recall') AS median_rank FROM j""")
def gold_report(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").join(table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("c")), F.col("s_suppkey") == F.col("l_suppkey"))
    rows = rows.join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey")).groupBy("c", "p_brand").agg(F.count_distinct("l_orderkey").alias("n"))
    ranked = rank.top_k(rows, ["c"], [F.desc("n"), F.col("p_brand")], 1000)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(o).alias("o")) for k, o in (("recall", 1), ("forbid", 2), ("expect", 3))])).alias("x")
    cases = table(spark, d, "nation").select(F.col("n_nationkey").alias("c"), kinds).select("c", "x.kind", F.concat(F.lit("Brand#"), (F.col("c") % 9 + F.col("x.o")).cast("string")).alias("p_brand"))
    return rank.gold_report(ranked, cases, "c", "p_brand", 3)


@query("""WITH t AS (SELECT l_orderkey, list_distinct(list(p_type) FILTER (WHERE l_returnflag = 'R')) AS o, list_distinct(list(p_type) FILTER (WHERE l_returnflag <> 'R')) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1), s AS (SELECT l_orderkey, list_sort(coalesce(o, [])) AS o, list_sort(coalesce(n, [])) AS n FROM t)
    SELECT l_orderkey, array_to_string(list_filter(n, lambda x: NOT list_contains(o, x)), '|') AS added, array_to_string(list_filter(o, lambda x: NOT list_contains(n, x)), '|') AS removed, o = n AS equal, len(o) > 0 AND len(n) > 0 AND len(list_intersect(o, n)) = 0 AS disjoint FROM s""")
def set_deltas(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
    sets = rows.groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("p_type"))).alias("old"), F.collect_set(F.when(F.col("l_returnflag") != "R", F.col("p_type"))).alias("new"))
    out = sets.select("l_orderkey", link.set_delta(F.col("old"), F.col("new")).alias("x"))
    return out.select("l_orderkey", joined(F.col("x.added")).alias("added"), joined(F.col("x.removed")).alias("removed"), "x.equal", "x.disjoint")


@query("""WITH o AS (SELECT DISTINCT upper(p_brand || ' ' || p_type) AS name FROM part WHERE p_size > 25), n AS (SELECT DISTINCT lower(p_brand || ' ' || p_type) AS name FROM part WHERE p_size <= 24)
    SELECT name, 'add' AS action FROM n WHERE lower(name) NOT IN (SELECT lower(name) FROM o) UNION SELECT name, 'remove' FROM o WHERE lower(name) NOT IN (SELECT lower(name) FROM n) UNION SELECT name, 'add' FROM (SELECT 'only new' AS name)""")
def set_changes_both(spark, d):
    parts = table(spark, d, "part").select("p_size", F.concat_ws(" ", "p_brand", "p_type").alias("name"))
    new = parts.filter("p_size <= 24").select(F.lower("name").alias("name")).unionByName(spark.range(1).select(F.lit("only new").alias("name")))
    return mutate.set_changes(parts.filter("p_size > 25").select(F.upper("name").alias("name")), new, "name")


@query("""SELECT id, tag, NULL::BIGINT AS size, 'suppliers' AS export FROM (SELECT s_suppkey AS id, s_name AS tag FROM supplier) UNION ALL SELECT p_partkey, NULL, p_size, 'parts' FROM part""")
def export_union(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("tag"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("size"))
    return mutate.union_exports({"suppliers": s, "parts": p})


@query("""SELECT p_partkey, p_brand FROM part WHERE p_size % 4 = 0""")
def would_be_lost(spark, d):
    """Parts of which a quarter changed its type, some of them from null."""
    old = table(spark, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") % 8 != 0, F.col("p_type")).alias("t"))
    new = table(spark, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") % 4 == 0, F.lit("new")).otherwise(F.col("p_type")).alias("t"))
    return mutate.would_be_lost(old, new, ["t", "p_brand", "p_partkey"]).select("p_partkey", "p_brand")


@query("""SELECT k, v, n FROM (SELECT p_brand AS k, min(p_type) AS v, 'first' AS n FROM part WHERE p_size > 25 GROUP BY 1) UNION ALL SELECT k, v, n FROM (SELECT 'Brand#' || s_nationkey AS k, min(s_name) AS v, 'second' AS n FROM supplier GROUP BY 1) WHERE k NOT IN (SELECT p_brand FROM part WHERE p_size > 25)""")
def first_source_wins(spark, d):
    a = table(spark, d, "part").filter("p_size > 25").select(F.col("p_brand").alias("k"), F.col("p_type").alias("v"), F.lit("first").alias("n"))
    b = table(spark, d, "supplier").select(F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")).alias("k"), F.col("s_name").alias("v"), F.lit("second").alias("n"))
    return link.union_first(a, b, "k")


@query("""WITH a AS (SELECT user_id AS c, event_type AS s, 'f' || event_id % 4 AS f FROM events WHERE event_id % 2 = 0), b AS (SELECT user_id AS c, event_type AS s, 'f' || event_id % 4 AS f FROM events WHERE event_id % 2 = 1 AND user_id % 3 > 0), u AS (SELECT c, s, f, 0 AS side FROM a UNION ALL SELECT c, s, f, 1 FROM b)
    SELECT c, coalesce(string_agg(DISTINCT s, '|' ORDER BY s) FILTER (WHERE side = 0), '') AS l, coalesce(string_agg(DISTINCT s, '|' ORDER BY s) FILTER (WHERE side = 1), '') AS r, string_agg(DISTINCT s, '|' ORDER BY s) AS syndromes, string_agg(DISTINCT f, '|' ORDER BY f) AS formulas FROM u GROUP BY c""")
def fused_modalities(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("c"), F.col("event_type").alias("s"), F.concat(F.lit("f"), (F.col("event_id") % 4).cast("string")).alias("f"), "event_id")
    out = link.fused(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1 and c % 3 > 0"), "c", "s", "f")
    return out.select("c", joined(F.col("left")).alias("l"), joined(F.col("right")).alias("r"), joined(F.col("syndromes")).alias("syndromes"), joined(F.col("formulas")).alias("formulas"))


@query("""WITH p AS (SELECT DISTINCT c_nationkey AS source, p_brand AS target, p_name AS item FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey), o AS (SELECT source, count(DISTINCT item) AS own FROM p GROUP BY 1),
    s AS (SELECT source, target, count(*) AS shared FROM p WHERE target <> 'Brand#1' GROUP BY ALL HAVING count(*) >= 2)
    SELECT source, target, shared, rank, round_even(shared / own, 3) AS score FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY shared DESC, target) AS rank FROM s) JOIN o USING (source) WHERE rank <= 3""")
def related_scores(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    rows = lines.join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")).join(table(spark, d, "part").select("p_partkey", "p_brand", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    pairs = rows.select(F.col("c_nationkey").alias("source"), F.col("p_brand").alias("target"), F.col("p_name").alias("item"))
    confirmed = pairs.filter("target = 'Brand#1'").select("source", "target").distinct()
    return link.related_score(pairs, "source", "target", "item", 2, 3, confirmed)


@query("""WITH k AS (SELECT min((p_partkey, p_type)) AS v, lower(p_brand) AS b, p_name AS s FROM part WHERE p_size > 25 GROUP BY 2, 3), a AS (SELECT DISTINCT p_brand, p_name FROM part WHERE p_size <= 25),
    t0 AS (SELECT a.*, k.v FROM a JOIN k ON k.b = lower(a.p_brand) AND k.s = a.p_name), w AS (SELECT a.*, unnest(list_filter(string_split(p_name, ' '), lambda x: length(x) >= 3)) AS w FROM a), t1 AS (SELECT p_brand, p_name, min(k.v) AS v FROM w JOIN k ON k.b = lower(p_brand) AND contains(k.s, w.w) GROUP BY 1, 2), t2 AS (SELECT p_name, min(k.v) AS v FROM (SELECT DISTINCT p_name FROM a) x JOIN k ON contains(k.s, string_split(p_name, ' ')[1]) WHERE length(string_split(p_name, ' ')[1]) >= 3 GROUP BY 1)
    SELECT a.p_brand, a.p_name, coalesce(t0.v, t1.v, t2.v)[2] AS p_type, CASE WHEN t0.v IS NOT NULL THEN 0 WHEN t1.v IS NOT NULL THEN 1 WHEN t2.v IS NOT NULL THEN 2 END AS tier FROM a LEFT JOIN t0 USING (p_brand, p_name) LEFT JOIN t1 USING (p_brand, p_name) LEFT JOIN t2 USING (p_name)""")
def fallback_tiers(spark, d):
    p = table(spark, d, "part")
    known = p.filter("p_size > 25").select("p_brand", "p_name", "p_type", "p_partkey")
    return review.fallback_match(p.filter("p_size <= 25").select("p_brand", "p_name").distinct(), known, "p_brand", "p_name", "p_type", "p_partkey")


_FOLD = """WITH RECURSIVE m AS (SELECT o_orderkey, o_orderstatus AS scope, p_name || CASE WHEN p_size % 6 = 0 THEN ' 2' WHEN p_size % 6 = 1 THEN ' mạch' ELSE '' END AS p_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
    seeds AS (SELECT DISTINCT p_name FROM m WHERE regexp_matches(p_name, '(^|[^\\p{L}])red($|[^\\p{L}])')), hit AS (SELECT DISTINCT o_orderkey, scope FROM m JOIN seeds USING (p_name)),
    top AS (SELECT p_name, row_number() OVER (ORDER BY n DESC, p_name) AS k FROM (SELECT p_name, count(DISTINCT o_orderkey) AS n FROM m JOIN hit USING (o_orderkey, scope) WHERE p_name NOT IN (SELECT p_name FROM seeds) GROUP BY p_name ORDER BY n DESC, p_name LIMIT 100)),
    fold(k, kept) AS (SELECT 0::BIGINT, []::VARCHAR[] UNION ALL SELECT top.k, CASE WHEN len(kept) >= 30 OR regexp_matches(p_name, '[0-9]') OR contains(p_name, 'mạch') OR list_contains(kept, p_name) OR len(list_filter(kept, lambda x: contains(x, ' ') AND contains(p_name, x))) > 0 THEN kept ELSE list_append(kept, p_name) END FROM fold JOIN top ON top.k = fold.k + 1)
    SELECT unnest(kept) AS p_name, generate_subscripts(kept, 1) - 1 AS place FROM (SELECT kept FROM fold ORDER BY k DESC LIMIT 1)"""


@query(_FOLD)
def related_terms_whole(spark, d):
    """The suggestion of related terms in full: scoped, unscoped where that is empty, then the ordered filter."""
    suffix = F.when(F.col("p_size") % 6 == 0, " 2").when(F.col("p_size") % 6 == 1, " mạch").otherwise("")
    parts = table(spark, d, "part").select("p_partkey", F.concat("p_name", suffix).alias("p_name"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    members = lines.join(table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("scope")), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "scope", "p_name")
    seeds = G.matching_terms(spark.createDataFrame([("red",)], "term string"), parts.select("p_name").distinct(), "term", "p_name").select("p_name")
    found = G.related_terms(members, seeds, ["o_orderkey", "scope"], ["o_orderkey"], "p_name", "o_orderkey")
    names = found.agg(F.sort_array(F.collect_list(F.struct((-F.col("frequency")).alias("f"), "p_name"))).alias("xs"))  # 100 rows at most
    return names.select(F.posexplode(drop_redundant(F.col("xs.p_name"))).alias("place", "p_name"))


@query("""SELECT name AS value, upper(k[1]) || k[2:] AS clean FROM (SELECT DISTINCT 'Thể ' || p_brand AS name, NULL AS k FROM part WHERE false) UNION ALL
    SELECT DISTINCT lower(p_type) || ' (' || p_size % 3 || ')', upper(lower(p_type)[1]) || lower(p_type)[2:] FROM part WHERE length(p_type) >= 3 UNION ALL SELECT DISTINCT 'a do ' || lower(p_type), upper(lower(p_type)[1]) || lower(p_type)[2:] FROM part""")
def staging_names(spark, d):
    p = table(spark, d, "part")
    low = F.lower("p_type")
    a = p.select(F.concat(F.lit("  "), low, F.lit(" ("), (F.col("p_size") % 3).cast("string"), F.lit(")")).alias("value"))
    return clean.staging_names(a.unionByName(p.select(F.concat(F.lit("a do "), low).alias("value"))).unionByName(p.select(F.col("p_name").alias("value"))), "value")
