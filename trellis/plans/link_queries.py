"""Linkage, voting, precedence, ranking and gates on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions.text import features, tokens
from trellis.functions.textkeys import array_key
from trellis.operators import gates, link, mutate, rank
from trellis.plans.registry import query, table

STOP = ["the", "of", "and", "de", "la", "der", "und", "el", "que", "en"]


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lower(text), lang ORDER BY least(length(text), 3000) DESC, doc_id) AS k FROM documents) WHERE k = 1""")
def dedup_keep_best(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.lower("text").alias("head"), F.least(F.length("text"), F.lit(3000)).alias("size"))
    return link.keep_best(docs, ["head", "lang"], [F.desc("size"), F.col("doc_id")]).select("doc_id")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, list_distinct(list(p_type ORDER BY p_type)) AS items FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL),
    b AS (SELECT *, row_number() OVER w AS k, first_value(items) OVER w AS best FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY len(items) DESC, o_orderkey))
    SELECT o_orderkey FROM b WHERE k = 1 OR len(list_intersect(items, best)) / len(list_distinct(list_concat(items, best))) < 0.6""")
def dedup_keep_richest(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, d, "part").select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
    sets = rows.groupBy("o_custkey", "o_orderkey").agg(F.collect_set("p_type").alias("items"))
    return link.keep_richest(sets, ["o_custkey"], "items", "o_orderkey").select("o_orderkey")


@query()
def content_clusters(spark, d):
    """Whole texts alike within a first sentence; the ratio of sequences has no SQL, the tests hold it against all pairs."""
    docs = table(spark, d, "documents").select("doc_id", F.concat_ws("|", "lang", F.regexp_extract("text", r"^([^.\n]*)", 1)).alias("block"), F.lower("text").alias("text"))
    return link.content_clusters(docs, "block", "doc_id", "text").select("doc_id", "cluster")


@query("""WITH b AS (SELECT l_orderkey, min(l_linestatus) AS status FROM lineitem GROUP BY 1)
    SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, CASE WHEN o_orderkey IS NULL THEN 'new' WHEN l_orderkey IS NULL THEN 'gone' WHEN o_orderstatus = status THEN 'same' ELSE 'changed' END AS change
    FROM orders FULL JOIN b ON o_orderkey = l_orderkey""")
def set_diff_plan(spark, d):
    """Orders as the old version, what the lines say of them as the new one."""
    old = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    new = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("status"))
    return mutate.diff(old, new, ["o_orderkey"], "status")


@query("""WITH c AS (SELECT DISTINCT upper(p_name) AS name FROM part WHERE p_size > 25), n AS (SELECT DISTINCT p_name AS name FROM part WHERE p_size <= 40 AND p_type <> 'SMALL')
    SELECT name, 'add' AS action FROM n WHERE lower(name) NOT IN (SELECT lower(name) FROM c) UNION SELECT name, 'remove' FROM c WHERE lower(name) NOT IN (SELECT lower(name) FROM n)""")
def set_changes(spark, d):
    parts = table(spark, d, "part")
    old = parts.filter("p_size > 25").select(F.upper("p_name").alias("name")).distinct()
    return mutate.set_changes(old, parts.filter("p_size <= 40 and p_type <> 'SMALL'").select(F.col("p_name").alias("name")).distinct(), "name")


@query("""SELECT p_partkey, CASE WHEN s_suppkey IS NULL THEN 'orphan' WHEN p_size = s_suppkey % 50 AND left(p_name, 1) = lower(left(s_name, 1)) THEN 'same'
    WHEN p_size = s_suppkey % 50 THEN 'NAME' WHEN left(p_name, 1) = lower(left(s_name, 1)) THEN 'HERB' ELSE 'NAME+HERB' END AS drift FROM part LEFT JOIN supplier ON s_suppkey = p_partkey""")
def drift_classify(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    joined = table(spark, d, "part").join(s, F.col("s_suppkey") == F.col("p_partkey"), "left")
    herb, name = F.col("p_size") == F.col("s_suppkey") % 50, F.substring("p_name", 1, 1) == F.lower(F.substring("s_name", 1, 1))
    drift = F.when(F.col("s_suppkey").isNull(), "orphan").when(herb & name, "same").when(herb, "NAME").when(name, "HERB").otherwise("NAME+HERB")
    return joined.select("p_partkey", drift.alias("drift"))


@query("""SELECT d.doc_id, CASE WHEN r.doc_id IS NOT NULL THEN NULL ELSE coalesce(e.v, a.v) END AS code,
    CASE WHEN r.doc_id IS NOT NULL THEN 'rejected' WHEN e.v IS NOT NULL THEN 'expert' WHEN a.v IS NOT NULL THEN 'auto' ELSE 'none' END AS origin
    FROM documents d LEFT JOIN (SELECT doc_id, 'q' || quality AS v FROM labels WHERE quality IS NOT NULL) e USING (doc_id)
    LEFT JOIN (SELECT doc_id, source AS v FROM documents WHERE n_chars > 1500) a USING (doc_id) LEFT JOIN (SELECT doc_id FROM labels WHERE toxic = 1) r USING (doc_id)""")
def merge_precedence(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    expert = labels.filter("quality is not null").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("code"))
    auto = docs.filter("n_chars > 1500").select("doc_id", F.col("source").alias("code"))
    return link.precedence(docs, [("expert", expert), ("auto", auto)], "doc_id", "code", labels.filter("toxic = 1").select("doc_id"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), b AS (SELECT user_id, max(n) AS votes FROM c GROUP BY 1)
    SELECT user_id, CASE WHEN votes >= 2 AND count(*) = 1 THEN min(event_type) END AS event_type, votes FROM c JOIN b USING (user_id) WHERE n = votes GROUP BY user_id, votes""")
def vote_consensus(spark, d):
    return link.majority(table(spark, d, "events"), ["user_id"], "event_type")


@query("""WITH m AS (SELECT DISTINCT user_id % 10 AS item, user_id // 10 AS voter, event_type AS block, strftime(ts, '%H') AS member FROM events),
    b AS (SELECT item, voter, block, string_agg(member, ',' ORDER BY member) AS b FROM m GROUP BY ALL),
    p AS (SELECT item, voter, string_agg(b, '|' ORDER BY b) AS partition FROM b GROUP BY ALL), c AS (SELECT item, partition, count(*) AS n FROM p GROUP BY ALL), t AS (SELECT item, max(n) AS votes FROM c GROUP BY 1)
    SELECT item, CASE WHEN votes >= 2 AND count(*) = 1 THEN min(partition) END AS partition, votes FROM c JOIN t USING (item) WHERE n = votes GROUP BY item, votes""")
def partition_consensus(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 10).alias("item"), F.floor(F.col("user_id") / 10).alias("voter"), F.col("event_type").alias("block"), F.date_format("ts", "HH").alias("member"))
    return link.majority(link.partition_key(e, ["item", "voter"], "block", "member"), ["item"], "partition")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_wins(spark, d):
    return link.latest_wins(table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id")


@query("""WITH l AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents), r AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS name FROM benchmark),
    s AS (SELECT word, name FROM l JOIN r ON word <> name AND length(word) >= 4 AND length(name) >= 4 AND (contains(word, name) OR contains(name, word))), f AS (SELECT word FROM s GROUP BY word HAVING count(*) <= 5)
    SELECT word, name, 'exact' AS method FROM l JOIN r ON word = name WHERE word <> '' UNION ALL SELECT word, name, 'substring' FROM s JOIN f USING (word)""")
def bridge_exact_substring(spark, d):
    """The reference's bridge between the vocabularies of documents and benchmark: exact links uncapped, the cap on substring links alone."""
    words = lambda df, name: df.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias(name))
    return link.name_bridge(words(table(spark, d, "documents"), "word"), words(table(spark, d, "benchmark"), "name"), "word", "name", 5)


@query("""WITH p AS (SELECT DISTINCT c_nationkey AS source, p_brand AS target, p_name AS item FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
    s AS (SELECT source, target, count(*) AS shared FROM p GROUP BY ALL HAVING count(*) >= 2)
    SELECT source, target, shared, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY shared DESC, target) AS rank FROM s) WHERE rank <= 3""")
def related_links_whole(spark, d):
    return _related_links(spark, d, table(spark, d, "lineitem"))


def _related_links(spark, d, lines):
    lines = lines.select("l_orderkey", "l_partkey")
    rows = lines.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.join(table(spark, d, "part").select("p_partkey", "p_brand", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    return link.related(rows.select(F.col("c_nationkey").alias("source"), F.col("p_brand").alias("target"), F.col("p_name").alias("item")), "source", "target", "item", 2, 3)


def _bm25(spark, d, exact=None):
    docs = table(spark, d, "documents").select("doc_id", features(tokens(F.col("text"), STOP)).alias("f"))
    items = table(spark, d, "benchmark").select("item_id", features(tokens(F.col("text"), STOP)).alias("f"))
    asked = rank.query_features(items, "item_id", {"text": (F.col("f"), 5.0, 16)})
    index = rank.bm25_index(docs, "doc_id", {"text": (F.col("f"), 2.0)}, asked)
    return rank.bm25_top(rank.bm25_plan(asked, index, "item_id"), index, "item_id", "doc_id", 5, exact)


_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
_WORDS = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '' AND NOT list_contains(" + _STOP_SQL + ", x))"
_FEATURES = "list_concat(list_transform(w, lambda x: 'u:' || x), list_transform(range(1, len(w)), lambda i: 'b:' || w[i] || ' ' || w[i + 1]))"
_BM25 = f"""WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents), dr AS (SELECT doc_id, unnest({_FEATURES}) AS feature FROM dw),
    tf AS (SELECT doc_id, feature, sum(2.0 * CASE WHEN feature LIKE 'b:%' THEN 1.35 ELSE 1.0 END)::DOUBLE AS tf FROM dr GROUP BY ALL),
    ln AS (SELECT d.doc_id, coalesce(l.length, 1.0) AS length FROM documents d LEFT JOIN (SELECT doc_id, sum(tf) AS length FROM tf GROUP BY 1) l USING (doc_id)),
    st AS (SELECT avg(length) AS mean, count(*) AS n FROM ln), df AS (SELECT feature, count(*) AS df FROM tf GROUP BY 1),
    ix AS (SELECT doc_id, feature, df, ln(1.0 + (n - df + 0.5) / (df + 0.5)) AS idf, ln(1.0 + (n - df + 0.5) / (df + 0.5)) * tf * (1.35 + 1.0) / (tf + 1.35 * (1.0 - 0.72 + 0.72 * length / mean)) AS impact FROM tf JOIN df USING (feature) JOIN ln USING (doc_id) CROSS JOIN st),
    qw AS (SELECT item_id, {_WORDS} AS w FROM benchmark), qr AS (SELECT item_id, unnest({_FEATURES}) AS feature FROM qw), qc AS (SELECT item_id, feature, count(*) AS qf FROM qr GROUP BY ALL),
    kn AS (SELECT DISTINCT feature, df, idf FROM ix WHERE df <= 2500 AND idf >= 0.25),
    rk AS (SELECT item_id, feature, 5.0 * (1.0 + ln(qf)) * CASE WHEN feature LIKE 'b:%' THEN 1.25 ELSE 1.0 END AS multiplier, idf FROM qc JOIN kn USING (feature)),
    pl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY multiplier * idf DESC, feature) AS nth FROM rk) WHERE nth <= 16),
    sc AS (SELECT item_id, doc_id, round(sum(multiplier * impact), 6) AS score FROM pl JOIN ix USING (feature) GROUP BY ALL),
    tp AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc)"""


@query(_BM25 + " SELECT item_id, doc_id, rank FROM tp WHERE rank <= 5")
def bm25_topk(spark, d):
    """Score sums depend on the order of additions in their last bits: the comparison is on the ranking."""
    return _bm25(spark, d).select("item_id", "doc_id", "rank")


@query(_BM25 + ", rel AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)), " + """h AS (SELECT DISTINCT item_id FROM tp JOIN rel USING (item_id, doc_id) WHERE rank <= 3)
    SELECT count(*) AS queries, count(h.item_id) AS hits, round(count(h.item_id) / count(*), 6) AS recall FROM (SELECT DISTINCT item_id FROM rel) r LEFT JOIN h USING (item_id)""")
def recall_at_k(spark, d):
    """Benchmark items (a query set of bounded size, broadcast only below a checked size) against the documents that hold them."""
    relevant = _holding(table(spark, d, "benchmark"), table(spark, d, "documents").select("doc_id", F.col("text").alias("body")))
    return rank.recall_at_k(_bm25(spark, d), relevant, "item_id", "doc_id", 3)


_EXACT = """, ex AS (SELECT item_id, doc_id, 1 + (lower(d.text) = lower(b.text))::INT AS hits FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
    sx AS (SELECT item_id, doc_id, round(coalesce(score, 0) + coalesce(hits, 0) * 10000, 6) AS score FROM sc FULL JOIN ex USING (item_id, doc_id)), t2 AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sx)
    SELECT item_id, doc_id, rank FROM t2 WHERE rank <= 5"""


@query(_BM25 + _EXACT)
def bm25_exact_bonus(spark, d):
    """Documents that hold an item come before all others; of those with a bonus alike, the better score does."""
    bodies = table(spark, d, "documents").select("doc_id", F.col("text").alias("body"))
    items = table(spark, d, "benchmark")
    held = _holding(items, bodies).join(items, "item_id").join(bodies, "doc_id")
    hits = held.select("item_id", "doc_id", F.when(F.lower("body") == F.lower("text"), 2).otherwise(1).alias("hits"))
    return _bm25(spark, d, hits).select("item_id", "doc_id", "rank")


def _holding(items, docs):
    """(item_id, doc_id) of the documents whose body contains the item's text."""
    # Candidates share five words near the item's start.  Ids and seeds meet alone; bodies are fetched for those that did.
    windows = lambda w: F.explode(F.element_at(F.transform(F.array(w), lambda v: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(v) - 4, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(v, i, F.lit(5)))))), 1))
    words = F.split("text", r"[ \n]+")
    # Words 2 to 6 stand whole in the document if a seventh follows; shorter items meet every document.
    long = F.size(words) > 6
    q = items.filter(long).select("item_id", "text", F.concat_ws(" ", F.slice(words, 2, 5)).alias("seed"))
    short = items.filter(~long).select("item_id", "text").join(docs, F.col("body").contains(F.col("text"))).select("item_id", "doc_id")
    seeds = docs.select("doc_id", windows(F.split("body", r"[ \n]+")).alias("seed"))
    met = seeds.join(q.select("item_id", "seed"), "seed").select("item_id", "doc_id").distinct()
    held = met.join(q.select("item_id", "text"), "item_id").join(docs, "doc_id").filter(F.col("body").contains(F.col("text"))).select("item_id", "doc_id")
    return held.unionByName(short).distinct()


@query("""WITH n AS (SELECT doc_id, lower(text) AS k FROM documents), u AS (SELECT k, min(doc_id) AS doc_id FROM n GROUP BY k HAVING count(*) = 1)
    SELECT d.doc_id, CASE WHEN u.doc_id IS NOT NULL AND l.quality = 1 AND coalesce(l.toxic, 0) = 0 THEN 'A' WHEN l.quality IS NULL THEN 'unlabelled' ELSE 'review' END AS tier FROM n d LEFT JOIN u ON u.k = d.k LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def exact_consensus_tier(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("k"))
    unique = docs.groupBy("k").agg(F.count("*").alias("n")).filter("n = 1").select("k", F.lit(True).alias("unique"))
    joined = docs.join(unique, "k", "left").join(table(spark, d, "labels"), "doc_id", "left")
    tier = F.when(F.coalesce("unique", F.lit(False)) & (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), "A").when(F.col("quality").isNull(), "unlabelled").otherwise("review")
    return joined.select("doc_id", tier.alias("tier"))


@query("""WITH c AS (SELECT lang, source AS v, count(*) AS n FROM documents GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, length(v) DESC, v) AS k FROM c)
    SELECT lang, v AS label FROM r WHERE k = 1""")
def canonical_label(spark, d):
    return link.canonical_label(table(spark, d, "documents").select("lang", F.col("source").alias("v")), ["lang"], "v")


@query("""WITH l AS (SELECT l_orderkey, l_suppkey, p_type || '/' || p_size % 5 AS term FROM lineitem JOIN part ON p_partkey = l_partkey), f AS (SELECT DISTINCT l_suppkey AS row_id, term FROM l),
    q AS (SELECT DISTINCT c_nationkey AS case_id, term FROM l JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey),
    t AS (SELECT row_id, count(*) AS observable FROM f GROUP BY 1), m AS (SELECT case_id, row_id, count(*) AS matched FROM q JOIN f USING (term) GROUP BY ALL)
    SELECT row_id, case_id, matched, observable, round(matched / observable, 6) AS ratio FROM m JOIN t USING (row_id) WHERE matched >= 2 AND matched / observable >= 0.30""")
def match_ratio_whole(spark, d):
    return _match_ratio(spark, d, "true", "true")


def _match_ratio(spark, d, known, asked):
    term = F.concat_ws("/", "p_type", (F.col("p_size") % 5).cast("string")).alias("term")
    parts = table(spark, d, "part").select("p_partkey", term)
    lines = table(spark, d, "lineitem").join(parts, F.col("p_partkey") == F.col("l_partkey"))
    fields = lines.filter(known).select(F.col("l_suppkey").alias("row_id"), "term")
    buyers = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
    cases = lines.filter(asked).join(buyers, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("c_nationkey").alias("case_id"), "term")
    out = gates.match_ratio(cases, fields, "case_id", "term", "row_id")
    return out.select("row_id", "case_id", "matched", "observable", F.round("ratio", 6).alias("ratio"))


@query("""SELECT p_partkey, NOT ((g = 'pediatric' AND age >= 16) OR (g = 'adult' AND age < 16) OR (g = 'mature' AND age < 40)) AS by_age, NOT coalesce(sex <> only_sex, false) AS by_sex
    FROM (SELECT p_partkey, p_size AS age, CASE p_type WHEN 'SMALL' THEN 'pediatric' WHEN 'MEDIUM' THEN 'adult' ELSE 'mature' END AS g, CASE WHEN p_partkey % 3 = 0 THEN 'nu' WHEN p_partkey % 3 = 1 THEN 'nam' END AS sex, CASE WHEN p_size % 2 = 0 THEN 'nu' ELSE 'nam' END AS only_sex FROM part)""")
def admission_gates(spark, d):
    p = table(spark, d, "part").withColumn("g", F.when(F.col("p_type") == "SMALL", "pediatric").when(F.col("p_type") == "MEDIUM", "adult").otherwise("mature"))
    sex = F.when(F.col("p_partkey") % 3 == 0, "nu").when(F.col("p_partkey") % 3 == 1, "nam")
    only = F.when(F.col("p_size") % 2 == 0, "nu").otherwise("nam")
    return p.select("p_partkey", gates.age_gate(F.col("p_size"), F.col("g")).alias("by_age"), gates.sex_gate(sex, only).alias("by_sex"))


@query("""WITH lex(word, polarity) AS (VALUES ('hot', 1.0), ('red', 0.5), ('blue', -0.5), ('cold', -1.0), ('small', 0.0)),
    w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part), o AS (SELECT l_orderkey, count(*) AS total, count(polarity) AS known, avg(polarity) AS mean FROM lineitem JOIN w ON p_partkey = l_partkey LEFT JOIN lex USING (word) GROUP BY 1)
    SELECT l_orderkey, total, known, round(mean, 6) AS mean, CASE WHEN abs(mean) >= 0.5 THEN 'strong' WHEN abs(mean) >= 0.2 THEN 'flag' ELSE 'ok' END AS severity FROM o WHERE known >= 3 AND known >= 0.4 * total""")
def polarity_audit(spark, d):
    lexicon = spark.createDataFrame([("hot", 1.0), ("red", 0.5), ("blue", -0.5), ("cold", -1.0), ("small", 0.0)], "word string, polarity double")
    words = table(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word")).join(F.broadcast(lexicon), "word", "left")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(words, F.col("p_partkey") == F.col("l_partkey"))
    o = rows.groupBy("l_orderkey").agg(F.count("*").alias("total"), F.count("polarity").alias("known"), F.avg("polarity").alias("mean")).filter((F.col("known") >= 3) & (F.col("known") >= 0.4 * F.col("total")))
    severity = F.when(F.abs("mean") >= 0.5, "strong").when(F.abs("mean") >= 0.2, "flag").otherwise("ok")
    return o.select("l_orderkey", "total", "known", F.round("mean", 6).alias("mean"), severity.alias("severity"))
