"""Votes, mappings, reviews, catalogs and graph changes on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.operators import graph as G
from trellis.operators import link, mutate, review
from trellis.plans.registry import query, table

joined = lambda c: F.array_join(c, "|")


@query("""WITH v AS (SELECT user_id % 12 AS item, user_id // 12 AS voter, event_type AS cluster, event_id % 3 AS member, min(event_id) AS seen FROM events GROUP BY ALL), m AS (SELECT DISTINCT user_id % 12 AS item, event_id % 3 AS member FROM events),
    s AS (SELECT item, count(*) AS size FROM m GROUP BY 1), ok AS (SELECT item, voter, min(seen) AS seen, count(DISTINCT cluster) AS clusters FROM v GROUP BY ALL HAVING count(*) = count(DISTINCT member)), g AS (SELECT ok.*, size FROM ok JOIN s USING (item) JOIN (SELECT item, voter, count(DISTINCT member) AS named FROM v GROUP BY ALL) USING (item, voter) WHERE named = size),
    b AS (SELECT item, voter, cluster, string_agg(member::VARCHAR, ',' ORDER BY member::VARCHAR) AS b FROM v GROUP BY ALL), p AS (SELECT item, voter, string_agg(b, '|' ORDER BY b) AS partition FROM b GROUP BY ALL), k AS (SELECT g.*, partition, row_number() OVER (PARTITION BY item ORDER BY seen, voter) AS nth FROM g JOIN p USING (item, voter)),
    e AS (SELECT item, count(*) = 2 AND count(DISTINCT partition) = 1 AS agree FROM k WHERE nth <= 2 GROUP BY 1), u AS (SELECT k.* FROM k JOIN e USING (item) WHERE NOT (agree AND nth > 2)), t AS (SELECT item, partition, count(*) AS votes, min(clusters) AS clusters, min(size) AS size, min(nth) AS f FROM u GROUP BY ALL),
    w AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY item ORDER BY votes DESC, f) = 1), x AS (SELECT * FROM w WHERE votes >= 2)
    SELECT s.item, partition, coalesce(votes, 0) AS votes, CASE WHEN votes IS NULL THEN 'no_consensus' WHEN clusters = 1 THEN 'same' WHEN clusters = x.size THEN 'different' ELSE 'mixed' END AS verdict FROM s LEFT JOIN x USING (item)""")
def partition_verdicts(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 12).alias("item"), F.floor(F.col("user_id") / 12).alias("voter"), F.col("event_type").alias("cluster"), (F.col("event_id") % 3).alias("member"), "event_id")
    votes = e.groupBy("item", "voter", "cluster", "member").agg(F.min("event_id").alias("at"))
    return link.partition_verdicts(votes, e.select("item", "member"), "item", "voter", "cluster", "member", "at")


@query("""WITH v AS (SELECT user_id % 25 AS item, CASE event_type WHEN 'click' THEN 'pick' WHEN 'view' THEN 'outside_top5' WHEN 'error' THEN 'none_correct' ELSE 'insufficient' END AS verdict, CASE WHEN event_type IN ('click', 'view') THEN 'c' || event_id % 9 END AS code FROM events),
    o AS (SELECT item, verdict, code, CASE WHEN code IS NULL THEN verdict WHEN code = 'c8' THEN NULL WHEN code IN ('c6', 'c7') THEN 'inel:' || code ELSE code END AS outcome FROM v), t AS (SELECT item, outcome, count(*) AS votes, max(code) AS code FROM o WHERE outcome IS NOT NULL GROUP BY ALL),
    b AS (SELECT * FROM (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY item ORDER BY votes DESC, outcome) = 1) WHERE votes >= 2)
    SELECT i.item, CASE WHEN outcome IS NULL THEN 'no_consensus' WHEN starts_with(outcome, 'inel:') THEN 'ineligible_code' WHEN code IN ('c0', 'c1', 'c2') THEN 'in_top5' WHEN code IS NOT NULL THEN 'outside_top5' WHEN outcome = 'none_correct' THEN 'none' ELSE 'insufficient' END AS kind,
    CASE WHEN code IS NOT NULL AND NOT starts_with(outcome, 'inel:') THEN code END AS code, coalesce(votes, 0) AS votes FROM (SELECT DISTINCT item FROM v) i LEFT JOIN b USING (item)""")
def code_consensus(spark, d):
    e = table(spark, d, "events")
    verdict = F.when(F.col("event_type") == "click", "pick").when(F.col("event_type") == "view", "outside_top5").when(F.col("event_type") == "error", "none_correct").otherwise("insufficient")
    code = F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit("c"), (F.col("event_id") % 9).cast("string")))
    votes = e.select((F.col("user_id") % 25).alias("item"), F.col("event_id").alias("voter"), verdict.alias("verdict"), code.alias("code"))
    catalog = spark.createDataFrame([(f"c{k}", k < 6) for k in range(8)], "code string, eligible boolean")
    top = votes.select("item").distinct().select("item", F.explode(F.array(F.lit("c0"), F.lit("c1"), F.lit("c2"))).alias("code"))
    return link.code_consensus(votes, top, catalog, "item")


_REASONS = """WITH r AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN [] WHEN 1 THEN ['a'] WHEN 2 THEN ['b'] ELSE ['a', 'b'] END AS n, CASE p_size % 3 WHEN 0 THEN [] WHEN 1 THEN ['a'] ELSE ['c'] END AS l, p_size % 5 > 0 AS e, CASE WHEN p_size % 7 = 0 THEN ['f'] ELSE [] END AS f, p_size % 11 = 0 AS dup, p_size % 13 = 0 AS ui, p_size % 6 = 0 AS low FROM part),
    s AS (SELECT *, len(n) > 0 AND len(l) > 0 AND len(list_intersect(n, l)) = 0 AS conflict, len(n) = 1 AND len(l) = 1 AND n[1] = l[1] AS same FROM r), t AS (SELECT *, same AND e AND NOT (dup OR ui OR low) AND len(f) = 0 AS tier_a FROM s)
    SELECT p_partkey, array_to_string(list_filter([CASE WHEN conflict THEN 'exact_name_lead_conflict' END, CASE WHEN len(n) = 0 THEN 'name_not_exact' WHEN len(n) > 1 THEN 'name_exact_not_unique' END, CASE WHEN len(l) = 0 THEN 'lead_not_exact' WHEN len(l) > 1 THEN 'lead_exact_not_unique' END,
    CASE WHEN same AND NOT e THEN 'exact_code_not_auto_single_code_eligible' END, CASE WHEN len(f) > 0 THEN 'quality_flags_present' END, CASE WHEN dup THEN 'duplicate_name_unresolved' END, CASE WHEN ui THEN 'ui_or_template_row' END, CASE WHEN low THEN 'low_information' END, CASE WHEN tier_a THEN 'tier_a_exact_consensus_requires_human_review' END], lambda x: x IS NOT NULL), '|') AS reasons,
    tier_a, CASE WHEN dup THEN 'P0_duplicate_name' WHEN conflict THEN 'P0_exact_conflict' WHEN ui THEN 'P1_non_disease_or_tcm' WHEN low THEN 'P1_low_information' WHEN tier_a THEN 'P2_validate_tier_a' ELSE 'P1_manual_mapping' END AS priority FROM t"""


@query(_REASONS)
def mapping_reasons(spark, d):
    size = F.col("p_size")
    strings = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    names = F.when(size % 4 == 0, strings()).when(size % 4 == 1, strings("a")).when(size % 4 == 2, strings("b")).otherwise(strings("a", "b"))
    leads = F.when(size % 3 == 0, strings()).when(size % 3 == 1, strings("a")).otherwise(strings("c"))
    rows = table(spark, d, "part").select("p_partkey", names.alias("n"), leads.alias("l"), (size % 5 > 0).alias("e"), F.when(size % 7 == 0, strings("f")).otherwise(strings()).alias("f"), (size % 11 == 0).alias("dup"), (size % 13 == 0).alias("ui"), (size % 6 == 0).alias("low"))
    out = rows.select("p_partkey", review.decision_reasons(*[F.col(c) for c in ("n", "l", "e", "f", "dup", "ui")], F.lit(False), F.col("low")).alias("x"))
    return out.select("p_partkey", joined(F.col("x.reasons")).alias("reasons"), "x.tier_a", "x.priority")


@query("""WITH p AS (SELECT p_partkey AS id, p_size AS fp, CASE WHEN p_size % 5 = 0 THEN 'c' || p_size % 7 END AS code, p_size % 5 = 0 OR p_size = 1 AS a, ['c0', 'c1', 'c' || p_size % 9] AS c FROM part WHERE p_size <> 3), r AS (SELECT p_partkey AS id, CASE WHEN p_size = 2 THEN 0 ELSE p_size END AS fp FROM part WHERE p_size <> 4), k AS (SELECT 'c' || i AS code, i < 5 AS e FROM range(8) t(i))
    SELECT 'one_proposal_a_row' AS invariant, 0 AS violations UNION ALL SELECT 'no_row_without_proposal', count(*) FROM part WHERE p_size = 3 UNION ALL SELECT 'no_proposal_without_row', count(*) FROM part WHERE p_size = 4 UNION ALL SELECT 'fingerprints_fresh', count(*) FROM part WHERE p_size = 2
    UNION ALL SELECT 'at_most_top_candidates', 0 UNION ALL SELECT 'candidates_distinct', count(*) FROM p WHERE c[3] IN ('c0', 'c1') UNION ALL SELECT 'candidates_in_catalog', count(*) FROM p WHERE c[3] = 'c8' UNION ALL SELECT 'codes_of_tier_a_only', 0 UNION ALL SELECT 'tier_a_has_code', count(*) FROM p WHERE a AND code IS NULL
    UNION ALL SELECT 'codes_eligible', count(*) FROM p WHERE code IN ('c5', 'c6') UNION ALL SELECT 'codes_among_candidates', count(*) FROM p WHERE code IS NOT NULL AND NOT list_contains(c, code) UNION ALL SELECT 'catalog_codes_unique', 0""")
def run_invariants(spark, d):
    p, size = table(spark, d, "part"), F.col("p_size")
    code = F.when(size % 5 == 0, F.concat(F.lit("c"), (size % 7).cast("string")))
    candidates = F.array(F.lit("c0"), F.lit("c1"), F.concat(F.lit("c"), (size % 9).cast("string")))
    proposals = p.filter("p_size <> 3").select(F.col("p_partkey").alias("id"), size.alias("fingerprint"), code.alias("code"), ((size % 5 == 0) | (size == 1)).alias("tier_a"), candidates.alias("candidates"))
    rows = p.filter("p_size <> 4").select(F.col("p_partkey").alias("id"), F.when(size == 2, 0).otherwise(size).alias("fingerprint"))
    catalog = spark.createDataFrame([(f"c{k}", k < 5) for k in range(8)], "code string, eligible boolean")
    return review.invariants(proposals, rows, catalog)


_MAPPING = """WITH r AS (SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 THEN 'old' ELSE '' END AS code, CASE WHEN p_size % 9 = 0 THEN 'da_kiem_duyet' ELSE 'chua_kiem_duyet' END AS status, CASE WHEN p_size % 5 = 0 THEN 'auto' END AS au, CASE WHEN p_size % 3 = 0 THEN 'llm' END AS lm,
    CASE p_size % 7 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' WHEN 2 THEN 'pending' WHEN 3 THEN 'unmappable' END AS dec FROM part), n AS (SELECT *, coalesce(dec <> 'pending', false) AS done FROM r),
    m AS (SELECT *, CASE WHEN dec = 'approved' THEN 'exp' WHEN done THEN '' ELSE coalesce(au, lm, '') END AS new_code, CASE WHEN dec = 'approved' THEN 'da_kiem_duyet' WHEN dec = 'unmappable' THEN 'khong_anh_xa' ELSE 'chua_kiem_duyet' END AS new_status,
    CASE WHEN dec = 'approved' THEN 'expert_approved' WHEN done THEN dec WHEN au IS NOT NULL THEN 'machine_provisional' WHEN lm IS NOT NULL THEN 'machine_llm_consensus' ELSE 'none' END AS source FROM n)
    SELECT id, code, status, source, new_code, new_status, (code <> new_code OR status <> new_status) AND (code <> '' OR status <> 'chua_kiem_duyet') AND NOT (done OR (status = 'chua_kiem_duyet' AND coalesce(au, lm) IS NOT NULL)) AS orphan FROM m"""


@query(_MAPPING)
def mapping_plan(spark, d):
    p, size = table(spark, d, "part").withColumnRenamed("p_partkey", "id"), F.col("p_size")
    rows = p.select("id", F.when(size % 4 == 0, "old").otherwise("").alias("code"), F.when(size % 9 == 0, "da_kiem_duyet").otherwise("chua_kiem_duyet").alias("status"))
    decision = F.when(size % 7 == 0, "approved").when(size % 7 == 1, "rejected").when(size % 7 == 2, "pending").when(size % 7 == 3, "unmappable")
    reviews = p.select("id", decision.alias("decision"), F.when(size % 7 == 0, "exp").otherwise("").alias("code")).filter("decision is not null")
    return review.desired_mapping(rows, p.filter(size % 5 == 0).select("id", F.lit("auto").alias("code")), p.filter(size % 3 == 0).select("id", F.lit("llm").alias("code")), reviews)


@query("""SELECT p_partkey AS id, CASE p_size % 10 WHEN 0 THEN '' WHEN 1 THEN 'row_hash_stale' WHEN 2 THEN 'catalog_hash_stale' WHEN 3 THEN 'decision_unknown|code_without_approval' WHEN 4 THEN 'code_unknown' WHEN 5 THEN 'approved_without_code'
    WHEN 6 THEN 'reviewer_missing|reviewed_at_without_zone|note_missing' WHEN 7 THEN 'pending_with_values' WHEN 8 THEN 'unknown_id|reviewed_at_missing' ELSE '' END AS errors FROM part""")
def review_errors(spark, d):
    k, p = F.col("p_size") % 10, table(spark, d, "part")
    pick = lambda usual, **cases: F.coalesce(*[F.when(k == int(n[1:]), v) for n, v in cases.items()], F.lit(usual))
    reviews = p.select(F.when(k == 8, -F.col("p_partkey") - 1).otherwise(F.col("p_partkey")).alias("id"), F.col("p_partkey").alias("own"), pick("h", _1="x").alias("row_hash"), pick("cat", _2="x").alias("catalog_hash"), pick("approved", _3="maybe", _6="rejected", _7="pending", _9="pending").alias("decision"), pick("c1", _4="zz", _5="", _6="", _7="", _9="").alias("code"), pick("me", _6=" ", _7="", _9="").alias("reviewer"), pick("2024-05-01T10:00:00Z", _6="2024-05-01T10:00:00", _7="", _8="", _9="").alias("reviewed_at"), pick("", _7="n").alias("note"))
    rows = p.select(F.col("p_partkey").alias("id"), F.lit("h").alias("row_hash"))
    errors = review.review_errors(reviews.drop("own"), rows, spark.createDataFrame([("c1",)], "code string"), "cat")
    return errors.select(F.when(F.col("id") < 0, -F.col("id") - 1).otherwise(F.col("id")).alias("id"), joined(F.col("errors")).alias("errors"))


_HIER = """WITH r AS (SELECT p_partkey, p_brand AS code, CASE p_partkey % 3 WHEN 0 THEN p_brand || ' whole' WHEN 1 THEN p_brand ELSE '' END AS label, p_type AS code2, CASE WHEN p_size > 25 THEN 'x' ELSE 'yy' END AS label2 FROM part),
    c AS (SELECT code, label AS v, count(*) AS n FROM r WHERE label <> '' GROUP BY ALL), w AS (SELECT code, v FROM (SELECT a.*, (SELECT bool_and(contains(a.v, b.v)) FROM c b WHERE b.code = a.code) AS whole FROM c a) QUALIFY row_number() OVER (PARTITION BY code ORDER BY whole DESC, CASE WHEN whole THEN length(v) ELSE n END DESC, CASE WHEN whole THEN n ELSE length(v) END DESC, v) = 1),
    c2 AS (SELECT code2, label2 AS v, count(*) AS n FROM r GROUP BY ALL), w2 AS (SELECT code2, v FROM c2 QUALIFY row_number() OVER (PARTITION BY code2 ORDER BY n DESC, length(v) DESC, v) = 1)
    SELECT p_partkey, w.v AS label, w2.v AS label2 FROM r LEFT JOIN w USING (code) LEFT JOIN w2 USING (code2)"""


def _hierarchy(spark, d):
    label = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit(" whole"))).when(F.col("p_partkey") % 3 == 1, F.col("p_brand")).otherwise("")
    return table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("code"), label.alias("label"), F.col("p_type").alias("code2"), F.when(F.col("p_size") > 25, "x").otherwise("yy").alias("label2"))


_LEVELS = {"code": "label", "code2": "label2"}


@query(_HIER)
def canonical_hierarchy(spark, d):
    """Labels with one that contains all others, and labels without."""
    return review.canonical_hierarchy(_hierarchy(spark, d), _LEVELS).select("p_partkey", "label", "label2")


@query("""WITH r AS (SELECT p_brand AS code, CASE p_partkey % 3 WHEN 0 THEN p_brand || ' whole' WHEN 1 THEN p_brand END AS label, p_type AS code2, CASE WHEN p_size > 25 THEN 'x' ELSE 'yy' END AS label2 FROM part)
    SELECT 'label' AS level, code, count(DISTINCT label) AS labels FROM r GROUP BY code HAVING count(DISTINCT label) <> 1 UNION ALL SELECT 'label2', code2, count(DISTINCT label2) FROM r GROUP BY code2 HAVING count(DISTINCT label2) <> 1""")
def hierarchy_violations(spark, d):
    return review.hierarchy_violations(_hierarchy(spark, d), _LEVELS)


@query("""WITH r AS (SELECT p_partkey, p_size % 2 = 0 AS a, p_size % 3 = 0 AS b, p_size % 5 = 0 AS c, p_size % 7 = 0 AS e, p_size % 11 = 0 AS f, p_size % 13 = 0 AS g FROM part), x AS (SELECT *, CASE WHEN a OR b THEN 'not_usable' WHEN c OR g THEN 'forbidden' WHEN e THEN 'discouraged' ELSE 'allowed' END AS "primary" FROM r)
    SELECT p_partkey, NOT a AS codable, NOT (a OR b) AS morbidity, "primary", "primary" = 'allowed' AND NOT f AND NOT g AS single FROM x""")
def code_eligibility(spark, d):
    flags = [F.col("p_size") % n == 0 for n in (2, 3, 5, 7, 11, 13)]
    return table(spark, d, "part").select("p_partkey", review.eligibility(*flags).alias("x")).select("p_partkey", "x.*")


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 THEN 'T' || p_partkey ELSE p_name END AS title, CASE WHEN p_size % 2 = 0 THEN 'c' ELSE '' END AS code, array_to_string(list_filter(string_split(lower(p_name), ' '), lambda x: length(x) >= 4)[:1], '|') AS symptoms, p_size % 3 = 0 AS hidden, p_size % 4 = 0 AS renamed FROM part WHERE p_size % 5 <> 0""")
def reference_index(spark, d):
    p, size = table(spark, d, "part").withColumnRenamed("p_partkey", "id"), F.col("p_size")
    words = F.transform(F.filter(F.split(F.upper("p_name"), " "), lambda w: F.length(w) >= 4), lambda w: w)
    rows = p.select("id", F.col("p_name").alias("name"), F.when(size % 2 == 0, "c").alias("code"), words.alias("symptoms"), (size % 5 == 0).alias("ui"), (size % 10 == 0).alias("tcm"))
    out = review.reference_index(rows, p.filter(size % 3 == 0).select("id"), p.filter(size % 4 == 0).select("id", F.concat(F.lit("T"), F.col("id").cast("string")).alias("title")), most=1)
    return out.withColumn("symptoms", joined(F.col("symptoms")))


@query("""WITH r AS (SELECT p_brand, p_partkey, list_concat(string_split(p_name, ' '), CASE WHEN p_size % 3 = 0 THEN ['more', lower(p_type)] ELSE [] END) AS f FROM part)
    SELECT p_brand, p_partkey, array_to_string(f[:3], '|') AS symptoms FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY len(f) DESC, p_partkey) = 1) WHERE len(f) >= 3""")
def gold_case_rows(spark, d):
    none = F.array().cast("array<string>")
    cell = F.concat(F.split("p_name", " "), F.when(F.col("p_size") % 3 == 0, F.array(F.lit("more"), F.lower("p_type"))).otherwise(none))
    return review.gold_cases(table(spark, d, "part"), "p_brand", cell, "p_partkey", most=3).select("p_brand", "p_partkey", joined(F.col("symptoms")).alias("symptoms"))


@query("""SELECT least(7, count(DISTINCT p_name)) AS n, 0 AS covered FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size = 50)""")
def stable_sample(spark, d):
    """The names depend on a hash that SQL lacks; their number and that none is covered do not."""
    p = table(spark, d, "part")
    covered = p.filter("p_size = 50").select("p_name")
    sample = review.stable_sample(p, covered, "p_name", 7)
    return sample.join(covered.distinct().withColumn("c", F.lit(1)), "p_name", "left").agg(F.count("*").alias("n"), F.count("c").alias("covered"))


@query("""SELECT s_suppkey, round(least(s_nationkey, 20) * 50 + length(s_name) / 6.0 + least(length(repeat('x', s_nationkey * 200)), 3000) / 10.0 + 200 + CASE WHEN s_nationkey % 2 = 0 THEN 800 ELSE 0 END + CASE WHEN s_nationkey > 0 THEN 100 ELSE 0 END, 6) AS score FROM supplier""")
def quality_scores(spark, d):
    s = table(spark, d, "supplier")
    cause = F.repeat(F.lit("x"), F.col("s_nationkey") * 200)
    name = F.when(F.col("s_nationkey") % 2 == 0, F.lit("Bệnh supplier")).otherwise(F.lit("Bệnh khác"))
    score = link.quality_score(F.col("s_nationkey"), F.col("s_name"), cause, [F.col("s_name"), F.lit("x"), cause, F.lit(" ")], name)
    return s.select("s_suppkey", F.round(score, 6).alias("score"))


@query("""WITH w AS (SELECT DISTINCT p_brand AS name, string_split(p_name, ' ')[2] AS western, 'src' || p_size % 2 AS source, CASE WHEN p_size % 3 = 0 THEN 'xac_nhan' ELSE 'can_xac_nhan' END AS status FROM part), i AS (SELECT p_partkey AS item_id, CASE WHEN p_partkey % 4 = 0 THEN string_split(p_name, ' ')[2] ELSE p_name END AS title FROM part WHERE p_partkey < 40 OR p_size = 7),
    x AS (SELECT name, item_id, source, status FROM w JOIN i ON title = western), r AS (SELECT * FROM w WHERE western NOT IN (SELECT title FROM i)), t AS (SELECT western, title FROM (SELECT DISTINCT western, title FROM r JOIN i ON contains(' ' || title || ' ', ' ' || western || ' ')) QUALIFY row_number() OVER (PARTITION BY western ORDER BY length(title), title) <= 2),
    l AS (SELECT name, item_id, source, 'can_xac_nhan' AS status FROM r JOIN t USING (western) JOIN i USING (title)), a AS (SELECT * FROM x UNION ALL SELECT * FROM l)
    SELECT name, item_id, CASE WHEN bool_or(status = 'xac_nhan') THEN 'xac_nhan' ELSE 'can_xac_nhan' END AS status, string_agg(DISTINCT source, '+' ORDER BY source) AS sources FROM a GROUP BY name, item_id""")
def disease_links(spark, d):
    p, size = table(spark, d, "part"), F.col("p_size")
    second = F.split("p_name", " ")[1]
    wanted = p.select(F.col("p_brand").alias("name"), second.alias("western"), F.concat(F.lit("src"), (size % 2).cast("string")).alias("source"), F.when(size % 3 == 0, "xac_nhan").otherwise("can_xac_nhan").alias("status")).distinct()
    items = p.filter("p_partkey < 40 or p_size = 7").select(F.col("p_partkey").alias("item_id"), F.when(F.col("p_partkey") % 4 == 0, second).otherwise(F.col("p_name")).alias("title"))
    return link.disease_links(wanted, items, 2)


@query("""SELECT c_custkey, CASE WHEN role = 'doctor' THEN c_acctbal END AS vision, answer, CASE WHEN role = 'doctor' THEN array_to_string(list_transform(its, lambda x: x.n), '|') WHEN len(ok) > 0 THEN array_to_string(list_transform(ok[:5], lambda x: x.n), '|') END AS reference
    FROM (SELECT *, list_filter(its, lambda x: x.s) AS ok FROM (SELECT c_custkey, c_acctbal, c_name AS answer, CASE WHEN c_custkey % 3 = 0 THEN 'doctor' ELSE 'user' END AS role, list_transform(range(c_nationkey), lambda i: {'n': 'b' || i, 's': i % 3 = 0}) AS its FROM customer))""")
def role_views(spark, d):
    """What a doctor and another user see of one result."""
    c = table(spark, d, "customer")
    numbers = F.filter(F.sequence(F.lit(0), F.col("c_nationkey")), lambda i: i < F.col("c_nationkey"))
    items = F.transform(numbers, lambda i: F.struct(F.concat(F.lit("b"), i.cast("string")).alias("ten_benh"), F.lit("x").alias("icd10_code"), F.lit("l").alias("trang_thai_label"), F.when(i % 3 == 0, "da_kiem_duyet").otherwise("chua").alias("trang_thai"), F.lit("secret").alias("thuoc")))
    result = F.struct(F.col("c_name").alias("answer"), F.col("c_acctbal").alias("vision_details"), F.lit("i").alias("input_fusion"), F.lit("m").alias("has_makeup"))
    role = F.when(F.col("c_custkey") % 3 == 0, "doctor").otherwise("user")
    out = c.select("c_custkey", review.role_view(result, items, role, ["answer"]).alias("v"))
    return out.select("c_custkey", F.col("v.vision_details").alias("vision"), F.col("v.answer").alias("answer"), joined(F.transform("v.reference", lambda x: x["ten_benh"])).alias("reference"))


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE c_mktsegment END AS v, false AS is_new FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' END, true FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0""")
def merge_upsert(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return mutate.upsert(c.filter("k % 3 > 0"), c.filter("k % 2 = 0").withColumn("v", F.lit("new")), ["k"])


@query("""SELECT l_orderkey AS src, l_partkey AS dst, l_returnflag AS nguon FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT o_orderkey, o_custkey, 'R' FROM orders WHERE o_orderstatus = 'P'""")
def rebuilt_edges(spark, d):
    edges = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("nguon"))
    fresh = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    return mutate.rebuild_derived(edges, fresh, "nguon", "R")


@query("""WITH e AS (SELECT l_partkey AS id FROM lineitem WHERE l_returnflag <> 'R') SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'R' END AS nguon FROM part WHERE p_size % 2 = 1 OR p_partkey IN (SELECT id FROM e)""")
def undone_nodes(spark, d):
    edges = table(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), (-F.col("l_orderkey") - 1).alias("dst"), F.col("l_returnflag").alias("nguon"))
    nodes = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, "R").alias("nguon"))
    return mutate.undo_nodes(nodes, edges, "nguon", "R")


@query("""SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 40) AND l_orderkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 40)""")
def detached_edges(spark, d):
    edges = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))
    nodes = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_size")
    return mutate.detach_delete(nodes, edges, nodes.filter("p_size > 40"))[1]


@query("""SELECT o_orderkey AS id, coalesce(n_name, 'old') AS syndrome FROM orders LEFT JOIN (SELECT o_orderkey AS k, min(n_name) AS n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus <> 'P' GROUP BY 1) ON k = o_orderkey""")
def synced_names(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("old").alias("syndrome"))
    names = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("id"), F.col("n_name").alias("name"))
    edges = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"))
    return mutate.synced_names(rows, edges, names, "syndrome")


@query("SELECT p_partkey AS id, p_size % 3 = 0 AS flagged FROM part")
def flagged_names(spark, d):
    """Flags set on dirty names and taken off clean ones."""
    name = F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" (x)"))).otherwise(F.col("p_name"))
    nodes = table(spark, d, "part").select(F.col("p_partkey").alias("id"), name.alias("name"), (F.col("p_size") % 2 == 0).alias("flagged"))
    return mutate.flagged(nodes, G.is_dirty_name(F.col("name"))).select("id", "flagged")


@query("""SELECT l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') UNION ALL SELECT DISTINCT o_orderkey, 'c' || o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def replaced_members(spark, d):
    edges = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"))
    members = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("src"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("dst"))
    return mutate.replaced_members(edges, members)


@query("""WITH h AS (SELECT o_orderkey AS id, count(DISTINCT p_type) FILTER (WHERE p_type IN ('SMALL', 'LARGE')) AS hits FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1), g AS (SELECT id, hits, o_custkey, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY hits DESC, id DESC) AS k FROM h JOIN orders ON o_orderkey = id)
    SELECT id, k = 1 AS keep FROM g WHERE n > 1""")
def largest_overlap(spark, d):
    nodes = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus")
    members = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_orderkey").alias("id"), F.col("p_type").alias("member"))
    wanted = nodes.select("o_custkey", "o_orderstatus").distinct().select("*", F.explode(F.array(F.lit("SMALL"), F.lit("LARGE"))).alias("member"))
    return mutate.keep_largest_overlap(nodes, members, wanted, ["o_custkey", "o_orderstatus"])


@query("""WITH h AS (SELECT DISTINCT l_orderkey AS k, p_type AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R'), w AS (SELECT DISTINCT l_orderkey AS k, lower(p_type) AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R')
    SELECT k, n, 'add' AS action FROM w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.k = w.k AND lower(h.n) = lower(w.n)) UNION ALL SELECT k, n, 'remove' FROM h WHERE k IN (SELECT k FROM w) AND NOT EXISTS (SELECT 1 FROM w WHERE h.k = w.k AND lower(h.n) = lower(w.n))""")
def edge_sync(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_orderkey").alias("k"), F.col("p_type").alias("n"), "l_returnflag")
    return mutate.edge_sync(rows.filter("l_returnflag = 'R'").select("k", "n"), rows.filter("l_returnflag <> 'R'").select("k", F.lower("n").alias("n")), ["k"], "n")


@query("""WITH r AS (SELECT DISTINCT o_custkey::VARCHAR AS a, o_orderstatus AS b, o_orderpriority AS c FROM orders), k AS (SELECT DISTINCT c_custkey::VARCHAR AS a FROM customer WHERE c_acctbal > 0), l AS (SELECT DISTINCT o_custkey::VARCHAR AS a, lower(o_orderstatus) AS b FROM orders WHERE o_totalprice > 250000), f AS (SELECT DISTINCT o_custkey::VARCHAR AS a, lower(o_orderstatus) AS b, lower(o_orderpriority) AS c FROM orders WHERE o_totalprice > 200000)
    SELECT * FROM (SELECT r.a AS disease, r.b AS syndrome, r.c AS formula, CASE WHEN k.a IS NULL THEN 'skip' WHEN l.a IS NULL AND f.a IS NULL THEN 'link+formula' WHEN l.a IS NULL THEN 'link' WHEN f.a IS NULL THEN 'formula' END AS action FROM r LEFT JOIN k ON k.a = r.a LEFT JOIN l ON l.a = r.a AND l.b = lower(r.b) LEFT JOIN f ON f.a = r.a AND f.b = lower(r.b) AND f.c = lower(r.c)) WHERE action IS NOT NULL""")
def gap_plan(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("disease"), F.col("o_orderstatus").alias("syndrome"), F.col("o_orderpriority").alias("formula"), "o_totalprice")
    known = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("disease"))
    low = o.withColumn("syndrome", F.lower("syndrome"))
    return mutate.gap_plan(o.select("disease", "syndrome", "formula"), known, low.filter("o_totalprice > 250000"), low.filter("o_totalprice > 200000"))


@query("""SELECT o_custkey AS src, o_orderkey AS dst, NULL AS nguon FROM orders UNION ALL SELECT DISTINCT c_custkey, c_nationkey, 'enrich' FROM customer WHERE c_acctbal > 0""")
def enriched_edges(spark, d):
    edges = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"), F.lit(None).cast("string").alias("nguon"))
    c = table(spark, d, "customer")
    add = c.select(F.col("c_custkey").alias("src"), F.col("c_nationkey").cast("long").alias("dst"))
    nodes = c.filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    once = mutate.enriched(edges, add, nodes)
    return mutate.enriched(once, add, nodes)


@query("""SELECT conv_id || '/' || turn AS id FROM conversations WHERE role = 'user' AND NOT (conv_id = 3 AND turn = 0) UNION ALL SELECT 'new'""")
def history_log(spark, d):
    """One row added, one deleted by its owner, and the owner's list."""
    log = table(spark, d, "conversations").select(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.col("role").alias("username"), F.col("turn").alias("at"))
    log = mutate.history_create(log, spark.createDataFrame([("new", "user", 99)], "id string, username string, at long"))
    if not log.filter("id = '3/0' and username = 'user'").isEmpty():
        log = mutate.history_delete(log, "3/0", "user", "patient")
    return mutate.history_list(log, "user", "patient").select("id")


@query("""SELECT p_partkey, 'new' AS p_type FROM part WHERE p_size % 2 = 0 AND p_type <> 'new'""")
def update_plan(spark, d):
    """What a dry run would change; the rollback has the old rows."""
    p = table(spark, d, "part").select("p_partkey", "p_type")
    changes = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, "new").otherwise(F.col("p_type")).alias("p_type"))
    return mutate.plan_update(p, changes, ["p_partkey"]).changes


@query("""WITH c AS (SELECT p_partkey AS id, p_name AS name, 'src' AS source, CASE WHEN p_size % 2 = 0 THEN 'xac_nhan' ELSE 'can_xac_nhan' END AS status, NULL AS score FROM part WHERE p_size > 20 UNION ALL SELECT p_partkey, p_brand, 'may_de_xuat', 'may_de_xuat', p_size FROM part WHERE p_size < 40)
    SELECT id, string_agg(name || '/' || status || '/' || coalesce(score::INT::VARCHAR, ''), '|' ORDER BY status <> 'xac_nhan', name) AS links FROM c GROUP BY id""")
def exported_links(spark, d):
    from trellis.sources import tables

    p = table(spark, d, "part").withColumnRenamed("p_partkey", "id")
    sure = p.filter("p_size > 20").select("id", F.col("p_name").alias("name"), F.lit("src").alias("source"), F.when(F.col("p_size") % 2 == 0, "xac_nhan").otherwise("can_xac_nhan").alias("status"))
    out = tables.export_links(sure, p.filter("p_size < 40").select("id", F.col("p_brand").alias("name"), F.col("p_size").alias("score")))
    row = lambda x: F.concat_ws("/", x["name"], x["status"], F.coalesce(x["score"].cast("string"), F.lit("")))
    return out.select("id", joined(F.transform("links", row)).alias("links"))
