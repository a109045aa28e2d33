"""Gates, case matching and syndrome rules, on texts whose results are known and on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.operators import diagnose as D
from trellis.operators import gates, rank
from trellis.plans.registry import cases, query, table

joined = lambda c: F.array_join(c, "|")
part = lambda c, k: F.split(c, "#")[k]
items = lambda c, k: F.filter(F.split(part(c, k), ","), lambda x: x != "")

cases("pulse_fields", lambda c: D.is_pulse_field(c), [("mạch trầm tế", "true"), ("Mạch Huyền", "true"), ("giãn tĩnh mạch", "false"), ("mạch máu tắc", "false"), ("rêu vàng; mạch hoạt", "false"), ("phù", "false"), ("", "false")])
cases("concepts", lambda c: joined(D.concepts_of(c)), [("đi ngoài nhiều lần", "tiêu chảy"), ("Phân lỏng nát", "tiêu chảy"), ("tiêu chảy ra máu", ""), ("ho đờm lỏng loãng", ""), ("đại tiện lỏng nhão", "tiêu chảy"), (None, "")])
cases("reproductive_gate", lambda c: D.reproductive_conflict(part(c, 0), part(c, 1)), [("Động thai#kinh nguyệt không đều", "true"), ("Động thai#có thai, kinh nguyệt trước đó đều", "false"), ("Thống kinh#hành kinh", "false"), ("Sản hậu phúc thống#mới sinh, đau bụng", "false"), ("Lưu sản#hành kinh", "true"), ("Động thai#đau bụng", "false")])


def _gates():
    gate = lambda names, words, wanted, whole: F.struct(*[F.array(*[F.lit(x) for x in xs]).cast("array<string>").alias(n) for n, xs in (("names", names), ("names_regex", words), ("requires", wanted))], F.lit(whole).alias("kw_wb"))
    return F.array(gate(["hen"], [], ["khò khè"], False), gate([], ["lao"], ["ho"], True), gate(["tây y"], [], [], False))


cases("name_gates", lambda c: D.name_gate_conflict(part(c, 0), part(c, 1), _gates()), [("Hen suyễn#khò khè đêm", "false"), ("Hen suyễn#ho", "true"), ("Lao phổi#ho ra máu", "false"), ("Lao phổi#choáng", "true"), ("Hư laox#mệt", "false"), ("Bệnh tây y#ho, khò khè", "true"), ("Sởi#", "false")])
cases("locator_marks", lambda c: D.is_locator_mark(c), [("đau mắt", "true"), ("cục ở vú", "true"), ("nghẹt mũi", "true"), ("hoa mắt", "false"), ("ù tai", "false"), ("vàng mắt", "false"), ("tai nạn", "false"), ("mắt", "false"), ("núm vú", "false"), ("hậu môn", "false")])
cases("chief_ratios", lambda c: F.round(D.chief_ratio(part(c, 0), part(c, 1), F.array(F.lit("đau mắt"), F.lit("cộm mắt"))), 2), [("đau mắt, mắt đỏ, cộm mắt#Đau mắt từ hôm qua", "0.5"), ("đau mắt, cộm mắt#hoa mắt, chóng mặt", "0.0"), ("mắt đỏ#đau mắt", "0.0"), ("cộm mắt#cộm mắt", "1.0")])
cases("match_ways", lambda c: D.match_way(part(c, 0), items(c, 1)), [("đau đầu#đau đầu dữ dội,sốt", "1"), ("đau nhiều#sốt,đau rất nhiều", "2"), ("đi ngoài nhiều lần#ỉa chảy", "3"), ("ho#sốt", None), ("#sốt", None)])
cases("generic_terms", lambda c: joined(D.generic_filter(items(c, 0), ["mệt mỏi", "ăn kém"])), [("Mệt mỏi,ho khan", "ho khan"), ("ăn kém", ""), ("sốt,ho", "sốt|ho")])


def _clusters():
    groups = [["can vị bất hòa", "can khí phạm vị", "can vị bất hòa (can khí uất trệ)"], ["vị âm hư", "vị âm bất túc"]]
    return F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])


cases("synonym_pairs", lambda c: D.are_synonyms(part(c, 0), part(c, 1), _clusters()), [("Can vị bất hòa#Can khí phạm vị", "true"), ("Can vị bất hòa (x)#can  khí phạm vị", "true"), ("Vị âm hư#vị âm hư", "false"), ("Vị âm hư#Can khí phạm vị", "false"), ("A#B", "false")])
cases("regrounded_cores", lambda c: D.reground(part(c, 0), items(c, 1), items(c, 2), _clusters()), [("Khí trệ#Khí trệ,Thực tích,Thương thực#Vị nhiệt,Thương thực", "Thương thực"), ("Can vị bất hòa#Thương thực#Can khí phạm vị,Thương thực", "Can vị bất hòa"), ("Phế khí hư#Phong hàn#Khí hư,Phong hàn", "Phế khí hư"), ("Độc ứ#Huyết ứ#Vị nhiệt", "Độc ứ"), ("Khí trệ#Thương thực#", "Khí trệ"), ("Âm hư thấp nhiệt#Thận dương hư#Âm hư,Thận dương hư", "Thận dương hư")])


def _matched(c):
    """``ratio:syndrome+syndrome,…`` as structs."""
    one = lambda x: F.struct(F.substring_index(x, ":", 1).cast("double").alias("ratio"), F.split(F.substring_index(x, ":", -1), r"\+").alias("syndromes"))
    return F.transform(items(c, 2), one)


cases("concurrent_syndromes", lambda c: D.concurrent(part(c, 0), part(c, 1), _matched(c), items(c, 3), part(c, 4) == "1"), [("Phong nhiệt#Doanh vệ bất hòa#0.8:phong nhiệt,0.4:doanh vệ bất hòa#A#0", "Không có"), ("Phong nhiệt#Doanh vệ bất hòa#0.8:phong nhiệt,0.72:doanh vệ bất hòa#A,B#0", "Doanh vệ bất hòa"), ("Phong hàn#Phong nhiệt#0.75:phong hàn+phong nhiệt#A#0", "Không có"), ("Khí hư#Tâm huyết hư#0.5:khí hư#A#1", "Tâm huyết hư"), ("A#Không có#0.5:x#A#0", "Không có"), ("A#B#0.5:x##0", "B"), ("A#B##A#0", "B"), ("Can uất#Tỳ khí hư#0.7:tỳ khí hư (kèm thấp)#A#0", "Tỳ khí hư")])
cases("herb_cells", D.distinct_herbs, [("Sinh mẫu lệ, Mẫu lệ", "Mẫu lệ"), ("Màn kinh, Mạn kinh tử", "Mạn kinh tử"), ("Đương qui, Đương quy", "Đương qui, Đương quy"), ("Sâm, Quy. (Nếu lạnh gia: Quế)", "Sâm, Quy"), ("Nhân sâm (hoặc Đảng sâm), A giao", "Nhân sâm, A giao"), ("Cam thảo (chích), Tri mẫu (tẩm muối)", "Cam thảo (chích), Tri mẫu (tẩm muối)"), ("Hoàng cầm, (kết hợp bột X)", "Hoàng cầm"), ("Sinh địa, sâm", "Sinh địa, sâm"), ("", "")])
cases("herb_safety", lambda c: F.concat_ws("/", joined(D.herb_warnings(c)["toxic"]), joined(D.herb_warnings(c)["opposed"])), [("Cam toại, Đại kích, Cam thảo", "cam toại|đại kích/cam thảo + cam toại|cam thảo + đại kích"), ("Chu sa, Hoàng liên", "chu sa/"), ("Địa phụ tử, Bối mẫu", "/"), ("Phụ tử, Thổ bối mẫu", "/"), ("Phụ tử, Bối mẫu", "/phụ tử + bối mẫu"), ("", "/")])
cases("formula_signs", lambda c: D.formula_conflict(part(c, 0), part(c, 1).cast("double")), [("Phong hàn#-0.5", "true"), ("Phong hàn#0.5", "false"), ("Thấp nhiệt#0.5", "true"), ("Tỳ hư hàn#-2", "false"), ("Khí trệ#1", "false")])

_WORDS = "list_distinct(string_split(p_name, ' '))"


@query(f"""WITH r AS (SELECT p_partkey, {_WORDS} AS f FROM part), q AS (SELECT s_suppkey, list_distinct(list_concat(string_split(lower(s_name), '#'), ['red', CASE s_suppkey % 4 WHEN 0 THEN 'bolt' WHEN 1 THEN 'gear' WHEN 2 THEN 'ring' ELSE 'widget' END])) AS s FROM supplier),
    m AS (SELECT s_suppkey, p_partkey, len(list_filter(f, lambda x: list_contains(s, x))) AS matched, len(f) AS observable FROM q, r)
    SELECT s_suppkey, p_partkey, matched, observable, matched / observable AS ratio FROM m WHERE matched >= 2 AND matched / observable >= 0.3""")
def matched_cases(spark, d):
    """Suppliers as cases of two complaints, parts as rows whose words are fields, a pulse field beside them."""
    word = F.element_at(F.array(*[F.lit(w) for w in ("bolt", "gear", "ring", "widget")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    said = table(spark, d, "supplier").select("s_suppkey", F.array(F.lit("red"), word).alias("said"))
    rows = table(spark, d, "part").select("p_partkey", F.concat(F.array_join(F.array_distinct(F.split("p_name", " ")), ", "), F.lit(", mạch trầm")).alias("cell"))
    return D.match_cases(said, rows, "s_suppkey", "p_partkey", "said", "cell")


@query("""WITH t AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS term FROM part), n AS (SELECT count(*) AS n FROM part)
    SELECT term, count(*) AS df, round(ln(any_value(n) / (1.0 + count(*))), 6) AS idf FROM t, n GROUP BY term""")
def symptom_idfs(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(", ")).alias("cell"))
    return D.symptom_idf(rows, "p_partkey", "cell").select("term", "df", F.round("idf", 6).alias("idf"))


@query("""WITH b AS (SELECT l_suppkey % 5 AS c, p_brand, max((l_quantity / 50, l_linenumber, -l_orderkey, p_type)) AS m, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS syndromes FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity >= 25 GROUP BY ALL)
    SELECT * FROM (SELECT c, p_brand, m[4] AS p_type, syndromes, row_number() OVER (PARTITION BY c ORDER BY m[1] DESC, m[2] DESC, p_brand) AS rank FROM b) WHERE rank <= 3""")
def ranked_candidates(spark, d):
    """Lines as passed rows: their quantity as ratio, the line's order as row."""
    lines = table(spark, d, "lineitem").filter("l_quantity >= 25").join(table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
    row = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    lines = lines.withColumn("key", F.col("l_orderkey")).withColumn("c", F.col("l_suppkey") % 5)
    passed = lines.select("c", "key", F.col("l_linenumber").alias("matched"), (F.col("l_quantity") / 50).alias("ratio"), F.xxhash64(row).alias("line"), "p_brand", "p_type")
    best = passed.groupBy("c", "p_brand").agg(F.max(F.struct("ratio", "matched", (-F.col("key")).alias("k"), "p_type")).alias("b"), F.sort_array(F.collect_set("p_type")).alias("xs"))
    one = best.select("c", "p_brand", F.col("b.p_type").alias("p_type"), F.array_join("xs", "|").alias("syndromes"), F.col("b.ratio").alias("ratio"), F.col("b.matched").alias("matched"))
    return rank.top_k(one, ["c"], [F.desc("ratio"), F.desc("matched"), F.col("p_brand")], 3).select("c", "p_brand", "p_type", "syndromes", "rank")


@query("""WITH s AS (SELECT p_name AS name, count(*) AS score, bool_or(p_size = 50) AS flag FROM (SELECT CASE WHEN p_partkey % 7 = 0 THEN 'thể ' || p_name WHEN p_partkey % 7 = 1 THEN p_name || ' (x)' ELSE p_name END AS p_name, p_size FROM part) GROUP BY 1)
    SELECT name, score FROM s WHERE NOT regexp_matches(name, '[0-9(]') AND NOT starts_with(lower(name), 'thể ') AND NOT coalesce(flag, false)""")
def scored_names(spark, d):
    name = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("thể "), "p_name")).when(F.col("p_partkey") % 7 == 1, F.concat("p_name", F.lit(" (x)"))).otherwise(F.col("p_name"))
    scored = table(spark, d, "part").select(name.alias("name"), "p_size").groupBy("name").agg(F.count("*").alias("score"), F.max(F.col("p_size") == 50).alias("flag"))
    return D.scored_syndromes(scored, "name", F.col("flag")).select("name", "score")


@query("""WITH c AS (SELECT DISTINCT c_nationkey AS cluster, lower(c_mktsegment) AS k FROM customer)
    SELECT x.k AS a, y.k AS b FROM c x JOIN c y ON x.cluster = y.cluster AND x.k <> y.k""")
def synonym_table(spark, d):
    names = table(spark, d, "customer").select(F.col("c_nationkey").alias("cluster"), F.concat("c_mktsegment", F.lit(" (note)")).alias("name")).distinct()
    return gates.synonyms(names)


@query("""WITH lex(word, score) AS (VALUES ('red', 1.0), ('red ring', 2.0), ('bolt', -1.0), ('small', -2.0)), n AS (SELECT DISTINCT p_name AS h FROM part),
    m AS (SELECT h, arg_max(score, (word = h, length(word), word)) AS s FROM n JOIN lex ON contains(' ' || h || ' ', ' ' || word || ' ') GROUP BY h),
    f AS (SELECT DISTINCT l_orderkey, p_name AS h FROM lineitem JOIN part ON p_partkey = l_partkey) SELECT l_orderkey, round(avg(s), 6) AS mean FROM f JOIN m USING (h) GROUP BY l_orderkey""")
def thermal_means(spark, d):
    lexicon = spark.createDataFrame([("red", 1.0), ("red ring", 2.0), ("bolt", -1.0), ("small", -2.0)], "word string, score double")
    formulas = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "p_name")
    return D.thermal_mean(formulas, lexicon, "l_orderkey", "p_name", "word", "score").select("l_orderkey", F.round("mean", 6).alias("mean"))


@query("""WITH own AS (SELECT DISTINCT p_brand AS item, unnest(string_split(p_name, ' ')) || p_size % 9 AS term FROM part), n AS (SELECT count(DISTINCT p_brand) AS n FROM part),
    idf AS (SELECT term, ln(any_value(n) / count(DISTINCT item) + 1.0) AS idf FROM own, n GROUP BY term), q AS (SELECT DISTINCT l_orderkey % 20 AS c, string_split(p_name, ' ')[1] || p_size % 9 AS term FROM lineitem JOIN part ON p_partkey = l_partkey),
    s AS (SELECT c, item, count(*) AS matched, round(sum(idf), 6) AS score FROM q JOIN own USING (term) JOIN idf USING (term) GROUP BY ALL HAVING count(*) >= 2)
    SELECT c, item, matched, rank FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY score DESC, item) AS rank FROM s) WHERE rank <= 5""")
def western_references(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("item"), F.split("p_name", " ").alias("words"), (F.col("p_size") % 9).cast("string").alias("n"))
    own = parts.select("item", F.explode("words").alias("w"), "n").select("item", F.concat("w", "n").alias("term"), F.lit("x").alias("status"))
    said = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(parts, F.col("p_partkey") == F.col("l_partkey")).select((F.col("l_orderkey") % 20).alias("c"), F.concat(F.col("words")[0], F.col("n")).alias("term"))
    return D.western_reference(said, own, "c", "term", "item", "status").select("c", "item", "matched", "rank")
