"""Admission gates and the matching of a case against knowledge rows.

The contract is inferred from public test tables, not from source, and may differ where no table tells it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from trellis.functions.clean import fields, is_deficient, is_pulse_field, polarity_sign

MATCH_RATIO, MATCH_LEAST, PEAK_IDF = 0.30, 2, 4.0
WINDOW = 0.15
NONE = "Không có"

# One concept with what tells it, and what changes its meaning.
CONCEPTS = {
    "tiêu chảy": (
        ["ỉa chảy", "ia chảy", "tiêu chảy", "tiết tả", "đi lỏng", "đi tả", "đại tiện lỏng", "đại tiện phân lỏng", "đại tiện nhiều lần", "đi ngoài nhiều lần", "đi ngoài phân lỏng", "đi ngoài lỏng", "phân lỏng", "phân nát", "lỏng nát", "tiêu lỏng", "ỉa lỏng", "phân nhão", "đại tiện nhão", "đại tiện loãng"],
        ["ra máu", "có máu", "lẫn máu", "kèm máu", "máu tươi", "mũi máu", "máu mũi", "mủ máu", "có mủ", "lẫn mủ", "mót rặn", "kiết lỵ"],
    ),
}
# Diseases of pregnancy and childbed, and what a text tells of cycle, pregnancy and birth.
PREGNANCY_DISEASES = ["động thai", "sản hậu", "hậu sản", "lưu sản", "nhâm thần", "tử giản", "sản giật"]
CYCLE_CUES = ["kinh nguyệt", "hành kinh", "thống kinh"]
PREGNANCY_CUES = ["có thai", "mang thai", "thai kỳ", "mới sinh", "sau sinh", "sau đẻ", "hậu sản"]
# Organs and complaints that together locate a disease; marks that need no organ.
ORGANS = ["mắt", "vú", "mũi", "tai", "họng", "răng", "lưỡi", "bụng", "lưng", "gối", "khớp", "đầu", "ngực"]
COMPLAINTS = ["đau", "sưng", "cộm", "nhức", "cục", "áp xe", "nghẹt", "chảy", "sổ", "ngứa", "loét", "viêm"]
SEX_MARKS = ["liệt dương", "di tinh", "xuất tinh sớm", "thống kinh", "bế kinh", "băng lậu", "đới hạ"]
# Organs that a syndrome's variant may name in front.
VISCERA = ["can", "tâm", "tỳ", "vị", "phế", "thận", "đởm", "đại trường", "tiểu trường", "bàng quang"]
# Spellings and ways of processing of herbs.
HERB_ALIASES = {"màn kinh": "Mạn kinh tử"}
HERB_PREFIXES = ["sinh", "chích", "trích", "sao", "chế"]
# Strongly toxic herbs, pairs that must not meet, and names that only look alike.
TOXIC_HERBS = ["cam toại", "nguyên hoa", "đại kích", "chu sa"]
OPPOSED_HERBS = [("cam thảo", "cam toại"), ("cam thảo", "đại kích"), ("cam thảo", "nguyên hoa"), ("phụ tử", "bối mẫu")]
LOOKALIKES = ["địa phụ tử", "ma hoàng căn", "thổ bối mẫu"]


def _any(c: Column, words: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: c.contains(w))


# --- gates ----------------------------------------------------------------------------------------------------


def reproductive_conflict(disease: Column, text: Column) -> Column:
    """A disease of pregnancy or childbed, and a text that tells of the cycle and of neither."""
    d, t = F.lower(disease), F.lower(F.coalesce(text, F.lit("")))
    return _any(d, PREGNANCY_DISEASES) & _any(t, CYCLE_CUES) & ~_any(t, PREGNANCY_CUES)


def name_gate_conflict(name: Column, text: Column, gates: Column) -> Column:
    """Whether any gate (names, names_regex, requires, kw_wb) that is about the disease finds no required word in the text.

    ``names`` are parts of the disease name, ``names_regex`` whole words of it; without required words a gate always
    drops; with ``kw_wb`` they must be whole words of the text.
    """
    d, t = F.lower(name), F.lower(F.coalesce(text, F.lit("")))
    word = lambda c, w: F.rlike(c, F.concat(F.lit(r"(?U)\b\Q"), w, F.lit(r"\E\b")))
    about = lambda g: F.exists(g["names"], lambda n: d.contains(n)) | F.exists(g["names_regex"], lambda n: word(d, n))
    told = lambda g: F.exists(g["requires"], lambda w: F.when(F.coalesce(g["kw_wb"], F.lit(False)), word(t, w)).otherwise(t.contains(w)))
    return F.exists(gates, lambda g: about(g) & ~told(g))


def is_locator_mark(c: Column) -> Column:
    """A chief complaint that tells where a disease is: an organ together with a complaint, several words."""
    k = F.lower(F.trim(c))
    whole = lambda words: k.rlike(r"(?U)\b(" + "|".join(words) + r")\b")
    return k.contains(" ") & whole(ORGANS) & whole(COMPLAINTS)


def admitted_marks(rows: DataFrame, chief: str, most: int) -> DataFrame:
    """(mark): chief complaints that admit a disease: of one sex, or locating and in at most ``most`` rows."""
    marks = rows.select(F.explode(F.array_distinct(fields(F.lower(chief)))).alias("mark")).groupBy("mark").agg(F.count("*").alias("df"))
    return marks.filter(F.col("mark").isin(SEX_MARKS) | (is_locator_mark(F.col("mark")) & (F.col("df") <= most))).select("mark")


def chief_ratio(chief: Column, text: Column, admitted: Column) -> Column:
    """Share of a row's admitted marks that the text tells."""
    own = F.array_intersect(F.array_distinct(fields(F.lower(chief))), admitted)
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.size(own) == 0, 0.0).otherwise(F.size(F.filter(own, lambda m: low.contains(m))) / F.size(own))


# --- matching -------------------------------------------------------------------------------------------------


def concepts_of(c: Column, concepts: dict[str, tuple[list[str], list[str]]] = CONCEPTS) -> Column:
    """Concepts that one complaint tells, without those that it vetoes."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.array_compact(F.array(*[F.when(_any(low, told) & ~_any(low, veto), name) for name, (told, veto) in concepts.items()]))


def match_way(field: Column, said: Column) -> Column:
    """How a field meets an array of complaints: 1 one contains the other, 2 all its words in one, 3 a shared concept; else null."""
    f = F.lower(F.trim(field))
    words = F.split(f, r"\s+")
    low = F.transform(said, lambda s: F.lower(F.trim(s)))
    first = F.exists(low, lambda s: (s != "") & (f.contains(s) | s.contains(f)))
    second = F.exists(low, lambda s: F.forall(words, lambda w: F.array_contains(F.split(s, r"\s+"), w)))
    third = F.arrays_overlap(concepts_of(f), F.flatten(F.transform(low, lambda x: concepts_of(x))))
    return F.when(f == "", None).when(first, 1).when(second, 2).when(third, 3)


def generic_filter(said: Column, generic: list[str]) -> Column:
    """Complaints that say something specific."""
    return F.filter(said, lambda s: ~F.lower(F.trim(s)).isin(generic))


def match_cases(cases: DataFrame, rows: DataFrame, case: str, row: str, said: str, cell: str, idf: DataFrame | None = None, peak: float = PEAK_IDF) -> DataFrame:
    """(case, row, matched, observable, ratio) of the rows that a case passes.

    Pulse fields are not observable and don't count.  Fields that meet the case through one concept only count once.
    A row passes with MATCH_LEAST matched fields and MATCH_RATIO of its observable ones; with ``idf`` (term, idf) one
    matched field must reach ``peak``.  Candidates share a word or a concept with the case: an equi-join.
    """
    observed = rows.select(row, F.filter(fields(F.col(cell)), lambda f: ~is_pulse_field(f)).alias("__f")).filter(F.size("__f") > 0)
    # Cases that say the same and rows with the same fields are classes: classes are matched, then their members put out.
    # A class is told by a hash of its own array; rows and cases without a key pass nothing.
    name = lambda c: F.unhex(F.sha2(F.to_json(F.struct(c)), 256))
    whose = cases.filter(F.col(case).isNotNull()).select(case, F.col(said).alias("__s")).withColumn("__u", name("__s"))
    where = observed.filter(F.col(row).isNotNull()).withColumn("__v", name("__f"))
    says, shows = whose.select("__u", "__s").distinct(), where.select("__v", "__f").distinct()
    keys = lambda xs: F.explode(F.array_distinct(F.flatten(F.transform(xs, lambda x: F.concat(F.split(F.lower(F.trim(x)), r"\s+"), F.transform(concepts_of(x), lambda c: F.concat(F.lit("#"), c)))))))
    meet = says.select("__u", keys(F.col("__s")).alias("__k")).join(shows.select("__v", keys(F.col("__f")).alias("__k")), "__k").select("__u", "__v").distinct()
    pairs = meet.join(says, "__u").join(shows, "__v")
    ways = F.transform("__f", lambda f: F.struct(f.alias("field"), match_way(f, F.col("__s")).alias("way")))
    hit = F.filter(ways, lambda w: w["way"].isNotNull())
    told = F.filter(hit, lambda w: w["way"] < 3)
    bridged = F.array_distinct(F.flatten(F.transform(F.filter(hit, lambda w: w["way"] == 3), lambda w: concepts_of(w["field"]))))
    known = F.array_distinct(F.flatten(F.transform(told, lambda w: concepts_of(w["field"]))))
    matched = F.size(told) + F.size(F.array_except(bridged, known))
    alike = pairs.select("__u", "__v", matched.alias("matched"), F.size("__f").alias("observable"), F.transform(hit, lambda w: F.lower(F.trim(w["field"]))).alias("__hits"))
    alike = alike.withColumn("ratio", F.col("matched") / F.col("observable")).filter((F.col("matched") >= MATCH_LEAST) & (F.col("ratio") >= MATCH_RATIO))
    if idf is not None:
        top = alike.select("__u", "__v", F.explode("__hits").alias("term")).join(idf, "term").groupBy("__u", "__v").agg(F.max("idf").alias("__peak")).filter(F.col("__peak") >= peak)
        alike = alike.join(top, ["__u", "__v"], "left_semi")
    # Rows are dealt evenly, by their own key, before each is put out with all the cases that it passes.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    met = where.select(row, "__v").repartition(parts, row).join(alike.drop("__hits"), "__v").drop("__v")
    return met.join(whose.select(case, "__u"), "__u").select(case, row, "matched", "observable", "ratio")


def symptom_idf(rows: DataFrame, row: str, cell: str) -> DataFrame:
    """(term, df, idf): log(N / (1 + df)) of each observable field over all rows."""
    terms = rows.select(row, F.explode(F.array_distinct(F.transform(F.filter(fields(F.col(cell)), lambda f: ~is_pulse_field(f)), lambda f: F.lower(f)))).alias("term"))
    n = rows.agg(F.count_distinct(row).alias("n"))
    df = terms.groupBy("term").agg(F.count_distinct(row).alias("df"))
    return df.crossJoin(F.broadcast(n)).select("term", "df", F.log(F.col("n") / (1.0 + F.col("df"))).alias("idf"))  # one row of totals


def ranked_diseases(passed: DataFrame, names: DataFrame, case: str, row: str, disease: str, syndrome: str) -> DataFrame:
    """(case, disease, syndrome of the best row, all syndromes, ratio, rank), ties by matched fields and name."""
    best = passed.join(names.select(row, disease, syndrome), row)
    order = F.max(F.struct("ratio", "matched", (-F.col(row)).alias("r"), syndrome)).alias("b")
    one = best.groupBy(case, disease).agg(order, F.sort_array(F.collect_set(syndrome)).alias("syndromes")).select(case, disease, F.col(f"b.{syndrome}").alias(syndrome), "syndromes", F.col("b.ratio").alias("ratio"), F.col("b.matched").alias("matched"))
    w = Window.partitionBy(case).orderBy(F.desc("ratio"), F.desc("matched"), disease)
    return one.withColumn("rank", F.row_number().over(w))


# --- syndromes ------------------------------------------------------------------------------------------------


def _key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"\([^)]*\)", " "), r"(?U)\s+", " "))


def are_synonyms(a: Column, b: Column, clusters: Column) -> Column:
    """Whether two different names stand in one cluster (an array of arrays of names), brackets ignored."""
    x, y = _key(a), _key(b)
    return (x != y) & F.exists(clusters, lambda c: F.exists(c, lambda n: _key(n) == x) & F.exists(c, lambda n: _key(n) == y))


def is_grounded(syndrome: Column, window: Column, clusters: Column) -> Column:
    """Whether the window's syndromes have it, a synonym of it, or it without the organs that it names in front."""
    s = _key(syndrome)
    bare = F.regexp_replace(s, "^(?:(?:" + "|".join(VISCERA) + r")\s+)+", "")
    return F.exists(window, lambda w: (_key(w) == s) | (_key(w) == bare) | are_synonyms(w, syndrome, clusters))


def reground(core: Column, ranked: Column, window: Column, clusters: Column) -> Column:
    """The core if it is grounded, else the first grounded one of the ranked syndromes, else the core all the same."""
    other = F.filter(ranked, lambda s: is_grounded(s, window, clusters))
    keep = (F.size(window) == 0) | is_grounded(core, window, clusters) | (F.size(other) == 0)
    return F.when(keep, core).otherwise(F.try_element_at(other, F.lit(1)))


def concurrent(core: Column, second: Column, matched: Column, diseases: Column, overridden: Column) -> Column:
    """The second syndrome if a disease near the best one has it and its sign doesn't contradict the core's, else none.

    ``matched`` has (ratio, syndromes); nothing is judged where no disease is known or the result was set by rule.
    """
    best = F.array_max(F.transform(matched, lambda m: m["ratio"]))
    near = F.flatten(F.transform(F.filter(matched, lambda m: m["ratio"] >= best - WINDOW - 1e-9), lambda m: m["syndromes"]))
    s = F.lower(F.trim(second))
    member = F.exists(near, lambda x: F.lower(x).contains(s) | s.contains(F.lower(x)))
    opposed = F.coalesce(polarity_sign(core) != polarity_sign(second), F.lit(False))
    free = overridden | (second == NONE) | (F.size(diseases) == 0) | (F.size(matched) == 0)
    return F.when(free | (member & ~opposed), second).otherwise(NONE)


def scored_syndromes(scored: DataFrame, name: str, flagged: Column | None = None) -> DataFrame:
    """Scored syndromes without flagged ones, names with digits or brackets, and mere forms."""
    bad = F.col(name).rlike("[0-9(]") | F.lower(name).startswith("thể ")
    return scored.filter(~bad & ~F.coalesce(flagged if flagged is not None else F.lit(False), F.lit(False)))


# --- herbs ----------------------------------------------------------------------------------------------------


def without_tail_notes(c: Column) -> Column:
    """A herb cell without alternatives, conditions and combinations; ways of processing stay."""
    c = F.regexp_replace(c, r"(?iU)\.\s*\(.*$", "")
    c = F.regexp_replace(c, r"(?iU)\s*\((?:hoặc|nếu|kết hợp|thay|gia|thêm)\b[^)]*(?:\)|$)", "")
    return F.regexp_replace(c, r"(?:,\s*)+(?=,|$)", "")


def distinct_herbs(c: Column) -> Column:
    """Each herb once: by its standard spelling, and without a processed form where the herb itself is listed."""
    names = F.transform(fields(without_tail_notes(c)), lambda h: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in HERB_ALIASES.items() for x in p]), F.lower(h)), h))
    bare = lambda h: F.regexp_replace(F.lower(h), "^(?:" + "|".join(HERB_PREFIXES) + r")\s+", "")
    lowered = F.transform(names, lambda h: F.lower(h))
    kept = F.filter(names, lambda h: (bare(h) == F.lower(h)) | ~F.array_contains(lowered, bare(h)))
    step = lambda out, h: F.when(F.exists(out, lambda k: F.lower(k) == F.lower(h)), out).otherwise(F.concat(out, F.array(h)))
    return F.array_join(F.aggregate(kept, F.array().cast("array<string>"), step), ", ")


def herb_warnings(c: Column) -> Column:
    """struct(toxic, opposed): toxic herbs of a cell and pairs that must not meet; names that only look alike don't count."""
    herbs = F.filter(F.transform(fields(c), lambda h: F.lower(h)), lambda h: ~h.isin(LOOKALIKES))
    has = lambda name: F.exists(herbs, lambda h: h.contains(name))
    toxic = F.filter(F.array(*[F.lit(h) for h in TOXIC_HERBS]), lambda t: F.exists(herbs, lambda h: h.contains(t)))
    opposed = F.array_compact(F.array(*[F.when(has(a) & has(b), f"{a} + {b}") for a, b in OPPOSED_HERBS]))
    return F.struct(toxic.alias("toxic"), opposed.alias("opposed"))


def thermal_mean(formulas: DataFrame, lexicon: DataFrame, formula: str, herb: str, word: str, score: str) -> DataFrame:
    """(formula, mean) over its known herbs: the score of the herb itself, else of the longest lexicon word in it.

    Candidates share a word with the herb, so that no pair of all herbs and all lexicon words is built.
    """
    h = formulas.select(formula, F.lower(F.trim(herb)).alias("__h")).distinct()
    names = h.select("__h").distinct()
    lex = lexicon.select(F.lower(F.trim(word)).alias("__w"), F.col(score).alias("__s"))
    pairs = names.select("__h", F.explode(F.split("__h", r"\s+")).alias("__k")).join(lex.withColumn("__k", F.substring_index("__w", " ", 1)), "__k")
    inside = pairs.filter(F.concat(F.lit(" "), F.col("__h"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("__w"), F.lit(" "))))
    best = inside.groupBy("__h").agg(F.max_by("__s", F.struct((F.col("__w") == F.col("__h")).alias("e"), F.length("__w").alias("n"), "__w")).alias("__s"))
    return h.join(best, "__h").groupBy(formula).agg(F.avg("__s").alias("mean"))


def formula_conflict(syndrome: Column, mean: Column) -> Column:
    """Whether a formula's mean goes the wrong way for a syndrome's sign; deficient and unsigned ones are not judged."""
    sign = F.when(~is_deficient(syndrome), polarity_sign(syndrome))
    return F.coalesce(F.when(sign == "han", mean < 0).when(sign == "nhiet", mean > 0), F.lit(False))


def western_reference(said: DataFrame, items: DataFrame, case: str, term: str, item: str, status: str, least: int = 2, most: int = 5) -> DataFrame:
    """(case, item, matched, score, status, rank): items that share ``least`` terms or more, by the idf of what they share."""
    n = items.agg(F.count_distinct(item).alias("n"))
    own = items.select(item, F.lower(term).alias("term"), status).distinct()
    idf = own.groupBy("term").agg(F.count_distinct(item).alias("df")).crossJoin(F.broadcast(n)).select("term", F.log(F.col("n") / F.col("df") + 1.0).alias("idf"))  # one row of totals
    met = said.select(case, F.lower(term).alias("term")).distinct().join(own, "term").join(idf, "term")
    scored = met.groupBy(case, item, status).agg(F.count("*").alias("matched"), F.round(F.sum("idf"), 6).alias("score")).filter(F.col("matched") >= least)
    w = Window.partitionBy(case).orderBy(F.desc("score"), item)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)
