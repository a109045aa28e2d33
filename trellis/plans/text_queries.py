"""Text, list and JSON operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from trellis.functions import terms
from trellis.functions import text as T
from trellis.functions.textkeys import array_key, paren_free, strip_lower_ws
from trellis.plans.registry import query, table

VOCABULARY = ["onthsh en", "of the", "in the", "erhe", "thand", "der ver", "de la", "que en"]


@query(r"""SELECT doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS k FROM documents""")
def text_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", strip_lower_ws(F.col("text")).alias("k"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 1 THEN NULL ELSE a END AS least, CASE event_id % 4 WHEN 2 THEN NULL WHEN 3 THEN a + 5 ELSE a END AS most
    FROM (SELECT event_id, (event_id % 90)::DOUBLE AS a FROM events)""")
def rate_parse(spark, d):
    n = (F.col("event_id") % 90).cast("int").cast("string")
    more = ((F.col("event_id") % 90) + 5).cast("int").cast("string")
    kind = F.col("event_id") % 4
    raw = F.when(kind == 0, F.concat(n, F.lit("%"))).when(kind == 1, F.concat(F.lit("dưới "), n, F.lit("%"))).when(kind == 2, F.concat(F.lit("hơn "), n, F.lit(" %"))).otherwise(F.concat(more, F.lit("% - "), n, F.lit("%")))
    least, most = T.rate_bounds(raw)
    return table(spark, d, "events").select("event_id", least.alias("least"), most.alias("most"))


@query("""SELECT p_partkey, unnest(range(3)) AS place, unnest([p_name || ' (a, b)', ' ' || p_type || ')', ' [x, ' || p_brand || ']']) AS item FROM part""")
def paren_split(spark, d):
    text = F.concat("p_name", F.lit(" (a, b), "), "p_type", F.lit("), [x, "), "p_brand", F.lit("]"))
    return table(spark, d, "part").select("p_partkey", F.posexplode(T.paren_split(text)).alias("place", "item"))


@query(r"""SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN contains(c, ' - ') THEN 'dash' WHEN contains(c, '/') THEN 'slash' WHEN regexp_matches(c, '[()]') THEN 'paren' WHEN regexp_matches(c, '[0-9]') THEN 'digit' WHEN length(c) > 40 THEN 'long' ELSE 'clean' END AS bucket
    FROM (SELECT text AS c FROM documents)) GROUP BY bucket""")
def name_bucket(spark, d):
    return table(spark, d, "documents").select(T.name_bucket(F.col("text")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


@query()
def longest_match_negation(spark, d):
    matcher = terms.TermMatcher(VOCABULARY, single_words=["erhe", "thand"], cues=["not", "sin"], emphatic=["only"], stops=["but", "pero"])
    return table(spark, d, "documents").select("doc_id", F.array_join(matcher.column(F.col("text")), "|").alias("terms"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", T.json_object(F.col("props"), "k bigint")["k"].alias("k"))


@query("""SELECT role, count(*) AS n, sum(length(text))::BIGINT AS chars, max(CASE WHEN role = 'system' THEN NULL ELSE turn END) AS last_turn FROM conversations GROUP BY role""")
def role_projection(spark, d):
    c = table(spark, d, "conversations").withColumn("visible", F.when(F.col("role") != "system", F.col("turn")))
    return c.groupBy("role").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.max("visible").alias("last_turn"))


@query("SELECT conv_id, turn FROM conversations WHERE role = 'user' ORDER BY turn DESC, conv_id")
def history_by_role(spark, d):
    return table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn").orderBy(F.desc("turn"), "conv_id")


@query("""SELECT user_id, concat_ws(', ', CASE WHEN a > 0 AND a < 130 THEN a || ' tuổi' END, CASE s WHEN 0 THEN 'nam giới' WHEN 1 THEN 'nữ giới' END, CASE user_id % 3 WHEN 0 THEN 'sợ lạnh' WHEN 1 THEN 'sợ nóng, thích mát' END) AS canonical
    FROM (SELECT DISTINCT user_id, user_id % 150 AS a, user_id % 3 AS s FROM events)""")
def interview_canonical(spark, d):
    """Codes to phrases in a fixed order; unknown codes say nothing, and an age counts between 0 and 130."""
    u = table(spark, d, "events").select("user_id").distinct()
    age = F.col("user_id") % 150
    parts = [
        F.when((age > 0) & (age < 130), F.concat(age.cast("string"), F.lit(" tuổi"))),
        F.when(F.col("user_id") % 3 == 0, "nam giới").when(F.col("user_id") % 3 == 1, "nữ giới"),
        F.when(F.col("user_id") % 3 == 0, "sợ lạnh").when(F.col("user_id") % 3 == 1, "sợ nóng, thích mát"),
    ]
    return u.select("user_id", F.concat_ws(", ", *parts).alias("canonical"))


@query(r"""SELECT p_partkey, lower(trim(regexp_replace(regexp_replace(p_name || ' (' || p_brand || ') ', '\([^)]*\)', ' ', 'g'), '\s+', ' ', 'g'))) AS k FROM part""")
def paren_free_key(spark, d):
    return table(spark, d, "part").select("p_partkey", paren_free(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") "))).alias("k"))


@query("SELECT doc_id, 'DOC-' || lpad(n, greatest(5, length(n))::INT, '0') AS dense_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id)::VARCHAR AS n FROM documents)")
def dense_ids_whole(spark, d):
    return _dense_ids(table(spark, d, "documents"))


def _dense_ids(docs):
    """Ranks within id ranges plus the counts before each range: no global single-task window over the rows."""
    kept = docs.select("doc_id", F.floor(F.col("doc_id") / 64).alias("range"))
    sizes = kept.groupBy("range").agg(F.count("*").alias("n"))
    # One row for each 64 ids; their prefix sums are taken in two steps as well.
    coarse = sizes.groupBy(F.floor(F.col("range") / 4096).alias("coarse")).agg(F.sum("n").alias("n"))
    before = coarse.withColumn("skip", F.coalesce(F.sum("n").over(Window.orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("coarse", "skip")
    inner = Window.partitionBy("coarse").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("coarse", F.floor(F.col("range") / 4096)).withColumn("own", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(before, "coarse").select("range", (F.col("own") + F.col("skip")).alias("skip"))
    nth = F.row_number().over(Window.partitionBy("range").orderBy("doc_id"))
    ranked = kept.withColumn("nth", nth).join(offsets, "range")
    number = (F.col("nth") + F.col("skip")).cast("string")
    # Five digits or more: padding would cut a longer number.
    return ranked.select("doc_id", F.concat(F.lit("DOC-"), F.when(F.length(number) < 5, F.lpad(number, 5, "0")).otherwise(number)).alias("dense_id"))


@query("""SELECT l_orderkey, string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS names FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def set_union_names(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    return rows.groupBy("l_orderkey").agg(array_key(F.collect_set("p_name")).alias("names"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def ext_event_windows(spark, d):
    from trellis.streaming.events import windowed_counts

    return windowed_counts(table(spark, d, "events"))
