"""Record linkage, votes, precedence and keep-best deduplication."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from trellis.operators.sequences import Sequences, Sets


def keep_best(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row of each group: the first by ``order``."""
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__nth = 1").drop("__nth")


def latest_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last record of each key of an append-only log."""
    return keep_best(df, keys, order)


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets; two empty sets are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def keep_richest(df: DataFrame, by: list[str], items: str, position: str, threshold: float = 0.6) -> DataFrame:
    """Keep the row with most items (ties: first position) and every row that is not ``threshold`` alike with it."""
    w = Window.partitionBy(*by).orderBy(F.size(items).desc(), F.col(position))
    best = df.withColumn("__nth", F.row_number().over(w)).withColumn("__best", F.first(items).over(w))
    return best.filter((F.col("__nth") == 1) | (jaccard(F.col(items), F.col("__best")) < threshold)).drop("__nth", "__best")


def majority(votes: DataFrame, item: list[str], outcome: str, least: int = 2) -> DataFrame:
    """The outcome with most votes if it has ``least`` and no other has as many; else null."""
    counts = votes.groupBy(*item, outcome).agg(F.count("*").alias("n"))
    best = counts.groupBy(*item).agg(F.max("n").alias("votes"))
    leaders = counts.join(best, item).filter("n = votes").groupBy(*item, "votes").agg(F.min(outcome).alias("leader"), F.count("*").alias("ties"))
    return leaders.select(*item, F.when((F.col("votes") >= least) & (F.col("ties") == 1), F.col("leader")).alias(outcome), "votes")


def partition_key(members: DataFrame, voter: list[str], block: str, member: str) -> DataFrame:
    """The canonical string of each voter's partition: blocks of sorted members, sorted."""
    blocks = members.groupBy(*voter, block).agg(F.array_join(F.sort_array(F.collect_set(member)), ",").alias("__b"))
    return blocks.groupBy(*voter).agg(F.array_join(F.sort_array(F.collect_list("__b")), "|").alias("partition"))


def name_bridge(left: DataFrame, right: DataFrame, left_key: str, right_key: str, cap: int, least: int = 4, deny: list[str] | None = None) -> DataFrame:
    """(left_key, right_key, method) between the distinct names of both sides: exact links, and substring links in either direction.

    Exact links always stay.  Substring links need ``least`` characters on both sides; a left name with more than
    ``cap`` of them, or on the ``deny`` list, has none.  Candidates share a name's first ``least`` characters.
    """
    a = left.select(F.col(left_key).alias("a")).filter("a <> ''").distinct()
    b = right.select(F.col(right_key).alias("b")).filter("b <> ''").distinct()
    exact = a.join(b, F.col("a") == F.col("b")).select("a", "b", F.lit("exact").alias("method"))
    long_a = a.filter(F.length("a") >= least)
    if deny:
        long_a = long_a.filter(~F.col("a").isin(deny))
    long_b = b.filter(F.length("b") >= least)
    grams = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - least + 1), lambda i: F.substring(F.col(c), i, F.lit(least))))).alias("gram")
    head = lambda c: F.substring(c, 1, least).alias("gram")
    inside = long_a.select("a", grams("a")).join(long_b.select("b", head("b")), "gram").filter(F.col("a").contains(F.col("b")))
    around = long_a.select("a", head("a")).join(long_b.select("b", grams("b")), "gram").filter(F.col("b").contains(F.col("a")))
    subs = inside.select("a", "b").unionByName(around.select("a", "b")).filter("a <> b").distinct()
    few = subs.groupBy("a").agg(F.count("*").alias("__fan")).filter(F.col("__fan") <= cap).select("a")
    links = exact.unionByName(subs.join(few, "a").select("a", "b", F.lit("substring").alias("method")))
    return links.select(F.col("a").alias(left_key), F.col("b").alias(right_key), "method")


def related(pairs: DataFrame, source: str, target: str, item: str, least: int, k: int) -> DataFrame:
    """Best k targets of each source by distinct shared items (``least`` or more), ties by target."""
    shared = pairs.groupBy(source, target).agg(F.count_distinct(item).alias("shared")).filter(F.col("shared") >= least)
    w = Window.partitionBy(source).orderBy(F.desc("shared"), target)
    return shared.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def precedence(base: DataFrame, sources: list[tuple[str, DataFrame]], key: str, value: str, rejected: DataFrame | None = None) -> DataFrame:
    """``base`` keys with the value and name of the first source that has one; rejected keys have none."""
    out = base.select(key)
    for name, df in sources:
        out = out.join(df.select(key, F.col(value).alias(f"__{name}")), key, "left")
    first = F.coalesce(*[F.col(f"__{n}") for n, _ in sources])
    origin = F.coalesce(*[F.when(F.col(f"__{n}").isNotNull(), n) for n, _ in sources], F.lit("none"))
    if rejected is None:
        return out.select(key, first.alias(value), origin.alias("origin"))
    out = out.join(rejected.select(key, F.lit(True).alias("__no")), key, "left")
    no = F.coalesce("__no", F.lit(False))
    return out.select(key, F.when(~no, first).alias(value), F.when(no, "rejected").otherwise(origin).alias("origin"))


TILE, TILE_CHARS, ROWS, PAIR_TASKS = 512, 1_500_000, 8, 128
#: A block of more than SMALL classes is dealt into up to SPREAD tiles, for more tasks.
SMALL, SPREAD = 128, 5
WORDS_LIKE, WORDS_LEAST, ITEMS_LIKE, ITEMS_LEAST, LONG = 0.55, 20, 0.6, 3, 80


def _alike(a: tuple, b: tuple, least: float, prefix: int | None) -> bool:
    """Two rows (text, items, other values) of one name: equal, alike by sequence or words, or with alike item sets.

    The rule for one pair; ``_tile_links`` decides by it for all pairs of a tile.
    """
    if a == b:
        return True
    (x, u, _), (y, v, _) = a, b
    if len(x) >= LONG and len(y) >= LONG:
        s, t = set(x.split()), set(y.split())
        if min(len(s), len(t)) >= WORDS_LEAST and len(s & t) / len(s | t) >= WORDS_LIKE:
            return True
        for p, q in ((x[:prefix], y[:prefix]), (y[:prefix], x[:prefix])):  # the ratio depends on the order of the two
            m = difflib.SequenceMatcher(None, p, q, autojunk=False)
            # Two upper bounds that cost little come first.
            if m.real_quick_ratio() >= least and m.quick_ratio() >= least and m.ratio() >= least:
                return True
    return len(u) >= ITEMS_LEAST and len(v) >= ITEMS_LEAST and len(u & v) / len(u | v) >= ITEMS_LIKE


class _Forest:
    def __init__(self, keys):
        self.root = {k: k for k in keys}

    def find(self, k):
        while self.root[k] != k:
            self.root[k] = k = self.root[self.root[k]]
        return k

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)


def _tile_links(keys: list, texts: list[str], items: list[frozenset], split: int | None, least: float, prefix: int | None) -> list[tuple]:
    """Links that connect all alike rows: of any two, or of one before ``split`` and one from there on."""
    links, n = [], len(keys)
    part = np.arange(n)  # the number of each row's part, which is connected
    # Rows of one key are one node.
    first: dict = {}
    for x, k in enumerate(keys):
        part[x] = part[first.setdefault(k, x)]
    long = np.array([len(t) >= LONG for t in texts])
    words = Sets([set(t.split()) if x else () for t, x in zip(texts, long, strict=True)])
    members = Sets(items)
    wholes = Sequences([t[:prefix] if x else "" for t, x in zip(texts, long, strict=True)], least)

    def join(x: int, ys: np.ndarray) -> None:
        for y in ys.tolist():
            if part[x] != part[y]:
                part[part == part[y]] = part[x]
                links.append((keys[x], keys[y]))

    for begin in range(split or 1, n, ROWS):
        xs = np.arange(begin, min(n, begin + ROWS))
        before = np.arange(n) < (xs if split is None else np.full(len(xs), split))[:, None]
        for x, ys in zip(xs.tolist(), before, strict=True):
            join(x, np.flatnonzero(ys & (words.alike(x, WORDS_LIKE, WORDS_LEAST) | members.alike(x, ITEMS_LIKE, ITEMS_LEAST))))
        apart = before & long & long[xs][:, None] & (part[xs][:, None] != part)
        for x, ys in zip(xs.tolist(), wholes.alike(xs, apart), strict=True):
            join(x, np.flatnonzero(ys))
    return links


def content_clusters(df: DataFrame, block: str, key: str, text: str, items: str | None = None, others: list[str] = (), least: float = 0.5, prefix: int | None = None) -> DataFrame:
    """(key, cluster) within each block: rows that are equal or alike by text or item sets; a cluster has its least key.

    Whole texts are compared, or their first ``prefix`` characters (words and items: always whole).  Equal rows are one
    class, whose least key stands for it.  The classes of a block are dealt into tiles of about TILE of them or TILE_CHARS
    characters; each pair of tiles is a task of its own that finds the links between its classes, so that a large block is compared
    by many tasks.  One task a block then joins links alone.
    """
    kind, of = df.schema[key].dataType.simpleString(), df.schema[block].dataType.simpleString()
    parts = max(PAIR_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    none = F.array().cast("array<string>")
    rows = df.select(block, key, F.coalesce(F.col(text), F.lit("")).alias("__t"), F.coalesce(F.col(items), none).alias("__i") if items else none.alias("__i"), F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in others]).cast("array<string>").alias("__o"))
    rows = rows.withColumn("__same", F.sha2(F.to_json(F.struct("__t", F.array_sort(F.array_distinct("__i")).alias("i"), "__o")), 256))
    # A row without a block is its own cluster.
    rep = F.when(F.col(block).isNull(), F.col(key)).otherwise(F.min(key).over(Window.partitionBy(block, "__same"))).alias("__rep")
    told = rows.select(block, key, "__same", F.length("__t").alias("__len")).select(block, key, "__same", "__len", rep)
    classes = told.filter("__rep is not null").select(block, "__same", "__rep", "__len").distinct()
    sizes = classes.groupBy(block).agg(F.count("*").alias("__n"), F.sum("__len").alias("__chars")).filter("__n > 1")
    # A class alone in its block is its own cluster: its texts never leave the JVM.
    reps = classes.drop("__len").join(sizes, block).withColumnRenamed("__rep", key)
    tiles = F.ceil(F.greatest(F.col("__n") / TILE, F.col("__chars") / TILE_CHARS, F.least(F.lit(SPREAD), F.col("__n") / SMALL))).cast("int")
    dealt = rows.join(reps, [block, key, "__same"]).withColumn("__own", F.pmod(F.xxhash64(key), tiles).cast("int")).withColumn("__other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    dealt = dealt.withColumn("__a", F.least("__own", "__other")).withColumn("__b", F.greatest("__own", "__other")).select(block, "__a", "__b", "__own", key, "__t", "__i")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__own", kind="stable")
        first = int((pdf["__own"] == pdf["__a"]).sum())
        split = first if pdf["__a"].iloc[0] != pdf["__b"].iloc[0] else None
        found = _tile_links(pdf[key].tolist(), pdf["__t"].tolist(), [frozenset(i) for i in pdf["__i"]], split, least, prefix) if split != len(pdf) and split != 0 else []
        return pd.DataFrame({block: [pdf[block].iloc[0]] * len(found), "u": [u for u, _ in found], "v": [v for _, v in found]}, dtype=object)

    # A fixed number of partitions: pairs of tiles are few bytes and much work, which adaptive execution would put together.
    links = dealt.repartition(parts, block, "__a", "__b").groupBy(block, "__a", "__b").applyInPandas(compare, f"{block} {of}, u {kind}, v {kind}")
    # A key of several rows of a block is one node.
    again = told.groupBy(block, key).agg(F.collect_set("__rep").alias("__reps")).filter("size(__reps) > 1")
    links = links.unionByName(again.select(block, F.col("__reps")[0].alias("u"), F.explode("__reps").alias("v")))

    def unite(pdf: pd.DataFrame) -> pd.DataFrame:
        forest = _Forest({*pdf["u"], *pdf["v"]})
        for u, v in zip(pdf["u"], pdf["v"], strict=True):
            forest.join(u, v)
        return pd.DataFrame({block: [pdf[block].iloc[0]] * len(forest.root), "__rep": list(forest.root), "cluster": [forest.find(k) for k in forest.root]}, dtype=object)

    linked = links.groupBy(block).applyInPandas(unite, f"{block} {of}, __rep {kind}, cluster {kind}")
    return told.join(linked, [block, "__rep"], "left").select(key, F.coalesce("cluster", "__rep").alias("cluster"))


def canonical_label(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The value that contains all others of its group (longest first), else the most frequent, longest, smallest."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    grouped = counts.groupBy(*by).agg(F.collect_list(F.struct(F.col(value).alias("v"), F.col("n").alias("n"))).alias("xs"))
    covers = F.filter("xs", lambda x: F.forall("xs", lambda y: x["v"].contains(y["v"])))
    ranked = F.array_sort(F.when(F.size(covers) > 0, covers).otherwise(F.col("xs")), lambda a, b: (
        F.when(F.size(covers) > 0, F.coalesce(F.nullif(F.length(b["v"]) - F.length(a["v"]), F.lit(0)), F.nullif(b["n"] - a["n"], F.lit(0)), F.when(a["v"] < b["v"], -1).otherwise(1)))
        .otherwise(F.coalesce(F.nullif(b["n"] - a["n"], F.lit(0)), F.nullif(F.length(b["v"]) - F.length(a["v"]), F.lit(0)), F.when(a["v"] < b["v"], -1).otherwise(1))).cast("int")
    ))
    return grouped.select(*by, ranked[0]["v"].alias("label"))


def contains_best(left: DataFrame, right: DataFrame, left_key: str, right_key: str, k: int, least: int = 3) -> DataFrame:
    """(left_key, right_key, rank): for each name the k shortest names that contain it as whole words (ties: by name).

    Candidates share the name's first word, so that no pair of all names is built.
    """
    a = left.select(F.lower(left_key).alias("__a"), left_key).filter(F.length("__a") >= least).distinct()
    b = right.select(F.lower(right_key).alias("__b"), right_key).distinct()
    word = lambda c: F.filter(F.split(c, r"(?U)\W+"), lambda w: w != "")
    pairs = a.withColumn("__w", F.try_element_at(word("__a"), F.lit(1))).join(b.withColumn("__w", F.explode(F.array_distinct(word("__b")))), "__w")
    held = pairs.filter(F.rlike("__b", F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.col("__a"), F.lit(r"\E(?!\w)"))))
    w = Window.partitionBy(left_key).orderBy(F.length(right_key), right_key)
    return held.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(left_key, right_key, "rank")


CONFIRMED, UNSURE = "xac_nhan", "can_xac_nhan"


def disease_links(wanted: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(name, item_id, status, sources) of wanted links (name, western, source, status) to items (item_id, title).

    Equal titles keep the wanted status; without one the k shortest titles that contain it need to be confirmed.  Links
    that several sources ask for are one, of the better status and with all their sources.
    """
    want = wanted.select("name", F.lower(F.trim("western")).alias("key"), "source", "status")
    own = items.select("item_id", "title", F.lower(F.trim("title")).alias("key"))
    exact = want.join(own.select("key", "item_id"), "key").select("name", "item_id", "source", "status")
    rest = want.join(own.select("key"), "key", "left_anti")
    near = contains_best(rest.select("key").distinct(), own.select("title").distinct(), "key", "title", k)
    loose = rest.join(near.select("key", "title"), "key").join(own.select("title", "item_id"), "title").select("name", "item_id", "source", F.lit(UNSURE).alias("status"))
    first = F.max(F.when(F.col("status") == CONFIRMED, 1).otherwise(0))
    both = exact.unionByName(loose).groupBy("name", "item_id").agg(first.alias("sure"), F.array_join(F.sort_array(F.collect_set("source")), "+").alias("sources"))
    return both.select("name", "item_id", F.when(F.col("sure") == 1, CONFIRMED).otherwise(UNSURE).alias("status"), "sources")


def related_score(pairs: DataFrame, source: str, target: str, item: str, least: int, k: int, confirmed: DataFrame | None = None) -> DataFrame:
    """``related`` with the share of the source's items that the target has; confirmed pairs are left out first."""
    own = pairs.groupBy(source).agg(F.count_distinct(item).alias("__own"))
    rest = pairs if confirmed is None else pairs.join(confirmed, [source, target], "left_anti")
    out = related(rest, source, target, item, least, k).join(own, source)
    return out.select(source, target, "shared", "rank", F.bround(F.col("shared") / F.col("__own"), 3).alias("score"))


def union_first(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of both, one a key: that of the first source that has it."""
    both = first.withColumn("__source", F.lit(0)).unionByName(second.withColumn("__source", F.lit(1)))
    return keep_best(both, [key], [F.col("__source"), *[F.col(c) for c in first.columns if c != key]]).drop("__source")


def fused(left: DataFrame, right: DataFrame, case: str, syndrome: str, formula: str) -> DataFrame:
    """(case, left, right, syndromes, formulas): the sorted syndromes of two observations alone and together, each formula once."""
    own = lambda df, name: df.groupBy(case).agg(F.sort_array(F.collect_set(syndrome)).alias(name), F.collect_set(formula).alias(f"__{name}"))
    both = own(left, "left").join(own(right, "right"), case, "full")
    none = F.array().cast("array<string>")
    a, b, x, y = (F.coalesce(c, none) for c in ("left", "right", "__left", "__right"))
    return both.select(case, a.alias("left"), b.alias("right"), F.sort_array(F.array_union(a, b)).alias("syndromes"), F.sort_array(F.array_union(x, y)).alias("formulas"))


def set_delta(old: Column, new: Column) -> Column:
    """struct(added, removed, equal, disjoint) of two sets; sets without a member are not called disjoint."""
    return F.struct(
        F.sort_array(F.array_except(new, old)).alias("added"), F.sort_array(F.array_except(old, new)).alias("removed"),
        ((F.size(F.array_except(new, old)) == 0) & (F.size(F.array_except(old, new)) == 0)).alias("equal"),
        ((F.size(old) > 0) & (F.size(new) > 0) & ~F.arrays_overlap(old, new)).alias("disjoint"),
    )


def partition_verdicts(votes: DataFrame, members: DataFrame, item: str, voter: str, cluster: str, member: str, order: str) -> DataFrame:
    """(item, partition, votes, verdict) of the partitions that voters made of an item's members.

    A vote counts if it deals each member to one cluster and names no other.  The first two voters decide if they
    agree, else all do; a partition needs two votes.  Verdict: same, different, mixed, or no_consensus.
    """
    sizes = members.select(item, member).distinct().groupBy(item).agg(F.count("*").alias("__size"))
    known = votes.join(members.select(item, member).distinct().withColumn("__known", F.lit(1)), [item, member], "left")
    checked = known.groupBy(item, voter).agg(F.count("*").alias("__rows"), F.count_distinct(member).alias("__named"), F.count("__known").alias("__good"), F.min(order).alias("__at"), F.count_distinct(cluster).alias("__clusters"))
    valid = checked.join(sizes, item).filter("__rows = __named and __good = __rows and __named = __size")
    keyed = partition_key(votes, [item, voter], cluster, member).join(valid.select(item, voter, "__at", "__clusters", "__size"), [item, voter])
    nth = F.row_number().over(Window.partitionBy(item).orderBy("__at", voter))
    keyed = keyed.withColumn("__nth", nth)
    early = keyed.filter("__nth <= 2").groupBy(item).agg((F.count("*") == 2).alias("__two"), F.count_distinct("partition").alias("__kinds"))
    used = keyed.join(early, item).filter(~((F.col("__two") & (F.col("__kinds") == 1)) & (F.col("__nth") > 2)))
    tally = used.groupBy(item, "partition").agg(F.count("*").alias("votes"), F.min("__clusters").alias("__clusters"), F.min("__size").alias("__size"), F.min("__nth").alias("__first"))
    best = keep_best(tally, [item], [F.desc("votes"), F.col("__first")]).filter("votes >= 2")
    verdict = F.when(F.col("__clusters") == 1, "same").when(F.col("__clusters") == F.col("__size"), "different").otherwise("mixed")
    out = best.select(item, "partition", "votes", verdict.alias("verdict"))
    return sizes.select(item).join(out, item, "left").select(item, "partition", F.coalesce("votes", F.lit(0)).alias("votes"), F.coalesce("verdict", F.lit("no_consensus")).alias("verdict"))


def code_consensus(votes: DataFrame, candidates: DataFrame, catalog: DataFrame, item: str) -> DataFrame:
    """(item, kind, code, votes) of votes (item, voter, verdict, code): the outcome that two voters or more share.

    A code outside the catalog makes a vote void; one that may not stand alone is an outcome of its own.  Kinds:
    in_top5, outside_top5, ineligible_code, none, insufficient, no_consensus.
    """
    cat = catalog.select(F.col("code"), F.col("eligible"))
    seen = votes.join(cat, "code", "left")
    picks = F.col("verdict").isin("pick", "outside_top5")
    outcome = F.when(picks & F.col("eligible"), F.col("code")).when(picks & ~F.col("eligible"), F.concat(F.lit("inel:"), "code")).when(~picks, F.col("verdict"))
    valid = seen.withColumn("outcome", outcome).filter("outcome is not null")
    tally = valid.groupBy(item, "outcome").agg(F.count("*").alias("votes"), F.max(F.when(picks, F.col("code"))).alias("code"), F.max("eligible").alias("eligible"))
    best = keep_best(tally, [item], [F.desc("votes"), F.col("outcome")]).filter("votes >= 2")
    top = candidates.select(item, "code").distinct().withColumn("__top", F.lit(True))
    joined = votes.select(item).distinct().join(best, item, "left").join(top, [item, "code"], "left")
    kind = (
        F.when(F.col("outcome").isNull(), "no_consensus").when(F.col("outcome").startswith("inel:"), "ineligible_code").when(F.col("code").isNotNull() & F.col("__top"), "in_top5")
        .when(F.col("code").isNotNull(), "outside_top5").when(F.col("outcome") == "none_correct", "none").otherwise("insufficient")
    )
    code = F.when(kind.isin("in_top5", "outside_top5"), F.col("code"))
    return joined.select(item, kind.alias("kind"), code.alias("code"), F.coalesce("votes", F.lit(0)).alias("votes"))


def quality_score(symptoms: Column, description: Column, cause: Column, core: list[Column], name: Column) -> Column:
    """Points for symptoms (at most 20), lengths (at most 3000), filled core columns, and a name that its description has."""
    length = lambda c: F.least(F.length(F.coalesce(c, F.lit(""))), F.lit(3000))
    filled = sum((F.when(F.trim(F.coalesce(c, F.lit(""))) != "", 100).otherwise(0) for c in core), F.lit(0))
    words = lambda c: F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\W+"), lambda w: F.length(w) >= 2)
    bare = F.regexp_replace(F.lower(name), r"(?U)^(bệnh|chứng|hội chứng)\s+", "")
    head = words(F.substring(F.lower(F.coalesce(description, F.lit(""))), 1, 400))
    named = (F.size(words(bare)) > 0) & F.forall(words(bare), lambda w: F.array_contains(head, w))
    return F.least(symptoms, F.lit(20)) * 50 + length(description) / 6.0 + length(cause) / 10.0 + filled + F.when(named, 800).otherwise(0)
