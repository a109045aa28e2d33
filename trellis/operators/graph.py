"""Property-graph patterns as joins: nodes by label and edges by type are DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from trellis.functions.textkeys import letter_bounded_in


@dataclass
class Graph:
    """``nodes[label]`` has id and name; ``edges`` has src, dst, type and properties.  Parallel edges are kept."""

    nodes: dict[str, DataFrame]
    edges: DataFrame
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def hop(self, *types: str, reverse: bool = False) -> DataFrame:
        """Edges of one type or of any of several; ``reverse``: from their targets to their sources."""
        edges = self.edges.filter(F.col("type").isin(list(types)))
        if not reverse:
            return edges
        return edges.select(*[F.col({"src": "dst", "dst": "src"}.get(c, c)).alias(c) for c in edges.columns])

    def scan(self, label: str) -> DataFrame:
        """Nodes of a label by name (ties: by id)."""
        return self.nodes[label].orderBy("name", "id")

    def clean_names(self, label: str, flag: str | None = None) -> DataFrame:
        """Names of a label without a digit or an opening bracket, and of nodes that aren't flagged."""
        nodes = self.nodes[label].filter(F.col("name").isNotNull() & ~F.col("name").rlike("[0-9(]"))
        return nodes.filter(~F.coalesce(F.col(flag), F.lit(False))) if flag else nodes

    def counts(self) -> DataFrame:
        """Rows of each label and of the edges."""
        parts = [df.agg(F.count("*").alias("n")).select(F.lit(label).alias("part"), "n") for label, df in sorted(self.nodes.items())]
        out = self.edges.agg(F.count("*").alias("n")).select(F.lit("edges").alias("part"), "n")
        for p in parts:
            out = out.unionByName(p)
        return out


def endpoints(edges: DataFrame) -> DataFrame:
    """(id): a row for each end of each edge."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id"))


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with their number of edge ends (0 without any)."""
    ends = endpoints(edges).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.join(ends, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without an edge in either direction."""
    return nodes.join(endpoints(edges).distinct(), "id", "left_anti")


def optional_match(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """A left join whose whole predicate is part of the join, so that unmatched rows stay."""
    return left.join(right, on, "left")


def not_exists(left: DataFrame, right: DataFrame, keys: list[str], null: object = "") -> DataFrame:
    """Anti join on keys that treat null as ``null``."""
    marked = right.select(*[F.coalesce(F.col(k), F.lit(null)).alias(f"__{k}") for k in keys]).distinct()
    on = [F.coalesce(left[k], F.lit(null)) == marked[f"__{k}"] for k in keys]
    return left.join(marked, on, "left_anti")


def cooccurrence(members: DataFrame, seeds: DataFrame, group: list[str], item: str, distinct: str, top: int) -> DataFrame:
    """Items that share a group with a seed item, by the number of distinct groups; seeds themselves are left out.

    Seeds are compared without case.  Groups that hold one are found first and semi-joined, so no pair of members is
    ever built.
    """
    lowered = seeds.select(F.lower(item).alias("__seed")).distinct()
    hit = members.join(lowered, F.lower(members[item]) == F.col("__seed"), "left_semi").select(*group).distinct()
    return (
        members.join(hit, group, "left_semi").join(lowered, F.lower(members[item]) == F.col("__seed"), "left_anti")
        .groupBy(item).agg(F.count_distinct(distinct).alias("frequency"))
        .orderBy(F.desc("frequency"), item).limit(top)
    )


def related_terms(members: DataFrame, seeds: DataFrame, scoped: list[str], unscoped: list[str], item: str, distinct: str, top: int = 100) -> DataFrame:
    """(item, frequency) of the scoped co-occurrence, or of the unscoped one where the scoped one has no row."""
    first = cooccurrence(members, seeds, scoped, item, distinct, top)
    rows = first.collect()  # at most ``top`` rows
    return members.sparkSession.createDataFrame(rows, first.schema) if rows else cooccurrence(members, seeds, unscoped, item, distinct, top)


def with_all_terms(rows: DataFrame, group: list[str], term: str, n_terms: int) -> DataFrame:
    """Groups that have all of ``n_terms`` distinct terms: one aggregation instead of a join for each term."""
    return rows.groupBy(*group).agg(F.count_distinct(term).alias("n")).filter(F.col("n") == n_terms).select(*group)


def all_else_any(rows: DataFrame, hits: Column, n_terms: int) -> DataFrame:
    """Rows that match all terms; if there are none at all, those that match any.  ``hits``: terms matched."""
    marked = rows.withColumn("__hits", hits).filter("__hits > 0")
    best = marked.agg(F.max((F.col("__hits") == n_terms).cast("int")).alias("__any_all"))
    return marked.crossJoin(F.broadcast(best)).filter((F.col("__any_all") == 0) | (F.col("__hits") == n_terms)).drop("__any_all", "__hits")


def matching_terms(terms: DataFrame, vocabulary: DataFrame, term: str, name: str) -> DataFrame:
    """(term, name) pairs where the name has the term between non-letters.

    Terms whose first word is a word of the name are the candidates, so the regular expression is an extra test
    on an equi-join and not a nested loop over all pairs.
    """
    first = F.element_at(F.filter(F.split(F.lower(F.col(term)), r"[^\p{L}]+"), lambda w: w != ""), 1)
    words = F.explode(F.array_distinct(F.filter(F.split(F.lower(F.col(name)), r"[^\p{L}]+"), lambda w: w != "")))
    pairs = vocabulary.select(name, words.alias("__w")).join(terms.select(term, first.alias("__w")), "__w")
    return pairs.filter(letter_bounded_in(F.col(name), F.lower(F.col(term)))).select(term, name).distinct()


# Words that a clean name of a syndrome never has.
DIRTY_WORDS = ["hoặc", "là", "gây", "do", "nếu"]


def is_dirty_name(name: Column) -> Column:
    """Missing, blank, over 40 characters, with a digit or a bracketed part, or with a word that tells a cause."""
    words = F.concat(F.lit(" "), F.lower(name), F.lit(" ")).rlike(r"\S (" + "|".join(DIRTY_WORDS) + r") \S")
    return name.isNull() | (F.trim(name) == "") | (F.length(name) > 40) | name.rlike("[0-9]") | name.rlike(r"\(.*\)") | words


def optional_in(df: DataFrame, column: str, values: list | None) -> DataFrame:
    """Rows whose column is one of ``values``; all rows where no values are given."""
    return df if values is None else df.filter(F.col(column).isin(values))


def full_match(c: Column, pattern: str) -> Column:
    """Whether the pattern matches the whole text."""
    return c.rlike(f"^(?:{pattern})$")


def without_edge(nodes: DataFrame, edges: DataFrame, types: list[str]) -> DataFrame:
    """Nodes from which no edge of any of the types starts."""
    starts = edges.filter(F.col("type").isin(types)).select(F.col("src").alias("id")).distinct()
    return nodes.join(starts, "id", "left_anti")


def neighbours(nodes: DataFrame, edges: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """(name, id, neighbour): every edge of the nodes that have an asked name, without regard to case; repeats stay."""
    wanted = asked.select(F.col(name), F.lower(name).alias("__low"))
    found = nodes.withColumn("__low", F.lower("name")).select("id", "__low").join(wanted, "__low")
    return found.join(edges.select(F.col("src").alias("id"), F.col("dst").alias("neighbour")), "id").select(name, "id", "neighbour")


def syndrome_diseases(terms: DataFrame, symptoms: DataFrame, term: str, name: str, syndrome: str, disease: str, scope: str) -> DataFrame:
    """(syndrome, diseases): the sorted diseases whose own edges lead from the syndrome to a name that has a term.

    ``symptoms`` has a row for each (disease, syndrome, symptom edge) with the edge's scope; rows without one don't count.
    """
    named = matching_terms(terms, symptoms.select(name).distinct(), term, name).select(name).distinct()
    own = symptoms.filter(F.col(scope) == F.col(disease)).join(named, name, "left_semi")
    return own.groupBy(syndrome).agg(F.sort_array(F.collect_set(disease)).alias("diseases"))


def facets(asked: DataFrame, nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(name, organs, tags) of each asked name: of the nodes that have it as it is written, or else in any case.

    ``edges`` has (src, kind, facet) with kind ``organ`` or ``tag``.  A name that no node has gets empty lists.
    """
    found = asked.join(nodes.select("id", F.col("name").alias("__own"), F.lower("name").alias("__low")), F.lower(asked[name]) == F.col("__low"), "left")
    exact = F.coalesce(F.col("__own") == F.col(name), F.lit(False))
    some = F.max(exact.cast("int")).over(Window.partitionBy(name))
    chosen = found.withColumn("__exact", exact).withColumn("__some", some).filter((F.col("__some") == 0) | F.col("__exact"))
    of = lambda kind: F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("facet"))))
    return chosen.join(edges, chosen["id"] == edges["src"], "left").groupBy(name).agg(of("organ").alias("organs"), of("tag").alias("tags"))


def snapshot(nodes: DataFrame, edges: DataFrame, properties: list[str]) -> DataFrame:
    """(id, outgoing, incoming): the edges of each node with their properties, sorted: what a change may need to restore."""
    one = lambda end: F.struct(F.col("type"), F.col(end).alias("other"), *properties)
    out = edges.groupBy(F.col("src").alias("id")).agg(F.sort_array(F.collect_list(one("dst"))).alias("outgoing"))
    into = edges.groupBy(F.col("dst").alias("id")).agg(F.sort_array(F.collect_list(one("src"))).alias("incoming"))
    return nodes.select("id").join(out, "id", "left").join(into, "id", "left")


def best_variant(nodes: DataFrame, edges: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """(name, id): of the nodes with an asked name in any case the one written alike, else that of highest degree (ties: id)."""
    both = asked.join(degree(nodes, edges).withColumn("__low", F.lower("name")), F.lower(asked[name]) == F.col("__low"))
    w = Window.partitionBy(asked[name]).orderBy((F.col("name") == asked[name]).desc(), F.desc("degree"), "id")
    return both.select(asked[name].alias("__asked"), "id", F.row_number().over(w).alias("__nth")).filter("__nth = 1").select(F.col("__asked").alias(name), "id")


def keyed_comparison(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side): ``both``, ``left`` or ``right``, by which side has the keys."""
    a, b = left.select(*keys).distinct().withColumn("__a", F.lit(True)), right.select(*keys).distinct().withColumn("__b", F.lit(True))
    side = F.when(F.col("__b").isNull(), "left").when(F.col("__a").isNull(), "right").otherwise("both")
    return a.join(b, keys, "full").select(*keys, side.alias("side"))
