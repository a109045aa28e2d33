"""Graph changes as reviewable plans.  A plan is a DataFrame; applying it is a separate, pure step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def diff(old: DataFrame, new: DataFrame, key: list[str], checksum: str) -> DataFrame:
    """key, change: new, changed, same or gone."""
    o = old.select(*key, F.col(checksum).alias("__old"), F.lit(True).alias("__in_old"))
    n = new.select(*key, F.col(checksum).alias("__new"), F.lit(True).alias("__in_new"))
    kind = F.when(F.col("__in_old").isNull(), "new").when(F.col("__in_new").isNull(), "gone").when(F.col("__old").eqNullSafe(F.col("__new")), "same").otherwise("changed")
    return o.join(n, key, "full").select(*key, kind.alias("change"))


def set_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys to add and to remove, compared without case, in their own spelling."""
    o, n = old.select(key, F.lower(key).alias("__k")), new.select(key, F.lower(key).alias("__k"))
    added = n.join(o, "__k", "left_anti").select(key, F.lit("add").alias("action"))
    return added.unionByName(o.join(n, "__k", "left_anti").select(key, F.lit("remove").alias("action"))).distinct()


def upsert(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """``table`` with ``rows`` merged in: their non-null values win; is_new tells created rows."""
    values = [c for c in table.columns if c not in key]
    t = table.select(*key, *[F.col(c).alias(f"__t_{c}") for c in values], F.lit(True).alias("__t"))
    r = rows.select(*key, *[F.col(c).alias(f"__r_{c}") for c in values if c in rows.columns])
    pick = [F.coalesce(F.col(f"__r_{c}"), F.col(f"__t_{c}")).alias(c) if c in rows.columns else F.col(f"__t_{c}").alias(c) for c in values]
    return t.join(r, key, "full").select(*key, *pick, F.col("__t").isNull().alias("is_new"))


def merge_plan(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(id, canonical): nodes with one key go to the one of highest degree (ties: smallest id)."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    w = Window.partitionBy(key).orderBy(F.desc("degree"), "id")
    ranked = nodes.join(ends, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    return ranked.withColumn("canonical", F.first("id").over(w)).select("id", "canonical")


def repoint(edges: DataFrame, plan: DataFrame, keep_properties: bool = True) -> DataFrame:
    """Edges with both ends moved to the canonical nodes, and exact duplicates dropped.

    Without ``keep_properties``, one edge of each (src, dst, type) is left: the one with the smallest properties.
    """
    s = plan.select(F.col("id").alias("src"), F.col("canonical").alias("__s"))
    d = plan.select(F.col("id").alias("dst"), F.col("canonical").alias("__d"))
    moved = edges.join(s, "src", "left").join(d, "dst", "left").withColumn("src", F.coalesce("__s", "src")).withColumn("dst", F.coalesce("__d", "dst")).select(*edges.columns)
    if keep_properties:
        return moved.distinct()
    rest = [c for c in edges.columns if c not in ("src", "dst", "type")]
    least = moved.groupBy("src", "dst", "type").agg(F.min(F.struct(*rest)).alias("__p"))
    return least.select("src", "dst", "type", *[F.col(f"__p.{c}").alias(c) for c in rest]).select(*edges.columns)


def split_node_edges(edges: DataFrame, fragments: DataFrame) -> DataFrame:
    """Edges of split nodes copied to each fragment (id, fragment), in both directions; other edges stay."""
    out = edges
    for end in ("src", "dst"):
        f = fragments.select(F.col("id").alias(end), F.col("fragment").alias("__f"))
        out = out.join(f, end, "left").withColumn(end, F.coalesce("__f", end)).drop("__f")
    return out.select(*edges.columns).distinct()


def rebuild_derived(edges: DataFrame, derived: DataFrame, provenance: str, tag: str) -> DataFrame:
    """Replace all edges of one provenance; edges of others, and without any, stay."""
    return edges.filter(~F.col(provenance).eqNullSafe(F.lit(tag))).unionByName(derived.withColumn(provenance, F.lit(tag)))


def undo(edges: DataFrame, provenance: str, tag: str) -> DataFrame:
    return edges.filter(~F.col(provenance).eqNullSafe(F.lit(tag)))


def undo_nodes(nodes: DataFrame, edges: DataFrame, provenance: str, tag: str) -> DataFrame:
    """``nodes`` without those of this provenance that no edge is left at, once the edges of the provenance are gone."""
    used = undo(edges, provenance, tag).select(F.explode(F.array("src", "dst")).alias("id")).distinct().withColumn("__used", F.lit(True))
    joined = nodes.join(used, "id", "left")
    return joined.filter(F.coalesce("__used", F.lit(False)) | ~F.col(provenance).eqNullSafe(F.lit(tag))).select(*nodes.columns)


def detach_delete(nodes: DataFrame, edges: DataFrame, doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without the ``doomed`` ids and all that touch them."""
    d = doomed.select("id").distinct()
    rest = edges.join(d.withColumnRenamed("id", "src"), "src", "left_anti").join(d.withColumnRenamed("id", "dst"), "dst", "left_anti")
    return nodes.join(d, "id", "left_anti"), rest.select(*edges.columns)


def pair_relations(groups: DataFrame, left: str, right: str, directed: bool = False) -> DataFrame:
    """Distinct pairs of the items of two alias lists; undirected pairs are kept once, smaller first."""
    pairs = groups.select(F.explode(left).alias("a"), right).select("a", F.explode(right).alias("b")).filter("a <> b")
    return pairs.distinct() if directed else pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


@dataclass
class Plan:
    """A change as rows to look at: what ``apply`` would write, and what it would have to put back.

    Nothing changes before ``apply``, which writes the rollback table first.
    """

    changes: DataFrame
    rollback: DataFrame

    def apply(self, target: DataFrame, key: list[str], rollback_path: str) -> DataFrame:
        self.rollback.write.mode("errorifexists").parquet(rollback_path)
        return upsert(target, self.changes, key).drop("is_new")

    @staticmethod
    def undo(target: DataFrame, key: list[str], rollback_path: str) -> DataFrame:
        """``target`` with the rows of the rollback table as they were."""
        old = target.sparkSession.read.parquet(rollback_path).select(*target.columns)
        return target.join(old, key, "left_anti").select(*target.columns).unionByName(old)


def plan_update(target: DataFrame, changes: DataFrame, key: list[str]) -> Plan:
    """A plan of the rows of ``changes`` that differ from ``target``, with their old rows."""
    values = [c for c in changes.columns if c not in key]
    old = target.select(*key, *[F.col(c).alias(f"__{c}") for c in values])
    differs = F.lit(False)
    for c in values:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    changed = changes.join(old, key, "left").filter(differs).select(*changes.columns)
    return Plan(changed, target.join(changed.select(*key), key, "left_semi"))


def synced_names(rows: DataFrame, edges: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """``rows`` (id, column…) with the name of the node that an edge leads from; rows without one stay.

    ``names`` has (id, name); where several lead to a row, the smallest name is taken.
    """
    own = edges.join(names.select(F.col("id").alias("src"), F.col("name").alias("__name")), "src").groupBy(F.col("dst").alias("id")).agg(F.min("__name").alias("__name"))
    joined = rows.join(own, "id", "left")
    return joined.withColumn(column, F.coalesce("__name", column)).select(*rows.columns)


def flagged(nodes: DataFrame, dirty: Column, flag: str = "flagged") -> DataFrame:
    """``nodes`` with the flag set where the name is dirty, and taken off where it isn't."""
    return nodes.withColumn(flag, dirty)


def replaced_members(edges: DataFrame, members: DataFrame, owner: str = "src", member: str = "dst") -> DataFrame:
    """``edges`` with the members of each owner of ``members`` (owner, member) replaced; other owners' stay."""
    rest = edges.join(members.select(owner).distinct(), owner, "left_anti").select(owner, member)
    return rest.unionByName(members.select(owner, member).distinct())


def keep_largest_overlap(nodes: DataFrame, members: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """(id, keep) of nodes that share the columns ``by``: the one with most wanted members stays (ties: the largest id)."""
    hits = nodes.select("id", *by).join(members, "id").join(wanted, [*by, "member"], "left_semi").groupBy("id").agg(F.count_distinct("member").alias("__hits"))
    groups = nodes.select("id", *by).join(hits, "id", "left").withColumn("__hits", F.coalesce("__hits", F.lit(0)))
    several = F.count("*").over(Window.partitionBy(*by))
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("__hits"), F.desc("id")))
    return groups.withColumn("__n", several).withColumn("__nth", nth).filter("__n > 1").select("id", (F.col("__nth") == 1).alias("keep"))


def edge_sync(have: DataFrame, want: DataFrame, scope: list[str], name: str) -> DataFrame:
    """(scope, name, action) that makes the names of each wanted scope those of ``want``, compared without case.

    Scopes that ``want`` doesn't have are left alone.
    """
    h = have.select(*scope, name, F.lower(name).alias("__k")).join(want.select(*scope).distinct(), scope, "left_semi")
    w = want.select(*scope, name, F.lower(name).alias("__k"))
    add = w.join(h, [*scope, "__k"], "left_anti").select(*scope, name, F.lit("add").alias("action"))
    return add.unionByName(h.join(w, [*scope, "__k"], "left_anti").select(*scope, name, F.lit("remove").alias("action"))).distinct()


def gap_plan(rows: DataFrame, diseases: DataFrame, links: DataFrame, formulas: DataFrame) -> DataFrame:
    """(disease, syndrome, formula, action): what a graph lacks of the rows of a table, compared without case.

    ``skip``: the disease itself is missing; else ``link``, ``formula`` or ``link+formula``; rows that lack nothing go.
    """
    low = lambda df, *cols: df.select(*[F.lower(F.trim(c)).alias(f"__{c}") for c in cols]).distinct()
    want = rows.filter((F.trim("disease") != "") & (F.trim("syndrome") != "") & (F.trim("formula") != "")).select("disease", "syndrome", "formula", *[F.lower(F.trim(c)).alias(f"__{c}") for c in ("disease", "syndrome", "formula")])
    known = low(diseases, "disease").withColumn("__known", F.lit(True))
    linked = low(links, "disease", "syndrome").withColumn("__linked", F.lit(True))
    treated = low(formulas, "disease", "syndrome", "formula").withColumn("__treated", F.lit(True))
    joined = want.join(known, ["__disease"], "left").join(linked, ["__disease", "__syndrome"], "left").join(treated, ["__disease", "__syndrome", "__formula"], "left")
    parts = F.concat_ws("+", F.when(F.col("__linked").isNull(), "link"), F.when(F.col("__treated").isNull(), "formula"))
    action = F.when(F.col("__known").isNull(), "skip").otherwise(F.nullif(parts, F.lit("")))
    return joined.select("disease", "syndrome", "formula", action.alias("action")).filter("action is not null").distinct()


def enriched(edges: DataFrame, additions: DataFrame, nodes: DataFrame, tag: str = "enrich") -> DataFrame:
    """``edges`` with (src, dst) additions between known sources and any targets, without scope and under a tag of their own.

    Edges without scope never meet a scoped pattern.  Additions that are there already are not added again.
    """
    known = additions.join(nodes.select(F.col("id").alias("src")), "src", "left_semi").distinct()
    fresh = known.join(edges.filter(F.col("nguon") == tag).select("src", "dst"), ["src", "dst"], "left_anti")
    return edges.unionByName(fresh.select("src", "dst", F.lit(tag).alias("nguon")), allowMissingColumns=True)


def history_create(history: DataFrame, rows: DataFrame) -> DataFrame:
    """The log with new rows (id, username, at, payload); an id that is there already is refused."""
    if not rows.join(history, "id", "left_semi").isEmpty():
        raise ValueError("a history row of this id exists")
    return history.unionByName(rows.select(*history.columns))


def history_list(history: DataFrame, username: str, role: str) -> DataFrame:
    """All rows for a doctor, one's own for others, the latest first (ties: by id)."""
    own = history if role == "doctor" else history.filter(F.col("username") == username)
    return own.orderBy(F.desc("at"), "id")


def history_delete(history: DataFrame, row_id: str, username: str, role: str) -> DataFrame:
    """The log without the row; only a doctor deletes others' rows, and a row that isn't found is an error."""
    mine = (F.col("id") == row_id) & (F.lit(role == "doctor") | (F.col("username") == username))
    if history.filter(mine).isEmpty():
        raise LookupError("there is no such row that this user may delete")
    return history.filter(~mine)


def union_exports(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of several exports with their union of columns, and the name of each one's export."""
    out = None
    for name, df in parts.items():
        own = df.withColumn("export", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def would_be_lost(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``old`` whose canonical JSON no row of ``new`` has."""
    canonical = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return old.withColumn("__j", canonical).join(new.select(canonical.alias("__j")).distinct(), "__j", "left_anti").drop("__j")
