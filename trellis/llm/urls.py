"""URL allow and block rules by sorted sweeps over reversed-host keys, with DataFrame functions only.

``a.example.org`` has the key ``org.example.a.``.  A rule for ``example.org`` holds for all hosts whose key begins with
``org.example.``: in sorted order that is one interval, and intervals are nested or disjoint.  The same holds for
host and path together: among the pages of a rule's host, the rule ``example.org/es/`` holds for the keys that begin
with ``org.example./es/``.  So two sweeps answer every url:

1. distinct hosts against the distinct hosts of the rules: which rule hosts hold for a host (itself and parents);
2. distinct (rule host, path) keys against the rules: the stack of nested rules that hold for the key.

A sweep sorts points and rules together by range partitions.  It walks the rules in order and keeps the stack of those
whose interval is still open: a rule closes all that are no prefix of it and opens its own.  The walk goes over blocks
of BLOCK rules in parallel; what is open at the end of each block is carried on by a second walk over one row a block.
A point takes the stack of the last rule before it, less what has closed since.

Only distinct hosts and distinct paths are swept: a host or url with a third of all pages is one point, and is joined
back by equi-joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from trellis.llm.common import materialize

#: Rules of the registered query: (verdict, host and path).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
DEFAULT_VERDICT = "allow"
#: Rules in a block of the walk, and rows of a range partition.
BLOCK = 256
PART_ROWS = 500_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\.", -1))), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as rows: host_key, key (of host and path), rule, verdict; of equal rules the block stays."""
    raw = spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")
    host = F.translate(F.regexp_extract("rule", r"(?s)^([^/]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keyed = raw.select(host_key(host).alias("host_key"), F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("path"), "rule", "verdict")
    first = F.min(F.struct((F.col("verdict") != "block").alias("allows"), "rule", "verdict")).alias("r")
    return keyed.groupBy("host_key", F.concat("host_key", "path").alias("key")).agg(first).select("host_key", "key", "r.rule", "r.verdict")


def _walk(rules: Column) -> Column:
    """(key, stack) of each of the sorted rules: those of the block that hold for it, itself last."""
    kind = "array<struct<key:string,rule:string,verdict:string>>"
    start = F.struct(F.array().cast(kind).alias("open"), F.array().cast(f"array<struct<key:string,stack:{kind}>>").alias("done"))

    def step(state: Column, rule: Column) -> Column:
        # The array binds the new stack, which is so computed once.
        stacks = F.array(F.concat(F.filter(state["open"], lambda r: rule["key"].startswith(r["key"])), F.array(rule)))
        return F.element_at(F.transform(stacks, lambda s: F.struct(s.alias("open"), F.concat(state["done"], F.array(F.struct(rule["key"].alias("key"), s.alias("stack")))).alias("done"))), 1)

    return F.aggregate(rules, start, step, lambda state: state["done"])


def _carry(blocks: Column) -> Column:
    """(part, block, carry) of each block in order: the rules that are open where it begins."""
    kind = "array<struct<key:string,rule:string,verdict:string>>"
    start = F.struct(F.array().cast(kind).alias("open"), F.array().cast(f"array<struct<part:int,block:bigint,carry:{kind}>>").alias("done"))

    def step(state: Column, b: Column) -> Column:
        after = F.concat(F.filter(state["open"], lambda r: b["key"].startswith(r["key"])), b["stack"])
        entry = F.struct(b["part"].alias("part"), b["block"].alias("block"), state["open"].alias("carry"))
        return F.struct(after.alias("open"), F.concat(state["done"], F.array(entry)).alias("done"))

    return F.aggregate(blocks, start, step, lambda state: state["done"])


def prefix_sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, stack): the rules (key, rule, verdict) whose key begins each of the distinct point keys, outermost first.

    Keys that no rule holds for are left out.
    """
    spark = points.sparkSession
    points = materialize(points.select("key").distinct(), "url-points")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-points.count() // PART_ROWS), -(-rules.count() // PART_ROWS))
    none = F.lit(None).cast("string")
    both = points.select("key", F.lit(1).alias("kind"), none.alias("rule"), none.alias("verdict")).unionByName(rules.select("key", F.lit(0).alias("kind"), "rule", "verdict"))
    # Written once, so that all readers see the same range partitions even if an executor is lost.
    ranged = materialize(both.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "url-sweep")
    starts = ranged.filter("kind = 0").withColumn("block", F.floor((F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1) / BLOCK))
    walked = starts.groupBy("part", "block").agg(F.sort_array(F.collect_list(F.struct("key", "rule", "verdict"))).alias("rules"))
    walked = materialize(walked.select("part", "block", _walk(F.col("rules")).alias("done")), "url-stacks")
    # One row a block: its last rule and what is open behind it.
    ends = walked.select(F.struct("part", "block", F.element_at("done", -1)["key"].alias("key"), F.element_at("done", -1)["stack"].alias("stack")).alias("b"))
    carries = ends.agg(F.sort_array(F.collect_list("b")).alias("blocks")).select(F.explode(_carry(F.col("blocks"))).alias("c")).select("c.part", "c.block", "c.carry")
    opened = walked.join(carries, ["part", "block"]).select("part", "block", "carry", F.explode("done").alias("d"))
    whole = F.concat(F.filter("carry", lambda r: F.col("d.key").startswith(r["key"])), F.col("d.stack"))
    opened = materialize(opened.select("part", F.col("d.key").alias("key"), F.lit(0).alias("kind"), whole.alias("stack")), "url-opened")
    last = ranged.select("part").distinct().join(opened.groupBy("part").agg(F.max(F.struct("key", "stack")).alias("end")), "part", "left")
    # One row for each range partition: the stack of the last rule before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("part", F.last("end", ignorenulls=True).over(before)["stack"].alias("carry"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.filter("kind = 1").select("part", "key", "kind", F.lit(None).cast(opened.schema["stack"].dataType).alias("stack")).unionByName(opened)
    swept = rows.withColumn("seen", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1").join(carried, "part", "left")
    active = F.filter(F.coalesce("seen", "carry"), lambda r: F.col("key").startswith(r["key"]))
    return swept.select("key", active.alias("stack")).filter(F.size("stack") > 0)


def url_filter(pages: DataFrame, rules: list[tuple[str, str]] = RULES, default: str = DEFAULT_VERDICT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict.

    The longest fitting rule wins (ties: more host, then block, then the greater string); without one the verdict
    is ``default``.  A null url or one without ``://`` has an empty host and path, and is judged as such.
    Repeated rows are judged alike; a rule given as allow and block blocks; without rules all have the default; an
    empty table gives no rows; other columns are not read; urls and rules may have any length.
    """
    spark = pages.sparkSession
    parsed = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    table = materialize(rule_table(spark, rules), "url-rules")
    urls = materialize(parsed.select("host", "path").distinct(), "urls")
    hosts = table.select(F.col("host_key").alias("key")).distinct().select("key", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    points = urls.select("host", host_key(F.col("host")).alias("key"))
    held = prefix_sweep(points, hosts).select("key", F.explode("stack.key").alias("host_key"))
    keyed = points.distinct().join(held, "key").select("host", "host_key")
    paths = materialize(urls.join(keyed, "host").select("host", "path", "host_key", F.concat("host_key", "path").alias("key")), "url-paths")
    top = prefix_sweep(paths, table).select("key", F.element_at("stack", -1).alias("top"))
    rank = F.struct(F.length("top.rule").alias("n"), F.length("host_key").alias("h"), (F.col("top.verdict") == "block").alias("b"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))
    best = paths.join(top, "key").groupBy("host", "path").agg(F.max(rank).alias("best"))
    joined = parsed.join(materialize(best, "url-verdicts"), ["host", "path"], "left")
    return joined.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
