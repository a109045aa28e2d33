"""Sources and sinks: CSV with a byte-order mark, checked JSON, append logs, atomic publication, classifications, link exports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trellis.operators.link import latest_wins
from trellis.operators.review import formula_guard

MARK = "\ufeff"


def read_csv(spark: SparkSession, path: str, required: list[str] = ()) -> DataFrame:
    """All-string CSV with a header; a byte-order mark before the first name is dropped."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")
    df = df.toDF(*[c.lstrip(MARK).strip('"') for c in df.columns])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Fixed column order, quotes doubled, formulas made harmless, and a byte-order mark before the header of each file."""
    kinds = dict(df.dtypes)
    cells = [formula_guard(F.col(c)) if kinds[c] == "string" else F.col(c).cast("string") for c in columns]
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    header = MARK + ",".join('"' + c.replace('"', '""') + '"' for c in columns)
    rows = df.select(F.concat_ws(",", *[quoted(c) for c in cells]).alias("value"))
    part = F.spark_partition_id()
    # The header stands first in each file; a row keeps its place behind it.
    lines = rows.select("value", part.alias("part"), F.monotonically_increasing_id().alias("at"))
    heads = lines.select("part").distinct().select(F.lit(header).alias("value"), "part", F.lit(-1).cast("long").alias("at"))
    if df.isEmpty():
        heads = df.sparkSession.createDataFrame([(header, 0, -1)], "value string, part int, at long")
    lines.unionByName(heads).repartition("part").sortWithinPartitions("part", "at").select("value").write.mode("errorifexists").text(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, hash_col: str | None = None, expected: str | None = None) -> DataFrame:
    """JSON lines under an explicit schema; malformed rows, or another hash than expected, raise."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if hash_col is not None and not df.filter(~F.col(hash_col).eqNullSafe(F.lit(expected))).isEmpty():
        raise ValueError("the records were made from another input")
    return df


def append_jsonl(df: DataFrame, path: str, sequence: str = "seq") -> None:
    """Append records.  Without a sequence of their own they get one: the time of the append, and their place in it."""
    if sequence not in df.columns:
        df = df.withColumn(sequence, F.unix_micros(F.current_timestamp()) * 1000).withColumn("place", F.monotonically_increasing_id())
    df.write.mode("append").json(path)


def load_done(spark: SparkSession, path: str, schema: str, key: list[str], sequence: str = "seq") -> DataFrame:
    """The last record of each key of an append log: by sequence, then by place in its append, then by content."""
    wanted = StructType.fromDDL(schema)
    extra = [c for c in (sequence, "place") if c not in wanted.names]
    df = spark.read.schema(", ".join([schema, *[f"{c} long" for c in extra]])).json(path)
    last = ["place"] if "place" in df.columns else []
    order = [F.desc(sequence), *[F.desc(c) for c in last], F.desc(F.to_json(F.struct(*wanted.names)))]
    return latest_wins(df, key, order).select(*wanted.names)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def publish(tables: dict[str, DataFrame], root: str) -> None:
    """Write a new version of several tables, then make it the current one by replacing one pointer file.

    Every version has a folder of its own.  A reader sees the pointer of the old version or of the new one, and with it
    all tables of that version; a failure before the replacement leaves the old version current.
    """
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/versions/{version}/{name}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, pointer = _file_system(spark, f"{root}/current.json")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{root}/current-{version}.json")
    out = fs.create(fresh, False)
    out.write(json.dumps({"version": version, "tables": sorted(tables)}).encode())
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf)
    replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(pointer), replace)


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current version."""
    found = spark.read.schema("version string, tables array<string>").json(f"{root}/current.json").first()
    return {name: spark.read.parquet(f"{root}/versions/{found['version']}/{name}") for name in found["tables"]}


def merge_json_dir(spark: SparkSession, pattern: str, schema: str, key: str) -> DataFrame:
    """Records of all files; of one key, that of the last file by name, and within a file the last by content."""
    names = StructType.fromDDL(schema).names
    df = spark.read.schema(schema).json(pattern).withColumn("__file", F.input_file_name())
    return latest_wins(df, [key], [F.desc("__file"), F.desc(F.to_json(F.struct(*names)))]).drop("__file")


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """(code, kind, superclass, title, inclusions) of the classes of a ClaML file."""
    schema = (
        "_code string, _kind string, SuperClass struct<_code:string>, "
        "Rubric array<struct<_kind:string,Label:struct<_VALUE:string>>>"
    )
    df = spark.read.format("xml").option("rowTag", "Class").schema(schema).load(path)
    labels = lambda *kinds: F.transform(F.filter("Rubric", lambda r: r["_kind"].isin(list(kinds))), lambda r: F.trim(r["Label"]["_VALUE"]))
    title = F.coalesce(F.try_element_at(labels("preferredLong"), F.lit(1)), F.try_element_at(labels("preferred"), F.lit(1)))
    return df.select(F.col("_code").alias("code"), F.col("_kind").alias("kind"), F.col("SuperClass._code").alias("superclass"), title.alias("title"), labels("inclusion").alias("inclusions"))


def export_links(confirmed: DataFrame, suggested: DataFrame) -> DataFrame:
    """(id, links): the links of each item, confirmed ones first, then by name.

    ``confirmed`` has (id, name, source, status), ``suggested`` (id, name, score), whose status is ``may_de_xuat``.
    """
    machine = suggested.select("id", "name", F.lit("may_de_xuat").alias("source"), F.lit("may_de_xuat").alias("status"), "score")
    both = confirmed.select("id", "name", "source", "status").unionByName(machine, allowMissingColumns=True)
    link = F.struct((F.col("status") != "xac_nhan").alias("last"), "name", "source", "status", "score")
    return both.groupBy("id").agg(F.sort_array(F.collect_list(link)).alias("xs")).select("id", F.transform("xs", lambda x: x.dropFields("last")).alias("links"))
