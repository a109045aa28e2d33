"""Sources and sinks on files."""

import glob

import pytest
from pyspark.sql import functions as F

from trellis.sources import tables


def test_csv(spark, tmp_path):
    path = f"file://{tmp_path}"
    df = spark.createDataFrame([("k", "=1+1", 3), ("K2", 'x,"y"\nz', None), (None, "", 4)], "a string, b string, n int")
    tables.write_csv(df.coalesce(1), f"{path}/csv", ["b", "a", "n"])
    raw = open(glob.glob(f"{tmp_path}/csv/part-*")[0], "rb").read()
    assert raw.startswith(b"\xef\xbb\xbf") and raw.splitlines()[0].decode("utf-8-sig") == '"b","a","n"'
    back = tables.read_csv(spark, f"{path}/csv", ["a"])
    assert back.columns == ["b", "a", "n"] and {r["b"] for r in back.collect()} == {"'=1+1", 'x,"y"\nz', None}
    tables.write_csv(df.limit(0), f"{path}/empty", ["b"])
    assert tables.read_csv(spark, f"{path}/empty").columns == ["b"]
    with pytest.raises(ValueError):
        tables.read_csv(spark, f"{path}/csv", ["absent"])


def test_json(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.createDataFrame([("a", 1, "h"), ("b", 2, "h")], "k string, v int, hash string").write.json(f"{path}/json")
    assert tables.read_json(spark, f"{path}/json", "k string, v int, hash string", "hash", "h").count() == 2
    with pytest.raises(ValueError):
        tables.read_json(spark, f"{path}/json", "k string, v int, hash string", "hash", "other")


def test_log(spark, tmp_path):
    """The last record of a key wins: by append, by place within one, and by content where a sequence repeats."""
    path = f"file://{tmp_path}/log"
    for rows in ([("k", 1), ("k", 2), ("j", 5)], [("k", 3), ("k", 0)]):
        tables.append_jsonl(spark.createDataFrame(rows, "k string, v int").coalesce(1), path)
    assert {(r["k"], r["v"]) for r in tables.load_done(spark, path, "k string, v int", ["k"]).collect()} == {("k", 0), ("j", 5)}
    other = f"file://{tmp_path}/own"
    tables.append_jsonl(spark.createDataFrame([("k", 7, 1), ("k", 9, 1), ("k", 8, 0)], "k string, v int, seq long"), other)
    assert [r["v"] for r in tables.load_done(spark, other, "k string, v int, seq long", ["k"]).collect()] == [9]


def test_publish(spark, tmp_path):
    """Readers see all tables of one version; a failed one changes nothing."""
    root = f"file://{tmp_path}/out"
    one = lambda n: spark.createDataFrame([(n,)], "v int")
    for n in (1, 2):
        tables.publish({"a": one(n), "b": one(10 * n)}, root)
        assert {k: [r["v"] for r in df.collect()] for k, df in tables.published(spark, root).items()} == {"a": [n], "b": [10 * n]}
    bad = one(3).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        tables.publish({"a": one(3), "b": bad}, root)
    assert [r["v"] for r in tables.published(spark, root)["a"].collect()] == [2]


def test_merged_files(spark, tmp_path):
    for name, rows in (("1.json", '{"k": "a", "v": 1}\n{"k": "b", "v": 1}\n{"k": "b", "v": 2}'), ("2.json", '{"k": "a", "v": 3}')):
        (tmp_path / name).write_text(rows)
    got = tables.merge_json_dir(spark, f"file://{tmp_path}/*.json", "k string, v int", "k").collect()
    assert {(r["k"], r["v"]) for r in got} == {("a", 3), ("b", 2)}


def test_classes(spark, tmp_path):
    (tmp_path / "c.xml").write_text('<ClaML><Class code="A00" kind="category"><SuperClass code="A00-A09"/><Rubric kind="preferred"><Label xml:lang="en"> Cholera </Label></Rubric><Rubric kind="inclusion"><Label>one</Label></Rubric><Rubric kind="inclusion"><Label>two</Label></Rubric></Class><Class code="I" kind="chapter"><Rubric kind="preferred"><Label lang="en">Short</Label></Rubric><Rubric kind="preferredLong"><Label lang="en">Long</Label></Rubric></Class></ClaML>')
    got = {r["code"]: (r["kind"], r["superclass"], r["title"], r["inclusions"]) for r in tables.read_classes(spark, f"file://{tmp_path}/c.xml").collect()}
    assert got == {"A00": ("category", "A00-A09", "Cholera", ["one", "two"]), "I": ("chapter", None, "Long", [])}
