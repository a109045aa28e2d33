"""URL rules against plain Python, with nested, repeated and very many rules."""

import random

import pytest
from pyspark.sql import functions as F

from trellis.llm import urls

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"), ("block", "a.example.org/"), ("allow", "b.a.example.org/x"), ("block", "net"), ("allow", "/es/")]


def plain(url, rules, default="allow"):
    if not url or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at]), rest[at:].split("?")[0].split("#")[0]
    fits = []
    for v, r in rules:
        r_host, slash, r_path = r.partition("/")
        if (host == r_host or host.endswith("." + r_host)) and path.startswith(slash + r_path):
            fits.append((len(r), len(r_host), v == "block", r, v))
    return host, path, *((max(fits)[3], max(fits)[4]) if fits else (None, default))


def check(spark, rows, rules):
    table = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1)).withColumn("key", F.lit("k"))
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.url_filter(table, rules).collect()]
    assert sorted(got, key=repr) == sorted(((k, *plain(u, rules)) for k, u in rows), key=repr)
    return table


def test_rules(spark):
    hosts = ["org", "example.org", "EXAMPLE.org", "a.example.org", "b.a.example.org", "xexample.org", "com", "q.com", "net", "w.net", "", "..org", "example.org:80", "a."]
    paths = ["", "/", "/es/", "/es", "/en/12", "/fr/x?y#z", "/de/", "/x#/es/", "/x/" + "y" * 5000, "?q=1"]
    rows = [(k, f"http://{h}{p}") for k, (h, p) in enumerate((h, p) for h in hosts for p in paths)] + [(1000, None), (1001, "no scheme"), (1002, ""), (1002, ""), (None, "http://org/x")]
    table = check(spark, rows, RULES)
    check(spark, rows, [*RULES, ("allow", "net"), ("block", "org/"), ("block", "org/")])
    check(spark, rows, [])
    assert urls.url_filter(table.limit(0), RULES).count() == 0


@pytest.mark.parametrize("block", [1, 3, 256])
def test_many_nested_rules(spark, monkeypatch, block):
    """Stacks go over the ends of blocks and partitions."""
    monkeypatch.setattr(urls, "BLOCK", block)
    monkeypatch.setattr(urls, "PART_ROWS", 20)
    rng = random.Random(6)
    host = lambda: ".".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 5)))
    rules = sorted({host() + path() for _ in range(80)})
    rules = [(rng.choice(["allow", "block"]), r) for r in rules]
    check(spark, [(k, f"s://{host()}{path()}") for k in range(400)], rules)
