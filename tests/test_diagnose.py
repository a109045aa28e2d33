"""Matching of cases by classes of equal complaints and equal fields."""

from trellis.operators import diagnose as D


def test_match_cases_compares_each_class_once(spark):
    """Members of equal cases and rows pass alike; the work is that of the classes, whatever their members."""
    said = [["ho", "sốt"], ["đau đầu", "ho"], None, [], ["phân lỏng", "ho"]]
    cells = ["ho, sốt, mạch trầm", "đau đầu dữ dội, ho khan, phù", "đi ngoài nhiều lần, tiêu chảy, ho", "mạch trầm", None, "sốt"]
    cases = [(k, said[k % 5]) for k in range(60)] + [(None, said[0]), (0, said[0])]
    rows = [(k, cells[k % 6]) for k in range(90)] + [(None, cells[0]), (0, cells[0])]
    c, r = spark.createDataFrame(cases, "c long, said array<string>"), spark.createDataFrame(rows, "r long, cell string")
    one = lambda n, m: {(k[0], k[1]): k[2:] for k in D.match_cases(c.filter(f"c < {n}").distinct(), r.filter(f"r < {m}").distinct(), "c", "r", "said", "cell").collect()}
    few = one(5, 6)
    assert few[0, 0] == (2, 2, 1.0) and (1, 1) in few and (4, 2) in few and not any(k in (2, 3) or v in (3, 4) for k, v in few)
    want = sorted((k, v, *few[k % 5, v % 6]) for k, _ in cases for v, _ in rows if k is not None and v is not None and (k % 5, v % 6) in few)
    assert sorted(map(tuple, D.match_cases(c, r, "c", "r", "said", "cell").collect())) == want
    # The match comes from the distinct sides: each is made of distinct classes before it meets the other.
    plan = D.match_cases(c, r, "c", "r", "said", "cell")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [__u" in plan and "Aggregate [__v" in plan
    idf = spark.createDataFrame([("sốt", 5.0), ("ho", 1.0)], "term string, idf double")
    peaked = {(x["c"] % 5, x["r"] % 6) for x in D.match_cases(c, r, "c", "r", "said", "cell", idf).collect()}
    assert peaked == {(0, 0)}
