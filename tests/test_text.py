"""Text operators on table-driven cases, with negative controls."""

import random

import pytest
from pyspark.sql import functions as F

from trellis.functions import findings, guard, terms
from trellis.functions import text as T
from trellis.functions import textkeys as K
from trellis.operators import graph, link, mutate, review

COMPLAINTS = ["đau bụng", "đau bụng dưới", "buồn ngủ", "hoa mắt", "run", "chân không vững", "dai dẳng", "cứng", "Ngạt mũi"]


@pytest.mark.parametrize(
    "text, found",
    [
        ("đau bụng dưới và run", ["đau bụng dưới", "run"]),
        ("đau bụng dưới, đau bụng", ["đau bụng dưới", "đau bụng"]),
        ("chưa hoa mắt bao giờ, hay buồn ngủ", ["buồn ngủ"]),
        ("chẳng buồn ngủ mà run", ["run"]),
        ("chân không vững hoa mắt", ["chân không vững", "hoa mắt"]),
        ("ko chỉ hoa mắt", ["hoa mắt"]),
        ("hoa mắt không", ["hoa mắt"]),
        ("không" + " a" * 30 + " run", ["run"]),
        ("đau bụng dai dẳng, cứng, runrun", ["đau bụng"]),
        ("NGẠT MŨI", ["Ngạt mũi"]),
        ("", []),
        (None, []),
    ],
)
def test_stated_terms(text, found):
    assert sorted(terms.TermMatcher(COMPLAINTS).extract(text)) == sorted(found)


def test_places_by_brute_force():
    """Spans are those of a search for each term alone, and the longest take their places first."""
    rng = random.Random(2)
    words = ["a", "b", "cc", "b-a", "a_b"]
    for _ in range(300):
        vocabulary = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(6)})
        text = "".join(rng.choice(words) + rng.choice([" ", ", ", ""]) for _ in range(rng.randint(0, 12)))
        index = terms.Vocabulary(vocabulary, terms._free)
        want = [(i, i + len(t), t) for t in vocabulary for i in range(len(text)) if text.startswith(t, i) and terms._free(text, i, i + len(t))]
        assert sorted(index.places(text)) == sorted(want)
        chosen, used = [], set()
        for t in sorted(vocabulary, key=lambda t: (-len(t), t)):
            for i, j, _ in sorted(p for p in want if p[2] == t):
                if not used & set(range(i, j)):
                    chosen.append((i, j, t))
                    used |= set(range(i, j))
                    break
        assert terms.longest_first(index.places(text)) == chosen


def test_keyword_states():
    m = terms.TermMatcher(COMPLAINTS)
    assert m.states("run rẩy", "run") and m.states("chân không vững, hoa mắt", "hoa mắt") and m.states("không run, sau đó run", "run")
    assert not m.states("không thấy run", "run") and not m.states("runrun", "run") and not m.states(None, "run")


def test_names_in_questions(spark):
    finder = terms.NameFinder(["Cảm", "Cảm cúm", "Ho gà", "x"])
    cases = [("cảm cúm là gì", "Cảm cúm"), ("bị cảm", None), ("bài thuốc cho cảm", "Cảm"), ("ho gà hay cảm cúm", "Cảm cúm"), ("cảmcúm", None), ("", None), (None, None)]
    df = spark.createDataFrame(cases, "q string, want string")
    assert [(r["q"], r["got"]) for r in df.select("q", finder.column(F.col("q")).alias("got")).collect()] == cases
    assert terms.NameFinder(["Cảm"], cues=None).find("bị cảm") == "Cảm"
    asks = spark.createDataFrame([("Hội chứng A gồm những bệnh gì",), ("hội chứng A",), ("các bệnh",), (None,)], "q string").select(terms.asks_for_diseases(F.col("q")))
    assert [r[0] for r in asks.collect()] == [True, False, False, False]


@pytest.mark.parametrize(
    "text, fine",
    [
        ("MATCH (n) RETURN n", True),
        ("match (n) return n ;; ", True),
        ("MATCH (n) WHERE n.note = 'please delete; set it' RETURN n", True),
        ("MATCH (`create`) RETURN 1 // drop", True),
        ("RETURN /* merge; */ 1", True),
        ("RETURN 'http://a' SET", False),
        ("RETURN 'it\\'s' DELETE", False),
        ("MATCH (n) detach delete n", False),
        ("RETURN 1; RETURN 2", False),
        ("RETURN offset, reset_set", True),
        ("RETURN 'open SET", False),
        ("  ", False),
        (None, False),
    ],
)
def test_read_only(text, fine):
    assert guard.is_read_only(text) is fine


def test_keys(spark):
    assert K.py_norm_key("Ｓtraße  X") == "strasse x"
    assert K.py_fold("Đường Amíp") == "duong amip"
    assert K.py_exact("A_b—C") == "a b c"
    repaired = spark.createDataFrame([("[:CÓ BIỂU_HIỆN]->()-[:BAO GÔM]",)], "q string").select(guard.repaired_names(F.col("q"))).first()[0]
    assert repaired == "[:CÓ_BIỂU_HIỆN]->()-[:BAO_GỒM]"


def test_paren_split(spark):
    def plain(text):
        out, depth = [""], 0
        for ch in text:
            depth = depth + 1 if ch in "([{" else max(0, depth - 1) if ch in ")]}" else depth
            if ch == "," and depth == 0:
                out.append("")
            else:
                out[-1] += ch
        return out

    rng = random.Random(4)
    texts = ["", "a", ",", "a (b, c), d) e, f"] + ["".join(rng.choice("ab,,()[]{}") for _ in range(rng.randint(1, 25))) for _ in range(200)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.paren_split(F.col("t")).alias("items")).collect()
    assert [r["items"] for r in got] == [plain(r["t"]) for r in got]
    assert spark.sql("select cast(null as string) as t").select(T.paren_split(F.col("t"))).first()[0] == [""]


def test_columns(spark):
    row = spark.sql("select 'ho2' as a, 'áo' as b, 'bệnh (x) (y)' as c, '```json\n{\"k\": 1}\n```' as j").select(
        K.letter_bounded(F.col("a"), "ho"), K.word_bounded(F.col("a"), "ho"), K.not_in_word(F.col("b"), "o"), review.trailing_alias(F.col("c")), T.json_object(F.col("j"), "k int")["k"], K.norm_key(F.col("b"))
    ).first()
    assert tuple(row) == (True, False, False, "y", 1, "áo")


def test_redundant(spark):
    names = ["buồn nôn", "ăn không ngon", "tối ăn không ngon", "ĂN KHÔNG NGON", " ", "nôn", "hoặc sốt", "mạch nhanh", "đau (nhẹ)", "sốt 2 ngày", "nôn khan"]
    xs = spark.createDataFrame([(names,)], "xs array<string>")
    assert xs.select(T.drop_redundant(F.col("xs"))).first()[0] == ["buồn nôn", "ăn không ngon", "nôn", "nôn khan"]
    assert xs.select(T.drop_redundant(F.col("xs"), limit=2)).first()[0] == ["buồn nôn", "ăn không ngon"]
    assert xs.select(T.drop_redundant(F.col("xs"), keywords=[], starts=[], dirty="^$")).first()[0][-4:] == ["mạch nhanh", "đau (nhẹ)", "sốt 2 ngày", "nôn khan"]


@pytest.mark.parametrize(
    "text, bounds",
    [
        ("12 % đến 30%", (12.0, 30.0)), ("30%–12%", (12.0, 30.0)), ("3,5-4.5%", (3.5, 4.5)), ("Xấp xỉ 7%", (7.0, 7.0)), ("7 %", (7.0, 7.0)), (">=7%", (None, None)), ("≥ 7%", (7.0, None)),
        ("lớn hơn  7%", (7.0, None)), ("≤7%", (None, 7.0)), ("7", (None, None)), ("101%", (None, None)), ("10%-101%", (None, None)), ("0012%", (None, None)), ("khoảng 7% người", (None, None)), ("", (None, None)), (None, (None, None)),
    ],
)
def test_rates(spark, text, bounds):
    least, most = T.rate_bounds(F.col("r"))
    assert tuple(spark.createDataFrame([(text,)], "r string").select(least, most).first()) == bounds


def test_rewrites(spark):
    rows = spark.createDataFrame([("Đầy  trướng bụng và TRƯỚNG BỤNG",), ("bụng chướng",), ("x\t y",)], "t string").select(T.rewrite_synonyms(F.col("t")))
    assert [r[0] for r in rows.collect()] == ["bụng đầy trướng và bụng trướng", "chướng bụng", "x y"]


def test_observations(spark):
    t, f = F.col("t"), F.col("f")
    row = spark.sql("select struct(' Đỏ ' as than_luoi, 'có' as luoi_beu, 'không' as dau_rang, 'không' as vet_nut, 'vàng' as reu_mau, 'dày' as reu_day, 'nhớt' as reu_chat) as t, struct('hồng hào bình thường' as sac_mat, 'có' as go_ma_do, 'không rõ' as phu, cast(null as string) as ban_do, 'có' as quang_tham, 'có' as trang_diem) as f").select(
        findings.tongue_findings(t), findings.face_findings(f), findings.tongue_sentence(t), findings.face_sentence(f)
    ).first()
    assert tuple(row) == (["lưỡi đỏ", "lưỡi bệu", "rêu vàng nhớt"], ["hai gò má đỏ", "quầng đen dưới mắt"], "Lưỡi: thân lưỡi đỏ, rêu vàng dày nhớt, lưỡi bệu.", "Sắc mặt: sắc mặt hồng hào bình thường, hai gò má đỏ, quầng thâm mắt, (có trang điểm).")


def test_mutations(spark):
    edges = spark.createDataFrame([(1, 2, "t", "a"), (3, 2, "t", "b"), (3, 2, "t", "a")], "src long, dst long, type string, p string")
    plan = spark.createDataFrame([(1, 3), (3, 3)], "id long, canonical long")
    assert mutate.repoint(edges, plan).count() == 2
    assert mutate.repoint(edges, plan, keep_properties=False).collect()[0]["p"] == "a"
    assert {r["id"] for r in graph.orphans(spark.createDataFrame([(2,), (9,)], "id long"), edges).collect()} == {9}
    up = mutate.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string"), ["k"])
    assert sorted(map(tuple, up.collect())) == [(1, "a", False), (2, "c", False), (3, "d", True)]


def test_lookup(spark):
    found = review.dictionary_lookup(spark.createDataFrame([("K",), ("k2",), ("z",)], "a string"), spark.createDataFrame([("K", "1"), ("K2", "2")], "a string, v string"), "a", "v")
    assert {r["a"]: r["v"] for r in found.collect()} == {"K": "1", "k2": "2", "z": None}


def test_majority(spark):
    votes = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b")], "i int, o string")
    assert {r["i"]: r["o"] for r in link.majority(votes, ["i"], "o").collect()} == {1: "a", 2: None}
