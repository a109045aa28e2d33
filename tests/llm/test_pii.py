"""Surrogates: detection, coreference, formats, distinctness, and the permutations against plain Python."""

import hashlib
import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from trellis.llm import pii

KEY = pii.DEMO_KEY


def replaced(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    return [r["text"] for r in sorted(pii.replace_pii(rows).collect(), key=lambda r: r["i"])]


def counted(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["n_entities"] for r in sorted(pii.surrogate_digest(rows).collect(), key=lambda r: r["doc_id"])]


def test_one_person(spark):
    a, b, c, d, e = replaced(spark, ["Mr John Smith wrote.", "then Dr Smith came", "see Smith, John (or Smith, John)", "best regards,\nJohn Smith", "Name: John van Smith"])
    given, family = re.fullmatch(r"Mr (\w+) (\w+) wrote\.", a).groups()
    assert b == f"then Dr {family} came" and d == f"best regards,\n{given} {family}" and e == f"Name: {given} van {family}"
    assert c.endswith(f"or {family}, {given})") and given.lower() in pii.GIVEN_NAMES["latin m"] and given != "John"
    assert len(family) == 5 and family != "Smith" and family[-1] == "h"


CASES = [
    ("contact Jane Doe or Smith, John", 2), ("Robert Miller was here", 1), ("born on 03/11/1984 in Rome", 1), ("passport no. C01X00T47", 1), ("call 030 1234567 now", 1), ("Dear Hiring Manager", 0),
    ("With regards,\nAnna", 1), ("Господин Иван Петров и Κύριος Νίκος", 2), ("In the year 1984, version 3.11", 0), ("On 03/11/1984 it rained", 0), ("Then Robert left. New York", 0), ("DE89 3704 0044 0532 0130 00", 1),
    ("a@b.co\u0001 and \u0001Mr Doe", 2), ("However, John went", 0), ("", 0), (None, 0),
]


def test_found(spark):
    assert counted(spark, [t for t, _ in CASES]) == [n for _, n in CASES]


def test_formats(spark):
    texts = ["ANNA.LEE@MAIL.EXAMPLE.COM", "x anna.lee@mail.example.com y", "born 3.11.1984, dob: 1984-11-03", "DE89 3704 0044 0532 0130 00 and DE89370400440532013000", "passport AB-1234-C", "\u0001 Mr Doe \u0001", "Mr. O'Neil-Ártúr", "MR DOE Mr DOE"]
    out = replaced(spark, texts)
    assert out[0] == out[1][2:-2].upper() and out[1].endswith(".com y") and out[1] != texts[1]
    first, second = re.fullmatch(r"born (\d{1,2}\.\d{1,2}\.\d{4}), dob: (\d{4}-\d\d-\d\d)", out[2]).groups()
    d, m, y = map(int, first.split("."))
    assert date(y, m, d).isoformat() == second != "1984-11-03" and date(1900, 1, 1) <= date(y, m, d) < date(1900, 1, 1) + timedelta(pii.DAYS)
    one, two = out[3].split(" and ")
    assert one.replace(" ", "") == two and int(two[4:] + "1314" + two[2:4]) % 97 == 1 and two[:2] == "DE"
    assert re.fullmatch(r"passport [A-Z]{2}-\d{4}-[A-Z]", out[4]) and out[4] != texts[4]
    assert re.fullmatch("\u0001 Mr [A-Z][a-z]{2} \u0001", out[5]) and re.fullmatch(r"Mr\. [A-Z]'[A-Z][a-z]+-[ÁÀÂÄÃÅÆÉÈÊËÍÌÎÏÓÒÔÖÕØÚÙÛÜ]\w+", out[6])
    assert out[7].startswith("MR DOE Mr ") and out[7][10:].isupper()


def test_distinct_entities(spark):
    """Thousands of entities of every kind stay as many, with addresses and names of few letters among them."""
    rng = random.Random(8)
    day = lambda: (date(1950, 1, 1) + timedelta(rng.randint(0, 20000))).isoformat()
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    kinds = {
        "card": lambda: f"4{rng.randint(0, 10**15 - 1):015d}", "phone": lambda: f"+49 30 {rng.randint(0, 9999):04d}", "ssn": lambda: f"{rng.randint(0, 999):03d}-11-2222", "date": lambda: "born " + day(),
        "iban": lambda: f"DE{rng.randint(0, 99):02d}ABCD{rng.randint(0, 10**12 - 1):012d}", "paper": lambda: f"passport {rng.choice('ABC')}{rng.randint(1000, 9999)}", "name": lambda: "Mr " + word(rng.randint(2, 4)).capitalize(),
        "mail": lambda: f"{word(rng.randint(1, 3))}@{word(2)}.org", "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), "hex": lambda: f"{rng.getrandbits(128):032x}",
    }
    texts = [t for make in kinds.values() for t in sorted({make() for _ in range(500)})]
    out = replaced(spark, texts)
    assert len(set(out)) == len(texts) and not any(a == b for a, b in zip(texts, out) if a.startswith(("Mr", "born")) or "@" in a)


def test_names_without_end(spark):
    """More names than short ones could tell apart, twice each."""
    rows = spark.range(20_000).select("id", F.concat(F.lit("Mr "), F.initcap(F.translate(F.lpad(F.conv("id", 10, 8), 5, "0"), "01234567", "bcdfghjk"))).alias("text"))
    out = pii.replace_pii(rows.unionByName(rows.withColumn("text", F.replace("text", F.lit("Mr "), F.lit("Dr. "))))).select("id", F.regexp_replace("text", r"^Mr |^Dr\. ", "").alias("name"))
    assert out.distinct().count() == out.select("name").distinct().count() == 20_000


def plain_hash(*parts, bits=256):
    return hashlib.new(f"sha{bits}", "\u0001".join([KEY, *map(str, parts)]).encode()).hexdigest()


def plain_digits(digits, *tweak):
    n = len(digits)
    a, b = n // 2, n - n // 2
    l, r = int(digits[:a] or 0), int(digits[a:] or 0)  # noqa: E741
    draw = lambda side, k, other: int(plain_hash(*tweak, n, k, side, other)[:15], 16)
    for k in (1, 2, 3):
        l = (l + draw("l", k, r)) % 10**a  # noqa: E741
        r = (r + draw("r", k, l)) % 10**b
    return (f"{l:0{a}d}" if a else "") + f"{r:0{b}d}"


def plain_text(text, *tweak):
    half = len(text) // 2
    l, r = text[:half], text[half:]  # noqa: E741

    def shift(part, other, k, side):
        stream = plain_hash(*tweak, k, side, other, bits=512)
        out = ""
        for i, c in enumerate(part):
            letters = next((s for s in pii.ALPHABETS if c in s), c)
            at = i % 42 * 3
            out += letters[(letters.index(c) + int(stream[at : at + 3], 16)) % len(letters)] if len(letters) > 1 else c
        return out

    for k in (1, 2, 3):
        l = shift(l, r, k, "l")  # noqa: E741
        r = shift(r, l, k, "r")
    return l + r


def test_permutations_by_plain_python(spark):
    rng = random.Random(3)
    digits = ["".join(rng.choice("0123456789") for _ in range(rng.randint(1, 16))) for _ in range(60)]
    words = ["".join(rng.choice("abcdeéiouñxyz12.-пёыαω") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    got = spark.createDataFrame(list(zip(digits, words)), "d string, w string").select(pii._permute_digits(F.col("d"), KEY, "t", F.lit("u")).alias("d"), pii._permute_text(F.col("w"), KEY, "t").alias("w")).collect()
    assert [r["d"] for r in got] == [plain_digits(d, "t", "u") for d in digits]
    assert [r["w"] for r in got] == [plain_text(w, "t") for w in words]
    # All texts of one shape, and all numbers of one length, have different images.
    every = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d")).select(pii._permute_digits(F.col("d"), KEY, "x").alias("p"))
    assert every.distinct().count() == 1000
