"""Text, list and JSON operators as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F
from pyspark.sql.column import Column

# Ordered rewrites of one complaint's spellings.
SYNONYM_REWRITES = [
    (r"\bđầy\s+trướng\s+bụng\b", "bụng đầy trướng"),
    (r"\bbụng\s+đầy\s+trướng\b", "bụng đầy trướng"),
    (r"\bbụng\s+chướng\b", "chướng bụng"),
    (r"\btrướng\s+bụng\b", "bụng trướng"),
]


def rewrite_synonyms(c: Column) -> Column:
    for pattern, to in SYNONYM_REWRITES:
        c = F.regexp_replace(c, f"(?iU){pattern}", to)
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def paren_split(c: Column) -> Column:
    """Split at commas that stand in no bracket; a stray closing bracket opens nothing.

    Within a piece between commas the depth d becomes max(d + net, from_zero): both are known for each piece alone,
    so one fold over the pieces tells which commas are outside of all brackets.
    """
    marks = lambda p: F.split(F.regexp_replace(p, r"[^(\[{)\]}]", ""), "")
    turn = lambda m: F.when(m.isin("(", "[", "{"), 1).when(m.isin(")", "]", "}"), -1).otherwise(0)

    def piece(p: Column) -> Column:
        net = F.aggregate(marks(p), F.lit(0), lambda d, m: d + turn(m))
        from_zero = F.aggregate(marks(p), F.lit(0), lambda d, m: F.greatest(F.lit(0), d + turn(m)))
        return F.struct(p.alias("text"), net.alias("net"), from_zero.alias("from_zero"))

    def step(state: Column, x: Column) -> Column:
        done = F.when(state["depth"] == 0, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"])
        text = F.when(state["depth"] == 0, x["text"]).otherwise(F.concat(state["open"], F.lit(","), x["text"]))
        return F.struct(done.alias("done"), text.alias("open"), F.greatest(state["depth"] + x["net"], x["from_zero"]).alias("depth"))

    pieces = F.transform(F.split(F.coalesce(c, F.lit("")), ",", -1), piece)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("depth"))
    # The fold puts the empty start before the first piece; it is left out again.
    return F.aggregate(pieces, start, step, lambda s: F.slice(F.concat(s["done"], F.array(s["open"])), F.lit(2), F.size(s["done"])))


# Words and signs before a percentage.
ABOUT = ["khoảng", "xấp xỉ", "gần", "tầm"]
AT_LEAST = ["hơn", "trên", "lớn hơn", "cao hơn", "≥", ">"]
AT_MOST = ["dưới", "thấp hơn", "nhỏ hơn", "≤", "<"]


def rate_bounds(c: Column) -> tuple[Column, Column]:
    """(least, most) of a percentage text: a range, a value, about, over or under; above 100 or anything else: null.

    The numbers are taken out first; what is left of the text, its form, then tells what they mean.
    """
    number = r"\d+(?:[.,]\d+)?"
    text = F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    form = F.regexp_replace(text, number, "#")
    known = F.transform(F.regexp_extract_all(text, F.lit(number), F.lit(0)), lambda n: F.when(n.rlike(r"^\d{1,3}([.,]|$)"), F.replace(n, F.lit(","), F.lit(".")).try_cast("double")))
    values = F.when(~text.contains("#") & F.forall(known, lambda x: F.coalesce(x <= 100, F.lit(False))), known)
    one, two = form.rlike("^[^#]*# ?%$"), form.rlike("^# ?%? ?([-–~]+|đến) ?# ?%$")
    before = F.trim(F.substring_index(form, "#", 1))
    exact = one & before.isin("", *ABOUT)
    least = F.when(two | exact | (one & before.isin(AT_LEAST)), F.array_min(values))
    most = F.when(two | exact | (one & before.isin(AT_MOST)), F.array_max(values))
    return least, most


def name_bucket(c: Column, legit: Sequence[str] = (), staging: Sequence[str] = ()) -> Column:
    """The first of the ordered rules on dirty names that holds."""
    low = F.lower(c)
    legit_name = F.lit(False)
    for word in legit:
        legit_name = legit_name | low.contains(word)
    staged = F.lit(False)
    for word in staging:
        staged = staged | low.startswith(word)
    return (
        F.when(staged & (c.contains(" - ") | c.contains("(")), "staging")
        .when(c.contains(" - ") & legit_name, "compound")
        .when(c.contains(" - "), "dash")
        .when(c.contains("/"), "slash")
        .when(c.rlike("[()]"), "paren")
        .when(c.rlike(r"\d"), "digit")
        .when((F.length(c) > 40) & legit_name, "long compound")
        .when(F.length(c) > 40, "long")
        .otherwise("clean")
    )


def tokens(c: Column, stop: Sequence[str] = (), limit: int | None = None) -> Column:
    """Lower-case words without stop words, the first ``limit`` of them."""
    words = F.filter(F.split(F.lower(c), r"(?U)[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(list(stop)) if stop else w != "")
    return words if limit is None else F.slice(words, 1, limit)


def features(words: Column) -> Column:
    """Words as ``u:`` and neighbouring pairs as ``b:`` features."""
    def both(w: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat(F.lit("b:"), F.element_at(w, i), F.lit(" "), F.element_at(w, i + 1)))
        return F.concat(F.transform(w, lambda x: F.concat(F.lit("u:"), x)), F.when(F.size(w) > 1, pairs).otherwise(F.array().cast("array<string>")))

    # The one-element array binds the words, which are so split once and not for each pair.
    return F.element_at(F.transform(F.array(words), both), 1)


def json_object(c: Column, schema: str) -> Column:
    """The object of a fenced block, else from the first ``{`` to the last ``}``; anything else is null."""
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    bare = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    body = F.when(fenced != "", fenced).when(bare != "", bare)
    return F.from_json(body, schema)


def ordered_distinct(c: Column) -> Column:
    """First of each item that is equal without case, in order, and no empty ones."""
    step = lambda kept, x: F.when((x == "") | F.exists(kept, lambda k: F.lower(k) == F.lower(x)), kept).otherwise(F.concat(kept, F.array(x)))
    return F.aggregate(F.transform(c, lambda x: F.trim(x)), F.array().cast("array<string>"), step)


# What a suggested term may not hold, start with or be about.
DIRTY_MARKS = r"[\"'()\[\]0-9]"
FRAGMENT_STARTS = ["hoặc "]
OBSERVED_ONLY = [
    "lưỡi", "rêu", "vết răng", "hằn răng", "sắc mặt", "sắc da", "gò má", "má đỏ", "ửng đỏ", "ửng hồng", "mặt đỏ", "mặt nhợt", "mặt nhạt", "mặt vàng", "mặt trắng", "mặt xanh",
    "mặt sạm", "mặt xạm", "mặt xám", "mặt tái", "mạch", "ung thư", "u não", "khối u", "hội chứng", "bệnh ",
]


def drop_redundant(c: Column, limit: int = 30, keywords: Sequence[str] = OBSERVED_ONLY, starts: Sequence[str] = FRAGMENT_STARTS, dirty: str = DIRTY_MARKS) -> Column:
    """The first ``limit`` texts of an ordered array that say something new.

    Left out are empty and dirty texts, fragments, those that hold a keyword, repeats without regard to case, and
    any that contains an already kept text of two words or more.
    """
    named = F.transform(F.transform(c, lambda x: F.trim(x)), lambda x: F.struct(x.alias("name"), F.lower(x).alias("key")))
    bad = lambda k: F.exists(F.array(*[F.lit(w) for w in keywords]).cast("array<string>"), lambda w: k.contains(w)) | F.exists(F.array(*[F.lit(w) for w in starts]).cast("array<string>"), lambda w: k.startswith(w))
    usable = F.filter(named, lambda x: (x["key"] != "") & ~x["name"].rlike(dirty) & ~bad(x["key"]))

    def step(kept: Column, x: Column) -> Column:
        old = F.exists(kept, lambda k: (k["key"] == x["key"]) | (k["key"].rlike(r"\S\s+\S") & x["key"].contains(k["key"])))
        return F.when(old | (F.size(kept) >= limit), kept).otherwise(F.concat(kept, F.array(x)))

    kind = F.array().cast("array<struct<name:string,key:string>>")
    return F.transform(F.aggregate(usable, kind, step), lambda x: x["name"])
