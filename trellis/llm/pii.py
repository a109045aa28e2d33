"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Detected entities: e-mail addresses, secrets (long hexadecimal strings), IPv4 addresses, social security numbers,
international and national telephone numbers, payment card numbers, IBANs, birth dates and document numbers after a
word that announces them, and names: after a form of address, after a word or closing that a name follows, with a
known given name, and as "family, given".

A surrogate is a function of a secret key, the entity's type and its canonical form (case and punctuation do not
matter), so every mention of an entity gets the same one, in any document, without a shuffle of texts:

* numbers go through a keyed Feistel permutation of their digits, letters through one that keeps vowels, consonants
  and script: different entities of one shape stay different.  Punctuation and country code stay, and the check
  digits of cards and IBANs stay as valid as they were;
* dates are permuted within their span of 120 years, and written as the mention was;
* names are replaced part by part, each part the same wherever it stands, so that "Mr John Smith", "Dr Smith" and
  "Smith, John" stay one person.  A known given name becomes another of its gender and script; other parts keep
  length, script and last letter.  Forms of address and particles stay.

The collision check runs over the distinct addresses and name parts of the corpus, the kinds where a surrogate can
equal another's or a real one.  Such a surrogate is drawn again, each time with one syllable more, until none is left:
longer and longer names never run out.  Those exceptions, usually few, are looked up for the documents that hold them.
Number surrogates are distinct by construction; one may equal another real number of the corpus, which is itself
replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from trellis.llm.common import discard, doc_texts, materialize

#: Key of the registered query; real use passes its own secret.
DEMO_KEY = "surrogate-demo-key"

FORMS_OF_ADDRESS = [
    "Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин", "Κύριος", "Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Mademoiselle", "Mlle", "Госпожа", "Κυρία", "Dr", "Prof",
]
PARTICLES = ["van", "von", "de", "da", "del", "della", "der", "den", "dos", "la", "le", "di", "du", "bin", "al", "ter", "zu"]
GIVEN_NAMES = {
    "latin m": ["alan", "alexander", "andrew", "bruno", "carl", "carlos", "charles", "daniel", "david", "edward", "erik", "felix", "fernando", "georg", "george", "hans", "hugo", "ivan", "james", "jean", "john", "jonas", "jorge", "joseph", "juan", "karim", "klaus", "leo", "louis", "luis", "manuel", "mark", "michael", "miguel", "paul", "pedro", "peter", "pierre", "richard", "robert", "stefan", "steven", "thomas", "walter", "william"],
    "latin f": ["alice", "amélie", "ana", "anna", "barbara", "bella", "camille", "carmen", "clara", "claire", "diana", "elena", "elisabeth", "emily", "emma", "eva", "flora", "greta", "hanna", "heike", "ingrid", "irene", "isabel", "jane", "jennifer", "julia", "karla", "laura", "lena", "linda", "lucía", "margaret", "maria", "marie", "mary", "monika", "nicole", "olga", "patricia", "sabine", "sarah", "sofía", "susan", "ursula"],
    "latin n": ["alex", "andrea", "chris", "dominique", "jules", "kim", "luca", "mika", "noa", "robin", "sacha", "toni"],
    "cyrillic m": ["алексей", "борис", "виктор", "владимир", "денис", "дмитрий", "егор", "иван", "михаил", "николай", "павел", "сергей"],
    "cyrillic f": ["алина", "анна", "вера", "дарья", "екатерина", "елена", "ирина", "мария", "наталья", "ольга", "светлана", "татьяна"],
    "cyrillic n": ["валя", "женя", "паша", "саша", "слава"],
    "greek m": ["ανδρέας", "γιάννης", "γιώργος", "δημήτρης", "κώστας", "νίκος", "παύλος", "πέτρος"],
    "greek f": ["άννα", "βασιλική", "ελένη", "ιωάννα", "κατερίνα", "μαρία", "σοφία"],
}
#: What a letter may become: one of its own alphabet.  Other characters stay.
ALPHABETS = [
    "aeiou", "bcdfghjklmnpqrstvwxyz", "0123456789", "áàâäãåæéèêëíìîïóòôöõøúùûü", "çčćđłñńřśšßžźż",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "αεηιουω", "βγδζθκλμνξπρσςτφχψ", "άέήίόύώ",
]
SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδζκλμνπρστφ", "αειου")}
#: Words before a name: with a colon, without, and closings of letters.
LABELS = "name|full name|contact|contact person|author|from|to|cc|attn|by|signed|sender|recipient|patient|customer|client|employee|kontakt|absender|empfänger|autor|kunde|nom|nombre|contacto|para|auteur|имя|контакт|автор|όνομα"
LEADS = "contact|contacts?|signed|signed by|written by|posted by|reported by|dear|lieber|liebe|cher|chère|querido|querida|estimado|estimada|kontakt|contacto"
CLOSINGS = "regards|sincerely|yours truly|faithfully|cheers|many thanks|freundlichen grüßen|viele grüße|beste grüße|cordialement|bien à vous|saludos|saludos cordiales|atentamente|с уважением|με εκτίμηση"
NO_NAMES = "Sir|Madam|All|Team|Hiring|Customer|Friends|Colleagues|Everyone|Support|Sales|The|Reader|Editor|Us"
BIRTH = "born|born on|date of birth|birth date|birthday|dob|geboren|geboren am|geburtsdatum|né le|née le|date de naissance|nacido el|nacida el|fecha de nacimiento|дата рождения"
PAPERS = "passport|passport no|passport no\\.|passport number|reisepass|reisepassnummer|personalausweis|ausweisnummer|pasaporte|passeport|dni|id card|id no|id number|driving licence|driver's license|licence no|license no|führerschein|permis de conduire|паспорт"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,200}+@(?:[A-Za-z0-9-]{1,63}+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])"
SECRET = r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![A-Za-z0-9])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
BIRTH_DATE = rf"(?=[0-9])(?<=(?i:{BIRTH})[: ]{{1,3}})(?:[0-9]{{1,2}}([./-])[0-9]{{1,2}}\1[0-9]{{4}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})(?![0-9A-Za-z])"
DOCUMENT = rf"(?=[A-Z0-9])(?<=(?i:{PAPERS})[:# ]{{1,3}})(?=(?:[A-Z-]*[0-9]){{4}})[A-Z0-9][A-Z0-9-]{{4,18}}+(?![0-9A-Za-z])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    r"|0[0-9]{2,4}[ /-][0-9]{4,8}(?:[ -][0-9]{2,6}){0,2}|0[1-9](?:[ .-][0-9]{2}){4})(?![0-9A-Za-z])"
)
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}+|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![0-9A-Za-z])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![0-9A-Za-z])"
_FORMS = "|".join(sorted(FORMS_OF_ADDRESS, key=len, reverse=True))
_GIVEN = "|".join(sorted({n.capitalize() for names in GIVEN_NAMES.values() for n in names}, key=lambda n: (-len(n), n)))
_END = r"(?![\p{L}\p{N}'’-])"
_PART = r"\p{Lu}(?:[\p{L}'’-]+|\.)"
_MORE = rf"(?: (?:(?:{'|'.join(PARTICLES)}) ){{0,2}}{_PART})"
NAME = (
    rf"(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:(?:{_FORMS})\.? {_PART}{_MORE}*+|(?:{_GIVEN}){_END}{_MORE}{{1,3}}+|(?<=(?i:or|and|&|;|:|contact|cc|attn) ){_PART}, (?:{_GIVEN}){_END}"
    rf"|(?<=(?<![\p{{L}}\p{{N}}])(?:(?i:{LABELS}): ?|(?i:{LEADS}) ))(?!(?:{NO_NAMES}){_END}){_PART}{_MORE}{{1,3}}+|(?<=(?i:{CLOSINGS})[,.!]{{0,1}}\s{{1,3}})(?!(?:{NO_NAMES}){_END}){_PART}{_MORE}{{0,3}}+)"
)
#: In this order at each place of the text.
ENTITY = "|".join([EMAIL, SECRET, IPV4, SSN, BIRTH_DATE, DOCUMENT, PHONE, CARD, IBAN, NAME])
#: What every entity has somewhere; texts without it are not searched for the long list above.
HINT = rf"@|[0-9a-f]{{32}}|[0-9A-F]{{32}}|[0-9][A-Z0-9./ ()-]{{3}}|{NAME}"
#: What stands around each entity while a text is taken apart; texts that have it themselves are taken apart otherwise.
FENCE = "\u0001"


def entity_type(e: Column) -> Column:
    return (
        F.when(e.contains("@"), "email")
        .when(e.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), "secret")
        .when(e.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), "ip")
        .when(e.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(e.rlike(r"^(?:[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})$"), "date")
        .when(e.rlike(r"^(?:[+(]|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$|0[0-9]+[ ./-][0-9 .-]+$)"), "phone")
        .when(e.rlike(r"^[0-9][0-9 -]*$"), "card")
        .when(e.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11,}$"), "iban")
        .when(e.rlike(r"^[A-Z0-9-]*[0-9][A-Z0-9-]*$"), "document")
        .otherwise("name")
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _date_fields(e: Column) -> Column:
    """(y, m, d) of a numeric date: the year is the long field, and a month over 12 is a day."""
    f = F.split(e, "[./-]")
    first = F.length(f[0]) == 4
    swapped = ~first & (f[1].cast("int") > 12)
    return F.struct(F.when(first, f[0]).otherwise(f[2]).alias("y"), F.when(swapped, f[0]).otherwise(f[1]).alias("m"), F.when(first, f[2]).when(swapped, f[1]).otherwise(f[0]).alias("d"))


def canonical(e: Column, kind: Column) -> Column:
    """One form for all mentions: lower case addresses, bare digits, ISO dates.  Names are told apart by their parts."""
    digits = F.regexp_replace(e, "[^0-9]", "")
    country = F.when(e.startswith("+"), F.concat(F.regexp_extract(e, r"^\+([0-9]{1,3})[ .(-]", 1), F.lit("+"))).otherwise("+")
    local = F.regexp_replace(F.regexp_replace(e, r"^\+[0-9]{1,3}(?=[ .(-])", ""), "[^0-9]", "")
    date = _let(_date_fields(e), lambda x: F.concat_ws("-", x["y"], F.lpad(x["m"], 2, "0"), F.lpad(x["d"], 2, "0")))
    return (
        F.when(kind.isin("email", "secret"), F.lower(e))
        .when(kind == "phone", F.concat(country, local))
        .when(kind.isin("iban", "document"), F.regexp_replace(e, "[ -]", ""))
        .when(kind == "date", F.when(date.try_cast("date").isNotNull(), date).otherwise(digits))
        .when(kind.isin("ip", "name"), e)
        .otherwise(digits)
    )


# --- keyed permutations ---------------------------------------------------------------------------------------


def _hash(key: str, *parts, bits: int = 256) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]), bits)


def _keyed(key: str, *parts) -> Column:
    """A keyed 60-bit number."""
    return F.conv(F.substring(_hash(key, *parts), 1, 15), 16, 10).cast("long")


def _permute_digits(digits: Column, key: str, *tweak) -> Column:
    """``_digits_permuted`` of digits that are computed once."""
    return _let(digits, lambda d: _digits_permuted(d, key, *tweak))


def _digits_permuted(digits: Column, key: str, *tweak) -> Column:
    """A keyed permutation of all digit strings of this length (at most 18): a Feistel network of two halves."""
    n = F.length(digits)
    a, b = F.floor(n / 2).cast("int"), (n - F.floor(n / 2)).cast("int")
    size = lambda k: F.pow(F.lit(10.0), k).cast("long")
    left = F.coalesce(F.substring(digits, F.lit(1), a).try_cast("long"), F.lit(0))
    right = F.coalesce(F.substring(digits, a + 1, b).try_cast("long"), F.lit(0))

    def turn(s: Column, k: Column) -> Column:
        draw = lambda side, other: _keyed(key, *tweak, n.cast("string"), k.cast("string"), side, other.cast("string"))
        l = F.pmod(s["l"] + F.pmod(draw("l", s["r"]), size(a)), size(a))  # noqa: E741
        return _let(l, lambda v: F.struct(v.alias("l"), F.pmod(s["r"] + F.pmod(draw("r", v), size(b)), size(b)).alias("r")))

    pad = lambda v: F.lpad(v.cast("string"), 10, "0")
    done = F.aggregate(F.sequence(F.lit(1), F.lit(3)), F.struct(left.alias("l"), right.alias("r")), turn, lambda s: F.concat(pad(s["l"]), pad(s["r"])))
    # Each half was padded to ten digits; keep the last a and b of them.
    return _let(done, lambda d: F.concat(F.when(a > 0, F.substring(d, 11 - a, a)).otherwise(""), F.substring(d, 21 - b, b)))


def _permute_long(digits: Column, key: str, *tweak) -> Column:
    """As ``_permute_digits``, for any length: blocks of 16 digits, each tweaked by the ones before it."""


    def permuted(d: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.length(d) - 1) / 16).cast("int")), lambda k: F.substring(d, k * 16 + 1, F.lit(16)))
        earlier = lambda k: F.substring(d, F.lit(1), k * 16)
        return F.when(F.length(d) == 0, "").otherwise(F.array_join(F.transform(blocks, lambda x, k: _digits_permuted(x, key, *tweak, k.cast("string"), earlier(k))), ""))

    return _let(digits, permuted)


def _turn_letter(c: Column, x: Column) -> Column:
    """The letter x places on in its alphabet."""
    on = lambda letters: F.substring(F.lit(letters), ((F.position(c, F.lit(letters)) - 1 + x) % len(letters) + 1).cast("int"), F.lit(1))
    return F.coalesce(*[F.when(F.position(c, F.lit(letters)) > 0, on(letters)) for letters in ALPHABETS], c)


def _permute_text(text: Column, key: str, *tweak) -> Column:
    """A keyed permutation of the lower-case texts of one shape: each letter stays in its alphabet (Feistel, two halves)."""


    def halves(chars: Column) -> Column:
        half = F.floor(F.size(chars) / 2).cast("int")
        return F.struct(F.slice(chars, F.lit(1), half).alias("l"), F.slice(chars, half + 1, F.size(chars)).alias("r"))

    start = _let(F.split(text, ""), halves)

    def shift(part: Column, other: Column, k: Column, side: str) -> Column:
        stream = _hash(key, *tweak, k.cast("string"), side, F.array_join(other, ""), bits=512)
        return _let(stream, lambda s: F.transform(part, lambda c, i: _turn_letter(c, F.conv(F.substring(s, (i % 42) * 3 + 1, F.lit(3)), 16, 10).cast("int"))))

    def turn(s: Column, k: Column) -> Column:
        return _let(shift(s["l"], s["r"], k, "l"), lambda l: F.struct(l.alias("l"), shift(s["r"], l, k, "r").alias("r")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(3)), start, turn, lambda s: F.array_join(F.concat(s["l"], s["r"]), ""))


def _luhn(digits: Column) -> Column:
    """Luhn sum of the digits, modulo 10."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.floor(c.cast("int") * 2 / 10) + c.cast("int") * 2 % 10).cast("int"))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10


def _mod97(text: Column) -> Column:
    """The remainder by 97 of a text of digits and capital letters, each letter two digits (A: 10)."""
    step = lambda r, c: (F.when(c.rlike("^[0-9]$"), r * 10 + c.cast("int")).otherwise(r * 100 + F.ascii(c) - 55) % 97).cast("int")
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _given_names(key: str) -> dict[str, str]:
    """Each known given name to the next of its gender and script, in keyed order: no name stays."""
    out: dict[str, str] = {}
    for group, names in GIVEN_NAMES.items():
        order = sorted((n for n in names if n not in out), key=lambda n: hashlib.sha256(f"{key}\u0001{group}\u0001{n}".encode()).digest())
        out |= dict(zip(order, order[1:] + order[:1], strict=True))
    return out


def _syllables(form: Column, key: str, attempt: Column) -> Column:
    """``attempt`` syllables in the script of the form."""
    letter = lambda letters, *parts: F.substring(F.lit(letters), (_keyed(key, *parts) % len(letters) + 1).cast("int"), F.lit(1))
    one = lambda k, script: F.concat(*[letter(s, "syllable", n, form, attempt.cast("string"), k.cast("string")) for n, s in enumerate(SYLLABLES[script])])
    words = lambda script: F.array_join(F.transform(F.sequence(F.lit(1), attempt), lambda k: one(k, script)), "")
    several = F.when(form.rlike(r"\p{IsCyrillic}"), words("cyrillic")).when(form.rlike(r"\p{IsGreek}"), words("greek")).otherwise(words("latin"))
    return F.when(attempt > 0, several).otherwise("")


def name_part(form: Column, key: str, attempt: Column | None = None) -> Column:
    """The surrogate of a lower-case name part; without an attempt the first one."""
    # One literal, and not one for each name: the plan stays small.
    table = F.str_to_map(F.lit(",".join(f"{a}:{b}" for a, b in _given_names(key).items())), F.lit(","), F.lit(":"))

    def permuted(text: Column) -> Column:
        # Parts of three letters or more keep the last one, which often tells gender.
        n = F.length(text)
        keep = F.when(n > 2, 1).otherwise(0)
        return F.concat(_permute_text(F.substring(text, F.lit(1), n - keep), key, "name", F.substring(text, n - keep + 1, keep)), F.substring(text, n - keep + 1, keep))

    # A result that is itself a known given name goes round once more, which keeps different parts different.
    rounds = F.aggregate(F.sequence(F.lit(1), F.lit(3)), form, lambda s, k: F.when((k == 1) | F.map_contains_key(table, s), permuted(s)).otherwise(s))
    first = F.coalesce(F.try_element_at(table, form), rounds)
    return first if attempt is None else F.concat(first, _syllables(form, key, attempt))


def email(form: Column, key: str, attempt: Column | None = None) -> Column:
    """The surrogate of a lower-case address: addresses of one domain stay together, the last label stays."""
    local, domain = F.substring_index(form, "@", 1), F.substring_index(form, "@", -1)
    end = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(end) - 1)
    more = F.lit("") if attempt is None else _syllables(F.concat(F.lit("a"), form), key, attempt)
    return F.concat(_permute_text(local, key, "email", domain), more, F.lit("@"), _permute_text(host, key, "domain", end), F.lit("."), end)


#: Days of the span that dates are permuted in (a prime, about 120 years), and where the first one begins.
DAYS = 43_801
FIRST_DAY = "1900-01-01"


def _date(form: Column, key: str) -> Column:
    seed = int(hashlib.sha256(f"{key}\u0001date".encode()).hexdigest(), 16)
    factor, offset = seed % (DAYS - 2) + 2, seed // DAYS % DAYS
    day = F.datediff(form.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    span = F.floor(day / DAYS)
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), (span * DAYS + F.pmod(F.pmod(day, F.lit(DAYS)).cast("long") * factor + offset, F.lit(DAYS))).cast("int"))
    return F.when(form.contains("-"), F.date_format(new, "yyyy-MM-dd")).otherwise(_permute_long(form, key, "date"))


def _mixed(text: Column, key: str, kind: str, tweak: Column) -> Column:
    """Digits permuted by what the letters are, each letter moved on by its place: different texts stay different."""
    return _let(text, lambda t: _mixed_once(t, key, kind, tweak))


def _mixed_once(text: Column, key: str, kind: str, tweak: Column) -> Column:
    shape = F.regexp_replace(text, "[0-9]", "9")
    new_digits = _permute_long(F.regexp_replace(text, "[^0-9]", ""), key, kind, shape, tweak)
    moved = lambda c, i: F.upper(F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), ((F.ascii(c) - 65 + _keyed(key, kind, "letter", i.cast("string")) % 25 + 1) % 26 + 1).cast("int"), F.lit(1)))
    letters = F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike("^[A-Z]$"), moved(c, i)).otherwise(c)), "")
    return _filled(letters, new_digits)


def _filled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order."""
    step = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substring(digits, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i")))
    return F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), step, lambda s: s["out"])


def number(kind: Column, form: Column, key: str) -> Column:
    """The canonical form of the surrogate of every kind but names and addresses."""
    secret = F.substring(_hash(key, "secret", form, bits=512), F.lit(1), F.length(form))
    octets = F.split(form, r"\.")
    whole = F.conv(F.array_join(F.transform(octets, lambda o: F.lpad(F.hex(o.cast("long")), 2, "0")), ""), 16, 10).cast("long")

    def ip_turn(s: Column, k: Column) -> Column:
        draw = lambda side, other: _keyed(key, "ip", k.cast("string"), side, other.cast("string")) % 65536
        return _let((s["l"] + draw("l", s["r"])) % 65536, lambda l: F.struct(l.alias("l"), ((s["r"] + draw("r", l)) % 65536).alias("r")))

    halves = _let(whole, lambda w: F.struct(F.floor(w / 65536).cast("long").alias("l"), (w % 65536).alias("r")))
    dotted = lambda s: F.concat_ws(".", *[x.cast("string") for v in (s["l"], s["r"]) for x in (F.floor(v / 256), v % 256)])
    ip = F.aggregate(F.sequence(F.lit(1), F.lit(3)), halves, ip_turn, dotted)
    country, rest = F.substring_index(form, "+", 1), F.substring_index(form, "+", -1)
    phone = F.concat(country, F.lit("+"), _permute_long(rest, key, "phone", country))
    # The last digit of a card, and the two check digits of an IBAN, keep their distance from the valid ones.
    body, check = F.substring(form, F.lit(1), F.length(form) - 1), F.substring(form, -1, 1)
    off = F.pmod(check.cast("int") + _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    card = _let(_permute_long(body, key, "card"), lambda b: F.concat(b, F.pmod(off - _luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    land, account = F.substring(form, 1, 2), F.substring(form, F.lit(5), F.length(form))
    valid = lambda a: 98 - _mod97(F.concat(a, land, F.lit("00")))
    iban = _let(_mixed(account, key, "iban", land), lambda a: F.concat(land, F.lpad(F.pmod(valid(a) + F.substring(form, 3, 2).cast("int") - valid(account), F.lit(100)).cast("string"), 2, "0"), a))
    return (
        F.when(kind == "secret", secret).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", _permute_digits(form, key, "ssn"))
        .when(kind == "iban", iban).when(kind == "date", _date(form, key)).when(kind == "document", _mixed(form, key, "document", F.lit("")))
    )


# --- mentions -------------------------------------------------------------------------------------------------


def _is_part(token: Column, place: Column) -> Column:
    """Whether a word of a name mention is to be replaced: not its form of address, not a particle."""
    bare = F.regexp_replace(token, "[.,]$", "")
    return ~(((place == 0) & bare.isin(FORMS_OF_ADDRESS)) | token.isin(PARTICLES))


def _part_form(token: Column) -> Column:
    return F.lower(F.regexp_replace(token, "[.,]$", ""))


def _recased(old: Column, new: Column) -> Column:
    """``new`` with capitals where ``old`` has them; what is longer is as the last letter of ``old``."""
    capital = lambda i: F.substring(old, F.least(i + 1, F.length(old)), F.lit(1)).rlike(r"\p{Lu}")
    return F.array_join(F.transform(F.split(new, ""), lambda c, i: F.when(capital(i) & ((i < F.length(old)) | (F.upper(old) == old) & (F.length(old) > 1)), F.upper(c)).otherwise(c)), "")


def _written(e: Column, kind: Column, form: Column) -> Column:
    """The surrogate's canonical form written as the mention ``e`` was: punctuation, spaces, case, order of a date."""
    bare = F.when(kind == "phone", F.substring_index(form, "+", -1)).otherwise(form)
    start = F.when(kind == "phone", F.regexp_extract(e, r"^(\+[0-9]{1,3}(?=[ .(-])|)", 1)).otherwise("")
    body = F.substring(e, F.length(start) + 1, F.length(e))
    both = kind.isin("iban", "document")
    step = lambda s, c: F.when(c.rlike("^[0-9]$") | (both & c.rlike("^[A-Z]$")), F.struct(F.concat(s["out"], F.substring(bare, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i")))
    filled = F.aggregate(F.split(body, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), step, lambda s: s["out"])
    mark, old = F.regexp_extract(e, "([./-])", 1), F.split(e, "[./-]")
    as_long = lambda field, like: F.when(F.length(like) == 1, field.cast("int").cast("string")).otherwise(field)
    new = F.split(form, "-")
    first, second = F.when(old[1].cast("int") > 12, new[1]).otherwise(new[2]), F.when(old[1].cast("int") > 12, new[2]).otherwise(new[1])
    date = F.when(~form.contains("-"), filled).when(F.length(old[0]) == 4, form).otherwise(F.concat(as_long(first, old[0]), mark, as_long(second, old[1]), mark, new[0]))
    return (
        F.when(kind.isin("email", "secret"), F.when(F.upper(e) == e, F.upper(form)).otherwise(form))
        .when(kind == "ip", form).when(kind == "date", date).otherwise(F.concat(start, filled))
    )


def _apart(text: Column) -> Column:
    """The text's pieces: what stands between entities (even places) and the entities (odd places)."""
    fenced = F.split(F.regexp_replace(text, ENTITY, f"{FENCE}$0{FENCE}"), FENCE, -1)
    between, entities = F.split(text, ENTITY, -1), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    other = F.slice(F.flatten(F.zip_with(between, entities, lambda b, e: F.array(b, F.coalesce(e, F.lit(""))))), F.lit(1), 2 * F.size(between) - 1)
    return F.when(~text.rlike(HINT), F.array(text)).when(text.contains(FENCE), other).otherwise(fenced)


def _drawn(kind: Column, form: Column, key: str, attempt: Column) -> Column:
    return F.when(kind == "email", email(form, key, attempt)).otherwise(name_part(form, key, attempt))


def exceptions(texts: DataFrame, key: str) -> DataFrame | None:
    """Addresses and name parts whose first surrogate is taken: (kind, form, surrogate); None if there are none."""
    entities = texts.select(F.explode(F.filter(_apart(F.col("text")), lambda _, i: i % 2 == 1)).alias("e")).select("e", entity_type(F.col("e")).alias("kind")).filter("kind in ('email', 'name')")
    parts = F.transform(F.filter(F.split("e", " "), _is_part), _part_form)
    found = entities.select("kind", F.explode(F.when(F.col("kind") == "email", F.array(F.lower("e"))).otherwise(parts)).alias("form")).distinct()
    draw = lambda df: df.withColumn("surrogate", _drawn(F.col("kind"), F.col("form"), key, F.col("attempt")))
    table = materialize(draw(materialize(found, "found").withColumn("attempt", F.lit(0))), "entities")
    real = table.select(F.col("kind").alias("k"), F.col("form").alias("f"))
    real = materialize(real, "real")
    while True:
        taken = table.join(real, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("f")), "left_semi").select("kind", "form")
        shared = table.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "form")).alias("first")).filter("n > 1")
        later = table.join(shared, ["kind", "surrogate"]).filter(F.col("form") != F.col("first.form")).select("kind", "form")
        bad = materialize(taken.unionByName(later).distinct(), "collisions")
        if bad.isEmpty():
            break
        again = draw(table.join(bad, ["kind", "form"], "left_semi").withColumn("attempt", F.col("attempt") + 1).drop("surrogate"))
        after = materialize(table.join(bad, ["kind", "form"], "left_anti").unionByName(again), "entities")
        discard(table, bad)
        table = after
    changed = table.filter("attempt > 0").select("kind", "form", "surrogate")
    return None if changed.isEmpty() else changed


def replace_pii(docs: DataFrame, key: str = DEMO_KEY, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity of the text replaced by its surrogate; all other columns as they are.

    ``count_col``: a further column with the number of entities.  Cases: a null text stays null and an empty one
    empty; a text without an entity stays the same, however long; repeated rows and mentions get the same surrogates;
    an empty table gives no rows; other columns may have any name but those that start with ``__``.
    """
    text = F.col(text_col)
    changed = exceptions(docs.select(text.alias("text")).filter("text is not null"), key)
    marked = docs.withColumn("__pieces", _apart(text))
    kind_form = lambda kind, form: F.concat_ws(" ", kind, form)
    override = None
    if changed is not None:
        # Only texts that hold an exception have a row in the map table, a written one: Spark broadcasts it while it is small.
        held = marked.select(F.xxhash64(text, F.length(text)).alias("__hash"), F.explode(F.filter("__pieces", lambda _, i: i % 2 == 1)).alias("e")).select("__hash", "e", entity_type(F.col("e")).alias("kind"))
        parts = F.transform(F.filter(F.split("e", " "), _is_part), _part_form)
        forms = held.filter("kind in ('email', 'name')").select("__hash", "kind", F.explode(F.when(F.col("kind") == "email", F.array(F.lower("e"))).otherwise(parts)).alias("form")).distinct()
        maps = forms.join(changed, ["kind", "form"]).groupBy("__hash").agg(F.map_from_entries(F.collect_list(F.struct(kind_form(F.col("kind"), F.col("form")), "surrogate"))).alias("__map"))
        maps = materialize(maps, "exceptions")
        marked = marked.withColumn("__hash", F.xxhash64(text, F.length(text))).join(maps, "__hash", "left")
        override = F.col("__map")

    def drawn(kind: str, form: Column) -> Column:
        first = email(form, key) if kind == "email" else name_part(form, key)
        return first if override is None else F.coalesce(F.try_element_at(override, kind_form(F.lit(kind), form)), first)

    def swapped_name(e: Column) -> Column:
        own = lambda t: _let(_part_form(t), lambda f: drawn("name", f))
        recased = lambda t: _let(F.regexp_replace(t, "[.,]$", ""), lambda old: _let(own(t), lambda fresh: _recased(old, fresh)))
        word = lambda t, i: F.when(_is_part(t, i), F.concat(recased(t), F.regexp_extract(t, "([.,]?)$", 1))).otherwise(t)
        return F.array_join(F.transform(F.split(e, " "), word), " ")

    def swapped(e: Column) -> Column:
        new = lambda k: F.when(k == "email", _let(F.lower(e), lambda f: drawn("email", f))).otherwise(_let(canonical(e, k), lambda f: number(k, f, key)))
        return _let(entity_type(e), lambda k: F.when(k == "name", swapped_name(e)).otherwise(_let(new(k), lambda f: _written(e, k, f))))

    woven = F.array_join(F.transform("__pieces", lambda p, i: F.when(i % 2 == 1, swapped(p)).otherwise(p)), "")
    out = marked.withColumn(text_col, F.when(F.size("__pieces") > 1, woven).otherwise(text))
    count = F.when(text.isNull(), 0).otherwise(F.floor(F.size("__pieces") / 2)).cast("int")
    return out.select(*[F.col(c) for c in docs.columns], *([count.alias(count_col)] if count_col else []))


def surrogate_digest(docs: DataFrame, key: str = DEMO_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_entities, text (with surrogates), text_sha256 of it."""
    out = replace_pii(doc_texts(docs, id_col, text_col), key, "text", "n_entities")
    return out.select("doc_id", F.col("n_entities").cast("long").alias("n_entities"), "text", F.sha2("text", 256).alias("text_sha256"))
