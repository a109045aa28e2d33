"""Cleaners of names, cells, lists and lines, as built-in expressions but for dirty lists and JSON trees."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from trellis.functions.textkeys import exact_key, py_fold

# What a cell says that has no data.
NOTHING_LEAD = ["không có", "chưa có", "không rõ"]
NOTHING_WHAT = ["thông tin", "dữ liệu", "số liệu", "thống kê"]
NOTHING_MORE = ["thống kê", "liên quan", "tham khảo", "đáng tin cậy", "cụ thể", "chi tiết"]
PLACEHOLDER = rf"(?iU)^(hiện tại\s*,?\s*)?({'|'.join(NOTHING_LEAD)})\s*({'|'.join(NOTHING_WHAT)})?( ({'|'.join(NOTHING_MORE)}))*[.\s]*$"
# Ways of processing a herb, and words of notes that are no herbs.
PROCESSING = ["tẩm", "sao", "chế", "chích", "thán", "sinh", "nướng", "bào"]
HERB_NOTES = r"(?iU)gia\b|giảm|nếu|hoặc|liều|thêm|bớt"


def _any(c: Column, parts: Sequence[str], test=lambda c, p: c.contains(p)) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: test(c, p))


def _squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _stripped(c: Column, marks: str) -> Column:
    """Without the given characters and spaces at both ends (``marks`` is written as in a character class)."""
    return F.regexp_replace(F.regexp_replace(c, rf"^[{marks}\s]+", ""), rf"[{marks}\s]+$", "")


def is_placeholder(c: Column) -> Column:
    return (F.length(F.trim(c)) < 80) & F.trim(c).rlike(PLACEHOLDER)


def herb_list(c: Column, keep_processing: bool = False) -> Column:
    """Names of a herb cell: notes in brackets go (those on processing stay, if asked for), and what is no name."""
    if keep_processing:
        # Brackets that name a way of processing are set aside while the others go.
        c = F.regexp_replace(c, rf"(?iU)\(([^)]*\b(?:{'|'.join(PROCESSING)})\b[^)]*)\)", "‹$1›")
    c = F.regexp_replace(c, r"\([^)]*\)", " ")
    c = F.translate(c, "‹›", "()")
    items = F.transform(F.split(F.coalesce(c, F.lit("")), "[,;.]"), lambda x: _squeezed(x))
    return F.filter(items, lambda x: (x != "") & ~x.rlike(HERB_NOTES) & (F.length(x) <= 30))


# --- dirty lists ----------------------------------------------------------------------------------------------

QUOTES = "'\"「」“”‘’"
_JOINS = ("và", "hoặc")


def _outside_commas(text: str) -> list[str]:
    """Parts between commas that stand in no bracket."""
    parts, depth, start = [], 0, 0
    for at, c in enumerate(text):
        depth = depth + (c in "([{") - (c in ")]}" and depth > 0)
        if c == "," and not depth:
            parts.append(text[start:at])
            start = at + 1
    return [*parts, text[start:]]


def _bounds(text: str) -> list[tuple[int, int]]:
    """Spans that part two items: a comma beside a quote, or nothing but space and a joining word between two quotes."""
    out: list[tuple[int, int]] = []
    for k, c in enumerate(text):
        if c in ",、":
            left, right = text[:k].rstrip(), text[k + 1 :].lstrip()
            word = next((w for w in _JOINS if right.startswith(w + " ")), "")
            after = right[len(word) :].lstrip()
            if left[-1:] and left[-1] in QUOTES or after[:1] and after[0] in QUOTES:
                out.append((len(left), len(text) - len(after) if after[:1] and after[0] in QUOTES else k + 1))
        elif c in QUOTES and k + 1 < len(text):
            rest = text[k + 1 :].lstrip()
            word = next((w for w in _JOINS if rest.startswith(w)), "")
            after = rest[len(word) :].lstrip()
            if after[:1] and after[0] in QUOTES and (word or len(rest) < len(text) - k - 1):
                out.append((k + 1, len(text) - len(after)))
    return out


def _trimmed(item: str) -> str:
    """Without quotes, brackets and separators at its ends, whatever their order, and without a bracket that is alone."""
    while True:
        x = re.sub(r"[.…]{2,}\s*$", "", item.strip(" \t,;\n[]" + QUOTES))
        if x.endswith(")") and x.count(")") > x.count("(") or x.endswith("(") and x.count("(") > x.count(")"):
            x = x[:-1]
        if x == item:
            return x
        item = x


def _parsed(text: str) -> list | None:
    for read in (json.loads, ast.literal_eval):
        if read is ast.literal_eval and re.search(rf"[{QUOTES}]\s*[{QUOTES}]", text):
            return None  # neighbouring strings would be read as one
        try:
            got = read(text)
            return list(got) if isinstance(got, (list, tuple)) else [got]
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
    return None


def _cut(text: str) -> list[str]:
    parts, start = [], 0
    for a, b in _bounds(text):
        if a >= start:
            parts.append(text[start:a])
            start = b
    parts.append(text[start:])
    # Only what begins with a quote is kept from its own commas.
    return [x for p in parts if p.strip() for x in ([p] if p.strip()[0] in QUOTES else _outside_commas(p))]


def dirty_items(text: str | None, prose: bool = False, depth: int = 0) -> tuple[list[str], list[str]]:
    """(items, flags) of a list cell of any make: JSON, a written list, quoted parts, or a plain enumeration.

    ``prose``: commas alone part nothing.  Flags: ``cut`` for an odd quote or an ellipsis at the end.
    """
    v = re.sub(r"[ \t]+", " ", (text or "").replace("\r\n", "\n").replace("\r", "\n")).strip()
    quotes, flags = sum(v.count(q) for q in QUOTES), []
    items = _parsed(v) if v.startswith("[") else None
    if items is None:
        body = v[1:-1] if v.startswith("[") and v.endswith("]") else v.removeprefix("[")
        if quotes >= 2 and (v.startswith("[") or _bounds(v)):
            items = _cut(body)
            if quotes % 2 or body.rstrip().endswith("..."):
                flags.append("cut")
        elif v.startswith("["):
            items = _outside_commas(body)
        elif not prose and len(_outside_commas(v.replace("、", ","))) > 2:
            items = []
            for part in _outside_commas(v):
                # A scrap of under five characters belongs to the item before it.
                if items and len(part.strip()) < 5:
                    items[-1] = f"{items[-1].rstrip()}, {part.strip()}"
                else:
                    items.append(part)
        else:
            items = [v]
    out: list[str] = []
    for item in map(str, items):
        inner = item.strip()
        nested = inner.startswith("[") or (sum(inner.count(q) for q in QUOTES) >= 4 and re.search(rf"[{QUOTES}]\s*,\s*[{QUOTES}]", inner))
        out += dirty_items(inner, prose, depth + 1)[0] if nested and depth < 2 else [item]
    seen: dict[str, str] = {}
    for item in map(_trimmed, out):
        if (len(item) > 1 or item == "ợ") and not re.match(PLACEHOLDER.replace("(?iU)", "(?i)"), item):
            seen.setdefault(py_fold(item), item)
    return list(seen.values()), flags


def dirty_list(c: Column, prose: bool = False) -> Column:
    """struct(items, flags) of ``dirty_items``."""

    @F.pandas_udf("struct<items:array<string>,flags:array<string>>")
    def apply(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([dirty_items(t, prose) for t in s], columns=["items", "flags"])

    return apply(c)


def renamed_tree(c: Column, names: dict[str, str]) -> Column:
    """A JSON text with whole keys and whole string values renamed at any depth; parts of strings are never."""

    def walk(x):
        if isinstance(x, dict):
            return {names.get(k, k): walk(v) for k, v in x.items()}
        return [walk(v) for v in x] if isinstance(x, list) else names.get(x, x) if isinstance(x, str) else x

    @F.pandas_udf("string")
    def apply(s: pd.Series) -> pd.Series:
        return s.map(lambda t: json.dumps(walk(json.loads(t)), ensure_ascii=False, separators=(",", ":")), na_action="ignore")

    return apply(c)


# --- lines and sentences --------------------------------------------------------------------------------------

# Doses, drugs, treatment and vaccination in lines on prevention.
UNITS = ["mg", "ml", "g", "mcg", "µg", "iu"]
DOSE = rf"(?iU)\d+\s*(?:{'|'.join(UNITS)})\b|\d\s*(?:triệu|vạn|nghìn)?\s*đơn vị\b|\d\s*(?:triệu|vạn|nghìn)\s*U\b|\d\s*viên\b|\d\s*giọt\b|\d\s*lần\s*(?:/|một|mỗi)\s*ngày|ngày\s+\d+\s*lần|(?:một|hai|ba|bốn|năm|sáu)\s+lần\s+(?:/|một|mỗi)\s*ngày|liều\s+(?:lượng|dùng|khởi đầu|duy trì)|mỗi ngày\s+\d+\s*(?:lần|viên|mg|ml|giọt)"
PERCENT, TOPICAL = r"\d[\d.,]*\s*%", r"(?iU)bôi|thoa|đắp|ngâm|nhỏ (?:mắt|mũi|tai|giọt)|rửa"
DRUGS = [
    "viên nang", "viên nén", "kháng sinh", "tiêm bắp", "tiêm tĩnh mạch", "truyền tĩnh mạch", "penicillin", "erythromycin", "amoxicillin", "ampicillin", "gentamicin", "aspirin", "corticoid", "quinolone",
    "metronidazole", "azithromycin", "fluconazole", "itraconazole", "ketoconazole", "nystatin", "phenobarbital", "rifampicin", "isoniazid", "streptomycin", "chloramphenicol", "tetracycline", "doxycycline",
    "ciprofloxacin", "ofloxacin", "levofloxacin", "acyclovir", "ribavirin", "interferon", "dexamethasone", "prednisolone", "prednisone", "hydrocortisone", "thyroxine", "sulfadiazine", "trimethoprim",
    "mebendazole", "albendazole", "praziquantel", "chloroquine", "primaquine", "cyclophosphamide", "penicillamine", "naproxen", "ibuprofen", "nifedipine", "glucocorticoid", "methylprednisolone", "amphotericin", "levodopa",
]
MEDICINE = rf"(?iU)(?<!hút )(?<!bỏ )(?<!cai )thuốc(?! lá| nhuộm| trừ sâu| diệt| súng| nổ)|{'|'.join(DRUGS)}"
TREATMENT = r"(?iU)(?<!cộng )(?<!đa )hóa trị(?! ba| hai| bốn| năm)|xạ trị|phẫu thuật cắt|tiêm bắp|tiêm tĩnh mạch|truyền tĩnh mạch|liệu pháp sốc|^\s*(?:\d+[.、)-]\s*)?(?:uống|tiêm|truyền|bôi|dùng)\s+(?:thuốc|kháng sinh)"
VACCINE = r"(?iU)vắc[- ]?xin|vaccine|tiêm phòng|tiêm chủng|chủng ngừa|miễn dịch (?:dự phòng|trước)|tăng cường (?:hệ )?miễn dịch|nâng cao (?:sức )?(?:đề kháng|miễn dịch)|khả năng miễn dịch"


def prevention_lines(c: Column) -> Column:
    """struct(kept, moved): lines on prevention, and those that tell a treatment; placeholder lines go."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~is_placeholder(x))
    dosed = lambda x: x.rlike(DOSE) | (x.rlike(PERCENT) & x.rlike(TOPICAL))
    treats = lambda x: ~x.rlike(VACCINE) & (x.rlike(TREATMENT) | (dosed(x) & x.rlike(MEDICINE)))
    return F.struct(F.array_join(F.filter(lines, lambda x: ~treats(x)), "\n").alias("kept"), F.array_join(F.filter(lines, treats), "\n").alias("moved"))


# Words that end the name at the start of a description.
LEAD_ENDS = ["là", "đề cập", "còn được", "cũng được", "được gọi", "thường", "chủ yếu", "chiếm", "bao gồm", "xảy ra", "có thể", "được xem", "được coi"]


def first_sentence(c: Column) -> Column:
    """The first sentence of the first line that has any text."""
    line = _squeezed(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?U)^\s*(\S[^\n]*)", 1))
    return F.trim(F.regexp_extract(line, r"""(?U)^(.*?)(?:[.!?。！？]["'”’\])}]*(?:\s|$)|$)""", 1))


def lead(c: Column) -> Column:
    """The name that a description begins with: no numbering, up to a mark or a word that ends it."""
    text = F.regexp_replace(first_sentence(c), r"^\s*\d{1,3}[.)、]\s*", "")
    words = "|".join(w.replace(" ", r"\s+") for w in LEAD_ENDS)
    return _stripped(F.regexp_extract(text, rf"(?iU)^(.*?)(?:\s*(?:[,;:(]|\b(?:{words})\b)|$)", 1), r"\"'“”‘’.,;:\-")


def title_variants(c: Column) -> Column:
    """The title, and the title without its bracketed parts where that is another one."""
    opens = F.length(c) - F.length(F.translate(c, "([（【", ""))
    bare = F.aggregate(F.sequence(F.lit(0), opens), c, lambda s, _: F.regexp_replace(s, r"\s*(?:\([^()]*\)|\[[^\[\]]*\]|（[^（）]*）|【[^【】]*】)", " "))
    bare = _stripped(_squeezed(bare), r",;:\-")
    return F.when((bare != "") & (exact_key(bare) != exact_key(c)), F.array(c, bare)).otherwise(F.array(c))


# Titles and phrases that tell of rows that name no disease.
UI_TITLES = ["trang chủ", "việt", "name", "phong bì"]
TRADITION = ["y học cổ truyền", "đông y", "trung y", "y học trung quốc", "y học trung hoa"]
CLASSICS = [
    "nội kinh", "kim quỹ", "thương hàn luận", "ôn bệnh", "cổ kim y", "sách cổ", "y thư cổ", "chứng trị", "danh y biệt lục", "hoàng đế nội kinh", "bản thảo cương mục", "thiên kim", "ngoại khoa chính tông",
    "y tông kim giám", "cảnh nhạc toàn thư", "tố vấn", "linh khu",
]
GENERIC_TITLES = ["bệnh", "chứng", "hội chứng", "ung thư", "viêm", "nhiễm trùng", "khối u", "rối loạn", "tên bệnh"]
CERTIFICATES = ["tên giấy chứng nhận", "tên chứng nhận bệnh"]


def risks(name: Column, description: Column) -> Column:
    """struct(ui, tcm, low_info): the reasons why a row may be no disease, tell a tradition, or say too little."""
    sentence = first_sentence(description)
    name_key, sentence_key = exact_key(name), exact_key(sentence)
    padded = F.concat(F.lit(" "), name_key, F.lit(" "), sentence_key, F.lit(" "))
    hits = lambda phrases: F.array_compact(F.array(*[F.when(padded.contains(f" {p} "), p) for p in phrases]))
    ui = F.array(F.when(name_key.isin(UI_TITLES), "known_ui_title"), F.when(F.trim(name).rlike(r"(?iU)^(bản\s+mẫu|template)\s*:"), "template_title"))
    signs = F.length(F.regexp_replace(sentence, r"[^\p{L}\p{N}]", ""))
    low = F.array(
        F.when(F.trim(F.coalesce(description, F.lit(""))) == "", "description_empty").when(signs < 30, "first_sentence_under_30_alnum"),
        F.when((sentence_key != "") & (sentence_key == name_key), "first_sentence_equals_name"),
        F.when(name_key.isin(GENERIC_TITLES), "generic_title"),
        F.when((F.size(hits(CERTIFICATES)) > 0) | sentence_key.endswith("tên bệnh"), "certificate_or_name_metadata"),
    )
    return F.struct(F.array_compact(ui).alias("ui"), F.concat(hits(TRADITION), hits(CLASSICS)).alias("tcm"), F.array_compact(low).alias("low_info"))


# --- names ----------------------------------------------------------------------------------------------------

# Beginnings of names that tell a stage, and verbs that tell a treatment.
STAGES = ["giai đoạn", "thể cấp", "thể mãn", "thể mạn", "mạn tính", "cấp tính", "phòng tái phát", "kinh nghiệm", "phòng ", "biến chứng", "di chứng", "do ", "sang chấn", "thời kỳ", "đợt ", "hoá mủ", "hóa mủ"]
TREATMENT_VERBS = ["bổ ", "kiện ", "thanh ", "ôn ", "hoạt ", "khu ", "trừ ", "tư ", "sơ ", "dưỡng ", "ích ", "lợi ", "nhuận "]
DANGLING = [" do", " của", " và"]


def clean_syndrome(c: Column) -> Column:
    """The syndrome that a dirty name names, with a capital; null where only a person can tell."""
    text = F.trim(c)
    prefix = _stripped(F.substring_index(text, "(", 1), r"\-")
    inside = F.regexp_extract(text, r"\(([^()]*)\)", 1)
    stage = (F.lower(prefix) == "chung") | _any(F.lower(prefix), STAGES, lambda a, p: a.startswith(p))
    after = F.regexp_extract(text, r"^.* do (.*)$", 1)
    pick = F.when(~text.contains("("), F.when(F.concat(F.lit(" "), F.lower(text), F.lit(" ")).contains(" do "), after)).when(prefix.contains(" - "), None).when(stage & text.rlike(r"\([^()]*\)"), inside).otherwise(prefix)
    name = _stripped(_squeezed(pick), r"\-.;,")
    low = F.lower(name)
    bad = (F.length(name) < 3) | (F.length(name) > 40) | (name == text) | name.rlike("[0-9]") | F.concat(F.lit(" "), low, F.lit(" ")).rlike(" (hoặc|nếu|kèm) ")
    bad = bad | _any(low, DANGLING, lambda a, p: a.endswith(p)) | _any(low, TREATMENT_VERBS, lambda a, p: a.startswith(p))
    return F.when(~bad, F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, F.lit(2), F.length(name))))


def staging_names(df, value: str):
    """(value, clean) of each distinct trimmed value that has a clean name of its own."""
    names = df.select(F.trim(value).alias(value)).filter(F.col(value) != "").distinct()
    return names.withColumn("clean", clean_syndrome(F.col(value))).filter("clean is not null")


def _distinct_folded(c: Column) -> Column:
    """First of each item that is equal without case, in order."""
    step = lambda kept, x: F.when(F.exists(kept, lambda k: F.lower(k) == F.lower(x)), kept).otherwise(F.concat(kept, F.array(x)))
    return F.aggregate(c, F.array().cast("array<string>"), step)


def symptom_fragments(c: Column) -> Column:
    """Single findings of a sentence-like name: no notes in brackets, no conditions, 3 to 60 characters, each once."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", " "), r"\([^)]*$", " "), r"\)", " ")
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"(?U)[;.…]|\s+nhưng\s+"), lambda p: F.trim(F.regexp_replace(_stripped(_squeezed(p), r"()\[\]\"'\-–—:,"), r"(?iU)^(hoặc|và|kèm theo|kèm|rồi|thì)\s+", "")))
    condition = r"(?iU)^(nếu|khi|về sau|nặng|nhẹ|giai đoạn|trường hợp|có thể|đôi khi|có khi|lâu ngày)\b"
    return _distinct_folded(F.filter(parts, lambda p: (F.length(p) >= 3) & (F.length(p) <= 60) & ~p.rlike(condition)))


def clean_cell(c: Column) -> Column:
    """A comma list without brackets, stray marks, scraps and repeats; it never has more fields than before."""
    text = F.translate(F.regexp_replace(F.regexp_replace(c, r"\([^()]*\)", " "), r"\([^)]*$", " "), "()", "  ")
    fields = F.transform(F.split(text, ","), lambda f: _squeezed(_stripped(_squeezed(f), r".…;:\"'\-–—")))
    cleaned = F.array_join(_distinct_folded(F.filter(fields, lambda f: F.length(f) >= 2)), ", ")
    filled = lambda t: F.size(F.filter(F.split(t, ","), lambda f: F.trim(f) != ""))
    return F.when(filled(cleaned) <= filled(c), cleaned).otherwise(c)


# Endings of formula names, labels of forms.
FORMULA_END = r"(?iU)(thang|tán|hoàn|ẩm|đan|tễ|cao|phương|bổ)\s*$"
FORM_LABELS = ["thể thực", "thể hư"]


def lead_herb(c: Column) -> Column:
    """The first herb of a mangled name: behind a formula's name and colon, before marks and words of a note."""
    text = F.regexp_replace(c, r"^\s*\([^)]*\)\s*", "")
    head = F.trim(F.substring_index(text, ":", 1))
    labelled = text.contains(":") & (head.rlike(FORMULA_END) | _any(F.lower(head), FORM_LABELS))
    body = F.when(labelled, F.substring(text, F.position(F.lit(":"), text) + 1, F.length(text))).otherwise(text)
    return _stripped(F.regexp_extract(body, r"(?iU)^(.*?)(?:\s*[.;:(]|\s+(?:nếu|gia|thêm|hợp|bỏ|bớt)\b|$)", 1), ")")


def valid_herb(c: Column) -> Column:
    return (F.length(c) >= 2) & (F.length(c) <= 20) & ~c.rlike(FORMULA_END) & ~_any(F.lower(c), [*FORM_LABELS, "tham khảo", "không liệt", "dùng", "/"])


def formula_name(c: Column) -> Column:
    """A formula's name without its alternatives and notes."""
    cut = _stripped(F.regexp_extract(c, r"(?U)^(.*?)(?:\s*\(\s*hoặc\b|\.\s*\(|$)", 1), ".,;")
    return F.when(cut == "", F.trim(c)).otherwise(cut)


def garbage_herb(c: Column) -> Column:
    """Brackets that don't match, sentence marks, or words of a note."""
    count = lambda m: F.length(c) - F.length(F.replace(c, F.lit(m), F.lit("")))
    notes = ["nếu ", "hoặc dùng", "kết hợp", "gia:", "tham khảo", "thể thực", "thể hư", " thêm "]
    return F.coalesce((count("(") != count(")")) | c.rlike("[.;]") | _any(F.lower(c), notes), F.lit(False))


# Words of deficiency, cold, heat and excess in names.
DEFICIENT = r"(?U)\b(hư|suy|bất túc|nhược|khuy|tổn|thiếu)\b"
COLD, HOT = r"(?U)\b(hàn|lạnh)\b", r"(?U)\b(nhiệt|hỏa|hoả|ôn|thử|táo)\b"
EXCESS = r"(?U)\b(đàm|đờm|trọc|ẩm|hỏa|hoả|nhiệt|ứ|trệ|uất|kết|ngưng|tích|thực|độc|nghịch|phong|hàn|thấp|thử|táo)\b"
TWO_SIDED = [",", "thất kiện", "huyết táo", "thượng cang", "thấp trệ"]


def is_deficient(c: Column) -> Column:
    return F.lower(c).rlike(DEFICIENT)


def polarity_sign(c: Column) -> Column:
    """``han`` or ``nhiet`` by the words of a name; null for neither or both."""
    cold, hot = F.lower(c).rlike(COLD), F.lower(c).rlike(HOT)
    return F.when(cold & ~hot, "han").when(hot & ~cold, "nhiet")


def facet_noise(name: Column, tag: Column) -> Column:
    """Which rule, R1 to R6, a facet tag breaks by its syndrome's name; null if none.  Two-sided names break none."""
    n, t = F.lower(name), F.lower(F.trim(tag))
    hot, cold = n.rlike(r"(?U)\b(nhiệt|hỏa|hoả)\b"), n.rlike(r"(?U)\bhàn\b")
    lacking, excess = n.rlike(DEFICIENT), n.rlike(EXCESS)
    yang, yin = n.contains("dương"), n.contains("âm")
    rule = (
        F.when(lacking & ~excess & (t == "thực"), "R1").when(lacking & ~excess & (t == "nhiệt") & yang & ~yin, "R3").when(lacking & ~excess & (t == "hàn") & yin & ~yang, "R4")
        .when(excess & ~lacking & (t == "hư"), "R2").when((t == "hàn") & hot & ~cold, "R5").when((t == "nhiệt") & cold & ~hot, "R6")
    )
    return F.when(~_any(n, TWO_SIDED), rule)


def facet_tags(name: Column) -> Column:
    """Facet tags that a name tells; none if it tells no more than the inner position that is assumed."""
    n = F.lower(name)
    hot, cold, lacking = n.rlike(r"(?U)\b(nhiệt|hỏa|hoả)\b"), n.rlike(r"(?U)\bhàn\b"), n.rlike(DEFICIENT)
    yang, yin = n.rlike(r"(?U)\bdương\b") & ~n.contains("âm"), n.rlike(r"(?U)\bâm\b") & ~n.contains("dương")
    nature = F.when(cold & ~hot, "Hàn").when(hot & ~cold, "Nhiệt").when(~hot & ~cold & lacking & yang, "Hàn").when(~hot & ~cold & lacking & yin, "Nhiệt")
    place = F.when(n.rlike(r"(?U)\bbiểu\b"), "Biểu").otherwise("Lý")
    tags = F.array_compact(F.array(place, F.when(lacking, "Hư"), F.when(n.rlike(EXCESS), "Thực"), nature))
    return F.when(tags == F.array(F.lit("Lý")), F.array().cast("array<string>")).otherwise(tags)


def departments(c: Column, most: int = 2) -> Column:
    """The first distinct departments of a written list."""
    parts = F.transform(F.split(_stripped(F.coalesce(c, F.lit("")), r"\[\]"), ","), lambda p: _stripped(p, "'\""))
    return F.array_join(F.slice(_distinct_folded(F.filter(parts, lambda p: p != "")), 1, most), ", ")


def drug_names(c: Column, most: int = 6) -> Column:
    """Drug names of a JSON list: six letters or more, no junk, no traditional forms, each once."""
    items = F.transform(F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>")), lambda x: _stripped(_squeezed(x), ".,;"))
    traditional = lambda x: F.lower(x).rlike(r"(?U)(hoàn|thang|tán|cao|đan)(\s+viên)?\s*$") & ~F.lower(x).endswith("phân tán")
    fine = F.filter(items, lambda x: (F.length(x) >= 6) & ~F.lower(x).contains("tên đề tài") & ~traditional(x))
    return F.slice(_distinct_folded(fine), 1, most)


# --- derived columns ------------------------------------------------------------------------------------------


def fields(c: Column) -> Column:
    """Fields of a comma cell, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda f: F.trim(f)), lambda f: f != "")


def is_pulse_field(c: Column) -> Column:
    """A field that tells the pulse: it begins with it, and means no vessel.  Such a field can't be observed."""
    return F.lower(F.trim(c)).rlike(r"(?U)^mạch\s+(?!máu\b|lạc\b|vành\b|chủ\b)")


def is_tongue_field(c: Column) -> Column:
    return F.lower(c).contains("lưỡi") | F.lower(c).contains("rêu")


def derived_columns(cell: Column, name: Column, gates: Column, most: int = 8) -> Column:
    """struct(tongue, pulse, chief) of a symptom cell; ``gates`` has (names, names_regex, requires) by disease name."""
    low = F.lower(name)
    named = lambda g: F.exists(g["names"], lambda n: low.contains(n)) | F.exists(g["names_regex"], lambda n: F.rlike(low, F.concat(F.lit(r"(?U)\b\Q"), n, F.lit(r"\E\b"))))
    chief = F.slice(F.array_distinct(F.flatten(F.transform(F.filter(gates, named), lambda g: g["requires"]))), 1, most)
    own = fields(cell)
    return F.struct(F.array_join(F.filter(own, is_tongue_field), ", ").alias("tongue"), F.array_join(F.filter(own, is_pulse_field), ", ").alias("pulse"), F.array_join(chief, ", ").alias("chief"))
