"""Lexical guard of query texts: one statement that changes nothing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.column import Column

# Words that change data or schema in a graph query text.
WRITE_WORDS = frozenset("CREATE MERGE DELETE DETACH SET REMOVE DROP FOREACH CALL LOAD PERIODIC IMPORT GRANT DENY REVOKE ALTER RENAME TERMINATE".split())
# Relation names of several words, each with its spellings by other separators.
RELATIONS = ["CÓ_BIỂU_HIỆN", "CHIA_THÀNH", "ĐƯỢC_ĐIỀU_TRỊ_BẰNG", "BAO_GỒM", "CÓ_TRIỆU_CHỨNG", "TƯƠNG_ĐƯƠNG", "TƯƠNG_ỨNG_TÂY_Y", "LIÊN_QUAN_TRIỆU_CHỨNG"]
MISSPELT = {"BAO GÔM": "BAO_GỒM", "BAO_GÔM": "BAO_GỒM"}

_QUOTES = "'\"`"


def _literal_end(text: str, at: int) -> int:
    """Where the comment, string or quoted name that begins at ``at`` ends; ``at`` if none does.

    One that is never closed hides nothing: what follows is read as code.
    """
    if text.startswith("//", at):
        end = text.find("\n", at)
        return len(text) if end < 0 else end
    if text.startswith("/*", at):
        end = text.find("*/", at + 2)
        return at if end < 0 else end + 2
    mark = text[at]
    if mark not in _QUOTES:
        return at
    k = at + 1
    while k < len(text) and text[k] != mark:
        k += 2 if text[k] == "\\" and mark != "`" else 1
    return k + 1 if k < len(text) else at


def is_read_only(statement: str | None) -> bool:
    """Whether the text is one statement without a write word outside of comments, strings and quoted names."""
    text, at, ended, some = (statement or "").upper(), 0, False, False
    while at < len(text):
        end = _literal_end(text, at)
        if end > at:
            at, some = end, True
            continue
        c = text[at]
        if c.isascii() and (c.isalnum() or c == "_"):
            begin = at
            while at < len(text) and text[at].isascii() and (text[at].isalnum() or text[at] == "_"):
                at += 1
            if ended or text[begin:at] in WRITE_WORDS:
                return False
            some = True
            continue
        if c == ";":
            ended = True
        elif not c.isspace():
            if ended:
                return False
            some = True
        at += 1
    return some


def read_only(c: Column) -> Column:
    @F.pandas_udf("boolean")
    def apply(s: pd.Series) -> pd.Series:
        return s.map(is_read_only)

    return apply(c)


def repaired_names(c: Column) -> Column:
    """Relation names written with spaces instead of underscores, or misspelt, as the schema has them."""
    for wrong, right in MISSPELT.items():
        c = F.replace(c, F.lit(wrong), F.lit(right))
    for name in RELATIONS:
        c = F.regexp_replace(c, name.replace("_", "[ _]"), name)
    return c
