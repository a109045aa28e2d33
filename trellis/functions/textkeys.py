"""Canonical text keys and the three word-boundary rules."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.column import Column


def strip_lower_ws(c: Column) -> Column:
    """Collapse white space, trim, lower-case."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def paren_free(c: Column) -> Column:
    """Without ``(...)`` parts, then as ``strip_lower_ws``."""
    return strip_lower_ws(F.regexp_replace(c, r"\([^)]*\)", " "))


def display_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def py_norm_text(s: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", s).split())


def py_norm_key(s: str) -> str:
    return py_norm_text(s).casefold()


def py_exact(s: str) -> str:
    """NFKC, casefold, anything but letters and digits to one space; accents stay."""
    return " ".join(re.sub(r"[\W_]+", " ", unicodedata.normalize("NFKC", s).casefold()).split())


def _without_marks(s: str) -> str:
    return "".join(c for c in s if unicodedata.category(c) != "Mn")


def py_fold_sparse(s: str) -> str:
    return _without_marks(unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", s).casefold().replace("đ", "d")))


def py_fold(s: str) -> str:
    """Casefold and drop combining marks, without compatibility normalisation."""
    return "".join(c for c in unicodedata.normalize("NFD", s.casefold()) if not unicodedata.combining(c)).replace("đ", "d")


def arrow_key(function: Callable[[str], str]) -> Callable[[Column], Column]:
    """An Arrow-batched column function of a string key (Spark has no NFKC or casefold of its own)."""

    def column(c: Column) -> Column:
        @F.pandas_udf("string")
        def apply(s: pd.Series) -> pd.Series:
            return s.map(function, na_action="ignore")

        return apply(c)

    return column


norm_text, norm_key, exact_key = arrow_key(py_norm_text), arrow_key(py_norm_key), arrow_key(py_exact)
fold_sparse, fold = arrow_key(py_fold_sparse), arrow_key(py_fold)


def letter_bounded(c: Column, term: str) -> Column:
    """The term between non-letters; digits are boundaries.  Lower-cases the column, and expects a lower-case term."""
    return F.lower(c).rlike(rf"(^|[^\p{{L}}])\Q{term}\E($|[^\p{{L}}])")


def letter_bounded_in(c: Column, term: Column) -> Column:
    """As ``letter_bounded``, for a term column."""
    return F.rlike(F.lower(c), F.concat(F.lit(r"(^|[^\p{L}])\Q"), term, F.lit(r"\E($|[^\p{L}])")))


def word_bounded(c: Column, term: str) -> Column:
    r"""Unicode ``\b``: digits and underscores belong to words."""
    return c.rlike(rf"(?U)\b\Q{term}\E\b")


def not_in_word(c: Column, term: str) -> Column:
    """No word character directly before or after; right even if the term starts or ends with another."""
    return c.rlike(rf"(?U)(?<!\w)\Q{term}\E(?!\w)")


def array_key(c: Column) -> Column:
    """A set as one sorted string; empty and null sets are ''."""
    return F.coalesce(F.array_join(F.sort_array(F.array_distinct(c)), "|"), F.lit(""))
