"""Vocabulary terms in free text: spans of longest matches, and how far negations reach.

A text is cut into words once.  A term can only stand where its first word does, so the vocabulary is looked up
by word and never scanned term by term.  All candidate spans are known before any is chosen: the longest terms
take their places first, each term one place, and no two places overlap.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.column import Column

# One-word terms that may be matched alone.
SINGLE_WORDS = ["sốt", "ho", "nôn", "mệt", "khát", "trướng", "chướng", "ngứa", "phù", "táo", "bón", "tê", "loét", "run", "nấc", "đau", "lỵ"]
# Names that only qualify another term.
QUALIFIERS = ["liên tục", "kéo dài", "thường xuyên", "lâu ngày", "từng cơn", "nhiều lần", "tái phát", "dữ dội", "âm ỉ", "đột ngột", "dai dẳng", "về đêm", "ban đêm"]
# Negation cues, what makes them emphatic, and where their reach ends.
NEGATION_CUES = ["không", "chẳng", "chả", "chưa", "ko"]
EMPHATIC = ["những", "chỉ"]
CLAUSE_WORDS = ["nhưng", "mà", "còn", "song", "tuy"]
CLAUSE_MARKS = ",.;:!?"
NEGATION_REACH = 40
EMPHATIC_REACH = 8
# What shows that a question is about a disease as a whole.
OVERVIEW_CUES = ["hội chứng", "bài thuốc", "phương thuốc", "vị thuốc", "tổng qu", "thông tin", "gồm những", "có những", "thể bệnh", "thuốc chữa", "thuốc trị", "chữa bệnh", "trị bệnh", "điều trị bệnh"]
# The two phrase sets of the question for the diseases of a syndrome.
SYNDROME_WORDS = ["hội chứng", "thể bệnh"]
DISEASE_WORDS = ["bệnh gì", "bệnh nào", "bệnh lý gì", "bệnh lý nào", "những bệnh", "các bệnh", "gồm bệnh", "có ở bệnh", "ở bệnh nào", "thuộc bệnh", "bệnh lý gồm", "bệnh lý liên quan"]

Span = tuple[int, int, str]
_WORD = re.compile(r"\w+")


def _is_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def _turns(text: str, at: int) -> bool:
    """Whether a word begins or ends between the characters before and at ``at``."""
    return _is_word(text, at - 1) != _is_word(text, at)


def _free(text: str, start: int, end: int) -> bool:
    """Whether neither neighbour of the span is a word character."""
    return not _is_word(text, start - 1) and not _is_word(text, end)


class Vocabulary:
    """Terms by their first word.  ``bounded`` tells whether a span of a text stands by itself."""

    def __init__(self, terms: Sequence[str], bounded: Callable[[str, int, int], bool]):
        self.bounded = bounded
        self.by_word: dict[str, list[tuple[int, str, str]]] = {}
        for term in sorted(set(terms)):
            form = term.lower().strip()
            if first := _WORD.search(form):
                self.by_word.setdefault(first.group(), []).append((first.start(), form, term))

    def places(self, text: str) -> Iterator[Span]:
        """(start, end, term) of every occurrence in a lower-case text, in order of the text."""
        for word in _WORD.finditer(text):
            for lead, form, term in self.by_word.get(word.group(), ()):
                start = word.start() - lead
                end = start + len(form)
                if start >= 0 and text.startswith(form, start) and self.bounded(text, start, end):
                    yield start, end, term


def longest_first(places: Iterator[Span]) -> list[Span]:
    """Longest terms first (ties: by name), each at its first free place."""
    taken: list[tuple[int, int]] = []
    seen: set[str] = set()
    out = []
    for start, end, term in sorted(places, key=lambda p: (-len(p[2]), p[2], p[0])):
        at = bisect_left(taken, (end, 0))
        if term in seen or (at and taken[at - 1][1] > start):
            continue
        taken.insert(at, (start, end))
        seen.add(term)
        out.append((start, end, term))
    return out


class Negations:
    """Free negation cues of a text and the clause ends between them; what stands inside ``covered`` spans is neither."""

    def __init__(self, text: str, covered: list[Span], cues: Sequence[str], emphatic: Sequence[str], stops: Sequence[str]):
        hidden = bytearray(len(text))
        for start, end, _ in covered:
            hidden[start:end] = b"\x01" * (end - start)
        open_words = [m for m in _WORD.finditer(text) if not hidden[m.start()]]
        self.cues, self.stops = [], [i for i, c in enumerate(text) if c in CLAUSE_MARKS and not hidden[i]]
        for word in open_words:
            if word.group() in stops:
                self.stops.append(word.start())
            if word.group() in cues:
                # Up to a few characters on, seen as blank where another term stands.
                tail = "".join(" " if hidden[i] else text[i] for i in range(word.end(), min(word.end() + EMPHATIC_REACH, len(text))))
                if not tail.lstrip().startswith(tuple(emphatic)):
                    self.cues.append(word.start())
        self.stops.sort()

    def reach(self, start: int) -> bool:
        """Whether the nearest cue before ``start`` is near enough and in the same clause."""
        k = bisect_left(self.cues, start)
        if not k:
            return False
        cue = self.cues[k - 1]
        stop = bisect_left(self.stops, start)
        return start - cue <= NEGATION_REACH and not (stop and self.stops[stop - 1] > cue)


class TermMatcher:
    """Terms that a text states: longest matches, without qualifiers, lone words that say too little, and negated ones."""

    def __init__(self, vocabulary: Sequence[str], single_words: Sequence[str] = SINGLE_WORDS, qualifiers: Sequence[str] = QUALIFIERS, cues: Sequence[str] = NEGATION_CUES, emphatic: Sequence[str] = EMPHATIC, stops: Sequence[str] = CLAUSE_WORDS):
        alone, vague = set(single_words), set(qualifiers)
        wanted = [t for t in vocabulary if t.strip().lower() not in vague and (len(t.split()) > 1 or t.lower() in alone)]
        self.vocabulary = Vocabulary(wanted, lambda text, a, b: _turns(text, a) and _turns(text, b))
        self.rules = (set(cues), tuple(emphatic), set(stops))

    def extract(self, text: str | None) -> list[str]:
        low = (text or "").lower()
        found = longest_first(self.vocabulary.places(low))
        negations = Negations(low, found, *self.rules)
        return [term for start, _, term in found if not negations.reach(start)]

    def states(self, text: str | None, keyword: str) -> bool:
        """Whether the text has the keyword, by itself and outside of the terms that hold a cue, without a negation before it."""
        low = (text or "").lower()
        held = [s for s in longest_first(self.vocabulary.places(low)) if any(w in self.rules[0] for w in s[2].lower().split())]
        negations = Negations(low, held, *self.rules)
        own = Vocabulary([keyword], self.vocabulary.bounded)
        return any(not negations.reach(start) and not any(a <= start < b for a, b, _ in held) for start, _, _ in own.places(low))

    def column(self, c: Column) -> Column:
        @F.pandas_udf("array<string>")
        def apply(s: pd.Series) -> pd.Series:
            return s.map(self.extract)

        return apply(c)

    def states_column(self, c: Column, keyword: str) -> Column:
        @F.pandas_udf("boolean")
        def apply(s: pd.Series) -> pd.Series:
            return s.map(lambda t: self.states(t, keyword))

        return apply(c)


class NameFinder:
    """The name that a question is about: the longest of several words, or a single word where a cue asks for it."""

    def __init__(self, names: Sequence[str], cues: Sequence[str] | None = OVERVIEW_CUES):
        self.vocabulary = Vocabulary([n for n in names if len(n.strip()) > 1], _free)
        self.cues = cues

    def find(self, text: str | None) -> str | None:
        low = (text or "").lower()
        found = [term for _, _, term in longest_first(self.vocabulary.places(low))]
        several = [t for t in found if len(t.split()) > 1]
        if self.cues is not None and not several and not any(cue in low for cue in self.cues):
            return None
        return next(iter(found if self.cues is None else several or found), None)

    def column(self, c: Column) -> Column:
        @F.pandas_udf("string")
        def apply(s: pd.Series) -> pd.Series:
            return s.map(self.find)

        return apply(c)


def asks_for_diseases(c: Column, about: Sequence[str] = SYNDROME_WORDS, wants: Sequence[str] = DISEASE_WORDS) -> Column:
    """Whether a question names a syndrome and asks for its diseases: a phrase of each set."""
    low = F.lower(F.coalesce(c, F.lit("")))
    any_of = lambda phrases: F.exists(F.array(*[F.lit(p) for p in phrases]), lambda p: low.contains(p))
    return any_of(about) & any_of(wants)
