"""Exact token counts of a byte-level BPE tokenizer, without tokenising each occurrence.

A pre-token's length in tokens does not depend on where it stands, so a text's count is the sum over its
pre-tokens.  Lengths come from two tiers inside each map task: a broadcast table of frequent pre-tokens, and a
bounded cache in the worker for what the table misses, which outlives the task.  No pre-token is ever shuffled.

The table is measured: pre-tokens are counted in a sample of documents (``sample_rows``, a parameter; chosen by a hash
of the text) and the most frequent TABLE_ENTRIES are kept, as one block of bytes with offsets and lengths.  Its size
is so bound by a constant, never by the data, and it is a cache only: a count never depends on what it holds.

Texts are cut into pre-tokens by the pattern of this family where both regular expression engines class all characters
alike, and by the library's own pre-tokenizer where not; either way the pre-tokens pass both tiers.

Cases: a null text counts as empty (0 tokens); texts of any length are counted whole; rows are independent, so repeated
rows give repeated results; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import doc_texts, hash_limit, map_arrow

#: The pre-token pattern of this family of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points whose letter, number or space class differs between Unicode releases of the two regex engines
#: start at U+0558; the library's own pre-tokenizer cuts texts with any character outside this safe range.
SAFE = r"[\x00-՗Ḁ-⁯₠-₿　-ㆎ一-龥가-힣＀-ￜ]*+"
CACHE_ENTRIES = 200_000
CACHED_CHARS = 64
TABLE_ENTRIES = 65_536
SAMPLE_ROWS = 2_000


class PreTokenCounter:
    """Counts tokens as the library's ``encode`` does, special strings inside texts included."""

    def __init__(self, tokenizer: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(regex.escape(s) for s in specials)) if specials else None
        self.findall, self.safe = regex.compile(PATTERN).findall, regex.compile(SAFE).fullmatch
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.frequent: dict[str, int] = {}
        encode = self.tokenizer.encode

        class Cache(dict):
            def __missing__(cache, token: str) -> int:  # noqa: N805
                n = len(encode(token, add_special_tokens=False).ids)
                if len(token) <= CACHED_CHARS:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[token] = n
                return n

        self.cache = Cache()

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if text.isascii() or self.safe(text):
            return self.findall(text)
        return [text[a:b] for _, (a, b) in self.cut(text)]

    def parts(self, text: str) -> list[str]:
        """The text between special strings."""
        return self.special.split(text) if self.special is not None and self.special.search(text) else [text]

    def count(self, text: str) -> int:
        frequent, cache = self.frequent, self.cache
        parts = self.parts(text)
        total = len(parts) - 1
        for part in parts:
            for token in self.pre_tokens(part):
                n = frequent.get(token)
                total += cache[token] if n is None else n
        return total


class FrequentLengths:
    """A compact table: the pre-tokens one after another, where each begins, and their lengths in tokens."""

    def __init__(self, lengths: dict[str, int]):
        raw = [t.encode() for t in lengths]
        self.bytes = b"".join(raw)
        self.offsets = np.cumsum([0] + [len(t) for t in raw]).astype(np.int32)
        self.lengths = np.array(list(lengths.values()), dtype=np.uint16)

    def as_dict(self) -> dict[str, int]:
        bounds = self.offsets.tolist()
        return {self.bytes[a:b].decode(): n for a, b, n in zip(bounds, bounds[1:], self.lengths.tolist(), strict=False)}


_COUNTERS: dict[bytes, PreTokenCounter] = {}


def _counter(tokenizer: str) -> PreTokenCounter:
    """The counter with its cache, kept for the later tasks of a worker (one tokenizer at a time)."""
    key = hashlib.sha256(tokenizer.encode()).digest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PreTokenCounter(tokenizer)
    return _COUNTERS[key]


def frequent_lengths(docs: DataFrame, tokenizer: str, sample_rows: int = SAMPLE_ROWS, text_col: str = "text") -> FrequentLengths:
    """Lengths of the pre-tokens that are most frequent in about ``sample_rows`` documents.

    Each task adds up the pre-tokens of its own sampled documents; what leaves it is bound by the sample.
    """
    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    n = texts.count()
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    sample = texts.filter(F.xxhash64("text") <= F.lit(hash_limit(sample_rows / max(n, 1))))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, counts = _counter(shared.value), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in counter.parts(text):
                    counts.update(counter.pre_tokens(part))
        kept = [(t, c) for t, c in counts.most_common(TABLE_ENTRIES) if len(t) <= CACHED_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in kept], pa.string()), pa.array([c for _, c in kept], pa.int64())], names=["token", "n"])

    counts: Counter = Counter()
    for row in map_arrow(sample, add_up, "token string, n long").toLocalIterator():
        counts[row["token"]] += row["n"]
    own = PreTokenCounter(tokenizer)
    best = sorted(counts, key=lambda t: (-counts[t], t))[:TABLE_ENTRIES]
    return FrequentLengths({t: own.cache[t] for t in best})


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``tokenizer_path`` is a file of the ``tokenizers`` library that the driver reads; its content is broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    context = docs.sparkSession.sparkContext
    table, shared = context.broadcast(frequent_lengths(docs, tokenizer, sample_rows, text_col)), context.broadcast(tokenizer)
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        counter.frequent = table.value.as_dict()
        for batch in batches:
            counts = [counter.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    texts = doc_texts(docs, id_col, text_col)
    return map_arrow(texts.withColumn("n_bytes", F.octet_length("text").cast("long")), count, schema)
