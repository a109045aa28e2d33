"""Language identification by prediction by partial matching over bytes.

For each language a variable-order context tree of its case-folded letter bytes (all else is one separator) is
counted to order 3.  A symbol unseen in a context costs an escape and is coded in the next shorter context,
with the symbols of the longer one excluded; below order 0 stands the uniform code.  After learning, the
statistics are frozen: the code length of every (context, symbol) is tabulated, in 32-bit floating point, so that
scoring a text is three table steps and one lookup a byte.  The language with the shortest code wins (ties: the smaller
name).

Learning reads a bounded sample of documents for each language (``max_docs``, a parameter), chosen by a hash of
the id.  The tables that are broadcast are bound by that sample, never by the corpus.  Languages whose tables together
would take over BLOCK_BYTES are tabulated and broadcast in several blocks, and a text is scored by one after another.

Cases: null texts and texts without a letter are ``und`` with score 0; rows are independent; without any
learned language every text is ``und``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import hash_limit, map_arrow, row_chunks, text_buffer

ORDER = 3
MAX_DOCS = 300
BLOCK_BYTES = 256 << 20


def _classes(used: np.ndarray) -> np.ndarray:
    """Byte to symbol: 0 the separator, 1 bytes that no sample has, then each used letter byte."""
    table = np.zeros(256, dtype=np.uint8)
    table[128:] = 1
    table[97:123] = 1
    table[used] = np.arange(2, 2 + len(used))
    return table


def symbols(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows, each after ORDER separators and with runs of separators made one; first and last index of each row."""
    sym = table[buf]
    size = np.diff(offsets)
    rows = len(size)
    out = np.zeros(len(sym) + ORDER * rows, dtype=np.uint8)
    target = np.arange(len(sym)) + np.repeat(ORDER * (np.arange(rows) + 1), size)
    out[target] = sym
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    heads = offsets[:-1] + ORDER * np.arange(rows)
    for k in range(ORDER):
        keep[heads + k] = True
    place = np.zeros(len(out) + 1, dtype=np.int64)
    np.cumsum(keep, out=place[1:])
    bounds = np.append(place[heads], place[-1])
    return out[keep], bounds


class ContextTrees:
    """Frozen code lengths: ``step`` walks contexts, ``cost[context, symbol]`` has the bits in each language."""

    def __init__(self, languages: list[str], table: np.ndarray, step: np.ndarray, cost: np.ndarray):
        self.languages, self.table, self.step, self.cost = languages, table, step, cost

    def bits(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each row in each language."""
        sym, bounds = symbols(buf, offsets, self.table)
        sym = np.append(sym, np.uint8(0)).astype(np.int32)
        width, flat = self.step.shape[1], self.step.ravel()
        coded = len(sym) - ORDER
        context = np.zeros(coded, dtype=np.int32)
        for k in range(ORDER):
            context = flat[context * width + sym[k : k + coded]]
        cost = self.cost.reshape(-1, len(self.languages))[context * width + sym[ORDER:]]
        # A row's first ORDER symbols are its padding, and are not coded; rows without more keep 0 bits.
        first, last = bounds[:-1], bounds[1:] - ORDER
        bits = np.add.reduceat(cost, np.stack([first, last], axis=1).ravel(), axis=0, dtype=np.float64)[::2]
        bits[first == last] = 0.0
        return bits


def learn(samples: dict[str, list[str]]) -> list[ContextTrees]:
    """Count the trees of case-folded sample texts, then tabulate their code lengths, in blocks of languages.

    A context that no language of a block has costs there what its longest known suffix costs: blocks change nothing.
    """
    languages = sorted(samples)
    if not languages:
        return []
    texts = {lang: [t.lower().encode() for t in samples[lang]] for lang in languages}
    seen = np.zeros(256, dtype=bool)
    for group in texts.values():
        for t in group:
            seen |= np.bincount(np.frombuffer(t, np.uint8), minlength=256) > 0
    letters = np.zeros(256, dtype=bool)
    letters[128:] = letters[97:123] = True
    table = _classes(np.flatnonzero(seen & letters))
    width = int(table.max()) + 1

    grams = {}
    for lang in languages:
        joined = b"".join(texts[lang])
        offsets = np.cumsum([0] + [len(t) for t in texts[lang]])
        sym, bounds = symbols(np.frombuffer(joined, np.uint8), offsets, table)
        coded = np.ones(len(sym), dtype=bool)
        for k in range(ORDER):
            coded[bounds[:-1] + k] = False
        at = np.flatnonzero(coded)
        wide = sym.astype(np.int64)
        code = np.zeros(len(at), dtype=np.int64)
        for k in range(ORDER, -1, -1):
            code = code * width + wide[at - k]
        grams[lang] = np.unique(code, return_counts=True)

    blocks: list[list[str]] = []
    for lang in languages:
        size = len(np.unique(grams[lang][0] // width)) + 1
        if not blocks or (held + size) * width * (len(blocks[-1]) + 1) * 4 > BLOCK_BYTES:  # noqa: F821
            blocks.append([])
            held = 0
        blocks[-1].append(lang)
        held += size
    return [_tabulate(block, {lang: grams[lang] for lang in block}, table, width) for block in blocks]


def _tabulate(languages: list[str], grams: dict[str, tuple[np.ndarray, np.ndarray]], table: np.ndarray, width: int) -> ContextTrees:
    # Contexts of order k are the k symbols before a coded symbol, over all languages.
    contexts = [np.zeros(1, dtype=np.int64)]
    every = np.unique(np.concatenate([grams[lang][0] for lang in languages]))
    for k in range(1, ORDER + 1):
        contexts.append(np.unique(every // width % width**k))
    base = np.cumsum([0] + [len(c) for c in contexts])

    def find(k: int, code: np.ndarray) -> np.ndarray:
        """Node of an order-k context, or of its longest suffix that is known."""
        node = np.zeros(len(code), dtype=np.int64)
        for order in range(k + 1):
            part = code % width**order
            place = np.minimum(np.searchsorted(contexts[order], part), len(contexts[order]) - 1)
            node = np.where(contexts[order][place] == part, base[order] + place, node)
        return node

    step = np.zeros((base[ORDER], width), dtype=np.int32)
    for k in range(ORDER):
        codes = (contexts[k][:, None] * width + np.arange(width)).ravel()
        step[base[k] : base[k + 1]] = find(k + 1, codes).reshape(-1, width)

    cost = np.zeros((base[-1], width, len(languages)), dtype=np.float32)
    for j, lang in enumerate(languages):
        shorter = np.full((1, width), 1.0 / width)
        for k in range(ORDER + 1):
            counts = np.zeros((len(contexts[k]), width))
            codes, times = grams[lang]
            node = np.searchsorted(contexts[k], codes // width % width**k)
            np.add.at(counts, (node, codes % width), times)
            below = shorter[find(k - 1, contexts[k] % width ** (k - 1)) - base[k - 1]] if k > 1 else np.repeat(shorter, len(contexts[k]), axis=0)
            present = counts > 0
            total, distinct = counts.sum(axis=1, keepdims=True), present.sum(axis=1, keepdims=True)
            left = 1.0 - (below * present).sum(axis=1, keepdims=True)
            done = (distinct > 0) & (left > 1e-12)
            escape = np.where(done, distinct / np.maximum(total + distinct, 1), 0.0)
            known = counts / np.where(done, total + distinct, np.maximum(total, 1))
            fresh = escape * below / np.where(done, left, 1.0)
            p = np.where(distinct == 0, below, np.where(present, known, fresh))
            p = np.maximum(p, 1e-12)
            cost[base[k] : base[k + 1], :, j] = -np.log2(p)
            shorter = p
    return ContextTrees(languages, table, step, cost)


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[ContextTrees]:
    """Learn from at most ``max_docs`` documents of each language of ``docs``."""
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one number a language
    if not sizes:
        return []
    limits = docs.sparkSession.createDataFrame([(lang, hash_limit(1.1 * max_docs / n)) for lang, n in sorted(sizes.items())], "lang string, most long")
    sample = labelled.withColumn("order", F.xxhash64("doc_id")).join(limits, "lang").filter("order <= most")
    by_lang: dict[str, list[tuple]] = {}
    for r in sample.select("lang", "order", "text").toLocalIterator():
        by_lang.setdefault(r["lang"], []).append((r["order"], r["text"]))
        # Rows with one id share its place in the order: a language keeps no more than its share at any time.
        if len(by_lang[r["lang"]]) > 4 * max_docs:
            by_lang[r["lang"]] = sorted(by_lang[r["lang"]])[:max_docs]
    return learn({lang: [t for _, t in sorted(rows)[:max_docs]] for lang, rows in by_lang.items()})


def predict(docs: DataFrame, trees: list[ContextTrees], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, lang_pred, score (the posterior of the language under equal priors)."""
    schema = "doc_id long, lang_pred string, score double"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    if not trees:
        return texts.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast((t.languages, t.table, t.step, t.cost)) for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            least, rest = np.full(batch.num_rows, np.inf), np.zeros(batch.num_rows)
            name = np.full(batch.num_rows, "und", dtype=object)
            for block in shared:
                model = ContextTrees(*block.value)
                bits = np.zeros((batch.num_rows, len(model.languages)))
                for a, b in row_chunks(offsets, 1 << 19):
                    bits[a:b] = model.bits(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                best = bits.argmin(axis=1)
                own = bits.min(axis=1)
                # The sum of 2 ** (least - bits) over the languages so far, under the least so far.
                low = np.minimum(least, own)
                rest = rest * np.exp2(-np.minimum(least - low, 1000.0)) + np.exp2(-np.minimum(bits - low[:, None], 1000.0)).sum(axis=1)
                name = np.where(own < least, np.array(model.languages, dtype=object)[best], name)
                least = low
            letter = batch.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.where(letter, name, "und").tolist(), pa.string()), pa.array(np.where(letter, 1.0 / rest, 0.0))],
                names=["doc_id", "lang_pred", "score"],
            )

    return map_arrow(texts, run, schema)
