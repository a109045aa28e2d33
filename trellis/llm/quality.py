"""Quality classifier: a second-order factorisation machine over hashed words, structure and metadata.

score(x) = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]): the pairwise
interactions of all features in time linear in the features of the document.  Features of a text are its
lower-cased words (hashed, log counts scaled to length one), binned structure statistics of the whole text and
the binned length metadata.  Labels, language, source and id are never features.

Learning is fitted on a bounded sample of labelled rows (``max_rows``, a parameter; rows are chosen by a hash of
their id, so the sample does not depend on partitions).  Scoring reads every text whole, map-side.

Cases: a null text counts as empty and is scored by its structure features; rows are scored independently, so
repeated rows score alike; of rows with one id one is learned from; labels of 0 and 1 for one id are both used, null
labels are not; texts of any length are read whole; with no usable label
the model is the constant 0.5; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import doc_texts, hash_limit, map_arrow, prefix_hash, row_chunks, separator_table, span_hash, text_buffer, word_spans

WORD_BITS = 16
BINS = 16
STATS = 14
FEATURES = (1 << WORD_BITS) + STATS * BINS
RANK = 8
MAX_LABELLED_ROWS = 8000
_SPACE = separator_table(b" \t\n\x0b\x0c\r")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _kinds() -> np.ndarray:
    kind = np.zeros((6, 256), dtype=bool)
    kind[0, [*range(65, 91), *range(97, 123)]] = True
    kind[1, 48:58] = True
    kind[2, 65:91] = True
    kind[3] = _SPACE
    kind[4, 10] = True
    kind[5, 128:] = True
    return kind


_KINDS = _kinds()
_PUNCT = ~(_KINDS[0] | _KINDS[1] | _KINDS[3] | _KINDS[5])


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.clip((BINS * np.sqrt(part / np.maximum(whole, 1))).astype(np.int64), 0, BINS - 1)


def _scale(x: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(x, 0) + 1.0).astype(np.int64), 0, BINS - 1)


def features(buf: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids, values and row starts (CSR) of the texts; every row has at least its structure features."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    buf = np.ascontiguousarray(buf)
    starts, ends = word_spans(buf, offsets, _SPACE)
    row = np.searchsorted(offsets, starts, side="right") - 1
    hashed = span_hash(prefix_hash(_LOWER[buf]), starts, ends)
    keys, counts = np.unique((row.astype(np.int64) << WORD_BITS) | (hashed >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    key_row, key_id = keys >> WORD_BITS, keys & ((1 << WORD_BITS) - 1)
    weight = np.log1p(counts).astype(np.float32)
    norm = np.sqrt(np.bincount(key_row, weight * weight, minlength=rows)).astype(np.float32)
    value = weight / np.maximum(norm[key_row], 1e-6)

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(buf) + 1, dtype=np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    words = np.bincount(row, minlength=rows)
    distinct = np.bincount(key_row, minlength=rows)
    top = np.zeros(rows, dtype=np.int64)
    np.maximum.at(top, key_row, counts)
    letters, digits, upper, space, lines, wide = (total(k[buf]) for k in _KINDS)
    punct = total(_PUNCT[buf])
    tail_punct = np.bincount(row, _PUNCT[buf[ends - 1]] if len(ends) else None, minlength=rows)
    stats = np.stack([
        _scale(n_chars), _scale(words), _share(letters, size), _share(digits, size), _share(upper, np.maximum(letters, 1)), _share(space, size),
        _share(lines, np.maximum(words, 1)), _share(wide, size), _share(punct, size), _share(tail_punct, words), _share(distinct, words), _share(top, words),
        np.clip(size // np.maximum(words, 1), 0, BINS - 1), _share(size - n_chars, size),
    ])
    stat_ids = (1 << WORD_BITS) + np.arange(STATS)[:, None] * BINS + stats
    ids = np.concatenate([key_id, stat_ids.ravel()])
    values = np.concatenate([value, np.full(STATS * rows, 0.5, np.float32)])
    owner = np.concatenate([key_row, np.tile(np.arange(rows), STATS)])
    order = np.argsort(owner, kind="stable")
    return ids[order], values[order].astype(np.float32), np.searchsorted(owner[order], np.arange(rows))


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def __post_init__(self):
        self.squares = (self.factors**2).sum(axis=1)

    def logits(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        one = np.add.reduceat(self.linear[ids] * values, starts)
        total = np.add.reduceat(self.factors[ids] * values[:, None], starts, axis=0)
        own = np.add.reduceat(self.squares[ids] * values * values, starts)
        return self.bias + one + 0.5 * ((total * total).sum(axis=1) - own)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
    """Adagrad on the log loss over (ids, values, label) rows, on the driver: the rows are a bounded sample."""
    rng = np.random.default_rng(seed)
    linear = np.zeros(FEATURES, np.float32)
    factors = rng.normal(0, 0.02, (FEATURES, RANK)).astype(np.float32)
    labels = np.array([r[2] for r in rows], dtype=np.float32)
    if not len(rows):
        return FactorisationMachine(0.0, linear, np.zeros_like(factors))
    prior = float(np.clip(labels.mean(), 0.01, 0.99))
    model = FactorisationMachine(float(np.log(prior / (1 - prior))), linear, factors)
    g_linear, g_factors = np.full(FEATURES, 1e-3, np.float32), np.full((FEATURES, RANK), 1e-3, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 128):
            take = order[at : at + 128]
            ids = np.concatenate([rows[k][0] for k in take])
            values = np.concatenate([rows[k][1] for k in take])
            lengths = np.array([len(rows[k][0]) for k in take])
            starts = np.cumsum(lengths) - lengths
            z = model.logits(ids, values, starts)
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[take]) / len(take)).astype(np.float32)
            model.bias -= rate * float(error.sum())
            each = np.repeat(error, lengths)
            total = np.repeat(np.add.reduceat(factors[ids] * values[:, None], starts, axis=0), lengths, axis=0)
            d_linear = each * values
            d_factors = (each * values)[:, None] * (total - factors[ids] * values[:, None])
            order_ids = np.argsort(ids, kind="stable")
            touched, first = np.unique(ids[order_ids], return_index=True)
            d_linear = np.add.reduceat(d_linear[order_ids], first) + decay * linear[touched] / len(take)
            d_factors = np.add.reduceat(d_factors[order_ids], first, axis=0) + decay * factors[touched] / len(take)
            g_linear[touched] += d_linear**2
            g_factors[touched] += d_factors**2
            linear[touched] -= rate * d_linear / np.sqrt(g_linear[touched])
            factors[touched] -= rate * d_factors / np.sqrt(g_factors[touched])
        model.squares = (factors**2).sum(axis=1)
    return model


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED_ROWS) -> FactorisationMachine:
    """Learn from at most ``max_rows`` rows of ``labels`` (doc_id, quality) whose texts are in ``docs``."""
    spark = docs.sparkSession
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    n = usable.count()
    chosen = usable.withColumn("order", F.xxhash64(F.col("doc_id")))
    if n > max_rows:
        # The hash threshold leaves a few more than max_rows ids, and only those are ordered.
        chosen = chosen.filter(F.col("order") <= F.lit(hash_limit(1.2 * max_rows / n)))
    picked = [tuple(r) for r in chosen.orderBy("order", "doc_id", "label").limit(max_rows).select("doc_id", "label").collect()]
    if not picked:
        return train([])
    ids = spark.createDataFrame(picked, "doc_id long, label int")
    # Of rows with one id, the text of the smallest hash: no more than max_rows texts come together.
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")
    texts = doc_texts(docs).join(F.broadcast(ids.distinct()), "doc_id").groupBy("doc_id", "label").agg(least).select("doc_id", "label", F.col("t.text").alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            n_chars = np.asarray(batch.column(2))
            for a, b in row_chunks(offsets):
                f_ids, values, starts = features(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n_chars[a:b])
                bounds = np.append(starts, len(f_ids)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(3).slice(a, b - a), pa.ListArray.from_arrays(bounds, pa.array(f_ids.astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(values))],
                    names=["doc_id", "label", "ids", "vals"],
                )

    table = map_arrow(texts.select("doc_id", "text", F.length("text").cast("long").alias("n"), "label"), featurise, "doc_id long, label int, ids array<int>, vals array<float>").toArrow()
    rows = []
    for key, label, f_ids, values in zip(table["doc_id"].to_pylist(), table["label"].to_pylist(), table["ids"], table["vals"], strict=True):
        rows.append((key, label, f_ids.values.to_numpy().astype(np.int64), values.values.to_numpy()))
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    return train([r[2:] + (r[1],) for r in rows])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_column(batch_text: pa.Array, n_chars: np.ndarray, model: FactorisationMachine) -> np.ndarray:
    buf, offsets = text_buffer(batch_text)
    out = np.zeros(len(offsets) - 1)
    for a, b in row_chunks(offsets, 1 << 19):
        part = features(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n_chars[a:b])
        out[a:b] = _sigmoid(model.logits(*part))
    return out


def score(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = FactorisationMachine(*shared.value)
        for batch in batches:
            s = score_column(batch.column(1), np.asarray(batch.column(2)), fm)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    texts = doc_texts(docs, id_col, text_col).withColumn("n", F.length("text").cast("long"))
    return map_arrow(texts, run, "doc_id long, score double, predicted int")


def keep_quality(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        fm = FactorisationMachine(*shared.value)
        for batch in batches:
            text = pc.fill_null(batch.column(at), "")
            s = score_column(text, np.asarray(pc.utf8_length(text)).astype(np.int64), fm)
            yield batch.filter(pa.array(s >= threshold))

    return map_arrow(docs, run, docs.schema)
