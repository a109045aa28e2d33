"""Improbable-feature fingerprints: rare byte windows in chained Bloom filters.

Every 64-byte window of a text has the Shannon entropy of its bytes, from 0 to 1000.  How often each entropy occurs is
counted over all windows of the corpus, and the rarer a window's entropy, the lower its rank; nearly constant windows
say nothing and are left out.  In each run of 64 neighbouring windows the leftmost of lowest rank gets a vote, and a
window with 16 votes or more is a feature.  A text under SHORT bytes has few such windows or none: all its windows of
8 bytes are features as well.  Features enter, in order, a chain of Bloom filters of 2048 bits, 128 features each, 5
bits a feature.  Two filters are compared by their common bits, scaled so that what chance alone would share is 0 and
a subset is 1; two chains by the weighted mean, over the shorter, of the best match in the longer.

A text without any feature has the hash of the whole text as its one feature; the empty text has none.  Texts that are
equal have equal fingerprints under one rank table; fingerprints of several corpora are compared under the same table,
which is a parameter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import doc_texts, map_arrow, mix64, prefix_hash, span_hash

WINDOW = 64
VOTES = 16
FILTER_BITS = 2048
PER_FILTER = 128
PROBES = 5
SHORT = 512
SHORT_WINDOW = 8
LEVELS = 1001
WEAK = 100  # entropies below it are left out
SEGMENT = 1 << 20
PART_BYTES = 128 << 20
_BLOCK = 1 << 16
_CUT = 1 << 19


#: The sum of c * log2(c) over the byte counts c of a window, in steps of 1/1024; GAIN[c]: from c to c + 1.
_PART = np.rint(np.array([0.0] + [c * np.log2(c) for c in range(1, WINDOW + 1)]) * 1024).astype(np.int32)
_GAIN = np.diff(_PART).astype(np.int32)
_STEP = 5
_LEFT_OUT = 1023


#: Entropy, from 0 to 1000, by that sum.
_ENTROPY = (1000 - (np.arange((int(_PART[WINDOW]) >> _STEP) + 1) << _STEP) * 1000 // int(_PART[WINDOW])).astype(np.int32)


def rank_table(counts: dict[int, int]) -> np.ndarray:
    """Rank of each entropy: its place among all, by how often it was counted (ties: the lower); weak ones are left out."""
    strong = sorted(range(WEAK, LEVELS), key=lambda e: (counts.get(e, 0), e))
    table = np.full(LEVELS, _LEFT_OUT, dtype=np.int32)
    table[strong] = np.arange(len(strong))
    return table


def _entropies(padded: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Entropy of the window that starts at each place; -1 where it doesn't lie within a text."""
    n = len(padded) - WINDOW
    ahead, behind = np.zeros(n + WINDOW, np.uint8), np.zeros(n + WINDOW, np.uint8)
    same = np.empty(_BLOCK, dtype=bool)
    for a in range(0, n, _BLOCK):
        b = min(a + _BLOCK, n)
        out, here, count = same[: b - a], padded[a:b], ahead[a:b]
        for lag in range(1, WINDOW):
            np.equal(here, padded[a + lag : b + lag], out=out)
            count += out.view(np.uint8)
            behind[a + lag : b + lag] += out.view(np.uint8)
    # A window's sum is what its bytes added less what left: differences of running sums, modulo 2**32.
    enter, leave = np.zeros(n + WINDOW + 1, np.int32), np.zeros(n + WINDOW + 1, np.int32)
    np.cumsum(_GAIN[np.minimum(behind, WINDOW - 1)], out=enter[1:])
    np.cumsum(_GAIN[np.minimum(ahead, WINDOW - 1)], out=leave[1:])
    total = enter[WINDOW : n + WINDOW] - leave[:n]
    entropy = np.full(n, -1, dtype=np.int32)
    whole = np.flatnonzero(size >= WINDOW)
    windows = size[whole] - WINDOW + 1
    at = np.arange(int(windows.sum())) + np.repeat(starts[whole] - (np.cumsum(windows) - windows), windows)
    sums = total[at] + np.repeat(leave[starts[whole]] - enter[starts[whole]], windows)
    entropy[at] = _ENTROPY[sums >> _STEP]
    return entropy


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after another, where each begins, and their sizes.

    Between them stand 64 values that no byte has, different within any 64: windows never join two texts.
    """
    size = np.array([len(t) for t in texts], dtype=np.int64)
    pad = np.arange(256, 256 + WINDOW, dtype=np.uint16)
    starts = np.cumsum(size + WINDOW) - size
    out = np.empty(int(starts[-1] + size[-1]) + 2 * WINDOW, dtype=np.uint16)
    out[:WINDOW] = pad
    for t, s in zip(texts, starts, strict=True):
        out[s : s + len(t)] = np.frombuffer(t, dtype=np.uint8)
        out[s + len(t) : s + len(t) + WINDOW] = pad
    out[-WINDOW:] = pad
    return out, starts, size


def _segments(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, int, int]]]:
    """(text, bytes, lo, hi) in groups of about SEGMENT bytes: the windows from lo to hi of those bytes are looked at.

    A long text is cut; each of its segments has what its windows' votes depend on before and behind them.
    """
    group, held = [], 0
    for k, t in enumerate(texts):
        for first in range(0, max(len(t), 1), SEGMENT):
            last = min(first + SEGMENT, len(t))
            begin, end = max(0, first - WINDOW), min(len(t), last + 2 * WINDOW)
            group.append((k, t[begin:end], first - begin, last - begin))
            held += end - begin
            if held >= SEGMENT:
                yield group
                group, held = [], 0
    if group:
        yield group


def _chosen(group: list[tuple[int, bytes, int, int]], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of the features of a group of segments, in order."""
    padded, starts, size = _padded([t for _, t, _, _ in group])
    entropy = _entropies(padded, starts, size)
    rank = np.where(entropy < 0, _LEFT_OUT, ranks[entropy])
    n = len(rank)
    bits = int(n).bit_length()
    key = (rank.astype(np.int64) << bits) | np.arange(n)
    best, width = key, 1
    while width < WINDOW:
        best = np.minimum(best[: len(best) - width], best[width:])
        width *= 2
    best = best[best < (_LEFT_OUT << bits)] & ((1 << bits) - 1)
    chosen = np.flatnonzero(np.bincount(best, minlength=n) >= VOTES)
    of = np.searchsorted(starts, chosen, side="right") - 1
    lo, hi = np.array([g[2] for g in group]), np.array([g[3] for g in group])
    inside = (chosen - starts[of] >= lo[of]) & (chosen - starts[of] < hi[of])
    chosen, of = chosen[inside], of[inside]
    return np.array([g[0] for g in group], dtype=np.int64)[of], span_hash(prefix_hash(padded), chosen, chosen + WINDOW)


def _short(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every 8-byte window of the texts under SHORT bytes."""
    short = [k for k, t in enumerate(texts) if SHORT_WINDOW <= len(t) < SHORT]
    if not short:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = np.array([len(texts[k]) for k in short])
    windows = size - SHORT_WINDOW + 1
    at = np.arange(int(windows.sum())) + np.repeat(np.cumsum(size) - size - (np.cumsum(windows) - windows), windows)
    hashes = span_hash(prefix_hash(np.frombuffer(b"".join(texts[k] for k in short), np.uint8)), at, at + SHORT_WINDOW)
    return np.repeat(np.array(short, dtype=np.int64), windows), hashes


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The chain of each text: an array of shape (filters, 256) of bytes."""
    if not texts:
        return []
    found = [_chosen(group, ranks) for group in _segments(texts)] + [_short(texts)]
    has = np.bincount(np.concatenate([f[0] for f in found]), minlength=len(texts))
    plain = [k for k, t in enumerate(texts) if t and not has[k]]
    found.append((np.array(plain, dtype=np.int64), np.array([int.from_bytes(hashlib.sha256(texts[k]).digest()[:8], "little") for k in plain], dtype=np.uint64)))
    of, hashes = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    order = np.argsort(of, kind="stable")
    of, hashes = of[order], hashes[order]
    count = np.bincount(of, minlength=len(texts))
    filters = -(-count // PER_FILTER)
    first = np.cumsum(filters) - filters
    nth = np.arange(len(of)) - (np.cumsum(count) - count)[of]
    cell = (first[of] + nth // PER_FILTER) * FILTER_BITS
    flags = np.zeros(int(filters.sum()) * FILTER_BITS, dtype=bool)
    mixed = mix64(hashes)
    for p in range(PROBES):
        flags[cell + ((mixed >> np.uint64(11 * p)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(flags).reshape(-1, FILTER_BITS // 8)
    return [packed[f : f + c] for f, c in zip(first, filters, strict=True)]


def entropy_counts(docs: DataFrame, text_col: str = "text") -> dict[int, int]:
    """How many windows of all documents have each entropy: at most LEVELS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, dtype=np.int64)
        for batch in batches:
            for group in _segments([t.encode() for t in batch.column(0).to_pylist()]):
                padded, starts, size = _padded([t for _, t, _, _ in group])
                entropy = _entropies(padded, starts, size)
                for (_, _, lo, hi), s in zip(group, starts.tolist(), strict=True):
                    own = entropy[s + lo : s + hi]
                    total += np.bincount(own[own >= 0], minlength=LEVELS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["entropy", "n"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return {r["entropy"]: r["n"] for r in map_arrow(texts, count, "entropy int, n long").groupBy("entropy").agg(F.sum("n").alias("n")).collect()}


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1; two empty chains are alike (1), an empty and another are not (0)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    wa, wb = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    nb = np.bitwise_count(wb).sum(axis=1).astype(float)
    score = weight = 0.0
    for row in wa:
        na = float(np.bitwise_count(row).sum())
        common = np.bitwise_count(row & wb).sum(axis=1)
        chance = na * nb / FILTER_BITS
        room = np.minimum(na, nb) - chance
        near = np.where(room > 0, (common - chance) / np.where(room > 0, room, 1.0), 0.0)
        score += na * min(1.0, max(0.0, float(near.max())))
        weight += na
    return score / weight


def as_string(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(rows: list[tuple[int | None, str, int]], following: str, ranks: np.ndarray) -> pa.RecordBatch:
    """``rows`` are (id, text, copies) in order; ``following`` is the text after the last.

    A copy is followed by the next copy, and the last one by the next text.
    """
    texts = [r[1] for r in rows] + [following]
    plan = [(k, after, copies) for k, (_, _, n) in enumerate(rows) for after, copies in ((k, n - 1), (k + 1, 1)) if copies]
    edited = []
    for k, after, _ in plan:
        own, cut = texts[k], len(texts[k]) // 3
        edited.append((own[: len(own) - cut] + texts[after][:cut]).encode())
    chains = fingerprints([t.encode() for t in texts], ranks)
    changed = fingerprints(edited, ranks)
    out = []
    for (k, after, copies), text, chain in zip(plan, edited, changed, strict=True):
        row = (rows[k][0], len(texts[k]), hashlib.sha256(text).hexdigest(), as_string(chains[k]), as_string(chain), likeness(chains[k], chain), likeness(chains[k], chains[after]))
        out.extend([row] * copies)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[f.split(" ")[0] for f in SCHEMA.split(", ")])


def document_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: np.ndarray | None = None) -> DataFrame:
    """Fingerprint each document, its edited text and the next document's, by descending id.

    Ids and text hashes alone are range-partitioned first, which gives segments of neighbouring rows; their number
    grows with the bytes of the texts.  Then each text is shuffled once, to its segment; the first row of a segment is
    sent to the segment before it as well, so that each task has the next document of every row of its own.  Copies of
    a row that a task has sent already go as a mere number.

    ``ranks``: a rank table; by default that of the entropies of these documents.

    Cases: a null text counts as empty; a null id counts as the lowest; rows with one id are ordered by the hash of
    the text, and each is followed by the next row; a single document follows itself; long texts are cut for the
    windows, with the same features; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    keyed = doc_texts(docs, id_col, text_col).withColumn("place", F.coalesce("doc_id", F.lit(lowest))).withColumn("mark", F.xxhash64("text"))
    size = keyed.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"]
    if size is None:
        return spark.createDataFrame([], SCHEMA)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // PART_BYTES))
    key = F.struct("place", "mark")
    ranged = keyed.select("place", "mark").repartitionByRange(parts, "place", "mark")
    bounds = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()  # one row a segment
    kind = np.dtype([("place", np.int64), ("mark", np.int64)])
    lows = np.array(sorted(tuple(r["lo"]) for r in bounds), dtype=kind)
    highs = np.array(sorted(tuple(r["hi"]) for r in bounds), dtype=kind)
    if ranks is None:
        ranks = rank_table(entropy_counts(docs, text_col))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text", "place", "mark", "segment", "tail"]
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            rows = np.empty(batch.num_rows, dtype=kind)
            rows["place"], rows["mark"] = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            segment = np.searchsorted(lows, rows, side="right") - 1
            fresh = np.array([r not in sent and not sent.add(r) for r in rows.tolist()], dtype=bool)
            texts = pc.if_else(pa.array(fresh), batch.column(1), pa.scalar(None, batch.column(1).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts, batch.column(2), batch.column(3), pa.array(segment, pa.int64()), pa.array(np.zeros(len(rows), bool))], names=names)
            head = np.flatnonzero((rows == highs[segment]) & fresh)
            if len(head):
                again = batch.take(pa.array(head))
                yield pa.RecordBatch.from_arrays([*again.columns, pa.array((segment[head] + 1) % len(lows), pa.int64()), pa.array(np.ones(len(head), bool))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last, held, segment, ended = None, 0, None, False
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 5)]
            for doc, text, place, mark, at, tail in zip(*columns, strict=True):
                if at != segment:
                    rows, last, held, segment, ended = [], None, 0, at, False
                if ended:
                    continue
                if tail:
                    ended = True
                    if rows:
                        yield _compare(rows, text, ranks)
                    continue
                if last == (place, mark):
                    rows[-1] = (doc, rows[-1][1], rows[-1][2] + 1)
                    continue
                if rows and held + len(text) > _CUT:
                    yield _compare(rows, text, ranks)
                    rows, held = [], 0
                rows.append((doc, text, 1))
                last, held = (place, mark), held + len(text)

    dealt = map_arrow(keyed, deal, "doc_id long, text string, place long, mark long, segment long, tail boolean")
    ordered = dealt.repartition(parts, "segment").sortWithinPartitions("segment", "tail", F.desc("place"), F.desc("mark"), F.desc_nulls_last("text"))
    return map_arrow(ordered, run, SCHEMA)
