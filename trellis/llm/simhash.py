"""SimHash fingerprints and near-duplicates, compared bit-sliced.

A block of fingerprints is stored as vertical bit planes: one bitset a bit position.  Row i is compared with row
i + s for all i at once: the difference planes are added up in carry-save bitwise counters, and a shift is
abandoned as soon as every pair of it has gone over the radius.

Blocks come from the pigeonhole principle: fingerprints that differ in at most two bits agree on two of four
16-bit blocks.  A bucket of one of these six keys that holds too many distinct fingerprints is cut again by
three parts of its free bits, at most two of which can differ, and once more: the last buckets have 15 free bits,
so none can exceed 32768 members, and no link is lost.  Equal fingerprints are one member throughout, and within
a block only the links of a spanning forest leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trellis.llm.common import doc_texts, map_arrow, materialize, mix64, row_chunks, separator_table, text_buffer, word_spans
from trellis.llm.components import connected_components

RADIUS = 2
SEED = 42
BUCKET = 4096
BLOCK_SHINGLES = 1 << 18
BLOCK_ROWS = 8192
LONG = 4 << 20  # bytes from which a text is shingled in pieces
_SPACE = separator_table(b" \t\n\x0b\x0c\r")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of the k-word shingles of each row in order, repeats included, and the row bounds.

    Words are lower-cased (A-Z) and joined by one space; a row with fewer words has one shingle of all of them.
    """
    low = _LOWER[buf]
    starts, ends = word_spans(low, offsets, _SPACE)
    words = np.diff(np.searchsorted(starts, offsets))
    count = np.where(words >= k, words - k + 1, (words > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    first_word = np.cumsum(words) - words
    head = np.repeat(first_word - bounds[:-1], count) + np.arange(bounds[-1])
    last = head + np.repeat(np.minimum(words, k), count) - 1
    # Where words are one space apart, the shingle stands in the text as it is.
    apart = np.zeros(len(starts) + 1, dtype=np.int64)
    if len(starts) > 1:
        apart[1 : len(starts)] = np.cumsum((starts[1:] - ends[:-1] != 1) | (low[ends[:-1]] != 32))
    apart[len(starts) :] = apart[len(starts) - 1] if len(starts) else 0
    raw, digest = low.tobytes(), xxhash.xxh64_intdigest
    hashes = np.empty(len(head), dtype=np.uint64)
    for first in range(0, len(head), BLOCK_SHINGLES):
        i, j = head[first : first + BLOCK_SHINGLES], last[first : first + BLOCK_SHINGLES]
        begin, end, plain = starts[i].tolist(), ends[j].tolist(), apart[j] == apart[i]
        if plain.all():
            hashes[first : first + len(i)] = [digest(raw[a:b], SEED) for a, b in zip(begin, end, strict=True)]
        else:
            spaced = zip(begin, end, plain.tolist(), i.tolist(), j.tolist(), strict=True)
            hashes[first : first + len(i)] = [digest(raw[a:b] if ok else b" ".join(raw[starts[w] : ends[w]] for w in range(x, y + 1)), SEED) for a, b, ok, x, y in spaced]
    return hashes, bounds


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    sums = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), BLOCK_SHINGLES):
        block = hashes[first : first + BLOCK_SHINGLES]
        sums += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sums


def majority_bits(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The fingerprint of each row: a bit is set if more than half of its hashes have it (no hash: zero)."""
    count = np.diff(bounds)
    out = np.zeros(len(count), dtype=np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        if len(hashes) <= BLOCK_SHINGLES:
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.int32)
        else:
            sums = np.array([bit_sums(hashes[bounds[r] : bounds[r + 1]]) for r in some])
        out[some] = np.packbits(2 * sums > count[some, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def long_fingerprint(buf: np.ndarray, k: int, size: int = 1 << 20) -> int:
    """The fingerprint of one long text, shingled in pieces of about ``size`` bytes that end between words."""
    spaces = np.flatnonzero(_SPACE[buf])
    sums, count, first, n = np.zeros(64, dtype=np.int64), 0, 0, len(buf)
    starts, ends = word_spans(buf, np.array([0, n]), _SPACE)
    while first < n:
        at = int(np.searchsorted(spaces, first + size))
        cut = int(spaces[at]) if at < len(spaces) else n
        # The words that begin before the cut, and the k - 1 after it that end their shingles.
        after = int(np.searchsorted(starts, cut))
        end = int(ends[min(after + k - 1, len(ends)) - 1]) if len(ends) and cut < n else n
        if len(starts) <= k or after - int(np.searchsorted(starts, first)) > 0 and len(starts) - int(np.searchsorted(starts, first)) >= k:
            hashes, _ = shingle_hashes(buf[first : max(end, cut)], np.array([0, max(end, cut) - first]), k)
            sums += bit_sums(hashes)
            count += len(hashes)
        first = cut if len(starts) > k else n
    return int(np.packbits(2 * sums > count, bitorder="little").view(np.uint64)[0]) if count else 0


def bit_planes(fingerprints: np.ndarray) -> np.ndarray:
    """(64, words): bit b of the fingerprints as a bitset over the rows, with one spare word of zeros."""
    n = len(fingerprints)
    bits = np.unpackbits(np.ascontiguousarray(fingerprints).view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    out = np.zeros((64, (n + 63) // 64 * 8 + 8), dtype=np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _packed(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 8, dtype=np.uint8)
    part = np.packbits(flags, bitorder="little")
    out[: len(part)] = part
    return out.view(np.uint64)


def _over(counters: list[np.ndarray], lost: np.ndarray, radius: int) -> np.ndarray:
    """Bitset of the pairs whose counter is over the radius."""
    above, equal = lost.copy(), ~lost
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def close_pairs(fingerprints: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group (rows of a group are neighbours) within the radius, shift by shift."""
    n = len(fingerprints)
    planes = bit_planes(fingerprints)
    words = planes.shape[1] - 1
    sizes = np.diff(np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), n))
    width = max(1, int(radius).bit_length())
    for shift in range(1, int(sizes.max(initial=0))):
        alive = group[:-shift] == group[shift:]
        dead = ~_packed(alive, words)
        skip, turn = shift >> 6, np.uint64(shift & 63)
        stay = words - skip
        counters = [np.zeros(stay, np.uint64) for _ in range(width)]
        lost = dead[:stay].copy()
        for b in range(64):
            moved = planes[b, skip : skip + stay]
            if turn:
                moved = (moved >> turn) | (planes[b, skip + 1 : skip + stay + 1] << (np.uint64(64) - turn))
            carry = planes[b, :stay] ^ moved
            for c in counters:
                carry, c[:] = c & carry, c ^ carry
            lost |= carry
            if b % 8 == 7 and (_over(counters, lost, radius) == np.uint64(0xFFFFFFFFFFFFFFFF)).all():
                break
        else:
            near = ~_over(counters, lost, radius)
            rows = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
            if len(rows):
                yield rows, rows + shift


class _Labels:
    """Union-find over the rows of a block, read as whole arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def flat(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return up
            self.root = up

    def find(self, x: int) -> int:
        while self.root[x] != x:
            x = self.root[x]
        return int(x)

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.root[max(x, y)] = min(x, y)
        return x != y


def _spanning(pairs: Iterator[tuple[np.ndarray, np.ndarray]], n: int, holds: Callable[[int, int], bool] | None = None, labels: _Labels | None = None) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs that hold; pairs of rows already connected (in ``labels``) are not looked at."""
    labels, left, right = labels or _Labels(n), [], []
    for a, b in pairs:
        root = labels.flat()
        for k in np.flatnonzero(root[a] != root[b]):
            x, y = int(a[k]), int(b[k])
            if labels.find(x) != labels.find(y) and (holds is None or holds(x, y)):
                labels.join(x, y)
                left.append(x)
                right.append(y)
    return left, right


# --- components of fingerprints within two bits ------------------------------------------------------------


def _parts(free: list[int], n: int) -> list[int]:
    """``free`` bit positions dealt into n masks of neighbouring bits."""
    return [sum(1 << b for b in chunk.tolist()) for chunk in np.array_split(np.array(free), n)]


def _levels() -> list[list[list[int]]]:
    """Masks of the three levels: first the six keys, then for each key of a level its three finer keys."""
    blocks = _parts(list(range(64)), 4)
    level = [blocks[i] | blocks[j] for i in range(4) for j in range(i)]
    found = [[level]]
    for _ in range(2):
        finer = [[mask | part for part in _parts([b for b in range(64) if not mask >> b & 1], RADIUS + 1)] for mask in level]
        found.append(finer)
        level = [m for group in finer for m in group]
    return found


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _buckets(members: DataFrame) -> DataFrame:
    """(pattern, key, fp, id) rows of buckets with two members or more and not too many."""
    levels, found, rows = _levels(), [], None
    for depth, groups in enumerate(levels):
        if depth == 0:
            keys = F.array(*[F.struct(F.lit(p).alias("pattern"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for p, m in enumerate(groups[0])])
        else:
            masks = F.array(*[F.array(*[F.lit(_signed(m)) for m in g]) for g in groups])
            finer = F.element_at(masks, F.col("pattern") + 1)
            keys = F.transform(F.sequence(F.lit(0), F.lit(RADIUS)), lambda k: F.struct((F.col("pattern") * (RADIUS + 1) + k).alias("pattern"), F.col("fp").bitwiseAND(F.element_at(finer, k + 1)).alias("key")))  # noqa: B023
        spread = (members if depth == 0 else rows).withColumn("at", F.explode(keys)).select(F.col("at.pattern").alias("pattern"), F.col("at.key").alias("key"), "fp", "id")
        counts = spread.groupBy("pattern", "key").agg(F.count("*").alias("n")).filter("n > 1")
        table = materialize(spread.join(counts, ["pattern", "key"]), "buckets")
        last = depth == len(levels) - 1
        small = table if last else table.filter(F.col("n") <= BUCKET)
        found.append(small.select((F.col("pattern") + F.lit(1000 * depth)).alias("pattern"), "key", "fp", "id"))
        if last or table.filter(F.col("n") > BUCKET).isEmpty():
            break
        rows = table.filter(F.col("n") > BUCKET).select("pattern", "fp", "id")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the sorted buckets of a partition; many small buckets are compared in one block."""
    held: list[np.ndarray] = []

    def flush(rows: np.ndarray) -> pa.RecordBatch:
        group = np.concatenate([[0], np.cumsum((rows[1:, :2] != rows[:-1, :2]).any(axis=1))]) if len(rows) else np.zeros(0, int)
        left, right = _spanning(close_pairs(rows[:, 2].view(np.uint64) if rows.flags.c_contiguous else np.ascontiguousarray(rows[:, 2]).view(np.uint64), group, RADIUS), len(rows))
        return pa.RecordBatch.from_arrays([pa.array(rows[left, 3]), pa.array(rows[right, 3])], names=["u", "v"])

    for batch in batches:
        held.append(np.stack([np.asarray(c).astype(np.int64) for c in batch.columns], axis=1))
        rows = np.concatenate(held)
        if len(rows) >= BLOCK_ROWS:
            # Up to the start of the last bucket, which may go on in the next batch.
            change = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1))
            cut = int(change[-1]) + 1 if len(change) else 0
            for a, b in _whole_buckets(rows[:cut]):
                yield flush(np.ascontiguousarray(rows[a:b]))
            rows = rows[cut:]
        held = [rows]
    if held:
        for a, b in _whole_buckets(held[0]):
            yield flush(np.ascontiguousarray(held[0][a:b]))


def _whole_buckets(rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole buckets of about BLOCK_ROWS rows; large buckets are kept from small ones."""
    if not len(rows):
        return
    edges = np.concatenate([[0], np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1, [len(rows)]]).tolist()
    first = 0
    for a, b in zip(edges, edges[1:], strict=False):
        if a > first and (b - first > BLOCK_ROWS or b - a > 64):
            yield first, a
            first = a
        if b - a > 64:
            yield a, b
            first = b
    if first < len(rows):
        yield first, len(rows)


def fingerprint_table(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the SimHash fingerprint of each text, as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            out = np.zeros(batch.num_rows, dtype=np.uint64)
            for a, b in row_chunks(offsets):
                part = buf[offsets[a] : offsets[b]]
                out[a:b] = long_fingerprint(part, shingle) if b - a == 1 and len(part) > LONG else majority_bits(*shingle_hashes(part, offsets[a : b + 1] - offsets[a], shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return map_arrow(doc_texts(docs, id_col, text_col), run, "doc_id long, fp long")


def simhash_components(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id linked with it).

    Cases: null and empty texts have fingerprint zero and link like any other; rows with one doc_id are separate
    rows of one node for each fingerprint; a null doc_id takes the component of its fingerprint, but links nothing
    (null if no document with an id has that fingerprint); an empty table gives no rows; other columns are not
    read.
    """
    table = materialize(fingerprint_table(docs, shingle, id_col, text_col), "fingerprints")
    members = table.groupBy("fp").agg(F.min("doc_id").alias("id"))
    known = members.filter("id is not null")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = _buckets(known).repartition(parts, "pattern", "key").sortWithinPartitions("pattern", "key", "id")
    links = map_arrow(dealt, _link_buckets, "u long, v long")
    # One document id may stand for several fingerprints, if ids repeat: then they are one node.
    roots = connected_components(links)
    classes = members.join(roots, members["id"] == roots["node"], "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    # Both sides are written tables, so that adaptive execution can split a fingerprint that many documents have.
    own = table.join(materialize(classes, "classes"), "fp")
    return own.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- near-duplicates by verified similarity ----------------------------------------------------------------

SHINGLE = 5
SIMILARITY = 0.8
WIDE_RADIUS = 20
BANDS, BAND_ROWS = 10, 3
TILE = 8192
FEW = 16
_ODD = [(0x9E3779B97F4A7C15 * (2 * k + 1)) & ((1 << 64) - 1) | 1 for k in range(BANDS * BAND_ROWS)]


def band_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys, each of BAND_ROWS least permuted shingle hashes; rows without shingles have zeros."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, BANDS), dtype=np.uint64)
    if len(some):
        for band in range(BANDS):
            key = np.zeros(len(some), dtype=np.uint64)
            for r in range(BAND_ROWS):
                permuted = hashes * np.uint64(_ODD[band * BAND_ROWS + r])
                permuted ^= permuted >> np.uint64(31)
                permuted *= np.uint64(0xBF58476D1CE4E5B9)
                key = mix64(key ^ np.minimum.reduceat(permuted, bounds[some]))
            out[some, band] = key
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = text_buffer(batch.column(1))
        for a, b in row_chunks(offsets):
            part, local = buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            hashes, bounds = shingle_hashes(part, local, SHINGLE)
            # The same word sequence has the same shingles in the same order.
            raw = hashes.tobytes()
            same = [xxhash.xxh3_128_digest(raw[8 * x : 8 * y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            keys = band_keys(hashes, bounds)
            flat = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel().view(np.int64)))
            # The fingerprint is of the shingle set, as the similarity is: a line that is repeated counts once.
            sets = [np.unique(hashes[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            fps = majority_bits(np.concatenate([hashes[:0], *sets]), np.cumsum([0] + [len(x) for x in sets]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(same, pa.binary()), pa.array(np.diff(bounds)), pa.array(fps.view(np.int64)), flat],
                names=["doc_id", "same", "n", "fp", "keys"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = text_buffer(batch.column(1))
        for a, b in row_chunks(offsets):
            hashes, bounds = shingle_hashes(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SHINGLE)
            sets = [np.unique(hashes[x:y]).tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(sets, pa.binary())], names=["id", "fp", "shingles"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted arrays without repeats."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def all_pairs(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for shift in range(1, n):
        yield np.arange(n - shift), np.arange(shift, n)


def similar_pairs(sets: list[np.ndarray], labels: _Labels) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of similar sets, but for those within the largest component: shared members are counted, nothing is left out."""
    root = labels.flat()
    outside = np.flatnonzero(root != np.bincount(root).argmax())
    if not len(outside):
        return
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, code, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = row[np.argsort(code, kind="stable")]
    ends, first = np.cumsum(holders), np.cumsum(size) - size
    for x in outside.tolist():
        own = code[first[x] : first[x] + size[x]]
        own = own[holders[own] > 1]
        many = holders[own]
        at = np.repeat(ends[own] - np.cumsum(many), many) + np.arange(many.sum())
        both = np.bincount(rows[at], minlength=len(sets))
        union = size[x] + size - both
        alike = both >= SIMILARITY * union
        alike[x] = False
        if alike.any():
            others = np.flatnonzero(alike)
            yield np.full(len(others), x), others


def _link_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links within each tile of the sorted partition: (band, key, ti, tj, id, fp, shingles) rows."""

    def flush(ids: list, fps: list, sets: list) -> pa.RecordBatch | None:
        order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
        node = np.array(ids, dtype=np.int64)[order]
        fp = np.array(fps, dtype=np.int64)[order].view(np.uint64)
        shingles = [np.frombuffer(sets[k], dtype=np.uint64) for k in order]

        def holds(x: int, y: int) -> bool:
            a, b = shingles[x], shingles[y]
            small, large = sorted((len(a), len(b)))
            return small >= SIMILARITY * large and jaccard(a, b) >= SIMILARITY

        labels = _Labels(len(fp))
        if len(fp) <= FEW:
            left, right = _spanning(all_pairs(len(fp)), len(fp), holds, labels)
        else:
            # Close fingerprints connect the copies at little cost; what they don't show, the sets decide.
            left, right = _spanning(close_pairs(fp, np.zeros(len(fp), np.int64), WIDE_RADIUS), len(fp), holds, labels)
            more = _spanning(similar_pairs(shingles, labels), len(fp), None, labels)
            left, right = left + more[0], right + more[1]
        return pa.RecordBatch.from_arrays([pa.array(node[left]), pa.array(node[right])], names=["u", "v"]) if left else None

    at, ids, fps, sets = None, [], [], []
    for batch in batches:
        for *key, i, fp, shingles in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != at:
                if len(ids) > 1 and (out := flush(ids, fps, sets)) is not None:
                    yield out
                at, ids, fps, sets = key, [], [], []
            ids.append(i)
            fps.append(fp)
            sets.append(shingles)
    if len(ids) > 1 and (out := flush(ids, fps, sets)) is not None:
        yield out


def _first_tiles(met: DataFrame) -> DataFrame:
    """(band, key, ti, tj, id): each member in one tile of its block, and the block's smallest in all.

    The smallest connects the tiles of a group of copies, and so do the bands, which deal one group differently.
    """
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("id", "band"), tiles).cast("int")
    at = F.when((F.col("id") == F.col("anchor")) & (tiles > 1), F.sequence(F.lit(0), tiles - 1)).otherwise(F.array(own))
    return met.select("band", "key", "id", F.explode(at).alias("ti")).select("band", "key", "ti", F.lit(-1).alias("tj"), "id")


def _second_tiles(met: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, key, ti, tj, id): tiles that hold all pairs of a block but those within its largest component.

    Pairs within one component can't change the result.  A block that is one component needs no tile; in others the
    members outside the largest (parts 0 to a - 1) meet each other and the members inside it (parts a to a + b - 1).
    A large group of copies costs its size once for each TILE members outside it, not its square.
    """
    comp = F.coalesce("root", "id").alias("comp")
    placed = materialize(met.join(roots, met["id"] == roots["node"], "left").select("band", "key", "n", "id", comp), "placed")
    sizes = placed.groupBy("band", "key", "comp").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    largest = sizes.groupBy("band", "key").agg(F.max(F.struct("c", "comp")).alias("top"), F.first("n").alias("all")).filter("top.c < all")
    largest = materialize(largest.select("band", "key", F.col("top.comp").alias("major"), F.col("top.c").alias("inside"), (F.col("all") - F.col("top.c")).alias("outside")), "majors")
    minor = F.col("comp") != F.col("major")
    a, b = F.ceil(F.col("outside") / TILE).cast("int"), F.ceil(F.col("inside") / TILE).cast("int")
    part = F.when(minor, F.pmod(F.xxhash64("id"), a)).otherwise(a + F.pmod(F.xxhash64("id"), b)).cast("int")
    others = F.when(minor, F.sequence(F.lit(0), a + b - 1)).otherwise(F.sequence(F.lit(0), a - 1))
    dealt = placed.join(largest, ["band", "key"]).select("band", "key", "id", part.alias("part"), F.explode(others).alias("other"))
    return dealt.select("band", "key", F.least("part", "other").alias("ti"), F.greatest("part", "other").alias("tj"), "id")


def _tile_links(tiled: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links (u, v) within the tiles."""
    parts = int(tiled.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = tiled.join(sets, "id").select("band", "key", "ti", "tj", "id", "fp", "shingles")
    dealt = dealt.repartition(parts, "band", "key", "ti", "tj").sortWithinPartitions("band", "key", "ti", "tj")
    return map_arrow(dealt, _link_tiles, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) of documents linked by a five-word shingle similarity of 0.8 or more.

    Equal word sequences are one class from the start.  Class representatives meet in blocks of equal min-hash
    band keys (a pair of similarity 0.8 misses all ten with a chance below 0.001); the exact shingle sets decide all
    pairs of a block.  In blocks over FEW members, fingerprints of the sets are compared bit-sliced first, and pairs
    within a wide radius are verified: that connects most copies.  The members outside the largest component then
    meet all others by counting shared shingles.  Pairs that are connected already are not verified again, so a
    group of copies costs about one verification a copy.
    A block over TILE members is dealt into tiles twice: first each member into one tile, which connects the copies,
    then only those outside the block's largest component against all (see ``_second_tiles``).
    """
    spark = docs.sparkSession
    texts = doc_texts(docs, id_col, text_col)
    table = materialize(map_arrow(texts.filter("doc_id is not null"), _describe, "doc_id long, same binary, n long, fp long, keys array<long>"), "described")
    classes = table.groupBy("same").agg(F.min(F.struct("doc_id", "n", "fp", "keys")).alias("r")).select("same", F.col("r.doc_id").alias("id"), F.col("r.n").alias("n"), F.col("r.fp").alias("fp"), F.col("r.keys").alias("keys"))
    spread = classes.filter("n > 0").select("id", "fp", F.posexplode("keys").alias("band", "key"))
    counts = spread.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("id").alias("anchor")).filter("n > 1")
    met = materialize(spread.join(counts, ["band", "key"]), "bands")
    wanted = met.select("id", "fp").distinct()
    sets = map_arrow(texts.join(wanted.hint("merge"), texts["doc_id"] == wanted["id"]).select("id", "text", "fp"), _sets, "id long, fp long, shingles binary")
    # A repeated id brings each of its texts; only the one that the class stands for has that fingerprint.
    sets = sets.dropDuplicates(["id", "fp"]) if _has_repeats(table) else sets
    hot = not met.filter(F.col("n") > TILE).isEmpty()
    if hot:
        sets = materialize(sets, "sets")
    links = _tile_links(_first_tiles(met), sets)
    if hot:
        links = materialize(links, "links")
        links = links.unionByName(_tile_links(_second_tiles(met.filter(F.col("n") > TILE), connected_components(links)), sets))
    roots = connected_components(links)
    merged = classes.join(roots, classes["id"] == roots["node"], "left").select("same", F.coalesce("root", "id").alias("component_id"))
    return table.join(materialize(merged, "classes"), "same").select("doc_id", "component_id")


def _has_repeats(table: DataFrame) -> bool:
    return not table.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").isEmpty()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that have the smallest id of their group.

    Cases: null and empty texts are one group; rows with one id are one document, and the row with the smallest
    text hash stays; rows without an id are kept; an empty table gives no rows.
    """
    groups = materialize(near_duplicates(docs, id_col, text_col), "groups")
    dropped = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("__dropped")).distinct()
    # Texts are dealt by id whatever the size of the other side: a small one is no reason for another plan.
    kept = docs.join(dropped.hint("merge"), docs[id_col].cast("long") == dropped["__dropped"], "left_anti")
    if _has_repeats(groups):
        first = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col), text_col)
        named = kept.filter(F.col(id_col).isNotNull()).withColumn("__nth", F.row_number().over(first)).filter("__nth = 1").drop("__nth")
        kept = named.unionByName(kept.filter(F.col(id_col).isNull()))
    return kept.select(*docs.columns)
