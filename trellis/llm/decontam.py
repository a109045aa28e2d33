"""Benchmark decontamination by greedy string tiling of joined seeds.

Texts are lower-cased token sequences (runs of ASCII letters, digits and non-ASCII bytes).  A seed is a run of
MIN_MATCH tokens (of an item with fewer: all of them).  Running Karp-Rabin hashes find the places of a document that
may hold a benchmark seed, by a bit table of the benchmark's hashes that is broadcast and of bounded size whatever
the benchmark's; a hit is verified by a digest of its tokens, and digests are what documents and items are joined by.

Of all matches of a document and an item the longest is marked as a tile, what overlaps it is cut to its unmarked
parts, and so on, as long as a match of MIN_MATCH tokens is left.  Tiles may come in any order, so a passage whose
parts were moved about is still covered.  A document is contaminated by an item when tiles cover THRESHOLD of the
item's tokens.

Which pairs are tiled is decided without losing any: tiles that cover c tokens hold c / MIN_MATCH seeds at least.  Each
item may therefore leave out its most frequent seeds, up to half of those less one, and the pairs that share enough of
the others are all that can reach the threshold.  A frequent trigram so doesn't bring most documents to most items.
Texts are read map-side and never shuffled; only seeds that documents and benchmark share are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trellis.llm.common import doc_texts, map_arrow, materialize, prefix_hash, row_chunks, span_hash, text_buffer, word_spans

MIN_MATCH = 3
THRESHOLD = 0.5
#: The bit table has about 16 bits a seed, between 2 ** 15 and 2 ** 27 (16 MB): a full one lets more through, and loses nothing.
TABLE_BITS = (15, 27)
#: Seed places of a document and an item that are paired at a time.
PAIRS = 1 << 20
_SEPARATE = np.ones(256, dtype=bool)
_SEPARATE[128:] = _SEPARATE[48:58] = _SEPARATE[65:91] = _SEPARATE[97:123] = False
_LOWEST = -(1 << 63)


def seed_places(buf: np.ndarray, offsets: np.ndarray, width: int | None) -> tuple[np.ndarray, ...]:
    """Rolling hashes of all runs of ``width`` tokens within a row, their row, first token, and bytes [start, end).

    ``width`` None: MIN_MATCH tokens, or the whole row where it has fewer.
    """
    starts, ends = word_spans(buf, offsets, _SEPARATE)
    rows = np.searchsorted(starts, offsets)
    count = np.diff(rows)
    size = np.minimum(count, MIN_MATCH) if width is None else np.full(len(count), width)
    runs = np.where(size > 0, np.maximum(count - size + 1, 0), 0)
    row = np.repeat(np.arange(len(count)), runs)
    place = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    first = rows[:-1][row] + place
    last = first + size[row]
    tokens = span_hash(prefix_hash(buf), starts, ends)
    return span_hash(prefix_hash(tokens), first, last), row, place, starts[first], ends[last - 1], count


def _digest(raw: bytes) -> bytes:
    """128 bits of the tokens of a piece of text, whatever stands between them."""
    table = bytes(32 if s else b for b, s in enumerate(_SEPARATE.tolist()))
    return xxhash.xxh3_128_digest(b" ".join(raw.translate(table).split()))


def _grouped(hits: np.ndarray, row: np.ndarray, place: np.ndarray, start: np.ndarray, end: np.ndarray, raw: bytes) -> dict[tuple[int, bytes], list[int]]:
    """Places of each (row, digest), in order."""
    out: dict[tuple[int, bytes], list[int]] = {}
    for k in hits.tolist():
        out.setdefault((int(row[k]), _digest(raw[start[k] : end[k]])), []).append(int(place[k]))
    return out


def _lower(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_buffer(pc.utf8_lower(pc.fill_null(texts, "")))


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, item_mark, n, seed, hash, places) of each seed of each item."""
    for batch in batches:
        buf, offsets = _lower(batch.column(1))
        for a, b in row_chunks(offsets):
            part = np.ascontiguousarray(buf[offsets[a] : offsets[b]])
            hashes, row, place, start, end, count = seed_places(part, offsets[a : b + 1] - offsets[a], None)
            found = _grouped(np.arange(len(hashes)), row, place, start, end, part.tobytes())
            first = {(int(r), int(p)): int(h) for h, r, p in zip(hashes.view(np.int64), row, place, strict=True)}
            rows = [a + r for r, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), batch.column(2).take(pa.array(rows, pa.int64())), pa.array([int(count[r - a]) for r in rows], pa.int32()),
                    pa.array([d for _, d in found], pa.binary()), pa.array([first[r, at[0]] for (r, _), at in found.items()], pa.int64()), pa.array(list(found.values()), pa.list_(pa.int32())),
                ],
                names=["item_id", "item_mark", "n", "seed", "hash", "places"],
            )


def _bit_table(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """The bits that the hashes set, and how many leading bits of a hash tell its place."""
    n = seeds.count()
    bits = min(max(int(16 * n + 1).bit_length(), TABLE_BITS[0]), TABLE_BITS[1])
    at = F.shiftrightunsigned("hash", 64 - bits) + 1
    rows = seeds.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in rows:  # at most 4,096 rows of 4 KB
        table[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return table, bits


def _doc_seeds(shared, bits: int, widths: list[int]):
    """(doc_id, mark, seed, places) of the seeds of each document that the benchmark may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shift = shared.value, np.uint64(64 - bits)
        for batch in batches:
            buf, offsets = _lower(batch.column(1))
            for a, b in row_chunks(offsets):
                part = np.ascontiguousarray(buf[offsets[a] : offsets[b]])
                raw, rows, seeds, places = part.tobytes(), [], [], []
                for width in widths:
                    hashes, row, place, start, end, _ = seed_places(part, offsets[a : b + 1] - offsets[a], width)
                    at = (hashes >> shift).astype(np.int64)
                    hits = np.flatnonzero(table[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                    for (r, digest), where in _grouped(hits, row, place, start, end, raw).items():
                        rows.append(a + r)
                        seeds.append(digest)
                        places.append(where)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), pa.array(seeds, pa.binary()), pa.array(places, pa.list_(pa.int32()))], names=["doc_id", "mark", "seed", "places"])

    return run


def matches(shared: list[tuple[np.ndarray, np.ndarray]], width: int) -> list[tuple[int, int, int]]:
    """Maximal matches (tokens, item token, document token) from the places of each shared seed in item and document.

    Document tokens are taken in pieces, so that no more than about PAIRS pairs of places are held at a time.
    """
    token = np.concatenate([d for _, d in shared])
    which = np.repeat(np.arange(len(shared)), [len(d) for _, d in shared])
    order = np.argsort(token, kind="stable")
    token, which = token[order], which[order]
    times = np.array([len(i) for i, _ in shared])
    cost = np.cumsum(times[which])
    open_runs: dict[int, list[int]] = {}
    done: list[tuple[int, int, int]] = []
    first = 0
    while first < len(token):
        last = max(first + 1, int(np.searchsorted(cost, (cost[first - 1] if first else 0) + PAIRS, side="right")))
        p = np.concatenate([shared[w][0] for w in which[first:last]])
        t = np.repeat(token[first:last], times[which[first:last]])
        along = np.lexsort((p, t - p))
        p, t = p[along], t[along]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (t[1:] - p[1:] != t[:-1] - p[:-1]) | (p[1:] != p[:-1] + 1)
        heads = np.flatnonzero(new)
        for n, a, b in zip(np.diff(np.append(heads, len(p))).tolist(), p[heads].tolist(), t[heads].tolist(), strict=True):
            # A run of the piece before may go on on the same diagonal.
            held = open_runs.get(b - a)
            if held and held[1] + held[0] == a:
                held[0] += n
            else:
                if held:
                    done.append((held[0] + width - 1, held[1], held[2]))
                open_runs[b - a] = [n, a, b]
        first = last
    return done + [(n + width - 1, a, b) for n, a, b in open_runs.values()]


def tiles(found: list[tuple[int, int, int]], length: int, width: int = MIN_MATCH) -> int:
    """Tokens of the item that greedy string tiling marks, from its maximal matches."""
    heap = [(-n, a, b) for n, a, b in found]
    heapq.heapify(heap)
    in_item, in_doc, marked = bytearray(length), set(), 0
    while heap and marked < length:
        n, a, b = heapq.heappop(heap)
        run = 0
        whole = True
        for k in range(-n + 1):
            if k < -n and not in_item[a + k] and b + k not in in_doc:
                run += 1
                continue
            if k < -n:
                whole = False
            if run >= width and not whole:
                heapq.heappush(heap, (-run, a + k - run, b + k - run))
            run = 0
        if whole:
            for k in range(-n):
                in_item[a + k] = 1
                in_doc.add(b + k)
            marked -= n
    return marked


def _tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, mark, item_id, coverage) of the pairs that reach the threshold."""
    for batch in batches:
        kept, shares = [], []
        for k, (n, shared) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
            width = min(n, MIN_MATCH)
            pairs = [(np.array(s["item"], np.int64), np.array(s["doc"], np.int64)) for s in shared]
            share = tiles(matches(pairs, width), n, width) / n
            if share >= THRESHOLD:
                kept.append(k)
                shares.append(share)
        take = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in range(3)], pa.array(shares, pa.float64())], names=["doc_id", "mark", "item_id", "coverage"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, mark): the id is never null, and mark tells rows of one id apart."""
    return doc_texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(_LOWEST)).alias("doc_id"), "text", F.xxhash64("text").alias("mark"))


def _verdicts(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str) -> DataFrame:
    """(doc_id, mark, n_items, item_id, coverage) of the contaminated documents, as a written table."""
    spark = docs.sparkSession
    schema = "doc_id long, mark long, n_items long, item_id long, coverage double"
    items = _keyed(benchmark, item_col, "text").distinct()
    item_seeds = materialize(map_arrow(items, _item_seeds, "item_id long, item_mark long, n int, seed binary, hash long, places array<int>"), "item-seeds")
    widths = sorted({r["w"] for r in item_seeds.select(F.least("n", F.lit(MIN_MATCH)).alias("w")).distinct().collect()})  # MIN_MATCH values at most
    if not widths:
        return spark.createDataFrame([], schema)
    table, bits = _bit_table(item_seeds)
    found = map_arrow(_keyed(docs, id_col, text_col), _doc_seeds(spark.sparkContext.broadcast(table), bits, widths), "doc_id long, mark long, seed binary, places array<int>")
    doc_seeds = materialize(found.join(item_seeds.select("seed").distinct(), "seed", "left_semi"), "doc-seeds")
    counted = item_seeds.join(doc_seeds.groupBy("seed").agg(F.count("*").alias("df")), "seed").select("item_id", "item_mark", "n", "seed", F.size("places").alias("times"), "df")
    # Seeds that a covered item must have, those it may leave out, and how many it then has of the others.
    width = F.least("n", F.lit(MIN_MATCH))
    must = F.ceil(F.ceil(F.col("n") * THRESHOLD) / width)
    spare = F.floor((must - 1) / 2)
    running = F.sum("times").over(Window.partitionBy("item_id", "item_mark").orderBy(F.desc("df"), "seed").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rest = counted.withColumn("left_out", running).filter(F.col("left_out") > spare).withColumn("need", must - spare)
    rest = materialize(rest.select("item_id", "item_mark", "seed", "times", "need"), "rare-seeds")
    pairs = doc_seeds.select("doc_id", "mark", "seed").join(rest, "seed").groupBy("doc_id", "mark", "item_id", "item_mark").agg(F.sum("times").alias("met"), F.first("need").alias("need"))
    pairs = materialize(pairs.filter("met >= need").select("doc_id", "mark", "item_id", "item_mark"), "tile-pairs")
    own = item_seeds.select("item_id", "item_mark", "n", "seed", F.col("places").alias("item"))
    shared = pairs.join(own, ["item_id", "item_mark"]).join(doc_seeds.withColumnRenamed("places", "doc"), ["doc_id", "mark", "seed"])
    grouped = shared.groupBy("doc_id", "mark", "item_id", "item_mark", "n").agg(F.collect_list(F.struct("item", "doc")).alias("shared"))
    hits = map_arrow(grouped.select("doc_id", "mark", "item_id", "n", "shared"), _tile, "doc_id long, mark long, item_id long, coverage double")
    # Of items that cover as much, the first.
    best = F.min(F.struct((-F.col("coverage")).alias("c"), "item_id")).alias("b")
    out = hits.groupBy("doc_id", "mark").agg(F.count("*").alias("n_items"), best)
    return materialize(out.select("doc_id", "mark", "n_items", F.nullif(F.col("b.item_id"), F.lit(_LOWEST)).alias("item_id"), (-F.col("b.c")).alias("coverage")), "contaminated")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row a document: doc_id, contaminated, n_items (items found), item_id (best covered), coverage (0: none found).

    Cases: null texts count as empty and are clean; items without a token match nothing, and items of one or two match
    as a whole; items that cover a document alike: the smallest id is the best; repeated rows are judged alike, and
    repeated items count once; an empty benchmark leaves all clean; an empty table gives no rows; texts of any length
    are read whole; other columns are not read.
    """
    found = _verdicts(docs, benchmark, id_col, text_col, item_col)
    rows = _keyed(docs, id_col, text_col).select("doc_id", "mark").join(found, ["doc_id", "mark"], "left")
    count = F.coalesce("n_items", F.lit(0)).cast("long")
    return rows.select(F.nullif("doc_id", F.lit(_LOWEST)).alias("doc_id"), (count > 0).alias("contaminated"), count.alias("n_items"), "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The clean rows of ``docs``, with all their columns."""
    found = _verdicts(docs, benchmark, id_col, text_col, item_col).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    return docs.join(found, (own == F.col("__id")) & (F.xxhash64(text) == F.col("__mark")), "left_anti").select(*docs.columns)
