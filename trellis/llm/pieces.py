"""SentencePiece encoding and decoding as weighted finite-state transducers.

Four machines are compiled from a model file: the normaliser (a byte trie whose leaves rewrite the longest match, then
spaces as a visible mark), the lexicon (a trie over the pieces; a leaf puts out its piece), the fallback (characters
that no piece has, put out as bytes or as the unknown piece) and an acceptor over pairs of pieces.  An input passes the
normaliser; what comes out is composed with lexicon and fallback into a lattice, whose arcs are pieces with weights;
the shortest path in the tropical semiring (minimum, plus) from its first to its last state is the encoding.

* A unigram model weighs an arc by its piece's negative score, and all pairs by 0.
* A BPE model's encoding is not the path of best summed scores.  A segmentation is the BPE result if and only if every
  two neighbouring pieces, encoded together, give just those two pieces.  So the arcs weigh 0, and a pair weighs 0 where
  BPE keeps it apart and infinity where it would merge over the boundary.  One path of each prefix has a finite weight,
  so that one state a position is enough.  Unlike best-score paths, this gives the library's ids exactly.

Where no piece goes over a space mark, the lattice falls apart into chunks, and equal chunks have equal paths: each
worker keeps a bounded number of them.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trellis.llm.common import doc_texts, map_arrow

MARK = "▁"
CACHE_ENTRIES = 150_000
PAIR_ENTRIES = 500_000
CACHED_CHARS = 48
MAX_PIECES = 1 << 20
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2
INFINITY = float("inf")
#: Fixed value: how much below the worst piece an unknown character scores in a unigram model.
UNKNOWN_PENALTY = 10.0
#: Weight of a character in bytes in a BPE model: any path of pieces alone is shorter.
BYTES_WEIGHT = 1.0


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            n = 8 if kind == 1 else 4
            yield tag >> 3, struct.unpack("<d" if n == 8 else "<f", data[at : at + n])[0]
            at += n


def read_model(data: bytes) -> tuple[list[tuple[str, float, int]], dict[int, object], dict[int, object]]:
    """Pieces (text, score, type), trainer settings and normaliser settings of a model file."""
    pieces, trainer, normaliser = [], {}, {}
    for field, value in _fields(data):
        if field == 1:
            p = dict(_fields(value))
            pieces.append((p.get(1, b"").decode(), p.get(2, 0.0), p.get(3, _NORMAL)))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normaliser = dict(_fields(value))
    return pieces, trainer, normaliser


class Normaliser:
    """The first machine: rewrites by the longest match in a byte trie, then the model's rules on spaces.

    The trie is the double array that the model file carries; an empty one leaves all characters as they are.
    """

    def __init__(self, settings: dict[int, object]):
        data = settings.get(2, b"")
        self.prefix, self.squeeze, self.escape = bool(settings.get(3, 1)), bool(settings.get(4, 1)), bool(settings.get(5, 1))
        size = struct.unpack_from("<I", data)[0] if data else 0
        self.units = struct.unpack_from(f"<{size // 4}I", data, 4) if data else ()
        self.texts = data[4 + size :]

    @staticmethod
    def _next(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes read, bytes put out) of the longest match at ``at``."""
        units, best = self.units, None
        node = self._next(units[0])
        for k in range(at, len(raw)):
            node ^= raw[k]
            unit = units[node]
            if unit & 0x800000FF != raw[k]:
                break
            node ^= self._next(unit)
            if unit >> 8 & 1:
                best = (k + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])]

    def rewrite(self, text: str) -> list[str]:
        """The output of each match, in order; a character without a match is its own."""
        if not self.units:
            return list(text)
        raw, at, out = text.encode(), 0, []
        while at < len(raw):
            found = self.longest(raw, at)
            if found is None:
                width = 1 if raw[at] < 128 else 2 if raw[at] < 224 else 3 if raw[at] < 240 else 4
                found = width, raw[at : at + width]
            out.append(found[1].decode())
            at += found[0]
        return out

    def apply(self, text: str) -> str:
        mark = MARK if self.escape else " "
        if not self.units and not self.squeeze:
            return (mark if self.prefix and text else "") + (text.replace(" ", mark) if self.escape else text)
        out, spaced = [], self.squeeze
        for part in self.rewrite(text):
            if spaced:
                part = part.lstrip(" ")
            out.append(part)
            if part:
                spaced = self.squeeze and part.endswith(" ")
        joined = "".join(out)
        if self.squeeze:
            joined = joined.rstrip(" ")
        return (mark if self.prefix and joined else "") + joined.replace(" ", mark)


class PieceTransducer:
    """Lexicon, fallback and pair acceptor of a model, and their composition with texts."""

    def __init__(self, data: bytes):
        import regex

        pieces, trainer, normaliser = read_model(data)
        self.kind, self.in_bytes = trainer.get(3, _UNIGRAM), bool(trainer.get(35, 0))
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models are supported")
        if any(kind == _USER for _, _, kind in pieces):
            raise ValueError("user-defined pieces are not supported")
        self.normaliser = Normaliser(normaliser)
        self.text = [p[0] for p in pieces]
        self.sizes = [len(t) for t in self.text]
        self.score = {t: s for t, s, kind in pieces if kind == _NORMAL}
        self.bytes = [0] * 256
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == _UNKNOWN), 0)
        self.unknown_weight = UNKNOWN_PENALTY - min(self.score.values(), default=0.0) if self.kind == _UNIGRAM else BYTES_WEIGHT
        surface = trainer.get(44, " ⁇ ".encode())
        self.out: list[bytes] = []
        for i, (t, _, kind) in enumerate(pieces):
            if kind == _BYTE:
                self.bytes[int(t[3:5], 16)] = i
                self.out.append(bytes([int(t[3:5], 16)]))
            else:
                self.out.append(b"" if kind == _CONTROL else surface if kind == _UNKNOWN else t.replace(MARK, " ").encode())
        self.pairs: dict[int, float] = {}
        self.alone: dict[str, bytes] = {}
        # The lexicon: a state has its arcs, and the piece that it puts out (none: -1).
        self.lexicon, self.singles, self.weights = [{}, -1], set(), [0.0] * len(pieces)
        for i, (t, score, kind) in enumerate(pieces):
            # Of a BPE model only pieces that BPE itself makes of their characters can be on a path.
            if kind == _NORMAL and t and (self.kind == _UNIGRAM or self._bpe(t) == [t]):
                state = self.lexicon
                for c in t:
                    state = state[0].setdefault(c, [{}, -1])
                state[1] = i
                if len(t) == 1:
                    self.singles.add(t)
                if self.kind == _UNIGRAM:
                    self.weights[i] = -score
                else:
                    # A chunk that is such a piece has it as its path.
                    self.alone[t] = struct.pack("<i", i)
        # If no piece joins a character to a mark after it, no path crosses such a place.
        apart = not any(MARK in t.lstrip(MARK) for t in self.score)
        self.chunks = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall if apart else lambda text: [text]

        alone = self.alone

        class Cache(dict):
            def __missing__(cache, chunk: str) -> bytes:  # noqa: N805
                if (ids := alone.get(chunk)) is None:
                    plain = self.kind == _BPE and self.singles.issuperset(chunk)
                    ids = array("i", self.finite_path(chunk) if plain else self.shortest_path(chunk)).tobytes()
                if len(chunk) <= CACHED_CHARS:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[chunk] = ids
                return ids

        self.cache = Cache()

    def _bpe(self, text: str) -> list[str]:
        """Merge the best-scored neighbours (ties: the leftmost) until none is a piece."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def pair_weight(self, a: int, b: int) -> float:
        """Weight of piece b after piece a in a BPE model (-1: characters in bytes, which nothing merges with)."""
        if a < 0 or b < 0:
            return 0.0
        key = a * MAX_PIECES + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            x, y = self.text[a], self.text[b]
            known = self.pairs[key] = 0.0 if self._bpe(x + y) == [x, y] else INFINITY
        return known

    def finite_path(self, chunk: str) -> list[int]:
        """``shortest_path`` of a BPE model for a chunk without strange characters.

        All weights are 0 or infinity there, and exactly one path of each prefix is finite.  So the finite path is
        found depth first, long arcs first; a state from which no finite arc leads on is never entered again.
        """
        n, pairs, sizes, root = len(chunk), self.pairs, self.sizes, self.lexicon[0]
        path: list[int] = []
        others: list[list[int]] = []
        dead: set[int] = set()
        at, before, fresh, arcs = 0, -1, True, []
        while True:
            if fresh:
                arcs = []
                state, end = root.get(chunk[at]), at + 1
                while state is not None:
                    on, piece = state
                    if piece >= 0:
                        arcs.append(piece)
                    if end == n:
                        break
                    state = on.get(chunk[end])
                    end += 1
            fresh = False
            while arcs:
                piece = arcs.pop()
                if before >= 0:
                    apart = pairs.get(before * MAX_PIECES + piece)
                    if apart is None:
                        apart = self.pair_weight(before, piece)
                    if apart:
                        continue
                end = at + sizes[piece]
                if end in dead:
                    continue
                path.append(piece)
                if end == n:
                    return path
                others.append(arcs)
                at, before, fresh = end, piece, True
                break
            if not fresh:
                dead.add(at)
                at -= sizes[path.pop()]
                before, arcs = path[-1] if path else -1, others.pop()

    def shortest_path(self, chunk: str) -> list[int]:
        """Piece ids of the path of least weight through the lattice of ``chunk`` (ties: the first one found).

        The lattice is composed as the path is found: from each state lead the lexicon's arcs, short ones first, and
        the fallback's where no piece is that one character.
        """
        n, root, weights, by_pairs = len(chunk), self.lexicon[0], self.weights, self.kind == _BPE
        weight = [INFINITY] * (n + 1)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        weight[0] = 0.0
        for start in range(n):
            so_far, before, state, end = weight[start], last[start], root.get(chunk[start]), start + 1
            if so_far == INFINITY:
                continue
            if (state is None or state[1] < 0) and so_far + self.unknown_weight < weight[end]:
                weight[end], last[end], back[end] = so_far + self.unknown_weight, -1, start
            while state is not None:
                arcs, piece = state
                if piece >= 0:
                    total = so_far + weights[piece]
                    if total < weight[end] and by_pairs:
                        total += self.pair_weight(before, piece)
                    if total < weight[end]:
                        weight[end], last[end], back[end] = total, piece, start
                if end == n:
                    break
                state = arcs.get(chunk[end])
                end += 1
        ids: list[int] = []
        at = n
        while at:
            start = back[at]
            ids.extend([last[at]] if last[at] >= 0 else reversed(self.fallback(chunk[start:at])))
            at = start
        ids.reverse()
        return ids

    def fallback(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode()] if self.in_bytes else [self.unknown]

    def encode(self, text: str) -> bytes:
        """The piece ids of a text, as 32-bit little-endian numbers."""
        ids = b"".join(map(self.cache.__getitem__, self.chunks(self.normaliser.apply(text))))
        if self.in_bytes or not ids:
            return ids
        # A run of unknown characters is one unknown piece.
        numbers = np.frombuffer(ids, dtype="<i4")
        return numbers[np.append(True, (numbers[1:] != self.unknown) | (numbers[:-1] != self.unknown))].tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of the ids; bytes that are no UTF-8 become the replacement character."""
        numbers = np.frombuffer(ids, dtype="<i4").tolist()
        parts = list(map(self.out.__getitem__, numbers))
        # The space of the prefix goes, and with squeezed spaces that of every piece before the first character.
        for k in range(len(parts) if self.normaliser.prefix or self.normaliser.squeeze else 0):
            spaced = parts[k][:1] == b" " and numbers[k] != self.unknown
            parts[k] = parts[k][spaced:]
            if parts[k] or (spaced and not self.normaliser.squeeze):
                break
        return b"".join(parts).decode("utf-8", "replace")


_MACHINES: dict[bytes, PieceTransducer] = {}


def machine_of(data: bytes) -> PieceTransducer:
    """The compiled model, kept with its caches for the later tasks of a worker (one model at a time)."""
    key = hashlib.sha256(data).digest()
    if key not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[key] = PieceTransducer(data)
    return _MACHINES[key]


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece_ids) of each text, null: empty."""
    data = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(data.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _id_lists([machine.encode(t) for t in batch.column(1).to_pylist()])], names=["doc_id", "piece_ids"])

    return map_arrow(doc_texts(docs, id_col, text_col), run, "doc_id long, piece_ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, piece_ids)."""
    data = encoded.sparkSession.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(data.value)
        for batch in batches:
            texts = [machine.decode(np.array(ids or [], dtype="<i4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "piece_ids"), run, "doc_id long, text string")


def _id_lists(packed: list[bytes]) -> pa.ListArray:
    bounds = np.cumsum([0] + [len(p) // 4 for p in packed]).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))


def round_trip_digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_pieces, ids_sha256 (of the 32-bit little-endian ids), decoded_sha256, exact.

    ``exact``: the decoded text is the text.  Only a visible space mark in a text is not (it decodes as a space).

    Cases: a null text counts as empty, and has no ids; rows are independent, so repeated rows give repeated
    results; characters without a piece become bytes; an empty table gives no rows; other columns are not read.
    """
    data = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(data.value)
        for batch in batches:
            count, ids_hash, text_hash, exact = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = machine.encode(text)
                back = machine.decode(ids)
                count.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(back.encode()).hexdigest())
                exact.append(back == text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string()), pa.array(exact, pa.bool_())], names=["doc_id", "n_pieces", "ids_sha256", "decoded_sha256", "exact"])

    return map_arrow(doc_texts(docs, id_col, text_col), run, "doc_id long, n_pieces long, ids_sha256 string, decoded_sha256 string, exact boolean")


def with_pieces(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with all their columns, and piece_ids and decoded (the ids decoded again) beside them.

    Columns of ``docs`` that have one of these two names are replaced.  Cases as in ``round_trip_digest``.
    """
    data, at = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path)), docs.columns.index(text_col)
    schema = docs.drop("piece_ids", "decoded").schema.add("piece_ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())
    keep = [k for k, c in enumerate(docs.columns) if c not in ("piece_ids", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = PieceTransducer(data.value)  # other stages follow in these workers: nothing is kept
        for batch in batches:
            ids = [machine.encode(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], _id_lists(ids), pa.array([machine.decode(i) for i in ids], pa.string())], names=[*[batch.schema.names[k] for k in keep], "piece_ids", "decoded"])

    return map_arrow(docs, run, schema)
