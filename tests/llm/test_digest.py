"""Fingerprints, likeness and order of documents, against plain Python."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trellis.llm import digest
from trellis.llm.common import mix64, prefix_hash, span_hash

WORDS = ["then", "erhe", "thand", "onthsh", "der", "ver", "queres", "la", "in", "of", "ünd", "él"]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", ".", "ti"]) for _ in range(n))


def entropies(raw):
    """Entropy of each window, from its byte counts."""
    return [int(digest._ENTROPY[sum(int(digest._PART[c]) for c in Counter(raw[i : i + 64]).values()) >> digest._STEP]) for i in range(len(raw) - 63)]


def hash_of(raw):
    values = np.frombuffer(raw, np.uint8)
    return int(span_hash(prefix_hash(values), np.array([0]), np.array([len(raw)]))[0])




def test_votes_and_features():
    """Features are the windows with enough votes; runs at the edges hold fewer windows."""
    ranks = digest.rank_table(Counter(e for k in range(5) for e in entropies(prose(k, 200).encode())))
    for raw in (prose(9, 150).encode(), (prose(8, 60) + "z" * 100 + prose(7, 60)).encode(), bytes(range(256)) * 3):
        rank = [int(ranks[e]) for e in entropies(raw)]
        votes = Counter()
        for i in range(-63, len(rank)):
            run = [k for k in range(i, i + 64) if 0 <= k < len(rank)]
            best = min(run, key=lambda k: (rank[k], k))
            if rank[best] < digest._LEFT_OUT:
                votes[best] += 1
        want = [hash_of(raw[k : k + 64]) for k in sorted(votes) if votes[k] >= digest.VOTES]
        of, got = digest._chosen([(0, raw, 0, len(raw))], ranks)
        # Hashes depend on the bytes alone, not on where they stand.
        assert got.tolist() == want and set(of.tolist()) <= {0}


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    score = weight = 0.0
    for x in a:
        near = 0.0
        for y in b:
            chance = len(x) * len(y) / 2048
            room = min(len(x), len(y)) - chance
            near = max(near, (len(x & y) - chance) / room if room > 0 else 0.0)
        score += len(x) * min(1.0, near)
        weight += len(x)
    return score / weight


def bits(chain):
    return [set(np.flatnonzero(np.unpackbits(row)).tolist()) for row in chain]


def test_filters_and_likeness():
    ranks = digest.rank_table({})
    texts = [b"", b"ab", prose(1, 6).encode(), prose(2, 70).encode(), prose(2, 68).encode(), prose(3, 2500).encode(), prose(3, 2400).encode(), b"q" * 700]
    chains = digest.fingerprints(texts, ranks)
    for t, chain in zip(texts, chains):
        hashes = digest._chosen([(0, t, 0, len(t))], ranks)[1].tolist() if t else []
        if 8 <= len(t) < 512:
            hashes += [hash_of(t[i : i + 8]) for i in range(len(t) - 7)]
        if t and not hashes:
            hashes = [int.from_bytes(hashlib.sha256(t).digest()[:8], "little")]
        want = []
        for first in range(0, len(hashes), 128):
            mixed = mix64(np.array(hashes[first : first + 128], dtype=np.uint64)).tolist()
            want.append({m >> 11 * p & 2047 for m in mixed for p in range(5)})
        assert bits(chain) == want
    for x in chains:
        for y in chains:
            assert math.isclose(digest.likeness(x, y), plain_likeness(bits(x), bits(y)), abs_tol=1e-9)
    assert digest.likeness(chains[3], chains[4]) > 0.8 > 0.2 > digest.likeness(chains[3], chains[5])


def test_long_texts_in_segments(monkeypatch):
    ranks = digest.rank_table(Counter(entropies(prose(4, 400).encode())))
    texts = [prose(5, 900).encode(), b"x", prose(6, 30).encode(), b"ab" * 4000]
    whole = [c.tobytes() for c in digest.fingerprints(texts, ranks)]
    for size in (65, 200, 1000):
        monkeypatch.setattr(digest, "SEGMENT", size)
        assert [c.tobytes() for c in digest.fingerprints(texts, ranks)] == whole


def test_entropy_counts(spark):
    texts = [prose(k, 40 + k) for k in range(30)] + ["", None, "short", "é" * 100]
    got = digest.entropy_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert got == dict(Counter(e for t in texts for e in entropies((t or "").encode())))


@pytest.mark.parametrize("cut", [1 << 19, 50])
def test_documents(spark, monkeypatch, cut):
    monkeypatch.setattr(digest, "_CUT", cut)
    base = prose(2, 120)
    rows = [(1, None), (2, ""), (3, "   "), (4, "a"), (5, prose(1, 900)), (6, base), (7, base), (8, prose(3, 8)), (None, prose(5, 90)), (9, "日本語テキスト 🙂" * 9), *[(10, base)] * 40, *[(11, prose(k, 30)) for k in range(6)], *[(11, "same")] * 9]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("segment", F.lit(1)).withColumn("mark", F.lit("x"))
    marks = {r["t"]: r["h"] for r in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(((-(1 << 63) if i is None else i, marks[t or ""], t or "") for i, t in rows), reverse=True)
    ranks = digest.rank_table(digest.entropy_counts(df))
    chain = lambda t: digest.fingerprints([t.encode()], ranks)[0]
    want = []
    for k, (i, _, t) in enumerate(order):
        follow = order[(k + 1) % len(order)][2]
        m = len(t) // 3
        edited = t[: len(t) - m] + follow[:m]
        text = lambda c: base64.b64encode(c.tobytes()).decode()
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(chain(t)), text(chain(edited)), round(digest.likeness(chain(t), chain(edited)), 9), round(digest.likeness(chain(t), chain(follow)), 9)))
    got = [(-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in digest.document_digests(df.repartition(3)).collect()]
    assert sorted(got) == sorted(want)
    assert digest.document_digests(df.limit(0)).count() == 0
