"""Linkage operators against plain Python."""

import difflib
import random
import tracemalloc

import numpy as np

from trellis.operators import link, sequences
from trellis.plans import link_queries


def test_name_bridge(spark):
    """Exact links stay whatever the cap; substring links go both ways, and a hub loses these alone."""
    left = ["pain", "head", "ab", "abc", "headache", "longword", "backpain", "", None, "head", "deny", "a%b_c"]
    right = ["pain", "backpain", "painful", "headpain", "painless", "pains", "paint", "head", "ab", "abcd", "word", "", None, "denying", "deny", "xa%b_cx", "pain"]
    got = link.name_bridge(spark.createDataFrame([(x,) for x in left], "w string"), spark.createDataFrame([(x,) for x in right], "n string"), "w", "n", 5, deny=["deny"])
    names, want = {x for x in right if x}, []
    for w in {x for x in left if x}:
        if w in names:
            want.append((w, w, "exact"))
        subs = [n for n in names if n != w and len(n) >= 4 and len(w) >= 4 and w != "deny" and (w in n or n in w)]
        if len(subs) <= 5:
            want += [(w, n, "substring") for n in subs]
    assert sorted((r["w"], r["n"], r["method"]) for r in got.collect()) == sorted(want)
    assert ("pain", "pain", "exact") in want and not any(w == "pain" and m == "substring" for w, _, m in want)
    # A hub of exact links keeps them: seven items have the word.
    many = spark.createDataFrame([("fever",)] * 7, "n string")
    assert link.name_bridge(spark.createDataFrame([("fever",)], "w string"), many, "w", "n", 5).count() == 1


def test_documents_that_hold_an_item(spark):
    """Items of any number of words are found, also where they begin or end inside a word."""
    body = "zero one two three four five six seven eight nine ten"
    docs = [(1, body), (2, "x" + body + "y"), (3, "one  two\nthree"), (4, ""), (5, None), (6, body.replace(" ", "\n"))]
    texts = [" ".join(body.split(" ")[a : a + n]) for n in range(1, 10) for a in (0, 1, 2)] + ["ne two three four five six sev", "ro one two three four fi", "o", "", None, "one two", "absent words of some length that no document has"]
    items = list(enumerate(texts))
    got = link_queries._holding(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, body string"))
    want = {(i, d) for i, t in items for d, b in docs if t is not None and b is not None and t in b}
    rows = [(r["item_id"], r["doc_id"]) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_content_clusters(spark, monkeypatch):
    """Clusters of every pair that is equal or alike, with blocks cut into tiles and not."""
    import random

    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghijklmnop") * rng.randint(2, 6)
    rows, base = [], [[word() for _ in range(40)] for _ in range(6)]
    for k in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 2, 30])):
            words[rng.randrange(40)] = word()
        rows.append((k, "b" + str(k % 3), " ".join(words) if k % 7 else " ".join(words[:3]), [rng.choice("uvwxyz") for _ in range(rng.randint(0, 5))], k % 2))
    rows.append((99, "alone", None, None, 1))
    df = spark.createDataFrame(rows, "id long, block string, text string, items array<string>, n int")
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    one = lambda r: (r[2] or "", frozenset(r[3] or []), (str(r[4]),))
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[0] < b[0] and link._alike(one(a), one(b), 0.5, 600):
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    for tile in (256, 4):
        monkeypatch.setattr(link, "TILE", tile)
        got = {r["id"]: r["cluster"] for r in link.content_clusters(df, "block", "id", "text", "items", ["n"]).collect()}
        assert got == {k: find(k) for k in root}


def test_unlike_texts_of_a_block_take_few_matchers(monkeypatch):
    """Links of a tile are those of every pair; of unlike texts with one first sentence hardly a pair needs difflib."""
    rng = random.Random(5)
    sounds = ["th", "er", "in", "the", "an", "ou", "st", "ha", "re", "ed", "wh", "ing", "ó", "文", "😀"]
    word = lambda: "".join(rng.choice(sounds) for _ in range(rng.randint(1, 4)))
    text = lambda n: "one first sentence of all. " + " ".join(word() for _ in range(n))
    texts = [text(rng.choice([0, 5, 40, 120])) for _ in range(40)]
    for k in range(12):
        other = list(texts[k])
        for _ in range(len(other) // rng.choice([3, 5, 50])):
            other[rng.randrange(len(other))] = rng.choice("xyz ")
        texts.append("".join(other[rng.randrange(20) :]))
    # No two are equal: equal rows are one class before a tile is made.
    texts = list(dict.fromkeys(texts)) + ["", "a" * 200, "a" * 150 + "b" * 100, "ab" * 90, "ba" * 120]
    items = [frozenset(rng.sample("uvwxyz", rng.randint(0, 4))) for _ in texts]
    matcher, seen = difflib.SequenceMatcher, []
    for split in (None, 20):
        pairs = [(x, y) for x in range(split or 0, len(texts)) for y in range(x if split is None else split)]
        want, made = link._Forest(range(len(texts))), link._Forest(range(len(texts)))
        for x, y in pairs:
            if link._alike((texts[x], items[x], ()), (texts[y], items[y], ()), 0.5, 300):
                want.join(x, y)
        with monkeypatch.context() as m:
            m.setattr(difflib, "SequenceMatcher", lambda *a, **k: seen.append(1) or matcher(*a, **k))
            for u, v in link._tile_links(list(range(len(texts))), texts, items, split, 0.5, 300):
                made.join(u, v)
        assert [made.find(k) for k in made.root] == [want.find(k) for k in want.root]
    assert len(seen) < len(texts) ** 2 // 20


def test_content_clusters_of_odd_rows(spark):
    """Equal rows, repeated keys, and rows without a block or key."""
    body = " ".join(f"word{k}" for k in range(30))
    rows = [(1, "b", body), (2, "b", body), (3, "b", "short"), (4, "b", "short"), (5, "c", "short"), (6, None, "short"), (7, None, "short"), (None, "b", "short"), (4, "b", body), (None, "d", "x")]
    got = link.content_clusters(spark.createDataFrame(rows, "id long, block string, text string"), "block", "id", "text").collect()
    clusters = sorted((r["id"] or 0, r["cluster"] or 0) for r in got)
    assert clusters == [(0, 0), (0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (4, 1), (5, 5), (6, 6), (7, 7)]


LOOKED_AT = 3000  # places a pair


def _prose(rng, n: int) -> str:
    """About n characters of words that differ from text to text, as unlike texts of one language have."""
    sounds, text = ["th", "er", "in", "the", "an", "ou", "st", "ha", "re", "ed", "wh", "ing", "on", "ti", "es", "or"], ""
    while len(text) < n:
        text += "".join(rng.choice(sounds) for _ in range(rng.randint(1, 4))) + " "
    return text


def test_content_clusters_look_at_whole_texts(spark):
    """Texts that are alike only far from their beginning are linked, and those that are alike only there are not."""
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    tail, head = letters(2000), letters(700)
    texts = [letters(700) + tail, letters(700) + tail[:1000] + "-" + tail[1001:], head + letters(2400), head + letters(2400), letters(2700)]
    rows = [(k, "b", t) for k, t in enumerate(texts)]
    want = link._Forest(range(len(texts)))
    for x in range(len(texts)):
        for y in range(x):
            if link._alike((texts[x], frozenset(), ()), (texts[y], frozenset(), ()), 0.5, None):
                want.join(x, y)
    got = {r["id"]: r["cluster"] for r in link.content_clusters(spark.createDataFrame(rows, "id long, block string, text string"), "block", "id", "text").collect()}
    assert got == {k: want.find(k) for k in want.root} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


def test_ratios_of_whole_texts_equal_difflib():
    """Whole texts of all lengths, near copies, moved parts, repeats, and more characters than a byte numbers."""
    rng = random.Random(13)
    texts = [_prose(rng, n) for n in (90, 400, 700, 700, 1000)] + ["a" * 300, "ab" * 200, "", "".join(chr(0x4E00 + rng.randrange(400)) for _ in range(300))]
    for t in texts[:5]:
        other = list(t)
        for _ in range(len(t) // 3):
            other[rng.randrange(len(t))] = rng.choice("xyz 😀")
        texts += ["".join(other), t[len(t) // 3 :] + t[: len(t) // 3]]
    n = len(texts)
    got = sequences.Sequences(texts, 0.5).alike(np.arange(n), np.ones((n, n), bool))
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
    assert got.tolist() == [[ratio(a, b) >= 0.5 or ratio(b, a) >= 0.5 for b in texts] for a in texts]


def test_unlike_whole_texts_take_few_places_and_little_memory(monkeypatch):
    """Pairs of unlike texts are told apart by few of their common runs, and a tile takes memory by its characters."""
    rng = random.Random(17)
    texts = [_prose(rng, 3000) for _ in range(60)]
    ranges, seen = sequences._ranges, []
    monkeypatch.setattr(sequences, "_ranges", lambda lo, count: seen.append(int(count.sum())) or ranges(lo, count))
    assert link._tile_links(list(range(60)), texts, [frozenset()] * 60, None, 0.5, None) == []
    assert sum(seen) < LOOKED_AT * 60 * 59 / 2
    tracemalloc.start()
    link._tile_links(list(range(151)), [*texts, *[_prose(rng, 100) for _ in range(90)], "z" * 100_000], [frozenset()] * 151, None, 0.5, None)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 400e6
