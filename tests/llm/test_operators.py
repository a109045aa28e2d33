"""The pipeline operators against brute force and library results, with nulls, empty, long and repeated texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trellis.llm import components, decontam, langid, pieces, pii, quality, queries, simhash, suffixes, tokens

WORDS = ["then", "erhe", "thand", "onthsh", "der", "ver", "queres", "la", "in", "of", "ünd", "él"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", ".", "ti"]) for _ in range(n))


def fixture_rows():
    long = prose(1, 4000)
    base = prose(2, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, None), (2, ""), (3, "   "), (4, "a"), (5, long), (6, base), (7, base), (8, " ".join(near)), (9, base.upper()), (10, "a" * 3000), (11, prose(3, 300)), (12, "12 34 !!"),
        (12, "12 34 !!"), (13, prose(4, 80) + base), (14, "日本語テキスト 🙂 <|endoftext|> x"), (None, prose(5, 90)), (15, "▁x  y\n\n\tz"),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(fixture_rows(), "doc_id long, text string")
    clash = {c: F.lit("x") for c in ("fingerprint", "n_tokens", "key", "mark", "score", "place", "segment", "host", "decoded", "n", "u", "v")}
    return df.withColumns(clash).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text"))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_tokens(spark, docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.token_counts(docs, path).collect())
    count = lambda t: len(lib.encode(t or "", add_special_tokens=False).ids)
    assert got == sorted((i or 0, len((t or "").encode()), count(t), count(t) > 1024) for i, t in fixture_rows())
    assert tokens.token_counts(empty, path).count() == 0
    # No table, a table of all, and scripts outside of the safe range: the same counts.
    scripts = [(1, "नमस्ते दुनिया 123 <|endoftext|>"), (2, "مرحبا بالعالم"), (3, "שלום  עולם!"), (4, "สวัสดีชาวโลก"), (5, "ᚠᛇᚻ ᏣᎳᎩ " * 3000), (6, "x" * 1_500_000 + " नम")]
    table = spark.createDataFrame(scripts, "doc_id long, text string")
    for rows in (0, 10**6):
        assert {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(table, path, sample_rows=rows).collect()} == {i: count(t) for i, t in scripts}
    table = tokens.FrequentLengths({"a": 1, " नम": 4, "é": 70000 % 65536})
    assert table.as_dict() == {"a": 1, " नम": 4, "é": 4464}


def test_token_classes_agree():
    """The safe range holds no code point that the two regex engines class apart."""
    import regex
    from tokenizers import Tokenizer

    pre = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json")).pre_tokenizer
    find, safe = regex.compile(tokens.PATTERN).findall, regex.compile(tokens.SAFE)
    for start in range(0, 0x10000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000 and safe.fullmatch(chr(c))]
        text = " ".join(f"a{c}1{c}!{c} {c}{c}b" for c in chars)
        assert [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)] == find(text)


def test_quality(spark, docs, empty):
    rows = [(i, ("### " if i % 2 else "") + prose(i, 60).replace(" ", "### " if i % 2 else " ")) for i in range(300)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(300)] + [(5, None)], "doc_id long, quality int")
    model = quality.fit(train, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    held = {r["doc_id"]: r["predicted"] for r in quality.score(train, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert len(held) > 20 and np.mean([v == (k % 2 == 0) for k, v in held.items()]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in quality.score(docs, model).collect())
    assert quality.score(empty, model).count() == 0 and quality.keep_quality(docs, model).columns == docs.columns
    assert quality.fit(train, labels.limit(0)).bias == 0.0
    # The linear-time identity equals the sum over all pairs.
    ids, values = np.array([1, 2, 3]), np.array([0.5, 1.0, 2.0], np.float32)
    pairs = sum(model.factors[ids[i]] @ model.factors[ids[j]] * values[i] * values[j] for i in range(3) for j in range(i))
    assert np.isclose(model.logits(ids, values, np.array([0]))[0], model.bias + (model.linear[ids] * values).sum() + pairs, atol=1e-4)


def plain_simhash(text, k):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = np.array([xxhash.xxh64_intdigest(g, seed=42) for g in grams], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h)) if len(h) else 0


def test_simhash(spark, docs, empty):
    got = simhash.simhash_components(docs).collect()
    prints = sorted(((r["doc_id"] or 0, r["fingerprint"]) for r in got))
    assert prints == sorted((i or 0, f"{plain_simhash(t, 3):016x}") for i, t in fixture_rows())
    forest = components.Forest()
    known = [(i, plain_simhash(t, 3)) for i, t in fixture_rows() if i is not None]
    for i, a in known:
        for j, b in known:
            if (a ^ b).bit_count() <= 2:
                forest.union(i, j)
    assert all(r["component_id"] == forest.find(r["doc_id"]) for r in got if r["doc_id"] is not None)
    assert simhash.simhash_components(empty).count() == 0


def test_long_fingerprints():
    """A long text in pieces has the fingerprint of the whole."""
    rng = random.Random(12)
    for n in (0, 1, 2, 3, 4, 50, 4000):
        text = "".join(rng.choice(["a", "bb", "C", "dé"]) + rng.choice([" ", "  ", "\n"]) for _ in range(n)).encode()
        buf = np.frombuffer(text, np.uint8)
        for size in (1, 7, 100, 10**6):
            assert simhash.long_fingerprint(buf, 3, size) == plain_simhash(text.decode(), 3)
    big = (prose(3, 5000) + "\n") * 60
    assert simhash.long_fingerprint(np.frombuffer(big.encode(), np.uint8), 3) == plain_simhash(big, 3)


def test_close_pairs_and_levels():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fps[150:] = fps[:150] ^ (np.uint64(1) << rng.integers(0, 60, 150).astype(np.uint64))
    group = np.sort(rng.integers(0, 3, 300))
    for radius in (0, 1, 2, 7, 20):
        got = {(int(a), int(b)) for x, y in simhash.close_pairs(fps, group, radius) for a, b in zip(x, y)}
        assert got == {(i, j) for i in range(300) for j in range(i + 1, 300) if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= radius}
    # Whatever two bits differ, each level keeps the pair together in some finer bucket of any bucket that holds it.
    levels = simhash._levels()
    for a in range(64):
        for b in range(64):
            different = 1 << a | 1 << b
            for p, mask in enumerate(levels[0][0]):
                if not mask & different:
                    assert any(not m & different for m in levels[1][p])


def test_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 4)
    rows = [(i, "same words here all the time " + str(i % 7)) for i in range(40)]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    forest = components.Forest()
    prints = [(i, plain_simhash(t, 3)) for i, t in rows]
    for i, a in prints:
        for j, b in prints:
            if (a ^ b).bit_count() <= 2:
                forest.union(i, j)
    assert all(r["component_id"] == forest.find(r["doc_id"]) for r in got)


@pytest.mark.parametrize("tile", [simhash.TILE, 2, 3])
def test_near_dedup(spark, docs, empty, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    base = prose(90, 80).split(" ")
    # A group of copies that differ, and a chain that leaves it by steps of three words.
    copies = [(100 + k, " ".join(base[:k] + ["w" + str(k)] + base[k + 1 :])) for k in range(2, 40, 3)]
    drift = [(200 + k, " ".join(["v" + str(j) for j in range(k)] + base[k:])) for k in range(0, 48, 3)]
    more = spark.createDataFrame(copies + drift, "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    kept = sorted(r["doc_id"] for r in simhash.near_dedup(docs).collect() if r["doc_id"] is not None)
    texts, forest = {i: t for i, t in fixture_rows() + copies + drift if i is not None}, components.Forest()
    sets = {}
    for i, t in texts.items():
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    for i in sets:
        for j in sets:
            union = len(sets[i] | sets[j])
            if not union or len(sets[i] & sets[j]) / union >= 0.8:
                forest.union(i, j)
    assert kept == sorted({forest.find(i) for i in sets})
    assert simhash.near_dedup(docs).columns == docs.columns and simhash.near_dedup(empty).count() == 0


def test_near_dedup_repeated_line(spark):
    """The same shingle set is one group, however often one of the texts repeats a line."""
    rows = []
    for k in range(20):
        words = [f"w{k}x{j}" for j in range(1000)]
        line = words[500:512]
        # The line ends in front of its own start both times: more repeats bring no new shingle.
        rows += [(2 * k, " ".join(words + line * 2)), (2 * k + 1, " ".join(words + line * 50))]
    assert sorted(r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == list(range(0, 40, 2))


def test_similar_sets_of_far_fingerprints():
    """The sets decide every pair of a block, whatever the fingerprints say."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    for n in (2, 3, simhash.FEW, 60):
        sets = []
        for k in range(n):
            base = sets[int(rng.integers(0, k))] if k % 3 else rng.integers(0, 1 << 63, 60, dtype=np.uint64)
            sets.append(np.unique(np.concatenate([base[int(rng.integers(0, 8)) :], rng.integers(0, 1 << 63, int(rng.integers(0, 8)), dtype=np.uint64)])))
        fps = rng.integers(-(1 << 63), 1 << 63, n)
        zero = pa.array(np.zeros(n, np.int64))
        batch = pa.RecordBatch.from_arrays([zero, zero, zero, zero, pa.array(np.arange(n)), pa.array(fps), pa.array([x.tobytes() for x in sets])], names=list("bktjifs"))
        got, want = components.Forest(), components.Forest()
        for out in simhash._link_tiles(iter([batch])):
            for u, v in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
                got.union(u, v)
        for i in range(n):
            for j in range(i):
                if len(set(sets[i].tolist()) & set(sets[j].tolist())) / len(set(sets[i].tolist()) | set(sets[j].tolist())) >= 0.8:
                    want.union(i, j)
        assert [got.find(i) for i in range(n)] == [want.find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(50)] + [(200, i) for i in range(201, 260)]
    forest = components.Forest()
    for a, b in links:
        forest.union(a, b)
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(links, "u long, v long").repartition(4)).collect()}
    assert got == {x: forest.find(x) for x in forest.parent if forest.find(x) != x}


def test_pieces(spark, docs, empty):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = pieces.encode(docs, path)
    assert sorted((r["doc_id"] or 0, r["piece_ids"]) for r in encoded.collect()) == sorted((i or 0, lib.encode(t or "")) for i, t in fixture_rows())
    assert sorted(r["text"] for r in pieces.decode(encoded, path).collect()) == sorted((t or "").replace("▁", " ") for _, t in fixture_rows())
    with_ids = pieces.with_pieces(docs, path)
    assert set(docs.columns) <= set(with_ids.columns) and with_ids.count() == len(fixture_rows()) and pieces.round_trip_digest(empty, path).count() == 0


def test_decontamination(spark, docs, empty):
    item = prose(77, 40)
    words = item.split(" ")
    moved = " ".join(words[20:] + words[:20])
    rows = [(1, prose(90, 50) + " " + item + " " + prose(91, 50)), (2, prose(92, 30) + " " + moved.upper()), (3, prose(93, 100)), (4, None), (5, " ".join(words[:8]))]
    bench = spark.createDataFrame([(7, item), (8, "--"), (9, None), (7, item)], "item_id long, text string")
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in decontam.contamination(table, bench).collect()}
    assert got == {1: (True, 7), 2: (True, 7), 3: (False, None), 4: (False, None), 5: (False, None)}
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(table, bench).collect()) == [3, 4, 5]
    assert decontam.contamination(empty, bench).count() == 0 and decontam.contamination(table, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.drop_contaminated(docs, bench).columns == docs.columns


def test_short_and_many_items(spark, monkeypatch):
    """Items of one or two tokens match as a whole; a full bit table and a frequent seed lose nothing."""
    monkeypatch.setattr(decontam, "TABLE_BITS", (15, 15))
    monkeypatch.setattr(decontam, "PAIRS", 7)
    often = "and so on "
    items = [(k, often + prose(500 + k, 30) + " " + often) for k in range(60)] + [(90, "zebra"), (91, "Zebra, yak"), (None, prose(777, 20)), (92, often * 20)]
    rows = [(k, "x y " + t) for k, t in items[:60]] + [(99, often * 50), (100, "a zebra"), (101, "zebra\tYAK!"), (102, "yak zebras"), (None, items[3][1]), (103, prose(777, 20)), (104, None)]
    table, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["item_id"] if r["contaminated"] else -1 for r in decontam.contamination(table, bench).collect()}
    assert got == {**{k: k for k in range(60)}, 99: 92, 100: 90, 101: 90, 102: -1, None: 3, 103: None, 104: -1}
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(table, bench).collect()) == [102, 104]


def test_contamination_by_brute_force(spark):
    """Every pair of a document and an item, tiled by looking at all pairs of places."""
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefgh")
    items = [(k, [word() for _ in range(rng.randint(1, 14))]) for k in range(25)]
    docs = []
    for k in range(80):
        words = [word() for _ in range(rng.randint(0, 30))]
        if k % 2:
            item = rng.choice(items)[1]
            cut = rng.randint(0, len(item))
            words += item[cut:] + [word()] + item[:cut]
        docs.append((k, words))
    want = {}
    for k, words in docs:
        shares = {i: plain_tiles(item, words, min(3, len(item))) / len(item) for i, item in items}
        found = {i: s for i, s in shares.items() if s >= 0.5}
        want[k] = (len(found), min(found, key=lambda i: (-found[i], i)) if found else None, max(found.values(), default=0.0))
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {r["doc_id"]: (r["n_items"], r["item_id"], r["coverage"]) for r in decontam.contamination(table, bench).collect()}
    assert got == want


def plain_tiles(item, doc, least):
    """Greedy string tiling by looking at all pairs of places."""
    a, b = [False] * len(item), [False] * len(doc)
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return sum(a)
        for k in range(best[0]):
            a[best[1] + k] = b[best[2] + k] = True


def test_tiles():
    rng = random.Random(5)
    for _ in range(150):
        item, doc = [rng.randint(0, 3) for _ in range(rng.randint(3, 25))], [rng.randint(0, 3) for _ in range(rng.randint(3, 40))]
        m = decontam.MIN_MATCH
        places = lambda xs: {tuple(xs[i : i + m]): [j for j in range(len(xs) - m + 1) if xs[j : j + m] == xs[i : i + m]] for i in range(len(xs) - m + 1)}  # noqa: E731, B023
        a, b = places(item), places(doc)
        shared = [(np.array(a[s]), np.array(b[s])) for s in a if s in b]
        got = decontam.tiles(decontam.matches(shared, m), len(item)) if shared else 0
        assert got == plain_tiles(item, doc, m)


def plain_bits(samples, lang, text):
    """Code length by prediction by partial matching with exclusion, straight from the counts."""
    letters = sorted({b for group in samples.values() for t in group for b in t.lower().encode() if b >= 128 or 97 <= b <= 122})
    symbol = lambda b: letters.index(b) + 2 if b in letters else 1 if b >= 128 or 97 <= b <= 122 else 0
    width = len(letters) + 2

    def symbols(t):
        out = [0, 0, 0]
        for b in t.lower().encode():
            s = symbol(b)
            if s or out[-1]:
                out.append(s)
        return out

    counts = {}
    for t in samples[lang]:
        s = symbols(t)
        for i in range(3, len(s)):
            for k in range(4):
                counts.setdefault(tuple(s[i - k : i]), {}).setdefault(s[i], 0)
                counts[tuple(s[i - k : i])][s[i]] += 1

    def chance(context, x, excluded=frozenset()):
        """The order -1 model is uniform; an escape goes to the next shorter context, without the symbols seen here."""
        here = {a: n for a, n in counts.get(context, {}).items()}
        shorter = (lambda a: chance(context[1:], a)) if context else (lambda a: 1 / width)
        if not here:
            return shorter(x)
        total, left = sum(here.values()), 1 - sum(shorter(a) for a in here)
        if left <= 1e-12:
            return here.get(x, 0) / total or 1e-12
        return here[x] / (total + len(here)) if x in here else len(here) / (total + len(here)) * shorter(x) / left

    s = symbols(text)
    return -sum(np.log2(chance(tuple(s[i - 3 : i]), s[i])) for i in range(3, len(s)))


def test_language(spark, docs, empty, monkeypatch):
    words = {"aa": ["alba", "anda", "arba"], "bb": ["brum", "bolk", "burt"], "cc": ["cola", "über", "albo"]}
    rows = [(k * 3 + j, " ".join(random.Random(k).choice(words[lang]) for _ in range(40)), lang) for j, lang in enumerate(words) for k in range(30)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = langid.fit(train)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(train, trees).collect()}
    assert all(got[i][0] == lang for i, _, lang in rows) and len(trees) == 1
    out = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, trees).collect()}
    assert out[1] == out[2] == out[3] == out[12] == "und" and out[4] in words
    assert langid.predict(empty, trees).count() == 0 and langid.fit(train.limit(0)) == []
    # Frozen code lengths are those of a distribution in every context.
    assert np.allclose(np.exp2(-trees[0].cost.astype(float)).sum(axis=1), 1.0, atol=1e-3)
    # Languages in several blocks, and the definition.
    samples = {lang: [t for _, t, x in rows if x == lang] for lang in words}
    monkeypatch.setattr(langid, "BLOCK_BYTES", 1)
    blocks = langid.learn(samples)
    assert [b.languages for b in blocks] == [["aa"], ["bb"], ["cc"]]
    again = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(train, blocks).collect()}
    assert all(again[i][0] == got[i][0] and np.isclose(again[i][1], got[i][1], atol=1e-9) for i in got)
    for text in ("alba brum", "über Ärger, 12 x", "arb", "zz"):
        raw = np.frombuffer(text.lower().encode(), np.uint8)
        for whole, part in zip(trees[0].bits(raw, np.array([0, len(raw)]))[0], blocks):
            assert np.isclose(whole, part.bits(raw, np.array([0, len(raw)]))[0, 0], rtol=1e-5)
        for lang, bits in zip(trees[0].languages, trees[0].bits(raw, np.array([0, len(raw)]))[0]):
            assert np.isclose(bits, plain_bits(samples, lang, text), rtol=1e-4)


def test_languages_without_end(spark):
    """Any number of languages, each of one document."""
    rows = [(k, f"w{k} " * 5, f"l{k:04d}") for k in range(600)]
    trees = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sum(len(t.languages) for t in trees) == 600


def test_pii(spark, docs, empty):
    text = "Mr Smith (Mrs. Anna Lee, Dr. Иван Петров) a.b@mail.example.com A.B@MAIL.example.com 4111 1111 1111 1111 4111-1111-1111-1111 10.20.30.40 +1 (017) 555-7713 078-05-1120 " + "ab12" * 10 + " clean 1234 words"
    rows = [(1, text), (2, "again Mr Smith, 4111111111111111"), (3, "nothing here 12"), (4, None), (5, "")]
    out = {r["doc_id"]: r["text"] for r in pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[3], out[4], out[5]) == ("nothing here 12", None, "") and out[1].endswith(" clean 1234 words")
    for secret in ("Smith", "Anna", "Петров", "a.b@mail", "4111 1111", "4111-1111", "10.20.30.40", "555-7713", "078-05-1120", "ab12ab12"):
        assert secret not in out[1]
    name = out[1].split(" ")[1]
    assert f"Mr {name}" in out[2]
    digits = lambda s: "".join(c for c in s if c.isdigit())
    card = digits(out[2])
    assert len(card) == 16 and digits(out[1]).count(card) == 2
    double = [int(c) if k % 2 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(card)]
    assert sum(double) % 10 == 0  # as valid as the original
    whole = pii.surrogate_digest(docs)
    assert sorted(r["text"] for r in whole.collect()) == sorted(t or "" for _, t in fixture_rows()) and pii.surrogate_digest(empty).count() == 0


def test_pii_card_of_fifteen_digits(spark):
    rows = [(1, "card 3782 822463 10005 or 3782-822463-10005, 378282246310005.")]
    out = pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()[0]["text"]
    cards = ["".join(c for c in part if c.isdigit()) for part in out.replace("card ", "").replace(" or ", ",").split(",")]
    assert len(set(cards)) == 1 and len(cards[0]) == 15 and cards[0] != "378282246310005"


def test_pii_long_names(spark):
    many = " ".join(["Anna"] * 3000)
    rows = [(1, "so Mr Juan Carlos Garcia Lopez came"), (2, "so Mr Juan Carlos Garcia Lopez Perez came"), (3, f"so Mrs {many} came")]
    out = {r["doc_id"]: r["text"] for r in pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(part in text for text in out.values() for part in ("Juan", "Carlos", "Garcia", "Lopez", "Perez"))
    assert [len(out[k].split(" ")) for k in (1, 2, 3)] == [len(t.split(" ")) for _, t in rows] and " Anna Anna" not in out[3]


def test_pii_distinct(spark):
    """All 2,000 numbers of one short type, and mentions that collide at first, keep distinct surrogates."""
    rows = [(k, f"x {k % 256}.{k // 256}.7.9 and u{k % 50}@b.co") for k in range(2000)]
    out = pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = {(rows[r["doc_id"]][1].split(" ")[1], r["text"].split(" ")[1]) for r in out}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) == 2000
    mails = {(rows[r["doc_id"]][1].split(" ")[3], r["text"].split(" ")[3]) for r in out}
    assert len(mails) == len({b for _, b in mails}) == 50


def plain_cut(raws, length):
    seen = {}
    for k, r in enumerate(raws):
        for i in range(len(r) - length + 1):
            seen.setdefault(r[i : i + length], []).append((k, i))
    cover = [np.zeros(len(r), bool) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                cover[k][i : i + length] = True
    return cover


@pytest.mark.parametrize("hot", [suffixes.HOT_CONTEXTS, 1, 4])
def test_suffixes(spark, docs, empty, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", hot)
    base = prose(50, 300)
    line = prose(52, 60)[:250]
    rows = fixture_rows() + [(20, base), (21, "x" + base[100:700] + "y" + prose(51, 100)), (22, base[:650] + "Z" + base[651:]), (23, base[:650] + "Q" + base[651:1200]), (24, "ab" * 900)]
    # A line of 250 bytes in many texts: some agree with another on the 400 bytes around it, some on 399 only.
    rows += [(30 + k, prose(60 + k, 40) + line + prose(70 + k, 60)) for k in range(6)]
    rows += [(40 + k, "p" * (k + 1) + base[900 : 1000 + k] + line + base[1200 : 1299 + k % 2] + "q" * k) for k in range(4)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    raws = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), raw, cover in zip(rows, raws, plain_cut(raws, 400)):
        kept = bytes(np.frombuffer(raw, np.uint8)[~cover]) if raw else b""
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        want.append((i or 0, len(raw), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = [(r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.repeated_bytes(table).collect()]
    assert sorted(got) == sorted(want)
    assert suffixes.repeated_bytes(empty).count() == 0


def test_merge_runs():
    rng = random.Random(9)
    for k in (1, 2, 3, 7):
        runs = [sorted((bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))), b"l", 1, 2, 3) for _ in range(rng.randint(1, 40))) for _ in range(k)]
        out = list(suffixes.merge_runs([suffixes.read_run(suffixes.write_run(r)) for r in runs]))
        assert [e[0] for e in out] == sorted(e[0] for r in runs for e in r)
        assert all(b[1] == suffixes.common_prefix(a[0], b[0]) for a, b in zip(out, out[1:]))


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert set(docs.columns) <= set(out.columns)
    rows = out.collect()
    assert 0 < len(rows) < docs.count() and len({r["doc_id"] for r in rows}) == len(rows)
    assert all(r["decoded"] == r["text"] for r in rows)
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    assert not any(b["text"] in r["text"] for b in bench for r in rows)
