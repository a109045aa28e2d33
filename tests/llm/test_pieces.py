"""The piece transducers against the library: the given model, and small unigram and BPE models made by hand."""

import random
import struct

import pytest
import sentencepiece

from trellis.llm import pieces, queries


def field(number, value):
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    tag, out = number << 3 | (0 if isinstance(value, int) else 2), b""
    parts = [tag, value if isinstance(value, int) else len(value)]
    for x in parts:
        while x > 127:
            out += bytes([x & 127 | 128])
            x >>= 7
        out += bytes([x])
    return out + (b"" if isinstance(value, int) else value)


def model(kind, vocabulary, in_bytes, normaliser):
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + ([(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if in_bytes else []) + [(t, s, 1) for t, s in vocabulary]
    out = b"".join(field(1, field(1, t.encode()) + field(2, s) + field(3, k)) for t, s, k in rows)
    trainer = field(3, kind) + field(4, len(rows)) + field(35, int(in_bytes))
    return out + field(2, trainer) + field(3, normaliser)


def texts(rng, n):
    letters = "aabbccd▁  ée12ﬁ①\t🙂"
    return ["", " ", "a", "  a  b  ", "ab" * 300] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("in_bytes", [True, False])
@pytest.mark.parametrize("rules", ["none", "nfkc"])
@pytest.mark.parametrize("kind", [1, 2])
def test_small_models(kind, rules, in_bytes):
    rng = random.Random(kind * 4 + in_bytes * 2 + len(rules))
    grams = {"".join(rng.choice("abcd▁é") for _ in range(rng.randint(2, 4))) for _ in range(40)}
    grams = sorted(g for g in grams if "▁" not in g.lstrip("▁") or kind == 1)
    vocabulary = [(c, -9.0 - k / 8) for k, c in enumerate("▁abcdé12")] + [(g, -1.0 - k / 16 - rng.random()) for k, g in enumerate(grams)]
    if rules == "nfkc":
        spec = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
        charsmap = pieces.read_model(spec)[2][2]
        normaliser = field(2, charsmap)
    else:
        normaliser = field(3, 1) + field(4, 0)
    data = model(kind, vocabulary, in_bytes, normaliser)
    lib = sentencepiece.SentencePieceProcessor(model_proto=data)
    own = pieces.PieceTransducer(data)
    for text in texts(rng, 300):
        assert own.normaliser.apply(text).replace("▁", " ") == lib.normalize(text).replace("▁", " ")
        ids = lib.encode(text)
        assert list(struct.unpack(f"<{len(ids)}i", own.encode(text))) == ids, text
        assert own.decode(own.encode(text)) == lib.decode(ids)


def test_given_model_and_long_text():
    path = queries.tokenizer_path("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceTransducer(pieces._model_bytes(path))
    rng = random.Random(1)
    long = "".join(rng.choice("etaoin shrdlu\n▁é日") for _ in range(1_200_000))
    for text in [*texts(rng, 300), long, "x" * 3000]:
        ids = own.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}i", ids)) == lib.encode(text)
        assert own.decode(ids) == text.replace("▁", " ")
