import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from cityflow.llm.pieces import PieceModel, code_documents, suffix_order

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def test_suffix_order():
    rng = np.random.default_rng(1)
    for _ in range(50):
        codes = rng.integers(97, 100, rng.integers(1, 60))
        text = "".join(map(chr, codes))
        order = suffix_order(codes, 64)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_occurrences(model):
    text = "the▁theatre▁of▁the▁three"
    starts, pieces = model.occurrences(np.array([ord(c) for c in text]))
    found = {(int(s), model.text[p]) for s, p in zip(starts, pieces)}
    known = {t for t in model.text if t}
    brute = {(i, text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in known}
    assert found == brute and len(starts) == len(brute)


def test_ids_are_those_of_the_library(model, odd_rows):
    rng = random.Random(3)
    letters = ["a", "b", "th", "ing", " ", "  ", "\n", "é", "😀", "你", "\x00", ".", "The", "tion", "▁", "<s>", "<0x0A>", "aa", "aaa"]
    texts = [t or "" for _, t in odd_rows] + ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(4000)]
    coded = [np.frombuffer(c, dtype="<u4") for c in model.encode(texts)]
    expected = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(texts)
    assert [c.tolist() for c in coded] == expected
    assert [model.decode(c) for c in coded] == [t.replace("▁", " ") for t in texts]


def test_forgetting_changes_nothing(model, monkeypatch):
    monkeypatch.setattr("cityflow.llm.pieces.REMEMBERED", 3)
    few = PieceModel(PATH)
    texts = ["one two three four", "five six seven", "one two nine\x00ten"]
    assert [few.encode([t])[0] for t in texts] == model.encode(texts)


def test_documents(odd_docs, odd_rows, no_docs):
    found = code_documents(odd_docs, PATH).collect()
    assert sorted(map(repr, ((r.doc_id, r.decoded) for r in found))) == sorted(map(repr, ((i, t or "") for i, t in odd_rows)))
    for r in found:
        assert r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    assert code_documents(no_docs, PATH).count() == 0
