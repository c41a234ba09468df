import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cityflow.llm.packing import CAPACITY, _knapsack, grouped, pack_documents, plan
from cityflow.llm.tokens import encode

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(histogram, capacity=CAPACITY, **options):
    runs = plan(histogram, capacity, **options)
    placed = Counter()
    for run in runs:
        assert sum(run.lengths) <= capacity and run.bins > 0
        for length in run.lengths:
            placed[length] += run.bins
    assert placed == Counter({k: v for k, v in histogram.items() if v})
    assert [r.first for r in runs] == np.concatenate([[0], np.cumsum([r.bins for r in runs])])[: len(runs)].astype(int).tolist()
    return sum(r.bins for r in runs)


def first_fit(histogram, capacity=CAPACITY):
    rooms = []
    for length in sorted(Counter(histogram).elements(), reverse=True):
        for i, room in enumerate(rooms):
            if room >= length:
                rooms[i] -= length
                break
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_every_piece_has_a_place(seed):
    rng = random.Random(seed)
    low, high = sorted(rng.sample(range(1, CAPACITY + 1), 2))
    histogram = dict(Counter(rng.randint(low, high) for _ in range(rng.randrange(1, 1500))))
    total = sum(k * v for k, v in histogram.items())
    assert -(-total // CAPACITY) <= check(histogram) <= first_fit(histogram) + 1


def test_few_sizes_are_combined():
    """Three of one size or two and two of others fill a sequence; taking the longest first does not find that."""
    histogram = {600: 300, 424: 300, 341: 900, 342: 1}
    assert check(histogram) <= 602


def test_small_cases():
    assert check({}) == 0 and check({5: 1}) == 1 and check({CAPACITY: 7}) == 7 and check({1: 5000}) == 5
    assert check({3: 4, 7: 3, 10: 2}, capacity=10, groups=2, large=0.2) == 6


def test_groups_have_equally_many():
    parts = grouped({n: 10 for n in range(100, 200)}, 10)
    assert [len(p) for p in parts] == [10] * 10


def test_knapsack():
    worth, filling = _knapsack(np.array([3, 5, 7]), np.array([0.3, 0.55, 0.7]), 10)
    assert worth == pytest.approx(1.1) and filling.tolist() == [0, 2, 0]


def test_ids_are_those_of_the_tokenizer(odd_rows):
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    bits = ["<|endoftext|>", " ", "  ", "\n", "don't", "I'LL", "é", "😀", "12", "٣", "　", "\x00", "x", "the ", "_", "…"]
    texts = [t or "" for _, t in odd_rows] + ["".join(rng.choices(bits, k=rng.randrange(20))) for _ in range(2000)]
    expected = [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encode(PATH, texts) == expected


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        encode(public_tokenizers.path("word_bpe_49k.json"), ["a"])


def test_pieces_and_places(spark, odd_rows):
    rng = random.Random(6)
    rows = odd_rows + [(100 + i, " ".join(rng.choices(["the", "of", "abc", "running"], k=rng.randrange(700)))) for i in range(300)]
    found = pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((str(doc), number, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(expected)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r.length for r in found) // 1024) + 2


def test_odd_documents(odd_docs, no_docs):
    assert {r.length for r in pack_documents(odd_docs, PATH).where("doc_id in (3, 4)").collect()} == {1}
    assert pack_documents(no_docs, PATH).count() == 0


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " \n\t\u3000" * 300_000, "\r\n" * 6_000 + " ", "\x1c" * 20_000 + "\x85" * 20_000])
def test_very_long_white_space(run):
    """Ids of the library, wherever a run stands and whatever follows it."""
    library = Tokenizer.from_file(PATH)
    texts = [f"a{run}b", run, f"{run}b", f"a {run}", f"a{run}<|endoftext|>{run}.", f"a{run}'s 1{run}7"]
    if len(run) > 100_000:
        texts = texts[:2]
    for text, ids in zip(texts, encode(PATH, texts), strict=True):
        assert np.array_equal(np.frombuffer(ids, dtype="<u4"), np.array(library.encode(text).ids, dtype="<u4")), text[:5]
