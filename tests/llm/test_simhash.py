import random
from collections import defaultdict

import numpy as np
import xxhash

from pyspark.sql import functions as F

from cityflow.llm.simhash import _forest, drop_near_copies, fingerprint, near_links, roots, simhash_classes

SPACES = " \t\n\v\f\r"


def by_hand(text, words=3):
    """Fingerprint straight from its definition."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for s in SPACES:
        lowered = lowered.replace(s, " ")
    tokens = [t for t in lowered.split(" ") if t]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest member of each component of values within two bits, by comparing all."""
    values = sorted(set(prints))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


def test_fingerprints(odd_rows):
    texts = [t for _, t in odd_rows] + ["A  b\tC\nd", "a b", "Ünï ÀB c"]
    assert [fingerprint(t or "") for t in texts] == [by_hand(t) for t in texts]


def test_hash_is_that_of_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()
    assert row[0] % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


def test_classes_against_all_pairs(odd_docs, odd_rows):
    found = simhash_classes(odd_docs).collect()
    prints = [by_hand(t) for _, t in odd_rows]
    root_of = components(prints)
    least = defaultdict(list)
    for (doc, _), p in zip(odd_rows, prints):
        if doc is not None:
            least[root_of[p]].append(doc)
    expected = [(doc, f"{p:016x}", min(least[root_of[p]], default=None)) for (doc, _), p in zip(odd_rows, prints)]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in found)


def _planted(rng, n):
    """Fingerprints with chains and dense neighbourhoods."""
    out = set()
    for _ in range(n):
        v = rng.getrandbits(64)
        out.add(v)
        for _ in range(rng.randrange(6)):
            v ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                v ^= 1 << rng.randrange(64)
            out.add(v)
    centre = rng.getrandbits(64)
    out |= {centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)}
    return sorted(out)


def test_links_connect_what_all_pairs_connect(spark):
    values = _planted(random.Random(5), 150)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(5)
    links = near_links(prints)
    pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= 2 or a != b for a, b in pairs)
    rooted = {r.u % (1 << 64): r.root % (1 << 64) for r in roots(links).collect()}
    mine, brute = defaultdict(set), defaultdict(set)
    for v in values:
        mine[rooted.get(v, v)].add(v)
    for v, r in components(values).items():
        brute[r].add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, brute.values()))


def test_large_key_as_small_key():
    """Beyond the pairwise size a key connects the same fingerprints."""
    rng = random.Random(9)
    base = rng.getrandbits(64)
    free = [b for b in range(64) if b >= 39 and b < 64]
    values = sorted({base ^ sum(1 << b for b in rng.sample(free, rng.randrange(5))) for _ in range(200)})
    prints = np.array(values, dtype="<u8")

    def connected(links):
        parent = list(range(len(values)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i, j in links:
            parent[max(root(i), root(j))] = min(root(i), root(j))
        return [root(i) for i in range(len(values))]

    assert connected(_forest(prints, 0)) == [values.index(components(values)[v]) for v in values]


def test_one_of_each_class_stays(odd_docs, odd_rows):
    left = drop_near_copies(odd_docs)
    assert left.schema.simpleString() == odd_docs.schema.simpleString()
    found = left.collect()
    root_of = components([by_hand(t) for _, t in odd_rows])
    # Two classes may have the same smallest id, where an id is repeated.
    first = {}
    for doc, text in odd_rows:
        root = root_of[by_hand(text)]
        first[root] = min((i for i in (first.get(root), doc) if i is not None), default=None)
    assert sorted(str(r.doc_id) for r in found) == sorted(map(str, first.values()))


def test_class_without_ids(spark):
    docs = spark.createDataFrame([(None, "just the same words here")] * 3 + [(4, "other words are in this")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in drop_near_copies(docs).collect()) == ["4", "None"]


def test_empty(no_docs):
    assert simhash_classes(no_docs).count() == 0 and drop_near_copies(no_docs).count() == 0
