import random
import time
from pathlib import Path

import numpy as np

import corpus_pipeline
from cityflow.llm import near, simhash
from cityflow.llm.near import drop_similar

WORDS = 5


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))}


def expected(rows):
    """The smallest id of each class, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(least.values())


def test_against_all_pairs(spark):
    """Near copies with a changed word or two, chains of them, and documents that share a passage."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for i in range(120):
        text = rng.choices(vocabulary, k=rng.randint(3, 120)) + (passage if i % 3 == 0 else [])
        texts.append(text)
        for _ in range(rng.randrange(5)):
            text = list(text)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(text))
                text[at : at + 1] = rng.choices(vocabulary, k=rng.randrange(3))
                text = text or ["w"]
            texts.append(text)
    for _ in range(80):
        text = list(texts[0])
        text[rng.randrange(len(text))] = "other"
        texts.append(text)
    rows = [" ".join(t) for t in texts] + ["", None, " \n", "Only four words here", "only FOUR words  here"]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert found == expected(rows) and len(found) < len(rows) - 100


def test_pages_of_one_template_do_not_meet(spark, monkeypatch):
    """600 pages of 14 words of their own and 110 common ones: candidates in proportion to the pages, not to their pairs."""
    rng = random.Random(6)
    common = [f"c{i}" for i in range(110)]
    rows = [(i, " ".join([f"w{rng.randrange(10**6)}" for _ in range(14)] + common)) for i in range(600)]
    rows.append((600, rows[3][1] + " more"))
    looked_at = []
    links = near._links

    def counting(texts, candidates, words):
        looked_at.append(candidates.distinct().count())
        return links(texts, candidates, words)

    monkeypatch.setattr(near, "_links", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in drop_similar(docs).collect()) == list(range(600))
    assert sum(looked_at) < 2 * len(rows)


def test_large_groups_are_dealt_to_lots(spark, monkeypatch):
    """A key with more documents than are compared at once gives the same classes."""
    monkeypatch.setattr(near, "TOGETHER", 7)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in drop_similar(docs).collect()) == expected(rows)


def test_long_texts_with_a_shared_passage(spark):
    rng = random.Random(10)
    passage = [f"p{i}" for i in range(3000)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(n)])) for i, n in enumerate([400, 400, 700, 800, 900, 3000, 20_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in drop_similar(docs).collect()) == expected(rows)


def test_first_shingles_are_the_rarest():
    rng = np.random.default_rng(4)
    often = rng.integers(0, 5, near.COUNTERS)
    for n in (1, 2, 5, 9, 10, 100, 1001):
        found = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        wanted = len(found) - -(-4 * len(found) // 5) + 1
        by_hand = sorted(found.tolist(), key=lambda h: (often[h % near.COUNTERS], h))[:wanted]
        assert near.first_shingles(found, often).tolist() == by_hand


def test_columns_and_edge_cases(odd_docs, no_docs):
    left = drop_similar(odd_docs)
    assert left.schema.simpleString() == odd_docs.schema.simpleString()
    assert {r.doc_id for r in left.collect()} >= {1, 3, 6, 8, 9, 10, 11, None}
    assert drop_similar(no_docs).count() == 0


def test_simhash_finds_the_first_pairs(spark, monkeypatch):
    """Documents whose fingerprints are near are compared first; those that it cannot find are found all the same."""
    rng = random.Random(15)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(3000)], k=400)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts)]
    near_prints = {(i, 100 + i) for i in range(20) if (simhash.fingerprint(rows[i][1], WORDS) ^ simhash.fingerprint(rows[20 + i][1], WORDS)).bit_count() <= 2}
    assert 0 < len(near_prints)
    compared = []
    links = near._links

    def noting(texts, found, words):
        compared.append({(r.a, r.b) for r in found.collect()})
        return links(texts, found, words)

    monkeypatch.setattr(near, "_links", noting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(r.doc_id for r in drop_similar(docs).collect()) == list(range(20)) == expected(rows)
    # Numbers of rows in one part are their places.
    assert {(a, b - 20 + 100) for a, b in compared[0] if b - a == 20} == near_prints


def test_shuffle_files_go_with_their_queries(spark):
    """The rounds leave no shuffle files behind, whether or not the driver collects its garbage."""
    texts = [" ".join(random.Random(i // 3).choices([f"w{k}" for k in range(500)], k=40)) + f" end{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(folders), spark.conf.get(setting)
    kept = drop_similar(docs, words=WORDS)
    for _ in range(50):
        if not (left := shuffle_files(folders) - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(setting) == was
    assert sorted(r.doc_id for r in kept.collect()) == expected(list(enumerate(texts)))


def shuffle_files(folders):
    return {p.name for folder in folders for p in Path(folder).rglob("shuffle_*")}
