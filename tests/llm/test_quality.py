import re
from collections import Counter

import numpy as np

from cityflow.llm.quality import _COUNTS, counts_of, estimate, judge, posterior, repeated_words, rules


def by_hand(text):
    """The contract's counts straight from their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [
    None,
    "",
    " \n\t",
    "a b c d e f g h " * 3,
    "line one\nline one\n\nline two\n \n ",
    "x\x1cy z\x85w 　q",
    "###| <b> $5 & 10% *",
    "a a a a a a a a a a a",
    " ".join(map(str, range(30))) + " " + " ".join(map(str, range(10))),
    "é 😀\vb\fc\rd",
]


def test_counts_by_hand(odd_rows):
    for text in TEXTS + [t for _, t in odd_rows]:
        assert counts_of(text)[:5] == by_hand(text), text


def test_repeated_words_random():
    rng = np.random.default_rng(2)
    for _ in range(200):
        words = [b"w%d" % i for i in rng.integers(0, rng.integers(1, 4), rng.integers(0, 60))]
        assert repeated_words(words) == by_hand(b" ".join(words).decode())[4]


def test_estimate_recovers_rules():
    """Votes drawn from known rules: a reliable, a fair and a useless one."""
    rng = np.random.default_rng(4)
    good = rng.random(20_000) < 0.8
    right = [0.95, 0.95, 0.85, 0.5]
    votes = np.stack([np.where(rng.random(len(good)) < 0.2, 0, np.where(rng.random(len(good)) < a, 1, -1) * np.where(good, 1, -1)) for a in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, shown = estimate(patterns, counts.astype(float))
    said = posterior(patterns, share, shown)
    accuracy = [(shown[j, 1, 2] + shown[j, 0, 0]) / (shown[j, 1, [0, 2]].sum() + shown[j, 0, [0, 2]].sum()) for j in range(4)]
    assert abs(share - 0.8) < 0.05
    assert accuracy[0] > 0.85 and accuracy[3] < 0.65
    verdict = dict(zip(map(tuple, patterns), said >= 0.5))
    assert np.mean([verdict[tuple(v)] == g for v, g in zip(votes, good)]) > 0.95


def test_verdicts(spark, odd_docs, odd_rows):
    clean = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(90)) + "."
    junk = " ".join("###" + w for w in clean.split())
    rows = [(i, clean.replace("word", f"{'qrstuvwxyz'[i % 10]}ord")) for i in range(60)] + [(100 + i, junk) for i in range(8)]
    found = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i].kept for i in range(60)) and not any(found[100 + i].kept for i in range(8))
    odd = judge(odd_docs).collect()
    assert len(odd) == len(odd_rows) and all(r.base_failed and not r.kept for r in odd if r.n_words < 20)
    assert all(r.base_failed for r in odd if r.doc_id in (6, 7))
    assert len(odd[0].votes) == len(rules()) and {c in odd[0].asDict() for c in _COUNTS} == {True}


def test_empty(no_docs):
    assert judge(no_docs).count() == 0
