import math
import random

import numpy as np

from cityflow.llm.pseudo import AROUND, CLASSES, FREQUENT, HIDDEN, OUTSIDE, SHAPES, SIDE, Vocabulary, learn, log_probabilities, neighbours, pseudo_likelihood, start, word_counts


def test_neighbours_stay_in_their_document():
    near = neighbours(np.array([1, 2, 3, 4, 5]), np.array([0, 0, 0, 1, 1]))
    assert near.tolist() == [
        [OUTSIDE, OUTSIDE, 1, OUTSIDE, OUTSIDE],
        [OUTSIDE, 1, 2, OUTSIDE, 4],
        [2, 3, OUTSIDE, 5, OUTSIDE],
        [3, OUTSIDE, OUTSIDE, OUTSIDE, OUTSIDE],
    ]
    assert neighbours(np.array([7]), np.array([0])).tolist() == [[OUTSIDE]] * 4
    assert neighbours(np.array([], dtype=int), np.array([], dtype=int)).shape == (4, 0)


def drawn(seed=2):
    rng = np.random.default_rng(seed)
    return {n: (rng.standard_normal(s) * 0.5).astype(np.float32) for n, s in SHAPES.items()}


def by_hand(weights, around, target):
    """log P of one class given the four around it, term by term."""
    total = [sum(float(weights["around"][k][around[k]][j]) for k in range(len(AROUND))) for j in range(weights["first"].shape[0])]
    hidden = [math.tanh(t) for t in total]

    def chosen(table, bias, at):
        logits = [sum(h * float(table[j][c]) for j, h in enumerate(hidden)) + float(bias[c]) for c in range(SIDE)]
        return logits[at] - math.log(sum(math.exp(x) for x in logits))

    first, second = divmod(target, SIDE)
    return chosen(weights["first"], weights["first0"], first) + chosen(weights["second"], weights["second0"][first], second)


def test_log_probabilities_by_hand():
    weights, rng = drawn(), random.Random(1)
    classes = np.array([rng.randrange(CLASSES) for _ in range(30)])
    near = neighbours(classes, np.repeat([0, 1, 2], 10))
    found = log_probabilities(weights, near, classes)
    assert np.allclose(found, [by_hand(weights, near[:, i], int(classes[i])) for i in range(30)], atol=1e-4)


def test_probabilities_sum_to_one():
    weights = drawn()
    near = np.tile(np.array([[3], [9], [OUTSIDE], [500]]), CLASSES)
    assert abs(np.exp(log_probabilities(weights, near, np.arange(CLASSES))).sum() - 1) < 1e-4


def test_word_itself_is_not_seen():
    """Changing a word changes its neighbours' contexts, not its own."""
    a, b = np.array([1, 2, 3]), np.array([1, 900, 3])
    same = np.zeros(3, dtype=int)
    assert (neighbours(a, same)[:, 1] == neighbours(b, same)[:, 1]).all()


def test_a_step_by_hand():
    """One step over a few words, against gradients by differences."""
    weights, rng = drawn(7), random.Random(3)
    classes = np.array([rng.randrange(CLASSES) for _ in range(6)])
    near = neighbours(classes, np.zeros(6, dtype=int))
    loss = lambda w: -log_probabilities(w, near, classes).sum()
    moved = {n: w.copy() for n, w in weights.items()}
    learn(moved, near, classes, rate=6.0)
    spots = [("around", (1, int(near[1, 2]), 5), 8), ("around", (3, OUTSIDE, 0), 8), ("first", (4, 7), 1), ("second", (HIDDEN - 1, 3), 1)]
    spots += [("first0", (int(classes[0]) // SIDE,), 1), ("second0", (int(classes[0]) // SIDE, int(classes[0]) % SIDE), 1)]
    for name, spot, times in spots:
        high, low = ({n: w.astype(np.float64) for n, w in weights.items()} for _ in range(2))
        high[name][spot] += 1e-4
        low[name][spot] -= 1e-4
        slope = (loss(high) - loss(low)) / 2e-4
        assert abs(float(weights[name][spot] - moved[name][spot]) - times * slope) < 2e-3, name


def test_learning_helps_unseen_text():
    rng = random.Random(5)

    def text(n):
        words = []
        while len(words) < n:
            words += rng.choice([[1, 2, 3], [4, 5, 6], [7, 2, 8]])
        return np.array(words)

    seen, unseen = text(30_000), text(3_000)
    weights = start(np.bincount(seen, minlength=CLASSES).astype(float))
    zero = np.zeros(len(unseen), dtype=int)
    before = log_probabilities(weights, neighbours(unseen, zero), unseen).mean()
    learn(weights, neighbours(seen, np.zeros(len(seen), dtype=int)), seen)
    after = log_probabilities(weights, neighbours(unseen, zero), unseen).mean()
    assert after > before + 0.5


def test_classes():
    words = [b"a", b"b", *[f"w{i}".encode() for i in range(FREQUENT)]]
    known = Vocabulary(words, list(range(len(words) + 5, 5, -1)))
    found, numbers, rare = known.classified([b"a", b"other", b"w767", b"other", b"b"])
    assert found.tolist()[0] == 0 and found[4] == 1 and numbers.tolist() == [0, -1, FREQUENT + 1, -1, 1]
    assert FREQUENT <= found[1] < CLASSES and found[1] == found[3] and FREQUENT <= found[2] < CLASSES
    assert rare.tolist() == [1, 3] and known.logs[0] == 0 and known.logs[FREQUENT + 1] > 0


def test_scores_depend_little_on_the_number_of_tasks(spark):
    rng = random.Random(6)
    phrases = [rng.choices([f"w{i}" for i in range(300)], k=5) for _ in range(60)]
    texts = [" ".join(w for _ in range(40) for w in rng.choice(phrases)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few, many = ({r.doc_id: r.mean_log_p for r in pseudo_likelihood(docs.repartition(n, "doc_id")).collect()} for n in (2, 6))
    apart = np.array([few[i] - many[i] for i in few])
    spread = np.std(list(few.values()))
    assert abs(apart).mean() < 0.5 and np.corrcoef(list(few.values()), [many[i] for i in few])[0, 1] > 0.8 and spread > 0


def test_documents(spark, odd_docs, odd_rows, no_docs):
    found = pseudo_likelihood(odd_docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_words) for r in found))) == sorted(map(repr, ((i, len((t or "").lower().encode().split())) for i, t in odd_rows)))
    for r in found:
        assert (r.mean_log_p is None and r.log_p == 0) if not r.n_words else r.log_p < 0
    assert pseudo_likelihood(no_docs).count() == 0
    counts = {bytes(r.word): r.n for r in word_counts(odd_docs.select("text")).collect()}
    assert counts[b"very"] == 8000 and counts[b"alpha"] == 2


def test_order_of_words_matters(spark):
    rng = random.Random(2)
    usual = [" ".join(rng.choice(["red fox runs", "old man sits", "big dog barks"]) for _ in range(40)) for _ in range(60)]
    shuffled = " ".join(rng.sample(usual[0].split(), len(usual[0].split())))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*usual, shuffled])], "doc_id long, text string").repartition(2)
    found = {r.doc_id: r.mean_log_p for r in pseudo_likelihood(docs).collect()}
    assert min(found[i] for i in range(60)) > found[60]


def test_rare_words_count_as_themselves(spark, monkeypatch):
    """Words beyond those with classes of their own: a frequent one is likelier than a rare one of the same class."""
    import zlib

    from cityflow.llm import pseudo

    monkeypatch.setattr(pseudo, "KNOWN", 800)
    rng = random.Random(4)
    own = [f"own{i}" for i in range(FREQUENT)]
    others = [f"o{i}" for i in range(4000)]
    a = others[0]
    b, c = [o for o in others[1:] if zlib.crc32(o.encode()) % 256 == zlib.crc32(a.encode()) % 256][:2]
    texts = [" ".join(own)] * 60 + [" ".join(rng.sample(others, 200)) for _ in range(60)] + [" ".join([a] * 30), b, b, c]
    tests = [f"own1 own2 {w} own3 own4" for w in (a, b, c)]
    docs = spark.createDataFrame(list(enumerate([*tests, *texts])), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.log_p for r in pseudo_likelihood(docs).collect()}
    times = {bytes(r.word).decode(): r.n for r in word_counts(docs).collect()}
    assert times[a] > times[b] != times[c]
    # The same class in the same context: the difference is that of the counts.
    assert abs(found[0] - found[1] - math.log(times[a] / times[b])) < 1e-6
    assert abs(found[1] - found[2] - math.log(times[b] / times[c])) < 1e-6


def test_classes_grow_with_the_vocabulary():
    from cityflow.llm.pseudo import shapes, side_for

    assert side_for(1000) == SIDE and side_for(5_000_000) > side_for(1_000_000) > SIDE
    side = side_for(5_000_000)
    weights = start(np.ones(side * side))
    assert {n: w.shape for n, w in weights.items()} == shapes(side)
    near = np.full((4, side * side), side * side)
    assert abs(np.exp(log_probabilities(weights, near, np.arange(side * side))).sum() - 1) < 1e-4
