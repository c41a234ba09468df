import random
import zlib

import numpy as np

from pyspark.sql import functions as F

from cityflow.llm.gru import HIDDEN, INPUT, Network, Windows, windows, word_inputs
from cityflow.llm.toxicity import STRIDE, WIDTH, _telling, drop_toxic, learned, numbered, score_documents, score_texts, train


def test_windows_cover_and_overlap():
    texts = [np.arange(n) for n in (0, 1, 4, 5, 11)]
    found = windows(texts, width=4, stride=3)
    by_text = {i: [] for i in range(5)}
    for column, owner in enumerate(found.owners):
        by_text[int(owner)].append(found.ids[: found.lengths[column], column].tolist())
    assert by_text[0] == [] and by_text[1] == [[0]] and by_text[2] == [[0, 1, 2, 3]]
    assert sorted(by_text[3]) == [[0, 1, 2, 3], [3, 4]]
    assert sorted(by_text[4]) == [[0, 1, 2, 3], [3, 4, 5, 6], [6, 7, 8, 9], [9, 10]]
    assert found.active.tolist() == [int((found.lengths > t).sum()) for t in range(len(found.ids))]


def test_word_inputs_do_not_depend_on_company():
    words = [b"alpha", b"", b"a", b"x" * 5000, "né".encode()]
    together = word_inputs(words)
    for i, word in enumerate(words):
        alone = word_inputs([word])
        assert alone.words[0] == together.words[i]
        begin, n = together.begins[i], together.counts[i]
        assert sorted(alone.grams) == sorted(together.grams[begin : begin + n]) and n > 0


def by_hand(network, x, ids):
    """Logit of one window by the equations of the gates, a word at a time."""
    w = {k: v.astype(np.float64) for k, v in network.weights.items()}
    sig = lambda v: 1 / (1 + np.exp(-v))

    def states(given, u):
        h, out = np.zeros(HIDDEN), []
        for g in given:
            inner = h @ u
            z = sig(g[:HIDDEN] + inner[:HIDDEN])
            r = sig(g[HIDDEN : 2 * HIDDEN] + inner[HIDDEN : 2 * HIDDEN])
            new = np.tanh(g[2 * HIDDEN :] + r * inner[2 * HIDDEN :])
            h = (1 - z) * new + z * h
            out.append(h)
        return out

    given = x[ids] @ w["in"] + w["in0"]
    forth = states(given[:, : 3 * HIDDEN], w["forth"])
    back = states(given[::-1, 3 * HIDDEN :], w["back"])[::-1]
    both = np.concatenate([forth, back], axis=1)
    look = np.exp(both @ w["look"])
    return (look / look.sum()) @ both @ w["out"] + w["out0"][0]


def _case():
    rng = np.random.default_rng(3)
    network = Network.new()
    x = rng.standard_normal((20, INPUT)).astype(np.float32)
    batch = windows([rng.integers(0, 20, n) for n in (7, 3, 1, 12)], width=5, stride=3)
    return network, x, batch


def test_forward_by_hand():
    network, x, batch = _case()
    found = network.forward(x, batch)
    expected = [by_hand(network, x.astype(np.float64), batch.ids[:n, i]) for i, n in enumerate(batch.lengths)]
    assert np.allclose(found, expected, atol=1e-5)


def test_gradients_by_differences():
    network, x, batch = _case()
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    x = x.astype(np.float64)
    target = (np.arange(len(batch.lengths)) % 2).astype(np.float64)
    weight = np.ones(len(target))
    grads, d_x, _ = network.gradients(x, batch, target, weight)
    step = 1e-3

    def slope(array, at):
        kept = array[at]
        array[at] = kept + step
        up = network.gradients(x, batch, target, weight)[2]
        array[at] = kept - step
        down = network.gradients(x, batch, target, weight)[2]
        array[at] = kept
        return (up - down) / (2 * step)

    rng = np.random.default_rng(0)
    for name, g in grads.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in g.shape)
            assert abs(slope(network.weights[name], at) - g[at]) < 5e-3, name
    for _ in range(10):
        at = (rng.integers(0, 20), rng.integers(0, INPUT))
        assert abs(slope(x, at) - d_x[at]) < 5e-3


def corpus(n, seed=1):
    rng = random.Random(seed)
    syllables = ["ta", "re", "mi", "lo", "sun", "ker", "pa", "vo"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 160))]
        bad = i % 4 == 0
        if bad:
            for _ in range(rng.randint(2, 5)):
                words[rng.randrange(len(words))] = rng.choice(["zgrub", "Frakk"]) + "".join(rng.choices(syllables, k=rng.randint(1, 2)))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    network = learned(docs, labels)
    found = {r.doc_id: r for r in score_documents(docs, network).collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    held = [(found[i].predicted, y) for i, _, y in rows if found[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95
    # Word forms that were never seen are known by their characters; a long clean text stays clean.
    clean = " ".join(t for _, t, y in rows[:400] if not y)
    assert score_texts(network, [clean[:3000] + " zgrubsunkerpa frakkvovovo " + clean[3000:6000]])[0] > 0.5
    left = {r.doc_id for r in drop_toxic(docs, network).collect()}
    assert left == {i for i, r in found.items() if r.score < 0.5}


def test_held_out_labels_are_not_read(spark):
    """Turning the labels of held-out rows changes nothing."""
    rows = corpus(300, seed=4)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = learned(docs, labels), learned(docs, turned)
    assert all((a.weights[k] == b.weights[k]).all() for k in a.weights)


def test_passages_are_whole_in_a_window_wherever_they_begin():
    for n in (24, 49, 60, 200):
        found = windows([np.arange(n)], WIDTH, STRIDE)
        held = [set(found.ids[: found.lengths[i], i].tolist()) for i in range(len(found.owners))]
        for begin in range(n - 23):
            assert any(set(range(begin, begin + 24)) <= h for h in held), (n, begin)


def test_a_toxic_passage_at_every_place_of_a_long_clean_text():
    rows = corpus(500, seed=9)
    network = train([r[1] for r in rows], [r[2] for r in rows])
    clean = " ".join(t for _, t, y in rows if not y).split()[:300]
    passage = "zgrubtare lo frakkmi sun zgrublo pa".split()
    texts = [" ".join(clean[:at] + passage + clean[at:]) for at in range(0, 301, 7)]
    assert (score_texts(network, texts) > 0.5).all() and score_texts(network, [" ".join(clean)])[0] < 0.5


def test_inputs_are_those_that_tell_the_classes_apart():
    """A word in eight toxic texts only tells; one in a hundred texts of both classes, or in two texts, does not."""
    texts = [f"common{i % 3} often " + ("bad " if i < 8 else "") + ("rare" if i in (1, 3) else "") for i in range(400)]
    label = np.array([float(i < 100) for i in range(400)], np.float32)
    inputs, numbers = numbered(texts)
    found = _telling(inputs, numbers, label)["words"]
    words = {w: inputs.words[numbers[i][at]] for w, i, at in (("often", 0, 1), ("bad", 0, 2), ("rare", 1, 3))}
    assert found[words["bad"]] and not found[words["often"]] and not found[words["rare"]]


def test_scores_do_not_depend_on_the_batch():
    rows = corpus(60, seed=2)
    network = train([r[1] for r in rows], [r[2] for r in rows], epochs=2)
    texts = [r[1] for r in rows]
    alone = np.array([score_texts(network, [t])[0] for t in texts])
    assert np.allclose(score_texts(network, texts), alone, atol=1e-5)


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    blank = learned(odd_docs, none)
    found = score_documents(odd_docs, blank).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    some = spark.createDataFrame([(1, 1), (2, None), (None, 1), (6, 0), (6, 0), (77, 1), (8, 5)], "doc_id long, toxic int")
    network = learned(odd_docs, some)
    assert score_documents(odd_docs, network).count() == len(odd_rows)
    assert drop_toxic(odd_docs, network).schema.simpleString() == odd_docs.schema.simpleString()
    assert score_documents(no_docs, network).count() == 0 and drop_toxic(no_docs, network).count() == 0
    assert learned(no_docs, none).weights.keys() == network.weights.keys()


def test_distinct_words_are_numbered_once():
    inputs, numbers = numbered(["The the THE.", "", "the end"])
    assert len(inputs.words) == 2 and [n.tolist() for n in numbers] == [[0, 0, 0], [], [0, 1]]
    assert isinstance(windows(numbers, 48, 36), Windows)
