"""Language-model scoring by masked pseudo-likelihood.

Each word is predicted from the two words on either side of it, never from itself, by a small network; the sum of
these conditional log-probabilities scores a document. The network predicts a word's class: the most frequent words of
the whole corpus have one of their own, all others share some by hash. A class is predicted in two parts of as many choices,
32 each or more in a large vocabulary. The chance of a word within its class is its share of the class's words, from counts
of all words, which stay distributed: only those of the most frequent ones are broadcast, all others are joined.

The network learns from every document, once: in each of two rounds, each task takes half of its rows, dealt by hash, through
the network from the same start, and what the tasks arrive at is averaged, weighted by their words, in a distributed aggregate.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, slices, stored, text_of

SIDE = 32
CLASSES = SIDE * SIDE
#: Classes of frequent words, three of four; the others are shared.
FREQUENT = 768
#: Words whose counts are broadcast; those of all others are joined.
KNOWN = 100_000
#: The class beyond the ends of a document.
OUTSIDE = CLASSES
HIDDEN = 16
AROUND = (-2, -1, 1, 2)
BATCH = 2_048
RATE = 0.5
#: Rates of the rounds, each over its share of the documents. What the tasks of a round arrive at is averaged, and the next
#: one begins with that, so that the weights depend less on how many tasks there are.
RATES = (0.5, 0.35)


def shapes(side: int) -> dict[str, tuple[int, ...]]:
    """Shapes of the weights, in the order in which they are numbered."""
    return {
        "around": (len(AROUND), side * side + 1, HIDDEN),
        "first": (HIDDEN, side),
        "first0": (side,),
        "second": (HIDDEN, side),
        "second0": (side, side),
    }


def side_for(vocabulary: int) -> int:
    """Choices of each part for so many distinct words: classes grow as the square root of the vocabulary."""
    return max(SIDE, math.ceil(1.25 * vocabulary**0.25))


SHAPES = shapes(SIDE)
Weights = dict[str, np.ndarray]


def frequent_classes(side: int) -> int:
    return side * side * FREQUENT // CLASSES


class Vocabulary:
    """The words whose counts are known here, by number: those with classes of their own first.

    Other words, of which there may be any number, share classes by hash.
    """

    def __init__(self, words: list[bytes], times: list[int], side: int = SIDE) -> None:
        self.own = min(len(words), frequent_classes(side))
        self.first_shared = frequent_classes(side)
        self.shared = side * side - self.first_shared
        self.numbers = {w: i for i, w in enumerate(words)}
        classes = [i if i < self.own else self.shared_class(w) for i, w in enumerate(words)]
        # A last place each for words that are not here.
        self.classes = np.array([*classes, 0], np.int64)
        logs = [0.0 if i < self.own else math.log(n) for i, n in enumerate(times)]
        self.logs = np.array([*logs, 0.0])

    def shared_class(self, word: bytes) -> int:
        """Class of a word that has none of its own."""
        return self.first_shared + zlib.crc32(word) % self.shared

    def classified(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes of words, their numbers (-1: not here), and the places of those that are not here."""
        numbers = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        found = self.classes[numbers]
        rare = np.flatnonzero(numbers < 0)
        found[rare] = [self.shared_class(words[i]) for i in rare.tolist()]
        return found, numbers, rare


def words_of(text: str) -> list[bytes]:
    """Words in lower case."""
    return text.lower().encode().split()


def start(counts: np.ndarray, seed: int = 3) -> Weights:
    """Weights that predict a class by how frequent it is, with a little noise where the network has to tell apart."""
    rng = np.random.default_rng(seed)
    side = math.isqrt(len(counts))
    share = (counts.reshape(side, side) + 1.0) / (counts.sum() + len(counts))
    small = {n: (rng.standard_normal(shapes(side)[n]) * 0.1).astype(np.float32) for n in ("around", "first", "second")}
    of_first = share.sum(axis=1)
    return small | {
        "first0": np.log(of_first).astype(np.float32),
        "second0": np.log(share / of_first[:, None]).astype(np.float32),
    }


def neighbours(classes: np.ndarray, documents: np.ndarray, outside: int = OUTSIDE) -> np.ndarray:
    """Classes around each word, (place, word); those of another document are `outside`. `documents` is ascending."""
    out = np.full((len(AROUND), len(classes)), outside, dtype=np.int64)
    for row, step in enumerate(AROUND):
        near = slice(max(0, step), len(classes) + min(0, step))
        here = slice(max(0, -step), len(classes) + min(0, -step))
        if here.start < here.stop:
            out[row, here] = np.where(documents[near] == documents[here], classes[near], outside)
    return out


def _hidden(weights: Weights, near: np.ndarray) -> np.ndarray:
    total = weights["around"][0].take(near[0], axis=0)
    for place in range(1, len(AROUND)):
        total += weights["around"][place].take(near[place], axis=0)
    return np.tanh(total, out=total)


def _logits(weights: Weights, hidden: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of both parts, (choice, word): sums over choices then run along whole rows."""
    a = weights["first"].T @ hidden.T
    a += weights["first0"][:, None]
    b = weights["second"].T @ hidden.T
    b += weights["second0"].T.take(first, axis=1)
    return a, b


def _log_softmax(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Logarithm of the share of one choice for each word; x is used up."""
    x -= x.max(axis=0)
    logits = x[chosen, np.arange(len(chosen))].astype(np.float64)
    np.exp(x, out=x)
    return logits - np.log(x.sum(axis=0), dtype=np.float64)


def log_probabilities(weights: Weights, near: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Conditional log-probability of each word's class given those around it."""
    out = np.empty(len(classes), np.float64)
    side = len(weights["first0"])
    first, second = np.divmod(classes.astype(np.int32), side)
    for at in range(0, len(classes), BATCH):
        part = slice(at, at + BATCH)
        a, b = _logits(weights, _hidden(weights, near[:, part]), first[part])
        out[part] = _log_softmax(a, first[part]) + _log_softmax(b, second[part])
    return out


def _shares(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Shares of all choices for each word, less one for the chosen: the gradient by the logits. In place."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    x[chosen, np.arange(len(chosen))] -= 1
    return x


def learn(weights: Weights, near: np.ndarray, classes: np.ndarray, rate: float = RATE) -> None:
    """One pass of gradient steps over words, in place. A step is the mean over its batch; sparse rows by their sum."""
    side = len(weights["first0"])
    table = weights["around"].reshape(-1, HIDDEN)
    places = len(table) // len(AROUND)
    firsts, seconds = np.divmod(classes.astype(np.int32), side)
    # Row of each neighbour in the table of all places; few enough for two bytes, which sort fastest, in small vocabularies.
    rows = near + np.arange(len(AROUND))[:, None] * places
    rows = rows.astype(np.int16 if len(table) < 1 << 15 else np.int32)
    for at in range(0, len(classes), BATCH):
        part = slice(at, at + BATCH)
        first, second = firsts[part], seconds[part]
        n = len(first)
        hidden = _hidden(weights, near[:, part])
        a, b = _logits(weights, hidden, first)
        _shares(a, first)
        _shares(b, second)
        d_hidden = weights["first"] @ a
        d_hidden += weights["second"] @ b
        d_hidden = d_hidden.T * (1 - hidden * hidden)
        step = np.float32(rate / n)
        weights["first"] -= step * (a @ hidden).T
        weights["second"] -= step * (b @ hidden).T
        weights["first0"] -= step * a.sum(axis=1)
        # Sums over the words of each first part, as a product with their indicator.
        of_first = np.zeros((side, n), np.float32)
        of_first[first, np.arange(n)] = 1
        weights["second0"] -= step * (of_first @ b.T)
        flat = rows[:, part].ravel()
        order = flat.argsort(kind="stable")
        sorted_rows = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        sums = np.add.reduceat(d_hidden.take(order % n, axis=0), starts, axis=0)
        # Rows of frequent classes get many words in a step, so the rate is that of the mean.
        table[sorted_rows[starts]] -= step * 8 * sums


def _flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[n].ravel() for n in SHAPES]).astype(np.float64)


def _shaped(values: np.ndarray, side: int) -> Weights:
    out, at = {}, 0
    for name, shape in shapes(side).items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, handed on whenever many different ones are held."""
    held: Counter = Counter()

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in slices(batches, "text"):
        for text in text_of(batch.column(0)):
            held.update(words_of(text))
        if len(held) > 500_000:
            yield handed()
            held = Counter()
    if held:
        yield handed()


def word_counts(rows: DataFrame) -> DataFrame:
    """How often each word occurs in all documents."""
    return rows.select("text").mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _split(texts: Iterator[str]) -> tuple[list[bytes], np.ndarray]:
    """Words of a batch, and the document of each."""
    split = [words_of(t) for t in texts]
    return list(chain.from_iterable(split)), np.repeat(np.arange(len(split)), [len(s) for s in split])


def _numbered(given, side: int):
    """Classes of the words of each document, what their shares of the classes add up to, and the words not known here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked, times, totals = given.value
        vocabulary = Vocabulary(ranked, times, side)
        # A class's words count once more than they are, which is left to words never seen.
        base = np.log(totals + 1)
        base[: vocabulary.own] = 0
        for batch in slices(batches, "text"):
            words, documents = _split(text_of(batch.column(1)))
            found, numbers, rare = vocabulary.classified(words)
            many = np.bincount(documents, minlength=batch.num_rows)
            # A word's share of its class; words that are not known here lack the logarithm of their count.
            within = np.bincount(documents, weights=vocabulary.logs[numbers] - base[found], minlength=batch.num_rows)
            ends = np.cumsum(many)
            held = found.astype(_kind(side))
            texts = [held[e - n : e].tobytes() for n, e in zip(many.tolist(), ends.tolist(), strict=True)]
            borders = np.concatenate([[0], np.cumsum(np.bincount(documents[rare], minlength=batch.num_rows))])
            listed = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array([words[i] for i in rare.tolist()], pa.binary()))
            arrays = [batch.column(0), pa.array(many, pa.int64()), pa.array(within), pa.array(texts, pa.binary()), listed]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "within", "classes", "rare"])

    return run


def _kind(side: int) -> str:
    return "<i2" if side * side < 1 << 15 else "<i4"


def _classes(column: pa.Array, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the words of a batch, and the document of each."""
    parts = [np.frombuffer(x.as_buffer(), _kind(side)) for x in column]
    found = np.concatenate(parts) if parts else np.empty(0, _kind(side))
    return found.astype(np.int64), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _learned(given, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = {n: w.copy() for n, w in given.value.items()}
        side = len(weights["first0"])
        seen = 0
        for batch in slices(batches, "classes", 2_000_000):
            found, documents = _classes(batch.column(0), side)
            learn(weights, neighbours(found, documents, side * side), found, rate)
            seen += len(found)
        if seen:
            values = _flat(weights)
            arrays = [pa.array(np.arange(len(values)), pa.int32()), pa.array(values * seen), pa.array(np.full(len(values), seen))]
            yield pa.RecordBatch.from_arrays(arrays, ["place", "weighted", "words"])

    return run


def _scored(given):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = given.value
        side = len(weights["first0"])
        for batch in slices(batches, "classes", 2_000_000):
            found, documents = _classes(batch.column(3), side)
            log_p = log_probabilities(weights, neighbours(found, documents, side * side), found)
            total = np.bincount(documents, weights=log_p, minlength=batch.num_rows) + batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(4), pa.array(total)], ["doc_id", "n_words", "tag", "log_p"])

    return run


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How well each document's words go with those around it, by a network that learned from all documents.

    Returns doc_id, n_words, log_p (sum of the natural logarithms of the conditional probabilities of the words)
    and mean_log_p (per word). A null or empty text has no words, log_p 0 and a null mean. Null and repeated
    ids are rows like any other; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    counts = stored(word_counts(rows))
    side = side_for(counts.count())
    own = frequent_classes(side)
    # TakeOrdered: at most KNOWN words, and as many as have classes of their own.
    top = counts.orderBy(F.desc("n"), "word").limit(max(KNOWN, own)).toArrow()
    ranked, times = top.column("word").to_pylist(), top.column("n").to_pylist()
    first_shared, shared = own, side * side - own
    by_class = np.zeros(side * side)
    # One row for each shared class.
    for r in counts.groupBy((F.crc32("word") % shared).alias("shared")).agg(F.sum("n").alias("n")).collect():
        by_class[first_shared + r["shared"]] = r["n"]
    for i, (word, n) in enumerate(zip(ranked[:own], times, strict=False)):
        by_class[first_shared + zlib.crc32(word) % shared] -= n
        by_class[i] = n
    broadcast = spark.sparkContext.broadcast
    # Words are split and looked up once; written, so the numbers stay what they are.
    numbered = rows.mapInArrow(
        _numbered(broadcast((ranked, times, by_class)), side), "doc_id long, n_words long, within double, classes binary, rare array<binary>"
    )
    marked = stored(numbered.withColumn("tag", F.monotonically_increasing_id()))
    weights = start(by_class)
    for turn, rate in enumerate(RATES):
        # One row for each weight from each task; the next round begins with their mean.
        own_turn = F.pmod(F.xxhash64("tag"), F.lit(len(RATES))) == turn
        told = marked.where(own_turn).select("classes").mapInArrow(_learned(broadcast(weights), rate), "place int, weighted double, words long")
        means = told.groupBy("place").agg((F.sum("weighted") / F.sum("words")).alias("mean")).toArrow()
        values = _flat(weights)
        values[means.column("place").to_numpy()] = means.column("mean").to_numpy()
        weights = _shaped(values, side)
    scored = marked.select("doc_id", "n_words", "within", "classes", "tag").mapInArrow(
        _scored(broadcast(weights)), "doc_id long, n_words long, tag long, log_p double"
    )
    # A word that occurs once has the logarithm 0.
    terms = marked.select("tag", F.explode("rare").alias("word")).join(counts.where("n > 1"), "word")
    added = terms.groupBy("tag").agg(F.sum(F.log("n")).alias("added"))
    log_p = F.col("log_p") + F.coalesce("added", F.lit(0.0))
    whole = scored.join(added, "tag", "left").select("doc_id", "n_words", log_p.alias("log_p"))
    return whole.withColumn("mean_log_p", F.col("log_p") / F.when(F.col("n_words") > 0, F.col("n_words")))
