"""Toxicity: every window of a text goes through a bidirectional recurrent network, and the worst one counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, packed, slices, text_of, unpacked, with_first
from cityflow.llm.gru import GRAM_BITS, WORD_BITS, Network, Trainer, Windows, WordInputs, _sigmoid, windows, word_inputs

#: Words of a window, and how far the next one is: any 24 words in a row are whole in one of them.
WIDTH, STRIDE = 48, 24
#: Labelled rows the network learns from, at most, of each class; and their longest text in bytes.
MOST_ROWS, MOST_BYTES = 2_000, 20_000
EPOCHS, BATCH = 4, 256
#: Updates at least, and those of them on all windows; few texts are gone through more often.
UPDATES, WARM_UP = 400, 120
#: First step sizes of the weights and of the tables of words and character runs.
RATES = (0.01, 0.05)
#: What the G-test of a word or a run of characters must reach for an input of its own: one in ten thousand do by chance.
TELLING = 15.1
#: Windows that are scored together.
TOGETHER = 4_096

_MARKS = b".,;:!?\"'()[]{}*#$%&|<>-_"


class _Numbers(dict):
    """Words by number, in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def numbered(texts: list[str]) -> tuple[WordInputs, list[np.ndarray]]:
    """Hashes of the distinct words of texts (lower case, without marks at the ends), and the texts as their numbers."""
    raw = _Numbers()
    split = [np.fromiter(map(raw.__getitem__, words), dtype=np.int64, count=len(words)) for words in (t.lower().encode().split() for t in texts)]
    plain = _Numbers()
    to_plain = np.fromiter((plain[w.strip(_MARKS)] for w in raw), dtype=np.int64, count=len(raw))
    return word_inputs(list(plain)), [to_plain[s] for s in split]


def _part(batch: Windows, chosen: np.ndarray) -> Windows:
    lengths = batch.lengths[chosen]
    return Windows(batch.ids[: int(lengths[0]), chosen], lengths, batch.owners[chosen])


def window_logits(network: Network, inputs: WordInputs, batch: Windows) -> np.ndarray:
    """Logit of every window."""
    x = network.embedded(inputs)
    out = np.empty(len(batch.lengths), np.float32)
    for begin in range(0, len(out), TOGETHER):
        chosen = np.arange(begin, min(begin + TOGETHER, len(out)))
        out[chosen] = network.forward(x, _part(batch, chosen))
    return out


def score_texts(network: Network, texts: list[str]) -> np.ndarray:
    """Chance that a text is toxic: that of its worst window; without words, that of nothing seen."""
    inputs, numbers = numbered(texts)
    batch = windows(numbers, WIDTH, STRIDE)
    worst = np.full(len(texts), -np.inf, np.float32)
    np.maximum.at(worst, batch.owners, window_logits(network, inputs, batch))
    worst = np.where(np.isinf(worst), network.weights["out0"][0], worst)
    return _sigmoid(worst.astype(np.float64))


def _restricted(inputs: WordInputs, batch: Windows) -> tuple[WordInputs, Windows]:
    """Only the words that occur in a batch of windows."""
    seen = np.arange(len(batch.ids))[:, None] < batch.lengths
    used = np.unique(batch.ids[seen])
    place = np.zeros(len(inputs.words), np.int64)
    place[used] = np.arange(len(used))
    counts = inputs.counts[used]
    begins = np.cumsum(counts) - counts
    grams = inputs.grams[np.repeat(inputs.begins[used] - begins, counts) + np.arange(counts.sum())]
    return WordInputs(inputs.words[used], grams, begins, counts), Windows(place[batch.ids], batch.lengths, batch.owners)


def _telling(inputs: WordInputs, texts: list[np.ndarray], label: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of the tables whose words or runs are in texts of one class more often than chance would have it.

    By the G-test on the numbers of texts with and without them. What is in a few texts only must be in texts of one
    class alone to pass, whatever the size of the sample, and what passes recurs.
    """
    held = {"words": np.zeros((2, 1 << WORD_BITS)), "grams": np.zeros((2, 1 << GRAM_BITS))}
    for text, of in zip(texts, label.astype(int).tolist(), strict=True):
        distinct = np.unique(text)
        held["words"][of, np.unique(inputs.words[distinct])] += 1
        counts = inputs.counts[distinct]
        before = np.cumsum(counts) - counts
        held["grams"][of, np.unique(inputs.grams[np.repeat(inputs.begins[distinct] - before, counts) + np.arange(counts.sum())])] += 1
    size = np.bincount(label.astype(int), minlength=2)[:, None].astype(float)
    found = {}
    for name, with_it in held.items():
        g = np.zeros(with_it.shape[1])
        for seen in (with_it, size - with_it):
            expected = size * seen.sum(0) / size.sum()
            g += 2 * (seen * np.log(np.divide(seen, expected, out=np.ones_like(seen), where=seen > 0))).sum(0)
        found[name] = g >= TELLING
    return found


def train(texts: list[str], toxic: list[int], epochs: int = EPOCHS, seed: int = 11) -> Network:
    """A network that has learned which texts are toxic.

    A label is of a whole text, and a toxic one need not be so throughout. At first all its windows
    count; later its worst one and those already taken for toxic. Without texts of both classes the network stays
    blank and only knows how frequent they are.
    """
    network = Network.new()
    label = np.array(toxic, dtype=np.float32)
    # Without any labels nothing is taken for toxic.
    share = (label.sum() + 1) / (len(label) + 2) if len(label) else 0.25
    network.weights["out0"][0] = np.log(share / (1 - share))
    if not len(label) or label.min() == label.max():
        network.weights["out"][:] = 0
        return network
    rng = np.random.default_rng(seed)
    inputs, numbers = numbered(texts)
    batch = windows(numbers, WIDTH, STRIDE)
    of_text = label[batch.owners]
    trainer = Trainer(network, open_rows=_telling(inputs, numbers, label))
    epochs = max(epochs, -(-UPDATES * BATCH // len(batch.lengths))) if len(batch.lengths) else 0
    warm = max(1, -(-WARM_UP * BATCH // max(1, len(batch.lengths))))
    for epoch in range(epochs):
        if epoch >= warm:
            logits = window_logits(network, inputs, batch)
            worst = np.full(len(texts), -np.inf, np.float32)
            np.maximum.at(worst, batch.owners, logits)
            picked = np.flatnonzero((of_text < 0.5) | (logits >= worst[batch.owners]) | (logits > 0))
        else:
            picked = np.arange(len(batch.lengths))
        trainer.rate, trainer.table_rate = (r * (1 - epoch / epochs) for r in RATES)
        rng.shuffle(picked)
        for begin in range(0, len(picked), BATCH):
            some = np.sort(picked[begin : begin + BATCH])
            few, part = _restricted(inputs, _part(batch, some))
            trainer.step(few, part, of_text[some], np.full(len(some), 1 / len(some), np.float32))
    return network


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; rows with 0 are never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """A network trained on at most `MOST_ROWS` labelled rows of each class, with texts of at most `MOST_BYTES`.

    The rows are those whose ids hash lowest, so they do not depend on the order of the tables. Labels other
    than 0 and 1, and labels without a document, are not used.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    usable = known.where(F.col("id").isNotNull() & (remainder(F.col("id")) != 0))
    ids: dict[int, int] = {}
    for value in (0, 1):
        # TakeOrdered: each task passes on at most that many.
        lowest = usable.where(F.col("toxic") == value).distinct().orderBy(F.xxhash64("id"), "id").limit(MOST_ROWS)
        for row in lowest.collect():
            ids[row["id"]] = max(value, ids.get(row["id"], 0))
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame(list(ids.items()), "id long, toxic int"))
    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    # A text that many rows share is one example.
    sample = (
        rows.where(F.octet_length("text") <= MOST_BYTES)
        .join(wanted, "id")
        .groupBy("text")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("text"), "text")
        .collect()
    )
    return train([r["text"] for r in sample], [r["toxic"] for r in sample])


def _scored(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(weights.value)
        for batch in slices(batches, "text"):
            scores = score_texts(network, list(text_of(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["row", "score"])

    return run


def _with_scores(docs: DataFrame, row: Column, network: Network, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    rows = docs.select(row.alias("row"), col(text_col).cast("string").alias("text"))
    # A network has the same size whatever it was trained on.
    weights = docs.sparkSession.sparkContext.broadcast(network.weights)
    return rows.mapInArrow(_scored(weights), with_first("row", rows, "score double"))


def score_documents(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out (never learned from), score (0 to 1) and predicted (1 from 0.5 on) of each document.

    Only the text is read for a score; null counts as empty, and a text without words has the score of
    nothing seen. A null id is not held out. Rows that repeat an id are scored each; other columns are not read; an empty
    table gives no rows.
    """
    scored = _with_scores(docs, F.struct(col(id_col).cast("long").alias("doc_id")), network, text_col)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(remainder(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted to be toxic; all columns as they were."""
    return _with_scores(docs, packed(docs), network, text_col).where("score < 0.5").select(*unpacked(docs, docs.columns))
