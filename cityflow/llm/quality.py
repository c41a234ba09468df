"""Quality by weak supervision: rules vote or abstain, and what they agree on tells how far to trust each.

Every rule votes for good (1) or bad (-1) or abstains (0) on counts of a document. The votes of all documents
are counted by pattern, of which there are at most 3 to the power of the number of rules;
expectation-maximisation over these counts estimates how each rule votes on good and on bad documents, and the posterior
probability of each pattern decides about its documents.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, slices, small_frame, stored, text_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 8

#: A document with fewer words, or with more of its words in repeated windows (percent), fails outright.
LEAST_WORDS = 20
MOST_REPEATED = 30

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_plain", "n_stutter")


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur at least twice in the list; windows of equal words are equal."""
    n = len(tokens)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(t, len(numbers)) for t in tokens], dtype=np.int64)
    if len(numbers) == n:
        return 0
    width = 1
    while width < window:
        # Names for runs of twice the width (or the window's), equal for equal runs only.
        step = min(width, window - width)
        pairs = ids[: len(ids) - step] * n + ids[step:]
        names, ids = np.unique(pairs, return_inverse=True)
        width += step
        if len(names) == len(ids):
            return 0
    again = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _plain(token: bytes) -> bool:
    """Whether a word is made of letters, but for a mark at its end."""
    return token.isalpha() or token.rstrip(b".,;:!?").decode().isalpha()


def counts_of(text: str | None) -> tuple[int, ...]:
    """The counts of a whole text, in the order of `_COUNTS`; all are zero for a null or empty one."""
    text = text or ""
    tokens = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    distinct = set(tokens)
    return (
        len(tokens),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(tokens),
        len(lines),
        len(distinct),
        sum(map(_plain, tokens)),
        sum(map(operator.eq, tokens[1:], tokens)),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = [counts_of(t) for t in text_of(batch.column(1))]
        arrays = [pa.array([f[i] for f in found], pa.int64()) for i in range(len(_COUNTS))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *_COUNTS])


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts the rules read, one row for each document."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counted, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS))



def _rule(value: Column, good_to: float, bad_from: float) -> Column:
    """Good up to one bound, bad from another on, and no vote between or without a value."""
    return F.coalesce(F.when(value >= bad_from, -1).when(value <= good_to, 1), F.lit(0))


def _per(count: str, of: str) -> Column:
    return F.col(count) / F.when(F.col(of) > 0, F.col(of))


def rules() -> dict[str, Column]:
    """The rules, each a vote over the counts."""
    length = _per("word_chars", "n_words")
    return {
        "long_enough": F.when(F.col("n_words") < LEAST_WORDS, -1).when(F.col("n_words") >= 40, 1).otherwise(0),
        "word_length": F.coalesce(F.when((length < 2.5) | (length > 14), -1).when(length.between(3.5, 11), 1), F.lit(0)),
        "few_symbols": _rule(_per("n_symbols", "n_words"), 0.02, 0.1),
        "few_repeated_lines": _rule(_per("n_dup_lines", "n_lines"), 0.1, 0.35),
        "few_repeated_words": _rule(_per("n_repeat_words", "n_words"), 0.05, 0.3),
        "little_stutter": _rule(_per("n_stutter", "n_words"), 0.02, 0.2),
        "varied_words": _rule(-_per("n_distinct", "n_words"), -0.3, -0.15),
        "plain_words": _rule(-_per("n_plain", "n_words"), -0.9, -0.7),
    }


#: What a rule is taken to say before any vote is seen, as shares of (bad, abstain, good) votes on bad and on good
#: documents, and how many documents that belief counts as.
BELIEF = np.array([[0.4, 0.3, 0.3], [0.05, 0.25, 0.7]])
BELIEF_WEIGHT = 10.0


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents, and how each rule votes on bad and on good ones, by expectation-maximisation.

    The second value is indexed by rule, class (bad, good) and vote (bad, abstain, good). Starts from
    documents without a bad vote as good; a rule is held to vote bad on bad documents at least as often.
    """
    good = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
    share, shown_votes = 0.5, np.tile(BELIEF, (patterns.shape[1], 1, 1))
    cast = patterns[:, :, None] == np.array([-1, 0, 1])
    for _ in range(rounds):
        weight = np.stack([1 - good, good]) * counts
        votes = np.einsum("cp,pjv->jcv", weight, cast) + BELIEF_WEIGHT * BELIEF
        updated = votes / votes.sum(axis=2, keepdims=True)
        turned = updated[:, 0, 0] < updated[:, 1, 0]
        updated[turned] = updated[turned].mean(axis=1, keepdims=True)
        share = float((weight[1].sum() + 1) / (weight.sum() + 2))
        moved = np.abs(updated - shown_votes).max(initial=0)
        shown_votes = updated
        good = posterior(patterns, share, shown_votes)
        if moved < 1e-9:
            break
    return share, shown_votes


def posterior(patterns: np.ndarray, share: float, shown_votes: np.ndarray) -> np.ndarray:
    """Probability of good for each vote pattern."""
    at = patterns.astype(int) + 1
    rule = np.arange(patterns.shape[1])
    odds = np.log(shown_votes[rule, 1, at] / shown_votes[rule, 0, at]).sum(axis=1) + np.log(share / (1 - share))
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Counts, votes and verdict of each document.

    Returns doc_id, the counts, `votes` (array, in the order of `rules()`), `quality` (posterior), `base_failed`
    (too few words, or too many in repeated windows) and `kept` (not base_failed, and quality of at
    least `least`). A null or empty text has no words and fails. Null and repeated ids are rows like any
    other; other columns are not read; an empty table gives no rows.
    """
    counted = stored(text_counts(docs, id_col, text_col))
    voted = counted.withColumn("votes", F.array(*[v.cast("int") for v in rules().values()]))
    # At most 3 ** 8 rows, however many documents there are.
    seen = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    patterns = np.array([r["votes"] for r in seen], dtype=float).reshape(-1, len(rules()))
    share, shown_votes = estimate(patterns, np.array([r["n"] for r in seen], dtype=float))
    chances = posterior(patterns, share, shown_votes).tolist()
    known = small_frame(docs.sparkSession, {"votes": [r["votes"] for r in seen], "quality": chances}, "votes array<int>, quality double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        voted.join(F.broadcast(known), "votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
