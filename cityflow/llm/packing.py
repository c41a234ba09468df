"""Best-fit packing of documents into sequences by linear grouping.

Lengths are whole numbers up to the capacity, so the plan works on how many pieces there are of each length, and
its size does not grow with the documents:

1. Large lengths are grouped so that each group has equally many pieces, and rounded up to the group's longest.
2. Few sizes are left; the best mix of fillings (how many of each size go into a sequence) is found by
   generating columns: a knapsack over the current prices proposes a filling until none pays.
3. Documents take the places of their group, the longest first, which frees what the rounding had added.
4. Sequences that are still not filled well are opened again, and small lengths and what was in these go, longest
   first, where they fit best. How well is well enough is tried out on the counts.

The plan is a list of runs (pieces number a to b of this length go to these sequences), by which
each piece finds its place from its length and its number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, slices, small_frame, stored, text_of
from cityflow.llm.tokens import encode

CAPACITY = 1024
#: Id behind each document.
END = 2
#: Lengths over this share of the capacity are large.
LARGE = 1 / 4
#: Groups that large lengths are rounded up in.
GROUPS = 128
#: Unused shares of a sequence beyond which it is opened again, tried one after the other.
OPENED = (0.0, 1 / 512, 1 / 128, 1 / 32, 1 / 8, 1.0)


@dataclass(frozen=True)
class Run:
    """`bins` sequences from number `first` on with the same `lengths` in them."""

    first: int
    bins: int
    lengths: tuple[int, ...]


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The filling of the highest price, any number of each size."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = sizes <= room
        worth = np.where(fits, best[room - np.where(fits, sizes, 0)] + prices, -1.0)
        choice = int(np.argmax(worth)) if len(sizes) else -1
        if choice >= 0 and worth[choice] > best[room - 1] + 1e-12:
            best[room], taken[room] = worth[choice], choice
        else:
            best[room] = best[room - 1]
    filling = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
            continue
        filling[taken[room]] += 1
        room -= int(sizes[taken[room]])
    return float(best[capacity]), filling


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """Fillings of a few sizes and how often each is used, so that few sequences hold all (a linear program)."""
    size, need = np.array(sizes), np.array(counts, dtype=float)
    columns = np.diag((capacity // size).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    amounts = inverse @ need
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        worth, filling = _knapsack(size, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        direction = inverse @ filling
        ratios = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
        leaves = int(np.argmin(ratios))
        step = ratios[leaves]
        amounts = np.maximum(amounts - step * direction, 0)
        amounts[leaves] = step
        columns[:, leaves] = filling
        pivot = inverse[leaves] / direction[leaves]
        inverse = inverse - np.outer(direction, pivot)
        inverse[leaves] = pivot
    return [(columns[:, j].astype(np.int64), float(amounts[j])) for j in range(len(sizes)) if amounts[j] > 1e-9]


def grouped(histogram: dict[int, int], groups: int) -> list[list[int]]:
    """Lengths in groups of about equally many pieces, shortest first."""
    share = max(1, -(-sum(histogram.values()) // groups))
    out: list[list[int]] = []
    filled = share
    for length in sorted(histogram):
        if filled >= share:
            out.append([])
            filled = 0
        out[-1].append(length)
        filled += histogram[length]
    return out


def _large(histogram: dict[int, int], capacity: int, groups: int) -> dict[tuple[int, ...], int]:
    """Sequences, by the lengths in them, for the large lengths."""
    parts = grouped(histogram, groups)
    if not parts:
        return {}
    tops = [g[-1] for g in parts]
    fillings = configurations(tops, [sum(histogram[n] for n in g) for g in parts], capacity)
    # Whole numbers of sequences; what rounding down leaves open is filled as well as it can be.
    slots = [(f, int(times)) for f, times in fillings if times >= 1]
    left = np.array([sum(histogram[n] for n in g) for g in parts]) - sum((f * t for f, t in slots), np.zeros(len(parts), dtype=np.int64))
    while left.max(initial=0) > 0:
        filling, room = np.zeros(len(parts), dtype=np.int64), capacity
        for j in range(len(parts) - 1, -1, -1):
            filling[j] = max(0, min(left[j], room // tops[j]))
            room -= filling[j] * tops[j]
        times = int(min(left[j] // filling[j] for j in np.flatnonzero(filling)))
        slots.append((filling, times))
        left = left - filling * times
    # Documents take the places of their group, longest first; equal places are handed out a run at a time.
    stock = [[[n, histogram[n]] for n in reversed(g)] for g in parts]
    bins: dict[tuple[int, ...], int] = defaultdict(int)
    for filling, times in sorted(slots, key=lambda s: -s[1]):
        open_runs = [(times, ())]
        for j in np.flatnonzero(filling).tolist():
            for _ in range(int(filling[j])):
                taken = []
                for many, lengths in open_runs:
                    while many and stock[j]:
                        length, have = stock[j][0]
                        used = min(many, have)
                        taken.append((used, (*lengths, length)))
                        many -= used
                        stock[j][0][1] -= used
                        if not stock[j][0][1]:
                            stock[j].pop(0)
                    if many:
                        taken.append((many, lengths))
                open_runs = taken
        for many, lengths in open_runs:
            if lengths:
                bins[tuple(sorted(lengths, reverse=True))] += many
    return bins


def _best_fit(bins: dict[tuple[int, ...], int], histogram: dict[int, int], capacity: int) -> dict[tuple[int, ...], int]:
    """Adds lengths, longest first, each where it leaves the least room; equal sequences are filled together."""
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for lengths, many in bins.items():
        by_room[capacity - sum(lengths)][lengths] = many

    def put(lengths: tuple[int, ...], many: int) -> None:
        if many:
            room = by_room[capacity - sum(lengths)]
            room[lengths] = room.get(lengths, 0) + many

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        for room in sorted(r for r in by_room if r >= length):
            each = room // length
            while todo and by_room[room]:
                lengths, many = by_room[room].popitem()
                full, rest = divmod(todo, each)
                if full >= many:
                    put(lengths + (length,) * each, many)
                    todo -= many * each
                else:
                    put(lengths + (length,) * each, full)
                    put(lengths + (length,) * rest, 1 if rest else 0)
                    put(lengths, many - full - (1 if rest else 0))
                    todo = 0
            if not todo:
                break
        if todo:
            each = capacity // length
            full, rest = divmod(todo, each)
            put((length,) * each, full)
            put((length,) * rest, 1 if rest else 0)
    return {lengths: many for room in by_room.values() for lengths, many in room.items()}


def _reopened(bins: dict[tuple[int, ...], int], small: dict[int, int], capacity: int, share: float) -> dict[tuple[int, ...], int]:
    """Best fit of small lengths and of those in sequences with more than a share of their room left."""
    loose = defaultdict(int, small)
    kept = {}
    for lengths, many in bins.items():
        if capacity - sum(lengths) > share * capacity:
            for length in lengths:
                loose[length] += many
        else:
            kept[lengths] = many
    return _best_fit(kept, loose, capacity)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> list[Run]:
    """Sequences for the pieces of each length; every piece has exactly one place."""
    limit = int(capacity * large)
    whole = {n: c for n, c in histogram.items() if n > limit and c}
    small = {n: c for n, c in histogram.items() if n <= limit and c}
    filled = _large(whole, capacity, groups)
    tried = [_reopened(filled, small, capacity, share) for share in OPENED]
    bins = min(tried, key=lambda b: sum(b.values()))
    runs, first = [], 0
    for lengths, many in sorted(bins.items()):
        runs.append(Run(first, many, lengths))
        first += many
    return runs


def _places(runs: list[Run]) -> dict[str, list[int]]:
    """Which pieces of a length go where: a row for each length of each run."""
    used: dict[int, int] = defaultdict(int)
    rows: dict[str, list[int]] = {n: [] for n in ("length", "begin", "end", "first", "each", "at")}
    for run in runs:
        at = 0
        for length in sorted(set(run.lengths), reverse=True):
            each = run.lengths.count(length)
            begin = used[length]
            used[length] += each * run.bins
            for name, value in zip(rows, (length, begin, used[length], run.first, each, at), strict=True):
                rows[name].append(value)
            at += each * length
    return rows


def _pieces(path: str, capacity: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokenizes and cuts; numbers the pieces of each length within the task."""
        part = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        seen: dict[int, int] = defaultdict(int)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in slices(batches, "text"):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode(path, list(text_of(batch.column(1)))), strict=True):
                ids += end
                total = len(ids) // 4
                start = 0
                # The rest of a long document is its first piece.
                for number, stop in enumerate(range((total - 1) % capacity + 1, total + 1, capacity)):
                    length = stop - start
                    rows.append((doc, number, start, length, zlib.crc32(ids[4 * start : 4 * stop]), part, seen[length]))
                    seen[length] += 1
                    start = stop
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return cut


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Where each piece of each document goes.

    A document is the ids of its text by the tokenizer file at `tokenizer` (a path that is the same on all
    machines) and `end_id`; one longer than `capacity` is cut, and its first piece is the shorter one. Returns one row
    for each piece: doc_id, piece, start (ids of the document before it), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit), sequence_id and offset (place in the sequence; gapless). A null text is
    empty, so its only id is the last one. Null and repeated ids are rows like any other; other columns are
    not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    pieces = stored(
        rows.mapInArrow(
            _pieces(tokenizer, capacity, end_id),
            "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long",
        )
    )
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(histogram, capacity))
    # Its rows follow the number of lengths and groups, not of documents.
    runs = F.broadcast(small_frame(spark, places, "run_length long, begin long, end long, first long, each long, at long"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    here = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("end"))
    past = F.col("rank") - F.col("begin")
    return ranked.join(runs, here).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.expr("(rank - begin) div each")).alias("sequence_id"),
        (F.col("at") + past % F.col("each") * F.col("length")).alias("offset"),
    )
