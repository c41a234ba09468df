"""Hard negatives by an inverted multi-index.

Vectors are halved, and each half has a codebook of centroids; the two nearest centroids of a vector name its cell. The score
of an anchor with any vector of a cell is at most the sum of two half scores, each the centroid's score plus the
anchor's norm times the radius of that centroid's vectors. The multi-sequence heap visits cells by that bound, highest
first. A search runs twice: some cells from the top give a score that the result has to beat, and then the heap goes
on until the bound falls below it. What was not visited can hold nothing better, so the result is exact.

Cells, and the anchors that visit them, meet in Spark: anchors go in batches of bounded size, and a cell is stored in
blocks of bounded size however many vectors it holds. Of equal vectors with one label only the first six can count
(five positives and the anchor itself); the rest is cut before the shuffle, and equal anchors search once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, shuffle_partitions, stored
from cityflow.llm.vectors import integers, matrix, whole

SEED = 42
#: Vectors that the codebooks are fitted to at most, those with the smallest hashes; all vectors are indexed.
FITTED = 16_384
#: Vectors of a cell on average, and centroids of a codebook at most.
PER_CELL, CENTROIDS = 512, 256
#: Anchors of a batch, and vectors of a block.
BATCH, BLOCK = 256, 1024
#: Vectors in the cells that are visited first.
PROBED = 1024
#: Products of whole numbers up to this size are exact in floating point, 64 of them added.
EXACT = 1 << 23


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, their radii, and how many vectors each cell holds."""

    dims: int
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    held: dict[int, int]

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of vectors."""
        cut = self.books[0].shape[1]
        return vectors[:, :cut], vectors[:, cut:]

    def bounds(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Highest half scores of each vector with the members of each half's centroids."""
        found = []
        for half, book, radius in zip(self.halves(vectors), self.books, self.radii, strict=True):
            norm = np.sqrt((half.astype(float) ** 2).sum(1))
            # A little more for what floating point loses.
            found.append(half @ book.T + norm[:, None] * radius[None, :] + 1e-9 * (1 + norm[:, None] * (np.abs(book).max(initial=0) + radius)[None, :]))
        return found


def multi_sequence(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs of two lists, highest sum first."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    if not len(a) or not len(b):
        return
    # Each row's next column; a row is opened when the one above it is first visited.
    heap = [(-(left[a[0]] + right[b[0]]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, int(a[i]), int(b[j])
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(left[a[i + 1]] + right[b[0]]), i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (-(left[a[i]] + right[b[j + 1]]), i, j + 1))


def visits(index: Index, left: np.ndarray, right: np.ndarray, needed: float | None) -> Iterator[int]:
    """Cells that one anchor visits: first those of some vectors, or after these all that may reach the needed score."""
    width, seen = len(index.books[1]), 0
    for bound, i, j in multi_sequence(left, right):
        cell = i * width + j
        probing = seen < PROBED
        seen += index.held.get(cell, 0)
        if needed is None and not probing:
            return
        if needed is not None and bound < needed:
            return
        if probing == (needed is None) and cell in index.held:
            yield cell


def _nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distances = (vectors * vectors).sum(1)[:, None] - 2.0 * (vectors @ book.T) + (book * book).sum(1)[None, :]
    found = distances.argmin(1)
    return found, np.sqrt(((vectors - book[found]) ** 2).sum(1))


def codebook(vectors: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """Centroids of at most `size` groups of vectors, by a few rounds of means."""
    if not len(vectors):
        return np.zeros((1, vectors.shape[1]))
    distinct = np.unique(vectors, axis=0).astype(float)
    rng = np.random.default_rng(SEED)
    book = distinct[rng.choice(len(distinct), min(size, len(distinct)), replace=False)]
    for _ in range(rounds):
        found, _ = _nearest(vectors.astype(float), book)
        sums = np.zeros_like(book)
        np.add.at(sums, found, vectors)
        count = np.bincount(found, minlength=len(book))[:, None]
        book = np.where(count > 0, sums / np.maximum(count, 1), book)
    return book


def _with_cells(dims: int, books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = books.value
        for batch in batches:
            vectors = matrix(batch.column(3), dims).astype(float)
            cut = one.shape[1]
            (i, r), (j, s) = _nearest(vectors[:, :cut], one), _nearest(vectors[:, cut:], two)
            more = [pa.array(x) for x in (i.astype(np.int32), j.astype(np.int32), r, s, i * len(two) + j)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "i", "j", "r", "s", "cell"])

    return run


def _blocks(dims: int):
    """Blocks of a sorted partition, each of one cell and in order of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 32
        for batch in batches:
            cells = batch.column(0).to_numpy()
            ids, tags, labels = (batch.column(c).to_numpy().astype(np.int64) for c in (1, 2, 3))
            vectors = matrix(batch.column(4), dims)
            edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            made = [(b, min(b + BLOCK, e)) for s, e in zip(edges, edges[1:], strict=False) for b in range(s, e, BLOCK)]
            if made:
                parts = [[x[b:e].tobytes() for b, e in made] for x in (ids, tags, labels)]
                parts.append([_packed(vectors[b:e]) for b, e in made])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(uid, uid + len(made)), pa.int64()),
                        pa.array([int(cells[b]) for b, _ in made], pa.int64()),
                        *[pa.array(x, pa.binary()) for x in parts],
                    ],
                    ["uid", "cell", "ids", "tags", "labels", "vectors"],
                )
            uid += len(made)

    return run


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in two bytes each where they fit, else in four."""
    return numbers.astype(np.int16 if np.abs(numbers).max(initial=0) < 1 << 15 else np.int32).tobytes()


def _unpacked(held: pa.Scalar, dims: int, rows: int) -> np.ndarray:
    data = held.as_buffer()
    return np.frombuffer(data, np.int16 if data.size == 2 * dims * rows else np.int32).reshape(rows, dims)


def _numbers(held: pa.Scalar) -> np.ndarray:
    return np.frombuffer(held.as_buffer(), np.int64)


def _visiting(given, dims: int):
    """For batches of anchors, the cells they visit with the anchors, and their windows, that visit each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*given.value)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, BATCH):
                batch = whole_batch.slice(at, BATCH)
                numbers, labels = (batch.column(c).to_numpy().astype(np.int64) for c in (0, 1))
                vectors, needed = matrix(batch.column(2), dims), batch.column(3).to_pylist()
                parts = batch.column(4).flatten().flatten()
                windows = np.stack([p.to_numpy(zero_copy_only=False).astype(np.int64) for p in parts])
                sizes = batch.column(4).value_lengths().to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                left, right = index.bounds(vectors)
                guests: dict[int, list[int]] = {}
                for q in range(batch.num_rows):
                    for cell in visits(index, left[q], right[q], needed[q]):
                        guests.setdefault(cell, []).append(q)
                place = np.full(batch.num_rows, -1)
                for cell, members in guests.items():
                    place[:] = -1
                    place[members] = np.arange(len(members))
                    own = place[owner] >= 0
                    held = [numbers[members], labels[members], place[owner[own]], *windows[:, own]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([cell], pa.int64()), pa.array([_packed(vectors[members])]), *[pa.array([h.tobytes()]) for h in held]],
                        ["cell", "vectors", *_VISIT],
                    )

    return run


#: What comes with a visit, each as longs: numbers and labels of the anchors; owner, name, lowest and highest score of the windows.
_VISIT = ["numbers", "labels", "owner", "name", "low", "high"]


def _scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    if max(np.abs(anchors).max(initial=0), np.abs(vectors).max(initial=0)) <= EXACT and anchors.shape[1] <= 64:
        return (anchors.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return anchors.astype(np.int64) @ vectors.astype(np.int64).T


_NONE = -(1 << 62)


def _highest(scores: np.ndarray, wanted: int) -> np.ndarray:
    """Positions of the highest scores of each row; of equal ones the first go first."""
    size = scores.shape[1]
    if size <= wanted or np.abs(np.where(scores == _NONE, 0, scores)).max(initial=0) >= 1 << 50:
        return np.argsort(-scores, axis=1, kind="stable")[:, :wanted]
    # One number for score and position; blocks have at most 2^10 rows.
    joined = np.where(scores == _NONE, _NONE, scores * size - np.arange(size)[None, :])
    return np.argpartition(-joined, wanted, axis=1)[:, :wanted]


def _met(dims: int, same: bool, wanted: int):
    """The best of each block for each window of the anchors that visit it: highest scores first, then smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = [batch.column(c)[at] for c in range(batch.num_columns)]
                numbers, labels, owner, name, low, high, ids, tags, others = map(_numbers, row[2:])
                scores = _scores(_unpacked(row[0], dims, len(numbers)), _unpacked(row[1], dims, len(ids)))
                fits = (labels[:, None] == others[None, :]) == same
                fits = fits[owner] & (scores[owner] >= low[:, None]) & (scores[owner] <= high[:, None])
                best = _highest(np.where(fits, scores[owner], _NONE), wanted)
                window = np.repeat(np.arange(len(owner)), best.shape[1])
                spot = best.ravel()
                good = fits[window, spot]
                window, spot = window[good], spot[good]
                found = [numbers[owner[window]], name[window], scores[owner[window], spot], ids[spot], tags[spot]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["number", "name", "score", "vec_id", "tag"])

    return run


@dataclass(frozen=True)
class MultiIndex:
    """An index whose blocks are stored."""

    index: Index
    blocks: DataFrame

    @classmethod
    def over(cls, rows: DataFrame, dims: int) -> MultiIndex:
        """Index of rows of tag, vec_id, label and v."""
        spark = rows.sparkSession
        fitted = rows.orderBy(F.xxhash64("v"), "tag").limit(FITTED).select("v").toArrow().column("v").combine_chunks()
        sample = matrix(fitted, dims)
        size = int(np.clip(round((rows.count() / PER_CELL) ** 0.5), 1, CENTROIDS))
        cut = -(-dims // 2)
        books = codebook(sample[:, :cut], size), codebook(sample[:, cut:], size)
        given = spark.sparkContext.broadcast(books)
        placed = stored(
            rows.select("tag", "vec_id", "label", "v").mapInArrow(
                _with_cells(dims, given), "tag long, vec_id long, label long, v array<int>, i int, j int, r double, s double, cell long"
            )
        )
        radii = []
        for book, number, radius in zip(books, "ij", "rs", strict=True):
            reach = np.zeros(len(book))
            # One row per centroid.
            for row in placed.groupBy(number).agg(F.max(radius).alias("far")).collect():
                reach[row[0]] = row[1]
            radii.append(reach)
        # At most CENTROIDS * CENTROIDS rows.
        held = {r[0]: r[1] for r in placed.groupBy("cell").count().collect()}
        # Ranges of (cell, hash) split a cell that holds many vectors.
        dealt = placed.repartitionByRange(shuffle_partitions(spark), "cell", F.xxhash64("tag")).sortWithinPartitions("cell", "vec_id", "tag")
        blocks = dealt.select("cell", "vec_id", "tag", "label", "v").mapInArrow(
            _blocks(dims), "uid long, cell long, ids binary, tags binary, labels binary, vectors binary"
        )
        return cls(Index(dims, books, (radii[0], radii[1]), held), stored(blocks))

    def _found(self, anchors: DataFrame, same: bool, wanted: int) -> DataFrame:
        """Best rows of the cells that anchors (number, label, v, needed, windows) visit."""
        spark, index = anchors.sparkSession, self.index
        # As plain values: executors have no copy of this module.
        given = spark.sparkContext.broadcast((index.dims, index.books, index.radii, index.held))
        dealt = anchors.select("number", "label", "v", "needed", "windows").repartition(shuffle_partitions(spark), "number")
        binary = ", ".join(f"{name} binary" for name in ["vectors", *_VISIT])
        visiting = dealt.mapInArrow(_visiting(given, index.dims), f"cell long, {binary}")
        # Visits are far larger than the anchors that make them, so both joins are told not to broadcast them.
        where = self.blocks.select("cell", "uid").hint("shuffle_hash")
        blocks = self.blocks.select("uid", "ids", "tags", F.col("labels").alias("others"), F.col("vectors").alias("theirs"))
        met = visiting.join(where, "cell").hint("merge").join(blocks, "uid").select("vectors", "theirs", *_VISIT, "ids", "tags", "others")
        found = met.mapInArrow(_met(index.dims, same, wanted), "number long, name long, score long, vec_id long, tag long")
        return best_of(found, wanted)

    def search(self, anchors: DataFrame, same: bool, wanted: int) -> DataFrame:
        """The first `wanted` rows of each window of the anchors (number, label, v, windows), of their label or of others.

        Returns number, name, score, vec_id and tag; higher scores come first, then smaller ids.
        """
        probe = anchors.withColumn("needed", F.lit(None).cast("double"))
        early = stored(self._found(probe, same, wanted))
        # The score each window has to beat: that of its last row where it is full.
        full = early.groupBy("number", "name").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == wanted)
        known = full.groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("name", "least"))).alias("known"))
        raised = F.transform(
            "windows",
            lambda w: F.struct(
                w["name"].alias("name"), F.coalesce(F.try_element_at("known", w["name"]), w["low"]).alias("low"), w["high"].alias("high")
            ),
        )
        told = anchors.join(known, "number", "left").withColumn("windows", raised)
        least = F.array_min(F.transform("windows", lambda w: w["low"])).cast("double")
        rest = told.withColumn("needed", least).where(F.col("needed").isNotNull()).drop("known")
        return stored(best_of(early.unionByName(self._found(rest, same, wanted)), wanted))


def best_of(rows: DataFrame, wanted: int) -> DataFrame:
    """The first rows of each window; what is too late already in its task is cut before the shuffle."""
    order = Window.partitionBy("number", "name").orderBy(F.desc("score"), "vec_id", "tag")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= wanted).drop("nth")


def _divided(value: Column, by: int) -> Column:
    """Whole quotient, rounded down."""
    below = value - F.pmod(value, F.lit(by).cast("long"))
    return F.call_function("div", below, F.lit(by).cast("long"))


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    labels: int = 10,
    moved: int = 7,
) -> DataFrame:
    """Hard negatives of every anchor (id divisible by `every`) and positive, as `anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    Rows without an id, label or whole vector (null or not finite components) take no part. Where the id is divisible by
    `moved` the label becomes (label + 1) % labels. Components become floor(scale * x), within 2^25 either way; a vector with
    fewer components than the longest ends in zeros. Scores are inner products, higher ones first, then smaller ids.
    Positives are the first other rows of the anchor's label; negatives the first rows of other labels with
    low % <= negative score / positive score <= high % (by products of whole numbers, so none for negative scores). Rows that repeat an id are
    rows of their own, as anchors too. Other columns are not read. An empty table, or one without anchors, gives no rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    number, label = col(id_col).cast("long"), col(label_col).cast("long")
    taken = vectors.where(whole(vector_col) & label.isNotNull() & number.isNotNull()).select(
        number.alias("vec_id"),
        F.when(number % moved == 0, (label + 1) % labels).otherwise(label).alias("label"),
        integers(vector_col, scale).alias("v"),
        F.monotonically_increasing_id().alias("tag"),
    )
    rows = stored(taken)
    # Two halves at least.
    dims = max(rows.agg(F.max(F.size("v"))).first()[0] or 0, 2)
    copies = Window.partitionBy("v", "label").orderBy("vec_id", "tag")
    some = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= max(positives + 1, negatives)).drop("copy")
    index = MultiIndex.over(stored(some), dims)
    key = F.sha2(F.to_json(F.struct("v", "label")), 256)
    anchors = stored(rows.where(F.col("vec_id") % every == 0).select(key.alias("key"), "vec_id", "tag", "label", "v"))
    searching = anchors.groupBy("key").agg(F.min("label").alias("label"), F.min("v").alias("v"))
    searching = stored(searching.withColumn("number", F.monotonically_increasing_id()))
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("name"), F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high")))
    found = index.search(searching.withColumn("windows", any_score), True, positives + 1)
    windows = found.select("number", F.col("score").alias("name")).distinct()
    # Between the least whole number of at least low % and the greatest of at most high %.
    lowest = -_divided(-F.col("name") * low, 100)
    windows = windows.select("number", "name", lowest.alias("low"), _divided(F.col("name") * high, 100).alias("high")).where("low <= high")
    # As many windows as positives at most.
    wanted = windows.groupBy("number").agg(F.collect_list(F.struct("name", "low", "high")).alias("windows"))
    against = index.search(searching.join(wanted, "number"), False, negatives)
    nearest = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id", "tag")))
    lists = against.groupBy("number", "name").agg(nearest.alias("negatives"))
    paired = found.join(lists.withColumnRenamed("name", "score"), ["number", "score"], "left")
    order = F.struct((-F.col("score")).alias("order"), "vec_id", "tag", "negatives")
    told = paired.groupBy("number").agg(F.sort_array(F.collect_list(order)).alias("positives")).join(searching.select("number", "key"), "number")
    others = F.slice(F.filter("positives", lambda p: p["tag"] != F.col("tag")), 1, positives)
    each = anchors.select("key", "vec_id", "tag").join(told, "key").select(F.col("vec_id").alias("anchor_id"), F.explode(others).alias("p"))
    ranked = each.select("anchor_id", "p", F.posexplode("p.negatives").alias("nth", "n"))
    return ranked.select(
        "anchor_id",
        F.col("p.vec_id").alias("positive_id"),
        (F.col("nth") + 1).cast("int").alias("rank"),
        F.col("n.vec_id").alias("negative_id"),
        (-F.col("p.order")).alias("positive_score"),
        (-F.col("n.order")).alias("negative_score"),
    )
