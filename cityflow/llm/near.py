"""Near copies by the Jaccard similarity of their word shingles, exactly.

All documents order shingles alike, rare ones first. Two sets of similarity 0.8 or more share one of their first shingles
(the first n - ceil(0.8 n) + 1 of n), and what is left of both from the first shared one on is large enough for the overlap that
the similarity takes; pairs for which it is not are never looked at, so that pages which share a template but not their
own words do not meet. A shingle that only one document has among its first leaves with the one shuffle that finds this out.

Pairs are compared in rounds. The first are those that SimHash finds (`simhash.py`), by fingerprints of the same shingles; two bits are
next to identity, so that it finds few of the pairs, and what it misses is found by shingles. In the next round, every document is compared with a few of those it is beside, or that come
first, under the most keys; two more compare documents with one of another component that they meet. In the last, only
documents that are not connected yet are compared, all that the keys allow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import UPPER_TO_LOWER, WorkTables, bounded_batches, col, packed, shuffle_partitions, shuffles_dropped, slices, stored, text_of, unpacked
from cityflow.llm.simhash import candidates, roots

SEED = 42
#: Similarity as a fraction.
OVER, UNDER = 4, 5
#: Counters that say how frequent a shingle is, roughly; they only order shingles.
COUNTERS = 1 << 17
#: Documents of a key that are compared in one go; a key with more is dealt to pairs of lots.
TOGETHER = 20_000
#: Documents that each one is compared with in the first round.
PARTNERS = 3
#: How often components that meet are linked further before all that is not connected is compared.
ROUNDS = 2
#: Distinct buckets that shingles are counted by, to rule pairs out without their sets.
BUCKETS = 64

_ODD = np.random.default_rng(SEED).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashes of the shingles of texts: words are split at ASCII white space, A-Z is lower-cased."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        """In order, repeats included; a text with fewer words than a shingle is one shingle, also one without words."""
        tokens = text.encode().translate(UPPER_TO_LOWER).split()
        if len(tokens) <= self.words:
            return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)], dtype=np.uint64)
        known = self.known
        if len(known) > 400_000:
            known.clear()
        for token in set(tokens).difference(known):
            # Mixed by an odd number each, so that sums tell places apart.
            known[token] = xxhash.xxh64_intdigest(token, SEED)
        hashes = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
        n = len(tokens) - self.words + 1
        total = hashes[:n] * _ODD[0]
        for i in range(1, self.words):
            total += hashes[i : i + n] * _ODD[i]
        return _mixed(total)

    def distinct(self, text: str) -> np.ndarray:
        """Ascending, each once."""
        return np.unique(self.of(text))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets are alike enough."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * UNDER >= OVER * (len(a) + len(b) - both)


def _counted(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingles(words), np.zeros(COUNTERS, np.int64)
        for batch in slices(batches, "text"):
            held = [shingles.of(text) for text in text_of(batch.column(0))]
            counts += np.bincount((np.concatenate(held) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["counter", "n"])

    return run


def first_shingles(found: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Those of a set that any similar set shares one of, in the common order."""
    wanted = len(found) - -(-OVER * len(found) // UNDER) + 1
    counts = often[found % np.uint64(COUNTERS)]
    if wanted < len(found):
        # Only what is not beyond the last wanted count is put in order.
        few = np.flatnonzero(counts <= np.partition(counts, wanted - 1)[wanted - 1])
        found, counts = found[few], counts[few]
    return found[np.lexsort((found, counts))[:wanted]]


def _keyed(words: int, given):
    """(key, tag, n, place) of the first shingles of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, often = Shingles(words), given.value
        for batch in slices(batches, "text"):
            keys, sizes = [], []
            for text in text_of(batch.column(1)):
                found = shingles.distinct(text)
                sizes.append(len(found))
                keys.append(first_shingles(found, often))
            lengths = np.array([len(k) for k in keys])
            places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            columns = [
                np.concatenate(keys).view(np.int64),
                np.repeat(batch.column(0).to_numpy(), lengths),
                np.repeat(np.array(sizes, np.int32), lengths),
                places.astype(np.int32),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "tag", "n", "place"])

    return run


def _may_meet(n: Column, place: Column, m: Column, spot: Column) -> Column:
    """Whether what is left of two sets from a shared shingle on suffices, if it is the first they share.

    Similarity OVER / UNDER takes an overlap of OVER / (OVER + UNDER) of both sizes together.
    """
    return F.least(n - place, m - spot) * (OVER + UNDER) >= (n + m) * OVER


def _rivals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of a sorted partition that share a key and lot, may be similar and are not connected yet."""

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        # Columns: tag, n, place, root, side; of different lots only pairs across are this group's.
        tag, n, place, root, side = rows.T
        kinds, owner = np.unique(root, return_inverse=True)
        if len(kinds) < 2:
            return
        # Whatever is connected to most of the others need not be compared with them, only with the rest.
        most = np.bincount(owner).argmax()
        rest = np.flatnonzero(owner != most)
        two_lots = side.any() and not side.all()
        for i in rest.tolist():
            fits = (owner != owner[i]) & (np.minimum(n[i] - place[i], n - place) * (OVER + UNDER) >= (n[i] + n) * OVER)
            # Pairs within the rest are seen from both; keep one.
            fits &= (owner == most) | (tag > tag[i])
            if two_lots:
                fits &= side != side[i]
            found = np.flatnonzero(fits)
            if len(found):
                own = np.full(len(found), tag[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(own, tag[found])), pa.array(np.maximum(own, tag[found]))], ["a", "b"]
                )

    held: list[np.ndarray] = []
    last = None
    for batch in batches:
        columns = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(8)], axis=1)
        if not len(columns):
            continue
        edges = [0, *(np.flatnonzero((columns[1:, :3] != columns[:-1, :3]).any(axis=1)) + 1).tolist(), len(columns)]
        for begin, end in zip(edges, edges[1:], strict=False):
            name = tuple(columns[begin, :3].tolist())
            if held and name != last:
                yield from pairs(np.concatenate(held))
                held = []
            held.append(columns[begin:end, 3:])
            last = name
    if held:
        yield from pairs(np.concatenate(held))


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in slices(batches, "text"):
            found = [shingles.distinct(t) for t in text_of(batch.column(1))]
            counts = [np.bincount((f >> np.uint64(58)).astype(np.int64), minlength=BUCKETS).astype(np.int32).tobytes() for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f.tobytes() for f in found], pa.binary()), pa.array(counts, pa.binary())], ["tag", "shingles", "counts"]
            )

    return run


def _in_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose counts by bucket leave room for the overlap they need."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32).reshape(-1, BUCKETS).astype(np.int64) for c in (2, 3))
        room = np.minimum(x, y).sum(1)
        fits = room * UNDER >= OVER * (x.sum(1) + y.sum(1) - room)
        yield batch.select([0, 1]).filter(pa.array(fits))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        alike = [
            similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
            for x, y in zip(batch.column(2), batch.column(3), strict=True)
        ]
        yield batch.select([0, 1]).filter(pa.array(alike, pa.bool_()))


def _links(texts: DataFrame, found: DataFrame, words: int) -> DataFrame:
    """Those of the pairs (a, b) that are alike enough."""
    tables = WorkTables()
    pairs = tables.put(found.distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("tag")).distinct()
    sets = tables.put(
        texts.join(wanted, "tag", "left_semi").select("tag", "text").mapInArrow(_sets(words), "tag long, shingles binary, counts binary")
    )

    def with_both(rows: DataFrame, column: str) -> DataFrame:
        one, two = (sets.select(F.col("tag").alias(side), F.col(column).alias(name)) for side, name in (("a", "x"), ("b", "y")))
        # The sets of b travel to a; a row per pair, and not two, is shuffled.
        return rows.join(two, "b").join(one, "a").select("a", "b", "x", "y")

    near = tables.put(with_both(pairs, "counts").mapInArrow(_in_reach, "a long, b long"))
    alike = stored(with_both(near, "shingles").mapInArrow(_checked, "a long, b long"))
    tables.drop(pairs, sets, near)
    return alike


def near_copies(texts: DataFrame, words: int) -> DataFrame:
    """Links (a, b) that connect what all pairs of similar `text` connect, by `tag`."""
    spark = texts.sparkSession
    counted = texts.select("text").mapInArrow(_counted(words), "counter int, n long")
    # At most COUNTERS rows.
    sums = counted.groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(COUNTERS, np.int64)
    often[sums.column("counter").to_numpy()] = sums.column("n").to_numpy()
    given = spark.sparkContext.broadcast(often)
    keyed = texts.select("tag", "text").mapInArrow(_keyed(words, given), "key long, tag long, n int, place int")
    of_key = Window.partitionBy("key").orderBy("n", "tag")
    entry = F.struct("tag", "n", "place")
    ranked = keyed.withColumns({"before": F.lag(entry).over(of_key), "after": F.lead("tag").over(of_key), "head": F.first(entry).over(of_key)})
    tables = WorkTables()
    # A key of one document alone meets nothing.
    shared = tables.put(ranked.where(F.col("before").isNotNull() | F.col("after").isNotNull()).drop("after"))

    def beside(other: str) -> DataFrame:
        fits = _may_meet(F.col("n"), F.col("place"), F.col(f"{other}.n"), F.col(f"{other}.place"))
        return shared.where(F.col(other).isNotNull() & fits & (F.col(f"{other}.tag") != F.col("tag"))).select("tag", F.col(f"{other}.tag").alias("partner"))

    def met_most(met: DataFrame) -> DataFrame:
        """The few partners of each document that it meets under the most keys: near copies meet under many."""
        often_met = met.groupBy("tag", "partner").agg(F.count("*").alias("times"))
        of_tag = Window.partitionBy("tag").orderBy(F.desc("times"), "partner")
        best = often_met.withColumn("nth", F.row_number().over(of_tag)).where(F.col("nth") <= PARTNERS)
        return best.select(F.least("tag", "partner").alias("a"), F.greatest("tag", "partner").alias("b"))

    # What SimHash connects and is alike, then what documents meet most often.
    printed = _links(texts, candidates(texts, words), words)
    early = stored(printed.unionByName(_links(texts, met_most(beside("before").unionByName(beside("head"))), words)))
    entries = shared.select("key", "tag", "n", "place")
    for again in range(ROUNDS + 1):
        rooted = roots(early).withColumnRenamed("u", "tag")
        placed = tables.put(entries.join(rooted, "tag", "left").withColumn("root", F.coalesce("root", "tag")))
        one = F.struct("root", "n", "place", "tag")
        met = placed.groupBy("key").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.count("*").alias("size")).where("low.root <> high.root")
        if again == ROUNDS:
            break
        # Under each key, documents are compared with one of the first component there, and its own with one of the last.
        other = F.when(F.col("root") == F.col("low.root"), F.col("high")).otherwise(F.col("low"))
        across = placed.join(met, "key").withColumn("other", other)
        fits = _may_meet(F.col("n"), F.col("place"), F.col("other.n"), F.col("other.place"))
        found = _links(texts, met_most(across.where(fits).select("tag", F.col("other.tag").alias("partner"))), words)
        early = stored(early.unionByName(found))
        tables.drop(placed)
    tables.drop(shared)
    lots = F.ceil(F.col("size") / TOGETHER).cast("int")
    apart = placed.join(met.select("key", lots.alias("lots")), "key").withColumn("lot", F.pmod(F.xxhash64("tag"), F.col("lots")).cast("int"))
    # Each lot meets itself and every other one once; the side says which of the two a document is of.
    spread = apart.select("*", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("other"))
    groups = spread.select(
        "key", F.least("lot", "other").alias("one"), F.greatest("lot", "other").alias("two"), "tag", "n", "place", "root", (F.col("lot") > F.col("other")).cast("int").alias("side")
    )
    dealt = groups.repartition(shuffle_partitions(spark), "key", "one", "two").sortWithinPartitions("key", "one", "two")
    late = _links(texts, dealt.mapInArrow(_rivals, "a long, b long"), words)
    tables.drop(placed)
    return early.unionByName(late)


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """One document of each class of near copies, all columns as they were: the one with the smallest id.

    A class is what pairs of a Jaccard similarity of at least 0.8 connect. Without any id in a class, and among rows that
    repeat the smallest one, it is any one row. A null text is empty; texts without words are alike. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(packed(docs).alias("row"), col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("tag"))
    # Written, so the numbers stay what they are.
    marked = stored(rows)
    text: Column = F.col("row").getField(text_col).cast("string")
    texts = marked.select("tag", text.alias("text"))
    with shuffles_dropped(docs.sparkSession):
        classes = roots(near_copies(texts, words)).withColumnRenamed("u", "tag")
    # Only members of classes with more than one document are compared.
    placed = marked.select("id", "tag").join(classes, "tag", "left").withColumn("root", F.coalesce("root", "tag"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tag"))
    stays = placed.groupBy("root").agg(first.alias("first")).select("first.tag")
    return marked.join(stays, "tag", "left_semi").select(*unpacked(marked, docs.columns))
