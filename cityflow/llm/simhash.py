"""SimHash near-dedup with pigeonring filtering.

A fingerprint is cut into a ring of five segments. If two fingerprints differ in at most two bits, then
some segment starts a chain whose first k segments together differ in at most 2k/5 bits for every k: none
in the first two, at most one in the first four, so at least one of the third and the fourth is
equal as well. Each fingerprint is therefore looked up under ten keys, (first, second and third) and
(first, second and fourth) segment from each of five starts, of 38 bits or more. Within a key, pairs that break
the chain's budget are pruned before the Hamming check. Of the links in a key only as many are passed on as it
takes to connect what they connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import UPPER_TO_LOWER, WorkTables, bounded_batches, col, packed, shuffle_partitions, slices, stored, unpacked, with_first

DISTANCE = 2
#: Widths of the ring's segments, from the lowest bit.
WIDTHS = (13, 13, 13, 13, 12)
SEED = 42
#: Keys with more fingerprints than this meet over shared neighbours instead of pair by pair.
PAIRWISE = 64

_STARTS = np.concatenate([[0], np.cumsum(WIDTHS)[:-1]])
_MASKS = [np.uint64(((1 << w) - 1) << int(s)) for w, s in zip(WIDTHS, _STARTS, strict=True)]
_ONE = np.uint64(1)


def fingerprint(text: str | bytes, words: int = 3) -> int:
    """SimHash of the word shingles of a text: words are split at ASCII white space, A-Z is lower-cased."""
    data = text.encode() if isinstance(text, str) else text
    tokens = data.translate(UPPER_TO_LOWER).split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    begins = [0, *ends[: -words].tolist()]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(line[b:e], SEED) for b, e in zip(begins, (ends[words - 1 :] - 1).tolist(), strict=True)], dtype="<u8")
    set_in = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in batch.column(1)], dtype="<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view("<i8"))], ["row", "fp"])

    return compute


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ten keys of each fingerprint; a key's number is in its four highest bits."""
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view("<u8")
        for number in range(10):
            chain = _chain(number)
            key = np.zeros_like(prints)
            shift = np.uint64(0)
            for s in chain:
                key |= ((prints & _MASKS[s]) >> np.uint64(_STARTS[s])) << shift
                shift += np.uint64(WIDTHS[s])
            key |= np.uint64(number) << np.uint64(59)
            yield pa.RecordBatch.from_arrays([pa.array(key.view("<i8")), batch.column(0)], ["key", "fp"])


def _chain(number: int) -> tuple[int, int, int]:
    """Segments that a key is made of."""
    start, third = divmod(number, 2)
    return start, (start + 1) % 5, (start + 2 + third) % 5


def _bits(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values).astype(np.int64)


def _forest(prints: np.ndarray, number: int) -> list[tuple[int, int]]:
    """Links among fingerprints that share a key, as a forest that connects the same ones."""
    parent = np.arange(len(prints))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []

    def join(i: int, j: int) -> None:
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            links.append((i, j))

    start = _chain(number)[0]
    if len(prints) <= PAIRWISE:
        left, right = np.triu_indices(len(prints), 1)
        differ = prints[left] ^ prints[right]
        so_far = np.zeros(len(differ), dtype=np.int64)
        # Cumulative differences of the chain, segment by segment, within their share of the distance.
        for length in range(1, 6):
            so_far += _bits(differ & _MASKS[(start + length - 1) % 5])
            fits = so_far * 5 <= DISTANCE * length
            left, right, differ, so_far = left[fits], right[fits], differ[fits], so_far[fits]
        near = _bits(differ) <= DISTANCE
        for i, j in zip(left[near].tolist(), right[near].tolist(), strict=True):
            join(i, j)
        return links
    # Two fingerprints differ in at most two bits exactly if they have a common neighbour at one bit or none,
    # so meeting at neighbours connects the same ones with work in proportion to the key's size.
    free = [b for b in range(64) if not any(int(_MASKS[s]) >> b & 1 for s in _chain(number))]
    around = np.concatenate([prints, *[prints ^ (_ONE << np.uint64(b)) for b in free]])
    owner = np.tile(np.arange(len(prints)), len(free) + 1)
    order = np.argsort(around, kind="stable")
    same = np.flatnonzero(around[order][1:] == around[order][:-1])
    for i, j in zip(owner[order][same].tolist(), owner[order][same + 1].tolist(), strict=True):
        join(i, j)
    return links


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of the keys of a sorted partition."""
    held_keys, held_prints = np.empty(0, dtype="<i8"), np.empty(0, dtype="<i8")

    def of(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch | None:
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        found = []
        for begin, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            group = prints[begin : begin + size]
            number = int(keys[begin].view("<u8") >> np.uint64(59))
            found += [(int(group[i]), int(group[j])) for i, j in _forest(group.view("<u8"), number)]
        if not found:
            return None
        a, b = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy(zero_copy_only=False)])
        prints = np.concatenate([held_prints, batch.column(1).to_numpy(zero_copy_only=False)])
        if not len(keys):
            continue
        # The last key may go on in the next batch.
        cut = int(np.searchsorted(keys, keys[-1]))
        held_keys, held_prints = keys[cut:].copy(), prints[cut:].copy()
        if cut and (out := of(keys[:cut], prints[:cut])) is not None:
            yield out
    if len(held_keys) and (out := of(held_keys, held_prints)) is not None:
        yield out


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints `fp` of two or fewer differing bits."""
    n = shuffle_partitions(prints.sparkSession)
    keyed = prints.mapInArrow(_keys, "key long, fp long")
    dealt = keyed.repartition(n, "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(_links, "a long, b long").distinct()


def candidates(texts: DataFrame, words: int) -> DataFrame:
    """Pairs (a, b) of `tag` that connect the texts whose fingerprints connect, for an exact check to follow.

    Texts of one fingerprint are a chain in the order of their numbers, and the first ones of linked fingerprints meet, so that
    there are fewer pairs than texts and links.
    """
    printed = texts.select(F.col("tag").alias("row"), "text").mapInArrow(_fingerprints(words), "row long, fp long")
    # Written, as texts are only read once for this.
    prints = stored(printed.select(F.col("row").alias("tag"), "fp"))
    chained = prints.withColumn("a", F.lag("tag").over(Window.partitionBy("fp").orderBy("tag")))
    same = chained.where(F.col("a").isNotNull()).select("a", F.col("tag").alias("b"))
    first = prints.groupBy("fp").agg(F.min("tag").alias("tag"))
    one, two = (first.select(F.col("fp").alias(side), F.col("tag").alias(name)) for side, name in (("a", "x"), ("b", "y")))
    across = near_links(first.select("fp")).join(one, "a").join(two, "b")
    return same.unionByName(across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def roots(links: DataFrame) -> DataFrame:
    """Node and smallest node of its component, for each node of a link but the smallest ones themselves.

    Alternates between tying larger neighbours and smaller neighbours of a node to the smallest one, until
    nothing moves; each round is a few joins on the node and is written to the shared folder.
    """
    tables = WorkTables()
    edges = tables.put(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = tables.put(smaller.unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        tables.drop(edges)
        edges = moved
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select("u", F.col("v").alias("root"))
        before = now


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, row: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint and a number of their own, and the class of each fingerprint with its smallest id."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(row.alias("row"), col(id_col).cast("long").alias("id")).alias("row"), col(text_col).cast("string").alias("text"))
    printed = rows.mapInArrow(_fingerprints(words), with_first("row", rows, "fp long"))
    # Written, so the numbers stay what they are.
    marked = stored(printed.select("row.row", "row.id", "fp", F.monotonically_increasing_id().alias("tag")))
    prints = stored(marked.groupBy("fp").agg(F.min("id").alias("least_id")))
    rooted = roots(near_links(prints.select("fp")))
    classes = prints.join(rooted, F.col("fp") == F.col("u"), "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    smallest = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return marked, classes.join(smallest, "root").select("fp", "root", "component_id")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """The class of near copies each document belongs to.

    Returns one row for each row of `docs`: doc_id, fingerprint (16 hexadecimal digits) and component_id, the
    smallest doc_id that links of two or fewer differing bits lead to. A text with fewer words than a
    shingle is one shingle; one without words, or null, has fingerprint zero and is linked like any other. A class
    without any id has a null component. Other columns are not read. An empty table gives no rows.
    """
    marked, classes = _classes(docs, id_col, text_col, words, F.lit(None).cast("int"))
    return marked.join(classes, "fp").select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One document of each class, all columns as they were: the one with the smallest id.

    Without any id in a class, and among rows that repeat the smallest one, it is any one row. Other edge cases as
    in `simhash_classes`. Texts are shuffled once, to meet the numbers of the rows that stay.
    """
    marked, classes = _classes(docs, id_col, text_col, words, packed(docs))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tag"))
    stays = marked.select("fp", "id", "tag").join(classes, "fp").groupBy("root").agg(first.alias("first")).select("first.tag")
    return marked.join(stays, "tag", "left_semi").select(*unpacked(marked, docs.columns))
