"""Exact dedup by content sort.

Sampled splitters range-partition the rows by (start of the normalised text, its SHA-256, id), an
external sort puts equal texts side by side, and neighbours are compared in full. The id is part of the
key, so a text that a third of all rows share is spread over many ranges; what a run of equal texts
has in each range is put together from two rows per range. Splitters carry the first characters and
the digest of a text instead of all of it, so that a sample stays small however long the texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import ascii_lower, bounded_batches, col, one_array, packed, shuffle_partitions, small_frame, stored, unpacked, with_first

#: Characters of a text in the sort key, in front of its digest.
PREFIX = 16

FIRST, LAST = 1, 2  # A run of equal texts that touches the lower or the upper border of its range.


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the sort key: start and digest of the normalised text."""
    for batch in batches:
        row, ids, texts = (one_array(batch.column(i)) for i in range(3))
        normal = ascii_lower(texts)
        digests = [hashlib.sha256(t.as_buffer() if t.is_valid else b"").digest() for t in normal]
        starts = pc.fill_null(pc.utf8_slice_codeunits(normal, 0, PREFIX), "")
        yield pa.RecordBatch.from_arrays(
            [row, ids, starts.cast(pa.string()), pa.array(digests, pa.binary())], ["row", "id", "start", "digest"]
        )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the runs of equal texts of a sorted range.

    Holds back the ids of one run until it ends; a range, and so a run in it, has a bounded number of rows.
    """
    part = TaskContext.get().partitionId()
    pending: list[pa.RecordBatch] = []  # rows of the run that is open
    last_text = None
    at_border = FIRST
    names = ["row", "id", "digest", "first_id", "n", "head", "part", "border"]

    def closed(chunks: list[pa.RecordBatch], changes: np.ndarray, border_first: int, border_last: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(chunks).combine_chunks()
        starts = np.concatenate([[0], changes])
        counts = np.diff(np.concatenate([starts, [rows.num_rows]]))
        run = np.repeat(np.arange(len(starts)), counts)
        ids = one_array(rows.column("id"))
        border = np.zeros(len(starts), dtype=np.int32)
        border[0] |= border_first
        border[-1] |= border_last
        head = np.zeros(rows.num_rows, dtype=bool)
        head[starts] = True
        arrays = [
            one_array(rows.column("row")),
            ids,
            one_array(rows.column("digest")),
            ids.take(pa.array(starts[run])),
            pa.array(counts[run], pa.int64()),
            pa.array(head),
            pa.array(np.full(rows.num_rows, part), pa.int32()),
            pa.array(border[run], pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        if not batch.num_rows:
            continue
        normal = ascii_lower(pc.fill_null(one_array(batch.column(2)), ""))
        kept = pa.RecordBatch.from_arrays(
            [one_array(batch.column(0)), one_array(batch.column(1)), one_array(batch.column(3))], ["row", "id", "digest"]
        )
        changes = np.flatnonzero(pc.not_equal(normal.slice(1), normal.slice(0, len(normal) - 1)).to_numpy(zero_copy_only=False)) + 1
        if pending and normal[0].as_py() != last_text:
            changes = np.concatenate([[0], changes])
        last_text = normal[-1].as_py()
        if not len(changes):
            pending.append(kept)
            continue
        # Everything before the last change is complete.
        held = sum(p.num_rows for p in pending)
        cut = int(changes[-1])
        done = [*pending, kept.slice(0, cut)] if cut else list(pending)
        inner = changes[:-1] + held
        if done:
            yield closed(done, inner, at_border, 0)
            at_border = 0
        pending = [kept.slice(cut)]
    if pending:
        yield closed(pending, np.array([], dtype=np.int64), at_border, LAST)


def _across(spark, runs: DataFrame) -> DataFrame:
    """What runs that go on over range borders are in whole: at most two rows for each range."""
    borders = (
        runs.where("border > 0")
        .groupBy("part", "border")
        .agg(F.max("digest").alias("digest"), F.max("n").alias("n"), F.max(F.when(F.col("head"), F.struct("first_id"))).alias("first"))
        .collect()
    )
    chains: list[list] = []
    for row in sorted(borders, key=lambda r: (r["part"], r["border"])):
        previous = chains[-1][-1] if chains else None
        # Neighbours across a border meet as their digests.
        joined = previous is not None and previous["border"] & LAST and row["border"] & FIRST
        if joined and previous["digest"] == row["digest"]:
            chains[-1].append(row)
        else:
            chains.append([row])
    fixes = [
        (row["part"], row["border"], chain[0]["first"]["first_id"], sum(r["n"] for r in chain), place == 0)
        for chain in chains
        if len(chain) > 1
        for place, row in enumerate(chain)
    ]
    columns = {n: [f[i] for f in fixes] for i, n in enumerate(("part", "border", "keep", "total", "leads"))}
    return small_frame(spark, columns, "part int, border int, keep long, total long, leads boolean")


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, keep: str, carry: bool) -> DataFrame:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    bounded_batches(spark)
    content = packed(docs) if carry else F.struct(col(text_col).alias(text_col))
    rows = docs.select(content.alias("row"), col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    keyed = rows.mapInArrow(_keys, with_first("row", rows, "id long, start string, digest binary"))
    by_id = F.desc_nulls_last("id") if keep == "largest" else F.asc_nulls_last("id")
    order = [F.col("start"), F.col("digest"), by_id]
    ranges = keyed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    placed = ranges.select("row" if carry else F.lit(None).cast("int").alias("row"), "id", F.col("row").getField(text_col).cast("string").alias("text"), "digest")
    rest = "id long, digest binary, first_id long, n long, head boolean, part int, border int"
    return placed.mapInArrow(_runs, with_first("row", placed, rest))


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The group each document belongs to, by equality of texts after lower-casing A-Z.

    Returns one row for each row of `docs`: doc_id, keep_id (id of the row that stays: the smallest
    or the largest of the group), group_size, kept (true for exactly one row of a group), text_sha256
    (of the normalised text). A null text is empty. A null id comes after all others; of rows that
    repeat an id one is kept. Other columns are not read. An empty table gives no rows.
    """
    runs = stored(_sorted_runs(docs, id_col, text_col, keep, carry=False).drop("row"))
    fixes = F.broadcast(_across(docs.sparkSession, runs))
    return runs.join(fixes, ["part", "border"], "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("leads").isNull(), F.col("first_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("total", "n").alias("group_size"),
        (F.col("head") & F.coalesce("leads", F.lit(True))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The documents without further copies of a text; all columns as they were.

    Edge cases as in `content_sort`.
    """
    heads = stored(_sorted_runs(docs, id_col, text_col, keep, carry=True).where("head").select("row", "id", "digest", "first_id", "n", "head", "part", "border"))
    fixes = F.broadcast(_across(docs.sparkSession, heads).select("part", "border", "leads"))
    return heads.join(fixes, ["part", "border"], "left").where(F.coalesce("leads", F.lit(True))).select(*unpacked(heads, docs.columns))
