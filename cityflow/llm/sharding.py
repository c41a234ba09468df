"""Sharding by longest-processing-time scheduling, in two levels.

Rows that must stay together are summed up first. Groups, dealt out over lanes by their key, are sorted
by size within a lane and go to the lane's least-loaded bin through a heap. The bins of all lanes, of
which there are at most `BINS` or one per lane and shard, are then scheduled onto the shards in the same
way. Where a bin holds one group, as all large ones do, this is plain longest-processing-time scheduling.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, shuffle_partitions, small_frame, stored, with_first

#: Bins of all lanes together; bounds what the driver schedules.
BINS = 65_536
#: Parts a group's rows are counted in, so that a group with very many rows never meets in one task.
SALTS = 512


def least_loaded(sizes: list[int], bins: int) -> list[int]:
    """The bin each item goes to, items taken in the given order (largest first)."""
    heap = [(0, b) for b in range(bins)]
    chosen = []
    for size in sizes:
        load, b = heap[0]
        heapq.heapreplace(heap, (load + size, b))
        chosen.append(b)
    return chosen


def _lanes(bins: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Schedules the groups of a lane, which come by falling size, the parts of a group in a row."""
        lane = TaskContext.get().partitionId()
        heap = [(0, b) for b in range(bins)]
        rows_in = [0] * bins
        group, b, place = None, 0, 0
        for batch in batches:
            keys, n_rows, total, total_rows, before = (c.to_pylist() for c in batch.columns[:1] + batch.columns[2:6])
            chosen, places = [], []
            for key, _, size, rows, earlier in zip(keys, n_rows, total, total_rows, before, strict=True):
                if key != group:
                    load, b = heap[0]
                    heapq.heapreplace(heap, (load + size, b))
                    group, place = key, rows_in[b]
                    rows_in[b] += rows
                chosen.append(b)
                places.append(place + earlier)
            arrays = [
                batch.column(0),
                batch.column(1),
                batch.column(6),
                batch.column(2),
                pa.array([lane] * len(keys), pa.int32()),
                pa.array(chosen, pa.int32()),
                pa.array(places, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "salt", "bytes", "n", "lane", "bin", "place"])

    return fill


def shard_groups(rows: DataFrame, key: Column, size: Column, order: Column, carried: dict[str, Column], shards: int) -> DataFrame:
    """Rows with the shard and the slot they go to; rows with the same key stay together.

    Returns the carried columns, `size`, `shard` (0 to shards - 1) and `slot` (0, 1, ... in each shard
    without a gap). `key` must not be null. Shards have near-equal sums of `size`, as far as a single
    group is not larger than a shard should be.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    lanes = shuffle_partitions(spark)
    bins = max(shards, BINS // lanes)
    base = stored(
        rows.select(
            key.alias("key"),
            F.pmod(F.xxhash64(order), F.lit(SALTS)).cast("int").alias("salt"),
            size.cast("long").alias("size"),
            order.alias("order"),
            F.struct(*[c.alias(n) for n, c in carried.items()]).alias("carried"),
        )
    )
    parts = base.groupBy("key", "salt").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("key")
    earlier = whole.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        parts.repartition(lanes, "key")
        .select(
            "key",
            "salt",
            "n",
            F.sum("bytes").over(whole).alias("total"),
            F.sum("n").over(whole).alias("total_rows"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
            "bytes",
        )
        .sortWithinPartitions(F.desc("total"), "key", "salt")
    )
    placed = stored(
        totals.mapInArrow(
            _lanes(bins), with_first("key", base, "salt int, bytes long, n long, lane int, bin int, place long")
        )
    )
    filled = placed.groupBy("lane", "bin").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    filled.sort(key=lambda r: (-r["bytes"], r["lane"], r["bin"]))
    to = least_loaded([r["bytes"] for r in filled], shards)
    used = [0] * shards
    first = []
    for r, s in zip(filled, to, strict=True):
        first.append(used[s])
        used[s] += r["n"]
    columns = {"lane": [r["lane"] for r in filled], "bin": [r["bin"] for r in filled], "shard": to, "first": first}
    # At most max(BINS, lanes x shards) rows, whatever the input.
    plan = F.broadcast(small_frame(spark, columns, "lane int, bin int, shard int, first long"))
    in_part = Window.partitionBy("key", "salt").orderBy("order")
    numbered = base.withColumn("nth", F.row_number().over(in_part) - 1)
    return (
        numbered.join(placed.join(plan, ["lane", "bin"]).select("key", "salt", "shard", "first", "place"), ["key", "salt"])
        .select("carried.*", "size", "shard", (F.col("first") + F.col("place") + F.col("nth")).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Documents over shards of near-equal bytes; equal texts stay together.

    Returns doc_id, size (UTF-8 bytes of the text plus `overhead`), text_crc32, law ('bytes'), shard,
    slot (gapless from 0 in each shard) and grown_shard (null: this law does not keep rows in place
    when a shard is added). A null text counts as the empty text. Null and repeated ids are placed like
    any other row. Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return shard_groups(
        docs,
        key=F.unhex(F.sha2(text, 256)),
        size=F.octet_length(text) + overhead,
        order=col(id_col).cast("long"),
        carried={"doc_id": col(id_col).cast("long"), "text_crc32": F.crc32(text.cast("binary"))},
        shards=shards,
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
