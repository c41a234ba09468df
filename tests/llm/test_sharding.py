import heapq
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from cityflow.llm.sharding import least_loaded, shard_documents, shard_groups


def test_rows_and_slots(odd_docs, odd_rows):
    found = shard_documents(odd_docs, shards=4).collect()
    assert len(found) == len(odd_rows)
    expected = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == expected
    slots = defaultdict(list)
    together = defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        together[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in together.values())
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}


def test_few_groups_as_one_heap_would(spark):
    """With a bin for each group the two levels give the loads of the plain schedule."""
    sizes = [100, 90, 80, 70, 60, 50, 40, 30, 20, 10, 55, 45]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i long, s long")
    found = shard_groups(rows, F.col("i"), F.col("s"), F.col("i"), {"i": F.col("i")}, 3).collect()
    loads = defaultdict(int)
    for r in found:
        loads[r.shard] += r["size"]
    heap = [0, 0, 0]
    for s in sorted(sizes, reverse=True):
        heapq.heappushpop(heap, heap[0])
        heapq.heapreplace(heap, heap[0] + s)
    assert sorted(loads.values()) == sorted(heap)


def test_hot_group_and_balance(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i} " * (i % 50 + 1)) for i in range(6000)]
    found = shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), shards=5).collect()
    loads = defaultdict(int)
    for r in found:
        loads[r.shard] += r["size"]
    assert max(loads.values()) / min(loads.values()) < 1.01
    for shard in loads:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert len({r.shard for r in found if r.text_crc32 == zlib.crc32(b"hot")}) == 1


def test_least_loaded():
    assert least_loaded([5, 4, 3, 3], 2) == [0, 1, 1, 0]


def test_empty(no_docs):
    assert shard_documents(no_docs).count() == 0
