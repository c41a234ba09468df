"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(rows: DataFrame) -> Column:
    """All columns of a row as one struct, so that working columns next to it cannot clash with them."""
    return F.struct(*[col(c).alias(c) for c in rows.columns])


def unpacked(rows: DataFrame, names: list[str], struct: str = "row") -> list[Column]:
    """The columns of a packed row."""
    return [F.col(struct).getField(n).alias(n) for n in names]


def with_first(name: str, like: DataFrame, rest: str) -> T.StructType:
    """Schema of a column as another frame has it, then others."""
    kind = like.schema[name].dataType
    return T.StructType([T.StructField(name, kind), *T.StructType.fromDDL(rest).fields])


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir`, or where that is unset one in the
    warehouse, the other place that all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def bounded_batches(spark: SparkSession) -> None:
    """Batches of at most 32 MB to and from Python, so that long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


#: Spark's setting that deletes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run within go when each ends; else they stay until the driver collects its garbage.

    For work in many rounds that are written in between: its disk is then that of its largest query, not of all.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(rows: DataFrame) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again.

    Cuts the lineage: what was computed survives lost executors, and rows dealt out by a task keep
    the numbers that task gave them.
    """
    path = f"{work_folder(rows.sparkSession)}/llm-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class WorkTables:
    """Intermediate tables that are deleted as soon as nothing reads them any more.

    What is made from a table must be written before the table is dropped: what was lost with an executor
    could not be computed again without it.
    """

    def __init__(self) -> None:
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def put(self, rows: DataFrame) -> DataFrame:
        """The rows written as Parquet in the shared folder and read again."""
        spark = rows.sparkSession
        path = f"{work_folder(spark)}/llm-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        made = spark.read.schema(rows.schema).parquet(path)
        self.paths[id(made)] = (made, path)
        return made

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that `put` wrote."""
        for made in tables:
            spark, (_, path) = made.sparkSession, self.paths.pop(id(made))
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def small_frame(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """Rows from the driver; callers state what bounds their number."""
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), schema)


def ascii_lower(texts: pa.Array) -> pa.Array:
    """A-Z to a-z in all texts of a batch at once; other bytes of UTF-8 are never in that range."""
    validity, offsets, data = texts.buffers()
    if data is None:
        return texts
    lowered = pa.py_buffer(data.to_pybytes().translate(UPPER_TO_LOWER))
    return pa.Array.from_buffers(texts.type, len(texts), [validity, offsets, lowered], texts.null_count, texts.offset)


def one_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A column of a batch as one array."""
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def text_of(values: pa.Array) -> Iterator[str]:
    """Texts of a batch; null is empty."""
    return (v or "" for v in values.to_pylist())


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one hold about `limit` bytes, or are one text."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.nan_to_num(
            np.asarray(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), dtype=float)
        ).astype(np.int64)
        lots = np.cumsum(sizes) // limit
        borders = np.flatnonzero(np.diff(lots)) + 1
        for begin, end in zip([0, *borders], [*borders, len(sizes)], strict=True):
            if end > begin:
                yield batch.slice(begin, end - begin)
