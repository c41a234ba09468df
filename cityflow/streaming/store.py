"""Batches of maintained tables as plain Parquet folders.

A store is a folder. Rows of a batch go to `<kind>/origin=<query>/batch=<number>`, which Spark's writer replaces as a
whole, so a batch that is run again replaces itself. When all kinds of a batch are written, one row in `commits` says so;
readers take the batches that have one, so a batch is there whole or not at all. Batch numbers mean something
within one checkpoint only, so the origin is the id of the streaming query.

Many small batches are put together by a plain job now and then: its rows are a batch like any other, whose commit says
which ones it stands for. Those are deleted by the next such job, so that readers which have started can end.
A store takes one writer at a time.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Origin of batches that stand for others.
TOGETHER = "together"
_COMMIT = (
    "position long, stands_for array<struct<origin:string,batch:long>>, done map<string,long>, folders array<string>, versions map<string,int>, "
    "origin string, batch long"
)


def hadoop_path(spark: SparkSession, path: str):
    """File system and location of a path."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    fs, location = hadoop_path(spark, path)
    stream = fs.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query a checkpoint belongs to; another checkpoint, or a new one in its place, has another."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata").splitlines()[-1])["id"]


def folder_name(spark: SparkSession, **values: object) -> str:
    """Path of partition folders as Spark's writer names them."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{k}={escape(str(v))}" for k, v in values.items())


@dataclass(frozen=True)
class Commit:
    """One batch: where it is in the order of all, and the partition folders each kind of its rows has."""

    origin: str
    batch: int
    position: int
    folders: tuple[str, ...] = ()
    stands_for: tuple[tuple[str, int], ...] = ()
    done: Mapping[str, int] = field(default_factory=dict)
    # Contract version by table.
    versions: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class BatchStore:
    """Batches of one flow; `partitions` are the columns that rows of a kind are split by, outermost first."""

    spark: SparkSession
    path: str
    partitions: Mapping[str, tuple[str, ...]]
    # Batches that are put together, and how old a folder without a commit is when it is deleted.
    every: int | None = 32
    orphan_hours: float = 24.0

    def commits(self) -> list[Commit]:
        """All commits in their order; as many as there are batches since the last two times they were put together."""
        fs, location = hadoop_path(self.spark, f"{self.path}/commits")
        if not fs.exists(location):
            return []
        rows = self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits").collect()
        found = [
            Commit(
                r.origin, r.batch, r.position, tuple(r.folders), tuple((c.origin, c.batch) for c in r.stands_for), dict(r.done), dict(r.versions)
            )
            for r in rows
        ]
        return sorted(found, key=lambda c: (c.position, c.origin, c.batch))

    @staticmethod
    def live(commits: Iterable[Commit]) -> list[Commit]:
        """Those that no other one stands for."""
        held = list(commits)
        replaced = {pair for c in held for pair in c.stands_for}
        return [c for c in held if (c.origin, c.batch) not in replaced]

    @staticmethod
    def done(commits: Iterable[Commit]) -> dict[str, int]:
        """Last batch of each query."""
        last: dict[str, int] = {}
        for c in commits:
            pairs = c.done.items() if c.origin == TOGETHER else [(c.origin, c.batch)]
            for origin, batch in pairs:
                last[origin] = max(last.get(origin, -1), batch)
        return last

    def committed(self, query: str, batch: int, commits: list[Commit] | None = None) -> bool:
        """Whether the batch of the query, or a later one, is in the store."""
        return self.done(self.commits() if commits is None else commits).get(query, -1) >= batch

    def folder(self, kind: str, commit: Commit | tuple[str, int]) -> str:
        """Where rows of a batch are."""
        origin, batch = (commit.origin, commit.batch) if isinstance(commit, Commit) else commit
        return f"{self.path}/{kind}/{folder_name(self.spark, origin=origin, batch=batch)}"

    def write(self, kind: str, query: str, batch: int, rows: DataFrame) -> None:
        """Rows of a batch, whatever the number of tables they are for; they take the place of an earlier attempt's."""
        names = self.partitions[kind]
        # Rows of a folder go together, and folders too big for a task are split at run time.
        dealt = rows.hint("rebalance", *names) if names else rows
        # The whole folder, with partitions that an earlier attempt had and this one has not.
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*names).parquet(self.folder(kind, (query, batch)))

    def _written(self, kind: str, commit: tuple[str, int]) -> list[str]:
        """Partition folders of a batch, below the batch's own."""
        fs, top = hadoop_path(self.spark, self.folder(kind, commit))
        level = [(top, "")]
        for _ in self.partitions[kind]:
            level = [
                (s.getPath(), f"{below}/{s.getPath().getName()}")
                for path, below in level
                if fs.exists(path)
                for s in fs.listStatus(path)
                if s.isDirectory() and "=" in s.getPath().getName()
            ]
        return [f"{kind}{below}" for path, below in level if fs.exists(path)]

    def commit(
        self, query: str, batch: int, position: int, stands_for: Iterable[tuple[str, int]] = (), done: Mapping[str, int] | None = None,
        versions: Mapping[str, int] | None = None,
    ) -> None:
        """Say that all kinds of a batch are written."""
        folders = [f for kind in self.partitions for f in self._written(kind, (query, batch))]
        row = (position, [tuple(p) for p in stands_for], dict(done or {}), folders, dict(versions or {}), query, batch)
        one = self.spark.createDataFrame([row], _COMMIT).drop("origin", "batch").coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.path}/commits/{folder_name(self.spark, origin=query, batch=batch)}")

    def read(self, kind: str, schema: T.StructType | str, commits: Iterable[Commit], chosen: Callable[[str], bool] | None = None) -> DataFrame:
        """Rows of some batches, or of those partition folders of them that are chosen by their path below the batch's."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        names = self.partitions[kind]
        paths = []
        for c in commits:
            own = [f[len(kind) :] for f in c.folders if f == kind or f.startswith(kind + "/")]
            paths += [self.folder(kind, c) + f for f in own if chosen is None or chosen(f)]
        known = {f.name for f in schema.fields}
        whole = T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in names if n not in known]])
        if not paths:
            return self.spark.createDataFrame([], whole)
        rows = self.spark.read.schema(whole).option("basePath", f"{self.path}/{kind}").parquet(*paths)
        return rows.select(*whole.names)

    def put_together(self, rows_of: Callable[[str, list[Commit]], DataFrame], chosen: list[Commit], commits: list[Commit]) -> None:
        """One batch in place of the chosen ones, of the rows that `rows_of` gives for each kind."""
        if not chosen:
            return
        number = max((c.batch for c in commits if c.origin == TOGETHER), default=-1) + 1
        for kind in self.partitions:
            if any(f == kind or f.startswith(kind + "/") for c in chosen for f in c.folders):
                self.write(kind, TOGETHER, number, rows_of(kind, chosen))
        done = self.done(commits)
        versions = {t: v for c in chosen for t, v in c.versions.items()}
        position = chosen[-1].position
        self.commit(TOGETHER, number, position, [(c.origin, c.batch) for c in chosen], done, versions)
        self.clean(commits)

    def clean(self, commits: list[Commit]) -> None:
        """Delete what the commits given, not the newest one, are replaced by, and old folders that never got a commit."""
        replaced = {pair for c in commits for pair in c.stands_for}
        for pair in replaced & {(c.origin, c.batch) for c in commits}:
            for kind in [*self.partitions, "commits"]:
                fs, location = hadoop_path(self.spark, self.folder(kind, pair))
                fs.delete(location, True)
        now = self.commits()
        known = {self.folder(kind, c) for c in now for kind in self.partitions}
        before = (time.time() - self.orphan_hours * 3600) * 1000
        for kind in self.partitions:
            fs, top = hadoop_path(self.spark, f"{self.path}/{kind}")
            for origin in fs.listStatus(top) if fs.exists(top) else []:
                for batch in fs.listStatus(origin.getPath()):
                    name = f"{self.path}/{kind}/{origin.getPath().getName()}/{batch.getPath().getName()}"
                    if name not in known and batch.getModificationTime() < before:
                        fs.delete(batch.getPath(), True)


# ---- which batches may hold a key -----------------------------------------------------------------

#: Keys that share a word of 64 bits on average; four bits of it are set for each.
KEYS_A_WORD = 4


def _hash(keys: Iterable[str]) -> Column:
    return F.xxhash64(*keys)


def _word(words: Column) -> Column:
    """Word of a key: its hash, whose upper half picks it, is in `hash`."""
    return F.pmod(F.shiftrightunsigned("hash", 24), words).cast("long")


def _mask() -> Column:
    """Bits of a key in its word, from the lower 24 bits of its hash."""
    # Shifts of a typed one, since the number of places is a column.
    bits = [f"shiftleft(1L, cast((shiftright(hash, {6 * i}) & 63) AS int))" for i in range(4)]
    return F.expr(" | ".join(bits))


def key_words(rows: DataFrame, keys: Iterable[str], parts: Iterable[str], words: int) -> DataFrame:
    """Bloom filter of the keys of each part, as rows: words, word, bits. Only words with a bit are there."""
    names = list(parts)
    hashed = rows.select(*names, _hash(keys).alias("hash"))
    placed = hashed.select(*names, F.lit(words).cast("long").alias("words"), _word(F.lit(words)).alias("word"), _mask().alias("mask"))
    return placed.groupBy(*names, "words", "word").agg(F.bit_or("mask").alias("bits"))


def words_for(count: int) -> int:
    """Words of a filter over so many keys: a power of two, so that few sizes are in use."""
    return max(64, 1 << max(0, -(-count // KEYS_A_WORD) - 1).bit_length())


def parts_with(rows: DataFrame, keys: Iterable[str], parts: Iterable[str], filters: DataFrame) -> DataFrame:
    """(origin, batch, parts) of the stored parts whose filters may have one of the keys of the rows."""
    names = list(parts)
    sizes = filters.select("words").distinct()
    probes = rows.select(*names, _hash(keys).alias("hash")).distinct()
    # The sizes of the filters in use, a few dozen powers of two at most.
    asked = probes.withColumn("words", F.explode(F.lit([r[0] for r in sizes.collect()]).cast("array<long>")))
    asked = asked.select(*names, "words", _word(F.col("words")).alias("word"), _mask().alias("mask"))
    met = filters.join(asked, [*names, "words", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return met.select("origin", "batch", *names).distinct()


def day_parts(time_column: str = "timeinstant", period: str = "yyyy-MM-dd") -> Column:
    """Part of a table whose key has a time: its day (or month, or year), so that a key is only looked for there."""
    return F.coalesce(F.date_format(time_column, period), F.lit("none"))
