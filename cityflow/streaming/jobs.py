"""Streaming jobs: the flows run over micro-batches into maintained tables, documents, replies and the error log.

The functions are the ones the batch plans use, called on each micro-batch. A batch that is run again
gives the same tables, so the delivery is effectively once into the tables of the store. Late rows are
never dropped: there is no watermark on maintained tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cityflow.config import FlowConfig, GraphConfig
from cityflow.operators.context import with_headers
from cityflow.operators.contract import (
    Contract,
    TableColumn,
    Version,
    catalogue,
    from_stored,
    next_version,
    stored_types,
    to_stored,
    to_wide,
)
from cityflow.operators.decode import rejected, rejection
from cityflow.operators.errors import errors_from_rejected, rejects_to_error_log
from cityflow.operators.graph import classify_response
from cityflow.operators.tables import HIGH, apply_lastdata, apply_mutable, mark_repeats, repeat_rejection
from cityflow.plans.flows import documents_of, flagged_entities, mutations_of
from cityflow.streaming.sinks import dispatch, post_json
from cityflow.streaming.store import (
    TOGETHER,
    BatchStore,
    Commit,
    checkpoint_id,
    day_parts,
    folder_name,
    hadoop_path,
    key_words,
    parts_with,
    words_for,
)

ERROR_SCHEMA = (
    "tenant string, timestamp timestamp, error string, query string, stage string, code string, "
    "seq struct<partition:int,offset:bigint,pos:int>, value string"
)
_SEQ = "struct<partition:bigint,offset:bigint,pos:int>"

#: What of a checked entity its table or the error log needs; the notification itself is kept of refused ones only.
_KEPT = (
    "entity",
    "entityid",
    "entitytype",
    "service",
    "servicepath",
    "seq",
    "change",
    "recvtime",
    "target",
    "target_schema",
    "target_table",
    "reject",
)

# A batch handler gets the records, the number of the batch, and the id of the query it is a batch of.
Handler = Callable[[DataFrame, int, str], None]


def start(
    stream: DataFrame,
    handle: Handler,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Run a handler over the micro-batches of a stream; it resumes from the checkpoint."""
    spark = stream.sparkSession

    def one_batch(records: DataFrame, batch: int) -> None:
        handle(records, batch, checkpoint_id(spark, checkpoint))

    writer = stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def run_available(stream: DataFrame, handle: Handler, checkpoint: str) -> None:
    """Drain what is there now, then stop."""
    start(stream, handle, checkpoint).awaitTermination()


def _now() -> datetime:
    return datetime.now(timezone.utc)


#: How many offsets of a partition are told apart when a batch is put into the order of commits.
_OFFSETS = 1 << 40


@dataclass
class RelationalJob:
    """Keeps the tables of one relational flow (historic, lastdata or mutable) and its error log.

    All tables of a batch, and its log, are one commit, and the rows of all tables go out in one write. Tables of
    the last two flows are stored as changes, in the order of their commits, and folded when they are read, so a batch
    costs what it holds and not what the table holds. Contracts may change while the tables are kept: a batch is
    stored under the version of its time and read in the columns of the newest (`renames`: by target, old column name to new).
    """

    spark: SparkSession
    flow: str
    contracts: Sequence[Contract]
    root: str
    config: FlowConfig = field(default_factory=FlowConfig)
    partial: bool = True
    # What a part of a historic table holds, as a date pattern; longer where few rows come from many days.
    period: str = "yyyy-MM-dd"
    renames: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    # Batches that are put together; None leaves that to a job that calls `compact`.
    every: int | None = 32
    # Receipt time of a batch.
    clock: Callable[[], datetime] = _now

    @property
    def store(self) -> BatchStore:
        """Where batches are kept: rows of tables, filters of their keys, and the error log."""
        kinds = {"rows": ("target", "part"), "log": ()}
        if self.flow == "historic":
            kinds["keys"] = ("target", "part")
        return BatchStore(self.spark, f"{self.root}/{self.flow}", kinds, self.every)

    # ---- contracts --------------------------------------------------------------------------------

    @property
    def _contract_path(self) -> str:
        return f"{self.root}/{self.flow}/contracts"

    def history(self) -> dict[str, list[Version]]:
        """Contract versions of every table, those given here last; new ones are written down."""
        kept = self._kept_history()
        for table in self.contracts:
            held = kept.setdefault(table.target, [])
            version = next_version(held, table, self.renames.get(table.target))
            if not held or version is not held[-1]:
                self._keep_version(version)
                held.append(version)
        return kept

    def _kept_history(self) -> dict[str, list[Version]]:
        fs, location = hadoop_path(self.spark, self._contract_path)
        if not fs.exists(location):
            return {}
        schema = "columns array<struct<name:string,type:string,nullable:boolean,pk:boolean,identity:string>>, target string, version int"
        found: dict[str, list[Version]] = {}
        # As many rows as the catalogue has had versions.
        for row in sorted(self.spark.read.schema(schema).parquet(self._contract_path).collect(), key=lambda r: r.version):
            columns = tuple(TableColumn(c.name, c.type, c.nullable, c.pk) for c in row["columns"])
            identities = tuple(c.identity for c in row["columns"])
            found.setdefault(row.target, []).append(Version(row.version, Contract(row.target, columns), identities))
        return found

    def _keep_version(self, version: Version) -> None:
        columns = [(c.name, c.type, c.nullable, c.pk, i) for c, i in zip(version.contract.columns, version.identities, strict=True)]
        schema = "columns array<struct<name:string,type:string,nullable:boolean,pk:boolean,identity:string>>"
        row = self.spark.createDataFrame([(columns,)], schema).coalesce(1)
        place = folder_name(self.spark, target=version.contract.target, version=version.number)
        row.write.mode("overwrite").parquet(f"{self._contract_path}/{place}")

    def _schema(self, history: Sequence[Version]) -> T.StructType:
        """Stored columns of a table, of all its versions."""
        names = [f"`{n}` {t}" for n, t in stored_types(history).items()]
        if self.flow != "historic":
            names += [f"seq {_SEQ}", "change string", "present array<string>", f"{HIGH} timestamp"]
        return T.StructType.fromDDL(", ".join(names))

    # ---- reading ----------------------------------------------------------------------------------

    def read(self, target: str) -> DataFrame:
        """Rows of a table as of the last committed batch."""
        history = self.history()[target]
        store = self.store
        rows = self._rows(target, history, store.live(store.commits()))
        return rows if self.flow == "historic" else self._state(history[-1].contract, rows)

    def _rows(self, target: str, history: Sequence[Version], commits: Sequence[Commit]) -> DataFrame:
        """Stored rows of a table in the columns of its newest contract."""
        place = "/" + folder_name(self.spark, target=target) + "/"
        schema = self._schema(history)
        rows = self.store.read("rows", schema, commits, lambda folder: folder.startswith(place))
        return from_stored(rows, history, [c for c in ("seq", "change", HIGH) if c in schema.names])

    def _state(self, table: Contract, changes: DataFrame, with_high: bool = False) -> DataFrame:
        """Rows of a table of which all changes are given."""
        if self.flow == "lastdata":
            control = [HIGH] if with_high else []
            return apply_lastdata(None, changes, ["entityid"], partial=self.partial, with_high=with_high).select(*table.names, *control)
        return apply_mutable(None, changes.drop("change", HIGH), table.key, partial=self.partial).select(*table.names)

    def errors(self) -> DataFrame:
        """Error log as of the last committed batch."""
        store = self.store
        return store.read("log", ERROR_SCHEMA, store.live(store.commits()))

    # ---- batches ----------------------------------------------------------------------------------

    def handle(self, records: DataFrame, batch: int, query: str = "batch") -> None:
        """Apply one micro-batch; one that is in the store already is left out, one that failed before its commit is replaced."""
        store = self.store
        commits = store.commits()
        if store.committed(query, batch, commits):
            return
        history = self.history()
        # One receipt time per batch, fixed here so that work done again gives the same rows.
        received = F.lit(self.clock()).cast("timestamp")
        tables = catalogue(self.spark, self.contracts)
        # Used once per shape of table; executors that go away only cost the work of decoding again.
        flagged = flagged_entities(records, tables, self.flow, self.config, received)
        entities = flagged.select(*_KEPT, F.when(F.col("reject").isNotNull(), F.col("value")).alias("value")).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        position = max((c.position for c in commits), default=0) + 1
        kept: list[DataFrame] = [entities]
        try:
            good = entities.where(F.col("reject").isNull() & (F.col("change") != "ignored"))
            # Accepted rows belong to tables of the catalogue, so there are no more names than it has.
            present = {r[0] for r in good.select("target").distinct().collect()}
            busy = [history[c.target][-1] for c in self.contracts if c.target in present]
            logs = [rejected(entities).where(F.col("reject.code") != "NO_ENTITIES")]
            written: list[DataFrame] = []
            for shape in _shapes(busy):
                if self.flow == "historic":
                    rows = self._historic(shape, good, store, store.live(commits), history)
                    if shape[0].contract.key:
                        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
                        kept.append(rows)
                        again = rows.where("repeated").withColumn("reject", repeat_rejection())
                        logs.append(again.select("seq", "reject", "_origin.*"))
                    written.append(to_stored(rows.where(~F.col("repeated")), shape[0], ["target", "part"]))
                else:
                    written.append(self._changes(shape, good, position))
            store.write("log", query, batch, rejects_to_error_log(*logs, now=received))
            if written:
                self._write(store, query, batch, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), written), busy)
            store.commit(query, batch, position, versions={v.contract.target: v.number for v in busy})
        finally:
            for frame in kept:
                frame.unpersist()
        if self.every and sum(c.origin != TOGETHER for c in store.live(store.commits())) >= self.every:
            self.compact()

    def _write(self, store: BatchStore, query: str, batch: int, rows: DataFrame, busy: Sequence[Version]) -> None:
        """The rows of all tables in one write, and for historic tables the filters of their keys in another."""
        store.write("rows", query, batch, rows)
        if self.flow == "historic":
            # Read back, as what is stored is what the filters are of.
            names = {n: t for v in busy for n, t in stored_types([v]).items()}
            schema = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in names.items()))
            written = store.read("rows", schema, [Commit(query, batch, 0, tuple(store._written("rows", (query, batch))))])
            self._write_filters(store, query, batch, written, busy)

    def _write_filters(self, store: BatchStore, query: str, batch: int, rows: DataFrame, tables: Sequence[Version]) -> None:
        words = words_for(rows.count())
        made = []
        for shape in _shapes(tables):
            if shape[0].contract.key:
                own = rows.where(F.col("target").isin([v.contract.target for v in shape]))
                made.append(key_words(own, _key_names(shape[0]), ["target", "part"], words))
        if made:
            store.write("keys", query, batch, reduce(DataFrame.unionByName, made))

    def _of_shape(self, shape: Sequence[Version], good: DataFrame, keep: Sequence[str]) -> DataFrame:
        here = good.where(F.col("target").isin([v.contract.target for v in shape]))
        return to_wide(here, shape[0].contract, ["target", *keep])

    def _historic(
        self, shape: Sequence[Version], good: DataFrame, store: BatchStore, live: Sequence[Commit], history: Mapping[str, Sequence[Version]]
    ) -> DataFrame:
        """Rows of tables of one shape with `repeated`, and with their tenant, place and content for the log."""
        table = shape[0].contract
        origin = F.struct("service", "target_schema", "target_table", F.to_json("entity").alias("value"))
        rows = self._of_shape(shape, good.withColumn("_origin", origin), ["seq", "_origin"]).drop("present")
        part = day_parts(period=self.period) if "timeinstant" in table.names else F.lit("all")
        rows = rows.withColumn("part", part)
        if not table.key:
            return rows.withColumn("repeated", F.lit(False))
        return mark_repeats(rows, ["target", *table.key], self.held_keys(rows, shape, store, live, history))

    def held_keys(
        self, rows: DataFrame, shape: Sequence[Version], store: BatchStore, live: Sequence[Commit], history: Mapping[str, Sequence[Version]]
    ) -> DataFrame | None:
        """Stored keys of the parts that may hold one of the rows' keys; the filters of all batches say which these are."""
        targets = [v.contract.target for v in shape]
        table = shape[0].contract
        schema = T.StructType.fromDDL("words long, word long, bits long, origin string, batch long")
        places = {"/" + folder_name(self.spark, target=t) + "/" for t in targets}
        filters = store.read("keys", schema, live, lambda folder: any(folder.startswith(p) for p in places))
        # Where a key column was changed, filters are of other values than these.
        names = [_key_names(v) for t in targets for v in history[t]]
        if any(n != names[0] for n in names):
            chosen = {(c.origin, c.batch): None for c in live}
        elif not live:
            return None
        else:
            stored = to_stored(rows, shape[0], ["target", "part"])
            # As many rows at most as there are parts in the batches that have not been put together.
            chosen = {}
            for r in parts_with(stored, names[0], ["target", "part"], filters).collect():
                chosen.setdefault((r.origin, r.batch), set()).add("/" + folder_name(self.spark, target=r.target, part=r.part))
        found = []
        for target in targets:
            place = "/" + folder_name(self.spark, target=target) + "/"
            for c in live:
                parts = chosen.get((c.origin, c.batch), set())
                own = lambda f, parts=parts, place=place: f.startswith(place) and (parts is None or f in parts)
                if any(f.startswith("rows") and own(f[4:]) for f in c.folders):
                    rows_there = store.read("rows", self._schema(history[target]), [c], own)
                    found.append(from_stored(rows_there, history[target]).select(F.lit(target).alias("target"), *table.key))
        return reduce(DataFrame.unionByName, found) if found else None

    def _changes(self, shape: Sequence[Version], good: DataFrame, position: int) -> DataFrame:
        """Rows of tables of one shape as changes in the order of their commits, then by where their records come from."""
        rows = self._of_shape(shape, good, ["seq", "change"])
        order = F.struct(
            F.lit(position).cast("long").alias("partition"),
            (F.col("seq.partition").cast("long") * _OFFSETS + F.col("seq.offset")).alias("offset"),
            F.col("seq.pos").alias("pos"),
        )
        rows = rows.withColumns({"seq": order, HIGH: F.lit(None).cast("timestamp"), "part": F.lit("all")})
        return to_stored(rows, shape[0], ["seq", "change", HIGH, "target", "part"])

    # ---- putting batches together -------------------------------------------------------------------

    def compact(self, whole: bool = False) -> None:
        """Put batches together: historic ones as they are, changes folded to the rows they leave.

        Historic batches that were put together before stay, unless `whole` is given or there are as many of them as of
        others. A fold reads the whole table; with `every` None it is for the caller to say when.
        """
        store = self.store
        commits = store.commits()
        live = store.live(commits)
        chosen = live
        if self.flow == "historic" and not whole:
            fresh = [c for c in live if c.origin != TOGETHER]
            chosen = fresh if len(live) - len(fresh) < (self.every or 32) else live
        history = self.history()

        def rows_of(kind: str, batches: list[Commit]) -> DataFrame:
            if kind == "log":
                return store.read("log", ERROR_SCHEMA, batches)
            if kind == "keys":
                return self._filters_of(store, history, batches)
            tables = [t for t, versions in history.items() if any(t in c.versions for c in batches)]
            folded = [self._folded(t, history[t], batches) for t in tables]
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), folded)

        store.put_together(rows_of, chosen, commits)

    def _filters_of(self, store: BatchStore, history: Mapping[str, Sequence[Version]], batches: Sequence[Commit]) -> DataFrame:
        made = []
        for target, versions in history.items():
            if versions[-1].contract.key and any(target in c.versions for c in batches):
                place = "/" + folder_name(self.spark, target=target) + "/"
                rows = store.read("rows", self._schema(versions), batches, lambda f, place=place: f.startswith(place))
                held = to_stored(from_stored(rows, versions, ["target", "part"]), versions[-1], ["target", "part"])
                made.append(key_words(held, _key_names(versions[-1]), ["target", "part"], words_for(held.count())))
        return reduce(DataFrame.unionByName, made)

    def _folded(self, target: str, history: Sequence[Version], batches: Sequence[Commit]) -> DataFrame:
        """Stored rows of a table that stand for those of some batches."""
        if self.flow == "historic":
            place = "/" + folder_name(self.spark, target=target) + "/"
            rows = self.store.read("rows", self._schema(history), batches, lambda f: f.startswith(place))
            kept = from_stored(rows, history, ["part"])
            return to_stored(kept.withColumn("target", F.lit(target)), history[-1], ["target", "part"])
        table = history[-1].contract
        rows = self._state(table, self._rows(target, history, batches), with_high=self.flow == "lastdata")
        zero = F.lit(0)
        # Older than any change.
        seq = F.struct(zero.cast("long").alias("partition"), zero.cast("long").alias("offset"), zero.alias("pos"))
        high = F.col(HIGH) if HIGH in rows.columns else F.lit(None).cast("timestamp")
        all_names = F.array(*[F.lit(c) for c in table.names])
        changes = rows.withColumns({"seq": seq, "change": F.lit("update"), HIGH: high, "present": all_names, "target": F.lit(target), "part": F.lit("all")})
        return to_stored(changes, history[-1], ["seq", "change", HIGH, "target", "part"])


def _shapes(versions: Sequence[Version]) -> list[list[Version]]:
    """Tables whose rows are made and stored alike."""
    shapes: dict[tuple, list[Version]] = {}
    for v in versions:
        shapes.setdefault((v.contract.columns, v.identities), []).append(v)
    return list(shapes.values())


def _key_names(version: Version) -> list[str]:
    """Names the key columns of a table are stored under."""
    return [version.stored()[k] for k in version.contract.key]


@dataclass
class DocumentJob:
    """Writes the documents of a flow, one folder per database and collection in each batch."""

    spark: SparkSession
    root: str
    prefix: str = ""
    every: int | None = 32
    clock: Callable[[], datetime] = _now

    @property
    def store(self) -> BatchStore:
        """Where documents are kept."""
        return BatchStore(self.spark, f"{self.root}/documents", {"rows": ("database", "collection")}, self.every)

    def read(self) -> DataFrame:
        """Documents as of the last committed batch."""
        store = self.store
        return store.read("rows", _DOCUMENT, store.live(store.commits())).select("database", "collection", "document")

    def handle(self, records: DataFrame, batch: int, query: str = "batch") -> None:
        """Add the documents of one micro-batch."""
        received = F.lit(self.clock()).cast("timestamp")
        _append(self.store, "rows", _DOCUMENT, query, batch, lambda: documents_of(records, self.prefix, received).select("database", "collection", "document"))


_DOCUMENT = "document string"


def _append(store: BatchStore, kind: str, schema: str, query: str, batch: int, rows: Callable[[], DataFrame]) -> None:
    """Add a batch to a store whose rows are never changed."""
    commits = store.commits()
    if store.committed(query, batch, commits):
        return
    store.write(kind, query, batch, rows())
    store.commit(query, batch, max((c.position for c in commits), default=0) + 1)
    now = store.commits()
    fresh = [c for c in store.live(now) if c.origin != TOGETHER]
    if store.every and len(fresh) >= store.every:
        gathered = store.live(now) if len(store.live(now)) - len(fresh) >= store.every else fresh
        store.put_together(lambda _, chosen: store.read(kind, schema, chosen), gathered, now)


@dataclass
class ErrorJob:
    """Turns dead letters into rows of the error log."""

    spark: SparkSession
    root: str
    config: FlowConfig = field(default_factory=FlowConfig)
    every: int | None = 32
    clock: Callable[[], datetime] = _now

    @property
    def store(self) -> BatchStore:
        """Where the error log is kept."""
        return BatchStore(self.spark, f"{self.root}/_error_log", {"log": ()}, self.every)

    def read(self) -> DataFrame:
        """Error log as of the last committed batch."""
        store = self.store
        return store.read("log", ERROR_SCHEMA, store.live(store.commits()))

    def handle(self, records: DataFrame, batch: int, query: str = "batch") -> None:
        """Add the error rows of one micro-batch of dead letters."""

        def rows() -> DataFrame:
            received = F.lit(self.clock()).cast("timestamp")
            found = errors_from_rejected(with_headers(records, keep_case=True), self.config, received)
            seq = F.struct("partition", "offset", F.lit(0).alias("pos"))
            return found.select(
                "tenant", "timestamp", "error", "query", F.lit("sink").alias("stage"), F.lit("DEAD_LETTER").alias("code"), seq.alias("seq"), "value"
            )

        _append(self.store, "log", ERROR_SCHEMA, query, batch, rows)


@dataclass
class GraphJob:
    """Sends the mutations of the graph flow; what the server does not take goes to the error log.

    Replies are written before they are judged, and only those of the batch are read for that. A batch that fails half-way
    is sent again; the server then answers that what it has is there already, which counts as taken.
    """

    spark: SparkSession
    root: str
    endpoint: str
    config: GraphConfig = field(default_factory=GraphConfig)
    send: Callable[[str, str, float], tuple[int, str]] = post_json
    parallel: int | None = None
    retries: int = 1
    backoff_s: float = 0.5
    every: int | None = 32
    clock: Callable[[], datetime] = _now

    @property
    def store(self) -> BatchStore:
        """Where replies and the error log are kept."""
        return BatchStore(self.spark, f"{self.root}/graph", {"replies": (), "log": ()}, self.every)

    def handle(self, records: DataFrame, batch: int, query: str = "batch") -> None:
        """Send one micro-batch and log what failed."""
        store = self.store
        commits = store.commits()
        if store.committed(query, batch, commits):
            return
        sent = dispatch(
            mutations_of(records, self.config), self.endpoint, self.send, retries=self.retries, backoff_s=self.backoff_s, parallel=self.parallel
        )
        store.write("replies", query, batch, sent.select("service", "seq", "query", "status", "body", "attempts"))
        own = Commit(query, batch, 0, ("replies",))
        judged = classify_response(store.read("replies", _REPLY, [own]))
        failed = judged.where(F.col("outcome") == "failed").select(
            "service", "seq", F.col("query").alias("value"), rejection("dispatch", "HTTP", F.col("error")).alias("reject")
        )
        received = F.lit(self.clock()).cast("timestamp")
        store.write("log", query, batch, rejects_to_error_log(failed, now=received))
        store.commit(query, batch, max((c.position for c in commits), default=0) + 1)
        now = store.commits()
        fresh = [c for c in store.live(now) if c.origin != TOGETHER]
        if store.every and len(fresh) >= store.every:
            kinds = {"replies": _REPLY, "log": ERROR_SCHEMA}
            store.put_together(lambda kind, chosen: store.read(kind, kinds[kind], chosen), fresh, now)

    def outcomes(self) -> DataFrame:
        """All replies with what they mean."""
        store = self.store
        return classify_response(store.read("replies", _REPLY, store.live(store.commits())))

    def errors(self) -> DataFrame:
        """Error log as of the last committed batch."""
        store = self.store
        return store.read("log", ERROR_SCHEMA, store.live(store.commits()))


_REPLY = "service string, seq struct<partition:int,offset:bigint,pos:int>, query string, status int, body string, attempts int"
