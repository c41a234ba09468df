"""Newest-wins tables kept in the state of a streaming query.

Where `RelationalJob` stores changes and folds them when they are read, here the newest values of each entity are the state
of the query itself, keyed by table and entity, and a micro-batch gives the rows it has changed. A table that is
already kept elsewhere can be given as initial state. The rules are those of `apply_lastdata`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cityflow.functions.times import iso_timestamp
from cityflow.operators.contract import Contract, to_wide
from cityflow.streaming.store import BatchStore, checkpoint_id

#: What is kept of an entity: its greatest time in microseconds, and its attributes as JSON texts by lower-case name.
STATE = "high long, entity string"
CHANGED = "target string, entityid string, change string, high long, entity string"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def step(held: tuple[int | None, str] | None, change: str, ts: int | None, entity: str, partial: bool, ties: str):
    """What is kept after one more change: (greatest time, attributes), or None when the entity is gone."""
    if change == "delete":
        return None
    high = held[0] if held else None
    newer = ts is None or high is None or (ts > high if ties == "keep" else ts >= high)
    if not newer:
        return held
    values = json.loads(entity)
    if partial and held:
        values = json.loads(held[1]) | values
    return (high if ts is None else ts if high is None else max(ts, high)), json.dumps(values, sort_keys=True)


class NewestWins(StatefulProcessor):
    """The newest values of one entity; the changes of a micro-batch are applied in the order of their records."""

    def __init__(self, partial: bool, ties: str) -> None:
        self.partial = partial
        self.ties = ties

    def init(self, handle) -> None:
        """State of an entity."""
        self.held = handle.getValueState("held", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        """Begin with what a table holds."""
        self.held.update((initialState.high, initialState.entity))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        """The row of the entity after the batch, if the batch has changed it.

        Changes of one entity in one batch are held together to be ordered; the intake of a batch bounds them.
        """
        before = tuple(self.held.get()) if self.held.exists() else None
        now = before
        for row in sorted(rows, key=lambda r: (r.partition, r.offset, r.pos)):
            now = step(now, row.change, row.ts, row.entity, self.partial, self.ties)
        if now == before:
            return
        if now is None:
            self.held.clear()
        else:
            self.held.update(now)
        target, entity_id = key
        yield Row(target=target, entityid=entity_id, change="upsert" if now else "delete", high=now and now[0], entity=now and now[1])

    def close(self) -> None:
        """Nothing is left open."""


def changes_of(entities: DataFrame) -> DataFrame:
    """Changes as the state takes them, from decoded entities with `target`, `seq` and `change`."""
    low = F.map_from_entries(
        F.transform(F.map_entries("entity"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    )
    told = entities.where(F.col("change") != "ignored").withColumn("_low", low)
    time = iso_timestamp(F.get_json_object(F.try_element_at("_low", F.lit("timeinstant")), "$.value"))
    kept = F.map_filter("_low", lambda k, v: ~k.isin("id", "type", "alterationtype"))
    return told.select(
        "target", "entityid", "seq", "change", F.unix_micros(time).alias("ts"), F.to_json(kept).alias("entity")
    )


def newest_by_state(changes: DataFrame, initial: DataFrame | None = None, partial: bool = True, ties: str = "keep") -> DataFrame:
    """Rows (CHANGED) that the micro-batches of a stream of changes give; `initial` has target, entityid, high and entity."""
    if ties not in ("keep", "replace"):
        raise ValueError("ties must be 'keep' or 'replace'")
    keys = ["target", "entityid"]
    # Nested values do not come as rows, so the order is spread.
    changes = changes.select(*keys, "seq.partition", "seq.offset", "seq.pos", "change", "ts", "entity")
    held = None if initial is None else initial.select(*keys, "high", "entity").groupBy(*keys)
    return changes.groupBy(*keys).transformWithState(NewestWins(partial, ties), CHANGED, "Update", "None", held)


@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """This kind of state is only kept there; other queries of the session keep their setting."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def changed_store(spark: SparkSession, path: str) -> BatchStore:
    """Where changed rows are kept, batch by batch."""
    return BatchStore(spark, path, {"rows": ()}, every=None)


def start_latest(changed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changed rows of each batch; a batch that is run again replaces itself."""
    spark = changed.sparkSession

    def one_batch(rows: DataFrame, batch: int) -> None:
        store, query = changed_store(spark, path), checkpoint_id(spark, checkpoint)
        commits = store.commits()
        if not store.committed(query, batch, commits):
            store.write("rows", query, batch, rows.withColumn("position", F.lit(batch)))
            store.commit(query, batch, max((c.position for c in commits), default=0) + 1)

    writer = changed.writeStream.outputMode("update").foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    with _state_in_rocksdb(spark):
        return writer.trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str, initial: DataFrame | None = None) -> DataFrame:
    """The rows of all tables as the state has them: target, entityid, high, entity."""
    store = changed_store(spark, path)
    rows = store.read("rows", f"{CHANGED}, position long", store.live(store.commits()))
    if initial is not None:
        first = initial.select("target", "entityid", F.lit("upsert").alias("change"), "high", "entity", F.lit(-1).cast("long").alias("position"))
        rows = first.unionByName(rows)
    last = rows.groupBy("target", "entityid").agg(F.max_by(F.struct("change", "high", "entity"), "position").alias("last"))
    return last.select("target", "entityid", "last.*").where("change = 'upsert'").drop("change")


def as_table(held: DataFrame, table: Contract) -> DataFrame:
    """Rows of one table from what is kept of its entities; columns that come with a record and not from it are NULL."""
    none = F.lit(None).cast("string")
    entities = held.where(F.col("target") == table.target).select(
        "entityid", F.from_json("entity", "map<string,string>").alias("entity"), none.alias("entitytype"), none.alias("servicepath")
    )
    return to_wide(entities, table).drop("present")
