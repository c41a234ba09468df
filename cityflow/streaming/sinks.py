"""Writers: routed tables, documents, error log, topics, relational databases and HTTP endpoints."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.operators.contract import Contract


def write_routed(rows: DataFrame, path: str, mode: str = "append") -> None:
    """All target tables of routed rows in one write, one folder per schema and table.

    Rows of a table are brought together before the write, and tables too big for one task are split.
    """
    keys = ["target_schema", "target_table"]
    rows.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def write_documents(documents: DataFrame, path: str, mode: str = "append") -> None:
    """Documents as JSON lines of text, one folder per database and collection."""
    keys = ["database", "collection"]
    placed = documents.select(*keys, F.col("document").alias("value"))
    placed.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).text(path)


def write_error_log(log: DataFrame, path: str, mode: str = "append") -> None:
    """Error rows, one folder per tenant."""
    log.hint("rebalance", "tenant").write.mode(mode).partitionBy("tenant").parquet(path)


def published(rows: DataFrame) -> DataFrame:
    """Columns a topic writer takes: topic, key, value, headers."""
    has = set(rows.columns)
    key = F.col("message_key") if "message_key" in has else F.lit(None).cast("string")
    none = F.lit(None).cast("array<struct<key:string,value:binary>>")
    headers = F.col("message_headers") if "message_headers" in has else none
    return rows.select(
        F.col("out_topic").alias("topic"), key.alias("key"), F.col("message").alias("value"), headers.alias("headers")
    )


def publish(rows: DataFrame, servers: str | None = None, path: str | None = None, options: Mapping[str, str] | None = None):
    """Write records to topics, or as Parquet where there is no broker.

    A batch is written at once. For a stream the writer is returned, ready for a checkpoint and start.
    """
    records = published(rows)
    if servers:
        chosen = {"kafka.bootstrap.servers": servers, "includeHeaders": "true", **(options or {})}
        if records.isStreaming:
            return records.writeStream.format("kafka").options(**chosen)
        return records.write.format("kafka").options(**chosen).save()
    if path is None:
        raise ValueError("give servers or a path")
    if records.isStreaming:
        return records.writeStream.format("parquet").option("path", path).outputMode("append")
    return records.write.mode("append").partitionBy("topic").parquet(path)


@dataclass(frozen=True)
class JdbcSink:
    """A relational database. Rows go to a staging table; `merge` then applies them there."""

    url: str
    options: dict[str, str] = field(default_factory=dict)
    # Called with the statement that applies the staging table, once per batch.
    merge: Callable[[str], None] | None = None
    batch_size: int = 5000


def quoted(name: str) -> str:
    """A table name with its schema, each part quoted."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split(".", 1))


def delete_statement(table: Contract, staging: str) -> str:
    """Statement that removes the rows whose keys are in a staging table."""
    target, held = quoted(table.target), quoted(staging)
    same = " AND ".join(f'{target}."{c}" = {held}."{c}"' for c in table.key)
    return f"DELETE FROM {target} USING {held} WHERE {same}"


def last_per_key(rows: DataFrame, table: Contract) -> DataFrame:
    """The last row of each key by `seq`, where rows have one; an aggregate that combines before its shuffle."""
    if not table.key or "seq" not in rows.columns:
        return rows
    last = F.max_by(F.struct(*[F.col(c) for c in rows.columns]), F.col("seq"))
    return rows.groupBy(*table.key).agg(last.alias("_row")).select("_row.*")


def upsert_statement(table: Contract, staging: str, newer: str | None = None) -> str:
    """Statement that applies a staging table: insert, or update on a key conflict.

    With `newer` the update only happens when that column grows, or where either row has none. Needs one
    staging row per key.
    """
    columns = ", ".join(f'"{c}"' for c in table.names)
    target = quoted(table.target)
    statement = f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {quoted(staging)}"
    if not table.key:
        return statement
    keys = ", ".join(f'"{c}"' for c in table.key)
    sets = ", ".join(f'"{c}" = excluded."{c}"' for c in table.names if c not in table.key)
    guard = ""
    if newer:
        held, new = f'{target}."{newer}"', f'excluded."{newer}"'
        guard = f" WHERE {new} > {held} OR {new} IS NULL OR {held} IS NULL"
    return f"{statement} ON CONFLICT ({keys}) DO UPDATE SET {sets}{guard}"


def write_jdbc(rows: DataFrame, sink: JdbcSink, table: Contract, newer: str | None = None) -> str:
    """Load rows of one table, one per key, into its staging table and apply it; returns the statement."""
    staging = f"{table.target}_staging"
    (
        last_per_key(rows, table)
        .select(*table.names)
        .write.format("jdbc")
        .options(url=sink.url, dbtable=staging, batchsize=str(sink.batch_size), truncate="true", **sink.options)
        .mode("overwrite")
        .save()
    )
    statement = upsert_statement(table, staging, newer)
    if sink.merge:
        sink.merge(statement)
    return statement


def post_json(url: str, body: str, timeout_s: float) -> tuple[int, str]:
    """One POST of a JSON body: status and text of the reply."""
    request = urllib.request.Request(url, body.encode(), {"Content-Type": "application/json"}, method="POST")
    try:
        with urllib.request.urlopen(request, timeout=timeout_s) as reply:
            return reply.status, reply.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as error:
        return error.code, error.read().decode("utf-8", "replace")


def dispatch(
    mutations: DataFrame,
    endpoint: str,
    send: Callable[[str, str, float], tuple[int, str]] = post_json,
    timeout_s: float = 30.0,
    retries: int = 1,
    backoff_s: float = 0.5,
    parallel: int | None = None,
    keep: Sequence[str] = ("service", "seq", "query"),
) -> DataFrame:
    """Send every mutation as one POST; rows come back with status, body and attempts.

    A call that raises or answers 500 and above is tried again. `parallel` bounds how many tasks send at
    once. Every evaluation of the result sends again, so write it once and read that; a task that is run
    again sends its rows again, which the receiver answers with "already exists".
    """
    rows = mutations.select(*keep, F.to_json(F.struct("query")).alias("request"))
    if parallel:
        rows = rows.repartition(parallel)
    added = [
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]

    def call(request: str) -> tuple[int | None, str, int]:
        status, body = None, ""
        for attempt in range(1, retries + 2):
            try:
                status, body = send(endpoint, request, timeout_s)
            except OSError as error:
                status, body = None, str(error)
            if status is not None and status < 500:
                return status, body, attempt
            if attempt <= retries:
                time.sleep(backoff_s)
        return status, body, retries + 1

    def post_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies = [call(request) for request in batch["request"]]
            yield batch.drop(columns="request").assign(
                status=pd.array([r[0] for r in replies], dtype="Int32"),
                body=[r[1] for r in replies],
                attempts=pd.array([r[2] for r in replies], dtype="Int32"),
            )

    schema = T.StructType([f for f in rows.schema.fields if f.name != "request"] + added)
    return rows.mapInPandas(post_all, schema)
