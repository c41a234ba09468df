"""Render ordinary tables as raw notification records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.times import iso_text


def attribute(kind: str, value: Column, metadata: Column | None = None) -> Column:
    """One `{type, value[, metadata]}` attribute."""
    members = [F.lit(kind).alias("type"), value.alias("value")]
    if metadata is not None:
        members.append(metadata.alias("metadata"))
    return F.struct(*members)


def time_attribute(ts: Column) -> Column:
    """A DateTime attribute holding the ISO text of a timestamp."""
    return attribute("DateTime", iso_text(ts))


def headers_of(service: Column, servicepath: Column, datamodel: Column | None = None) -> Column:
    """Record headers naming the tenant."""
    pairs = [("fiware-service", service), ("fiware-servicepath", servicepath)]
    if datamodel is not None:
        pairs.append(("fiware-datamodel", datamodel))
    return F.array(*[F.struct(F.lit(k).alias("key"), F.encode(v, "utf-8").alias("value")) for k, v in pairs])


def as_raw(
    table: DataFrame,
    flow: str,
    value: Column,
    offset: Column,
    headers: Column | None = None,
    kafka_ts: Column | None = None,
    partition: Column | None = None,
) -> DataFrame:
    """Raw records with `value` as body, one per row of `table`."""
    none = F.lit(None)
    return table.select(
        F.lit(flow).alias("flow"),
        F.lit(f"raw_{flow}").alias("topic"),
        (F.lit(0) if partition is None else partition).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        (F.lit("2024-01-01").cast("timestamp") if kafka_ts is None else kafka_ts).alias("kafka_ts"),
        none.cast("binary").alias("key"),
        value.alias("value"),
        (none.cast("array<struct<key:string,value:binary>>") if headers is None else headers).alias("headers"),
    )


def notification(entity_id: Column, entity_type: Column, attributes: Mapping[str, Column]) -> Column:
    """Notification body with one entity."""
    return notification_of(entity(entity_id, entity_type, attributes))


def entity(entity_id: Column, entity_type: Column, attributes: Mapping[str, Column]) -> Column:
    """One entity struct."""
    return F.struct(
        entity_id.alias("id"), entity_type.alias("type"), *[column.alias(name) for name, column in attributes.items()]
    )


def notification_of(*entities: Column) -> Column:
    """Notification body with the given entities (which must have equal members)."""
    body = F.struct(F.lit("sub").alias("subscriptionId"), F.array(*entities).alias("data"))
    return F.to_json(body, {"ignoreNullFields": "false"})
