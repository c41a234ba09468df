"""Documents: one JSON text per entity, with attribute metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.text import json_quote


def build_documents(entities: DataFrame) -> DataFrame:
    """Add `document` and `document_key` (needs `recvtime`, `database` and `collection`).

    The document holds recvTime, entityId, entityType, then for every member of the entity but `id` and
    `type` its value, and its metadata as `<name>_md` when there is any. Names keep their case, the
    order is that of the entity, and a member without a value is left out.
    """
    members = F.filter(F.map_entries("entity"), lambda e: ~e["key"].isin("id", "type"))
    parsed = F.transform(
        members,
        lambda e: F.struct(
            e["key"].alias("name"),
            e["value"].alias("json"),
            F.from_json(e["value"], "value VARIANT, metadata STRING").alias("p"),
        ),
    )
    parts = F.flatten(
        F.transform(
            parsed,
            lambda m: F.filter(
                F.array(
                    F.struct(m["name"].alias("key"), _value(m).alias("value")),
                    F.struct(F.concat(m["name"], F.lit("_md")).alias("key"), _metadata(m).alias("value")),
                ),
                lambda part: part["value"].isNotNull(),
            ),
        )
    )
    head = F.array(
        _part("recvTime", json_quote(F.col("recvtime"))),
        _part("entityId", json_quote(F.col("entityid"))),
        _part("entityType", json_quote(F.col("entitytype"))),
    )
    # A member named like one of the three takes its place.
    unique = F.map_entries(F.map_from_entries(F.filter(F.concat(head, parts), lambda p: p["value"].isNotNull())))
    text = F.array_join(F.transform(unique, lambda p: F.concat(json_quote(p["key"]), F.lit(":"), p["value"])), ",")
    return entities.withColumns(
        {
            "document": F.concat(F.lit("{"), text, F.lit("}")),
            "document_key": F.to_json(F.struct("database", "collection")),
        }
    )


def _part(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.alias("value"))


def _value(m: Column) -> Column:
    value = m["p"]["value"]
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", json_quote(F.try_variant_get(value, "$", "string"))).when(
        value.isNotNull(), F.coalesce(F.get_json_object(m["json"], "$.value"), F.lit("null"))
    )


def _metadata(m: Column) -> Column:
    text = m["p"]["metadata"]
    return F.when(text.rlike(r"^\s*[\{\[]") & ~F.regexp_replace(text, r"\s", "").isin("{}", "[]"), text)
