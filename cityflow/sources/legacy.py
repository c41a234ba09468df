"""Older notification shape to the current one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.text import json_quote
from cityflow.sources.raw import HEADER_TYPE

_BODY = "entityId STRING, entityType STRING, attributes ARRAY<STRING>"
_ATTRIBUTE = "attrName STRING, attrValue VARIANT, type STRING"

# Fixed value: subscription of a rewritten notification.
LEGACY_SUBSCRIPTION = "DefaultSubscriptionId"


def _member(text: Column) -> Column:
    """JSON member of one legacy attribute, `"name":{...}`."""
    one = F.from_json(text, _ATTRIBUTE)
    is_string = F.schema_of_variant(one["attrValue"]) == "STRING"
    value = F.when(is_string, json_quote(F.try_variant_get(one["attrValue"], "$", "string"))).otherwise(
        F.coalesce(F.get_json_object(text, "$.attrValue"), F.lit("null"))
    )
    typed = F.concat(F.lit('{"type":'), json_quote(one["type"]), F.lit(',"value":'), value, F.lit(',"metadata":{}}'))
    untyped = F.concat(F.lit('{"value":'), value, F.lit("}"))
    has_type = F.coalesce(one["type"], F.lit("")) != ""
    return F.concat(json_quote(one["attrName"]), F.lit(":"), F.when(has_type, typed).otherwise(untyped))


def normalise_legacy(records: DataFrame) -> DataFrame:
    """Records whose value is `{flow, headers, body|payload}` in the form a current producer sends.

    `{entityId, entityType, attributes: [{attrName, attrValue, type}]}` becomes the only element of
    `data`, a payload that already has `data` is taken as it is, a top-level `alterationType` joins the
    entity, and the headers of the envelope become record headers where the record has none. Records
    of any other shape pass unchanged.
    """
    envelope = F.from_json(
        "value", "flow STRING, headers MAP<STRING,STRING>, body STRING, payload STRING, alterationType STRING"
    )
    staged = records.withColumn("_env", envelope).withColumn(
        "_inner", F.coalesce(F.col("_env.body"), F.col("_env.payload"))
    )
    staged = staged.withColumn("_body", F.from_json("_inner", _BODY)).withColumn(
        "_members", F.transform(F.coalesce("_body.attributes", F.array().cast("array<string>")), _member)
    )
    alteration = F.col("_env.alterationType")
    alteration_member = F.concat(
        F.lit('"alterationType":'),
        F.when(alteration.startswith("{"), alteration).otherwise(
            F.concat(F.lit('{"value":'), json_quote(alteration), F.lit("}"))
        ),
    )
    id_members = F.array(
        F.concat(F.lit('"id":'), json_quote(F.col("_body.entityId"))),
        F.concat(F.lit('"type":'), F.coalesce(json_quote(F.col("_body.entityType")), F.lit("null"))),
    )
    none = F.array().cast("array<string>")
    members = F.concat(
        id_members, F.col("_members"), F.when(alteration.isNotNull(), F.array(alteration_member)).otherwise(none)
    )
    rewritten = F.concat(
        F.lit('{"subscriptionId":"' + LEGACY_SUBSCRIPTION + '","data":[{'), F.array_join(members, ","), F.lit("}]}")
    )
    is_legacy = F.col("_body.entityId").isNotNull()
    is_wrapped = F.get_json_object("_inner", "$.data").isNotNull()
    present = F.filter(F.map_entries("_env.headers"), lambda e: e["value"].isNotNull())
    listed = F.transform(
        present, lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "utf-8").alias("value"))
    ).cast(HEADER_TYPE)
    bare = F.coalesce(F.size("headers"), F.lit(0)) <= 0
    moved = staged.withColumns(
        {
            "headers": F.when((is_legacy | is_wrapped) & bare, listed).otherwise(F.col("headers")),
            "flow": F.when(
                is_legacy | is_wrapped, F.coalesce(F.lower(F.col("_env.flow")), F.col("flow"))
            ).otherwise(F.col("flow")),
            "value": F.when(is_legacy, rewritten).when(is_wrapped, F.col("_inner")).otherwise(F.col("value")),
        }
    )
    return moved.drop("_env", "_inner", "_body", "_members")
