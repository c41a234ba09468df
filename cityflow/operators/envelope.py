"""Published form of decoded entities: envelope, key, headers, topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.config import DM_SQL_ERRORS, FlowConfig, GraphConfig
from cityflow.functions.binding import bind
from cityflow.functions.geometry import SRID, wkb_by_steps
from cityflow.functions.text import json_quote, number_text, sanitise_name

# Names of published field types.
TIMESTAMP_FIELD = '"type":"int64","name":"org.apache.kafka.connect.data.Timestamp"'
GEOMETRY_FIELD = (
    '"type":"struct","name":"io.confluent.connect.jdbc.data.geometry.Geometry",'
    '"fields":[{"field":"wkb","type":"bytes"},{"field":"srid","type":"int32"}]'
)


def to_envelope(entities: DataFrame) -> DataFrame:
    """Add `message`, `{schema: {fields}, payload}` as JSON text.

    Fields come in the order base columns, attributes, recvtime; an attribute named like a base column
    takes its place. Needs `attrs` and `recvtime`. Everything is an expression, so that a row is written as it is read:
    with a function in Python, rows wait for it on disk, and those without a geometry, the most by far, by the hundred thousand.
    """
    base = [
        _field(F.lit(name), F.lit("string"), F.col(column), F.lit(None).cast("string"))
        for name, column in (
            ("entityid", "entityid"),
            ("entitytype", "entitytype"),
            ("fiwareservicepath", "servicepath"),
        )
    ]
    no_receipt = F.filter("attrs", lambda a: a["name"] != "recvtime")
    listed = F.transform(
        F.transform(
            no_receipt,
            lambda a: F.struct(a["name"].alias("name"), a["kind"].alias("kind"), _text(a).alias("text"), a["wkt"].alias("wkt")),
        ),
        lambda f: _field(f["name"], f["kind"], f["text"], f["wkt"]),
    )
    fields = F.map_values(F.map_from_entries(F.concat(F.array(*base), listed)))
    staged = bind(entities, "_fields", fields)
    receipt_field = F.lit('{"field":"recvtime","type":"string","optional":false}')
    receipt = F.concat(F.lit('"recvtime":'), json_quote(F.col("recvtime")))
    message = F.concat(
        F.lit('{"schema":{"type":"struct","fields":['),
        F.array_join(F.concat(F.col("_fields.schema"), F.array(receipt_field)), ","),
        F.lit('],"optional":false},"payload":{'),
        F.array_join(F.concat(F.col("_fields.member"), F.array(receipt)), ","),
        F.lit("}}"),
    )
    return staged.withColumn("message", message).drop("_fields")


def _field(name: Column, kind: Column, text: Column, wkt: Column) -> Column:
    """Entry of a map of fields by name: what a field is written as in the schema and in the payload."""
    made = F.struct(
        _schema_field(name, kind, text.isNull() & wkt.isNull()).alias("schema"),
        _payload_member(name, kind, text, wkt).alias("member"),
    )
    return F.struct(name.alias("key"), made.alias("value"))


def _text(a: Column) -> Column:
    return (
        F.when(a["kind"] == "double", number_text(a["v_double"]))
        .when(a["kind"] == "boolean", a["v_bool"].cast("string"))
        .when(a["kind"] == "timestamp", F.unix_millis(a["v_ts"]).cast("string"))
        .otherwise(a["v_string"])
    )


def _schema_field(name: Column, kind: Column, is_null: Column) -> Column:
    described = (
        F.when(kind == "geometry", F.lit(GEOMETRY_FIELD))
        .when(kind == "timestamp", F.lit(TIMESTAMP_FIELD))
        # A geometry that could not be converted is published as it came, under a type no table has.
        .when(kind == "bad_geometry", F.lit('"type":"geometry"'))
        .otherwise(F.concat(F.lit('"type":"'), kind, F.lit('"')))
    )
    optional = F.when(is_null, "true").otherwise("false")
    return F.concat(
        F.lit('{"field":'), json_quote(name), F.lit(","), described, F.lit(',"optional":'), optional, F.lit("}")
    )


def _payload_member(name: Column, kind: Column, text: Column, wkt: Column) -> Column:
    value = (
        F.when(kind == "geometry", F.concat(F.lit('{"wkb":"'), F.base64(wkb_by_steps(wkt)), F.lit(f'","srid":{SRID}}}')))
        .when(kind == "string", json_quote(text))
        .otherwise(text)
    )
    return F.concat(json_quote(name), F.lit(":"), F.coalesce(value, F.lit("null")))


def to_key(entities: DataFrame, fields: Sequence[str] = ("entityid",), with_time: bool = False) -> DataFrame:
    """Add `message_key`, the record key as JSON text: required text fields, and the time if asked.

    A missing time is left out of the payload though the schema still requires it.
    """
    names = [*fields, *(["timeinstant"] if with_time else [])]
    schema = ",".join(f'{{"field":"{n}","type":"string","optional":false}}' for n in names)
    time = F.get(F.filter("attrs", lambda a: a["name"] == "timeinstant"), 0)["v_string"]
    values = [(time if n == "timeinstant" else F.col(n)).alias(n) for n in names]
    key = F.concat(
        F.lit(f'{{"schema":{{"type":"struct","fields":[{schema}],"optional":false}},"payload":'),
        F.to_json(F.struct(*values)),
        F.lit("}"),
    )
    return entities.withColumn("message_key", key)


def to_headers(entities: DataFrame, flow: str) -> DataFrame:
    """Add `message_headers`, the routing headers; names are sanitised, the data model is kept."""
    suffix = "" if flow == "historic" else f"_{flow}"
    return entities.withColumn(
        "message_headers",
        header_list(
            ("fiware-service", sanitise_name(F.col("service"))),
            ("fiware-servicepath", sanitise_name(F.col("servicepath"))),
            ("fiware-datamodel", F.coalesce("datamodel", F.lit(""))),
            ("entityType", sanitise_name(F.col("entitytype"))),
            ("entityId", sanitise_name(F.col("entityid"))),
            ("suffix", F.lit(suffix)),
        ),
    )


def error_headers(tenant: Column) -> Column:
    """Routing headers of an error record."""
    return header_list(
        ("fiware-service", tenant),
        ("fiware-datamodel", F.lit(DM_SQL_ERRORS)),
        ("fiware-servicepath", tenant),
        ("entityType", F.lit("_error_log")),
    )


def header_list(*pairs: tuple[str, Column]) -> Column:
    """Headers as an array of key and bytes."""
    return F.array(*[F.struct(F.lit(k).alias("key"), F.encode(v, "utf-8").alias("value")) for k, v in pairs])


def with_topic(rows: DataFrame, config: FlowConfig | GraphConfig, flow: str, topics: FlowConfig | None = None) -> DataFrame:
    """Add `out_topic`.

    Relational and document flows publish per tenant and flow, errors to the tenant's error topic
    (`tenant` column), mutations to one shared topic or one per tenant.
    """
    names = topics or (config if isinstance(config, FlowConfig) else FlowConfig())
    prefix, suffix = F.lit(names.prefix), F.lit(names.suffix)
    if flow == "sgtr":
        per_tenant = isinstance(config, GraphConfig) and config.topic_by_service
        middle = F.concat(F.col("service"), F.lit("_sgtr_http")) if per_tenant else F.lit("sgtr_http")
    elif flow == "errors":
        middle = F.concat(F.col("tenant"), F.lit("_error_log"))
    else:
        middle = F.concat(F.col("service"), F.lit(f"_{flow}"))
    return rows.withColumn("out_topic", F.concat(prefix, middle, suffix))
