"""Error log rows from dead-letter records and from rejects of our own operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.config import FlowConfig
from cityflow.functions.binding import bind
from cityflow.functions.text import json_quote, number_text, strip, truncate_with_note
from cityflow.functions.times import iso_text
from cityflow.operators.envelope import error_headers, with_topic

# Longest error text and statement of an error row.
MAX_ERROR = 4000
MAX_QUERY = 8000

# What a statement, its schema, the main message and its detail look like in an error text, and
# what follows the tenant in a topic name.
STATEMENT = r'(INSERT INTO "[^"]+"[^)]+\)[^)]*\))'
STATEMENT_SCHEMA = r'INSERT INTO "([^"]+)"'
MAIN_MESSAGE = r"(ERROR: .+?)(\n|\z)"
DETAIL = r"(Detail: .+?)(\n|\z)"
AFTER_TENANT = r"_(historic|lastdata|mutable|http).*$"

_VALUE = "payload MAP<STRING,VARIANT>, _bad STRING"


def errors_from_rejected(records: DataFrame, config: FlowConfig = FlowConfig(), now: Column | None = None) -> DataFrame:
    """Error rows of dead-letter records: the records' columns plus tenant, timestamp, error and query.

    Needs `hdr` with its key case kept. Records whose value is no JSON, or is JSON null, are left out.
    """
    text = F.col("value")
    parsed = F.from_json(text, _VALUE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    header = lambda name: F.nullif(F.try_element_at("hdr", F.lit(name)), F.lit(""))
    message = F.coalesce(header("__connect.errors.exception.message"), F.lit("Unknown error"))
    cause = header("__connect.errors.exception.cause.message")
    full = F.when(
        cause.isNotNull() & ~F.contains(message, cause), F.concat(message, F.lit("\nCaused by: "), cause)
    ).otherwise(message)
    staged = bind(records, "_parsed", F.struct(parsed.alias("m"), F.schema_of_variant(F.try_parse_json(text)).alias("kind")))
    # What is no JSON has no kind, and JSON null holds no record.
    staged = staged.withColumn("_full", full).where(F.col("_parsed.kind") != "VOID")
    staged = staged.withColumn("tenant", _tenant(F.col("_full"), header("__connect.errors.topic"), config.prefix))
    table = F.coalesce(header("target_table"), F.lit("unknown_table"))
    statement = F.nullif(F.regexp_extract("_full", STATEMENT, 1), F.lit(""))
    query = F.coalesce(statement, _rebuilt(F.col("_parsed.m.payload"), F.col("tenant"), table, text))
    return staged.withColumns(
        {
            "timestamp": F.current_timestamp() if now is None else now,
            "error": truncate_with_note(_main_message(F.col("_full")), MAX_ERROR),
            "query": truncate_with_note(query, MAX_QUERY),
        }
    ).drop("_parsed", "_full")


def _tenant(full: Column, topic: Column, prefix: str) -> Column:
    in_statement = F.substring_index(F.regexp_extract(full, STATEMENT_SCHEMA, 1), ".", 1)
    named = F.coalesce(topic, in_statement)
    if prefix:
        named = F.when(named.startswith(prefix), F.substring(named, F.lit(len(prefix) + 1), F.length(named))).otherwise(
            named
        )
    cut = F.regexp_replace(named, AFTER_TENANT, "")
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("unknown"))


def _main_message(full: Column) -> Column:
    main = strip(F.regexp_extract(full, MAIN_MESSAGE, 1))
    detail = strip(F.regexp_extract(full, DETAIL, 1))
    return F.when(main == "", full).otherwise(
        F.when(detail == "", main).otherwise(F.concat(main, F.lit(" - "), detail))
    )


def _rebuilt(payload: Column, tenant: Column, table: Column, value: Column) -> Column:
    """Insert statement of the payload, or the whole value when it has none."""
    entries = F.map_entries(payload)
    columns = F.array_join(F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('"'))), ",")
    values = F.array_join(F.transform(entries, lambda e: _literal(e["value"])), ",")
    statement = F.concat(
        F.lit('INSERT INTO "'), tenant, F.lit('"."'), table, F.lit('" ('), columns, F.lit(") VALUES ("), values, F.lit(")")
    )
    return F.when(F.coalesce(F.size(payload), F.lit(0)) > 0, statement).otherwise(
        F.coalesce(F.get_json_object(value, "$"), value)
    )


def _literal(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    quoted = lambda text: F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    return (
        F.when(value.isNull() | (kind == "VOID"), F.lit("NULL"))
        .when(kind == "STRING", quoted(F.try_variant_get(value, "$", "string")))
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("string"))
        # Nested values as quoted JSON text.
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), quoted(F.to_json(value)))
        .otherwise(number_text(F.try_variant_get(value, "$", "double")))
    )


def to_error_events(errors: DataFrame, config: FlowConfig = FlowConfig()) -> DataFrame:
    """Published form of error rows: out_topic, message and message_headers."""
    member = lambda name, value: F.concat(F.lit(f'"{name}":'), F.coalesce(json_quote(value), F.lit("null")))
    message = F.concat(
        F.lit(
            '{"schema":{"type":"struct","fields":['
            '{"field":"timestamp","type":"string","optional":false},'
            '{"field":"error","type":"string","optional":false},'
            '{"field":"query","type":"string","optional":true}],"optional":false},"payload":{'
        ),
        F.concat_ws(",", member("timestamp", iso_text(F.col("timestamp"))), member("error", F.col("error")),
                    member("query", F.col("query"))),
        F.lit("}}"),
    )
    return with_topic(errors, config, "errors").withColumns(
        {"message": message, "message_headers": error_headers(F.col("tenant"))}
    )


def routing_rejects(routed: DataFrame) -> DataFrame:
    """Rows with `route_error` as rejects."""
    reject = F.struct(
        F.lit("route").alias("stage"), F.lit("ROUTE").alias("code"), F.col("route_error").alias("error")
    )
    return routed.where(F.col("route_error").isNotNull()).withColumn("reject", reject)


def rejects_to_error_log(*rejects: DataFrame, now: Column | None = None) -> DataFrame:
    """Error log rows of rejects: tenant, timestamp, error, query, stage, code, seq and value.

    The statement names the target table when there is one, and carries the entity it was for; like the
    error it is cut to its limit. `value` is what was refused, whole, as nothing else keeps it.
    """

    def as_log(rows: DataFrame) -> DataFrame:
        has = set(rows.columns)
        pick = lambda name, other="": F.col(name) if name in has else F.lit(other or None).cast("string")
        schema = F.coalesce(pick("target_schema"), pick("service", "unknown"))
        table = F.coalesce(pick("target_table"), F.lit("unknown_table"))
        body = F.coalesce(pick("value"), pick("entityid"))
        query = F.concat(
            F.lit('INSERT INTO "'), schema, F.lit('"."'), table, F.lit('" '), F.coalesce(body, F.lit(""))
        )
        return rows.select(
            F.coalesce(pick("service", "unknown"), F.lit("unknown")).alias("tenant"),
            (F.current_timestamp() if now is None else now).alias("timestamp"),
            truncate_with_note(F.col("reject.error"), MAX_ERROR).alias("error"),
            truncate_with_note(query, MAX_QUERY).alias("query"),
            F.col("reject.stage").alias("stage"),
            F.col("reject.code").alias("code"),
            (F.col("seq") if "seq" in has else F.struct("partition", "offset", F.lit(0).alias("pos"))).alias("seq"),
            body.alias("value"),
        )

    return reduce(DataFrame.unionByName, [as_log(r) for r in rejects])
