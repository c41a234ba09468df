"""Physical table of a row, from tenant context and data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.config import (
    DM_FIXED_TYPE_SCHEMA,
    DM_HTTP_ERRORS,
    DM_SQL_ERRORS,
    DM_TYPE_DATABASE,
    DM_TYPE_SCHEMA,
    FlowConfig,
)
from cityflow.functions.text import sanitise_name

# Default header of each routing field, as error texts name it.
FIELD_HEADERS = {
    "service": "fiware-service",
    "servicepath": "fiware-servicepath",
    "datamodel": "fiware-datamodel",
    "entitytype": "entityType",
    "suffix": "suffix",
}

# Fields each data model cannot do without.
REQUIRED = {
    DM_TYPE_DATABASE: ("service", "entitytype"),
    DM_TYPE_SCHEMA: ("servicepath", "entitytype"),
    DM_FIXED_TYPE_SCHEMA: ("servicepath", "entitytype"),
    DM_SQL_ERRORS: ("service",),
    DM_HTTP_ERRORS: ("service",),
}


def route(rows: DataFrame, config: FlowConfig = FlowConfig(), flow: str = "historic") -> DataFrame:
    """Add target_schema, target_table, `target` (schema.table) and route_error.

    The data model is the record's own when it names one, else the configured one, else one table per
    entity type in the tenant's schema. A configured field is the value of the header of that name, or
    the name itself when no such header exists (headers are looked up in `hdr` when present). A
    configured schema beats every data model. Rows that lack a required field get `route_error`.
    """
    suffix_text = "" if flow == "historic" else f"_{flow}"
    own = {
        "service": sanitise_name(F.col("service")),
        "servicepath": sanitise_name(F.col("servicepath")),
        "entitytype": sanitise_name(F.col("entitytype")),
        "suffix": F.lit(suffix_text if config.table_suffix is None else config.table_suffix),
        "datamodel": F.col("datamodel"),
    }
    value = {name: _configured(rows, config, name, default) for name, default in own.items()}
    staged = rows.withColumns(
        {
            "_service": value["service"],
            "_path": value["servicepath"],
            "_type": value["entitytype"],
            "_suffix": F.coalesce(value["suffix"], F.lit("")),
            "_model": F.coalesce(
                F.nullif(value["datamodel"], F.lit("")), F.lit(config.datamodel), F.lit(DM_TYPE_DATABASE)
            ),
        }
    )
    model = F.col("_model")
    is_error = model.isin(DM_SQL_ERRORS, DM_HTTP_ERRORS)
    schema = (
        F.when((model == DM_TYPE_DATABASE) | is_error, F.col("_service"))
        .when(model.isin(DM_TYPE_SCHEMA, DM_FIXED_TYPE_SCHEMA), F.col("_path"))
    )
    typed_table = F.concat("_path", F.lit("_"), "_type", "_suffix")
    table = (
        F.when(model.isin(DM_TYPE_DATABASE, DM_TYPE_SCHEMA), typed_table)
        .when(model == DM_FIXED_TYPE_SCHEMA, F.concat("_type", "_suffix"))
        .when(is_error, F.concat("_service", F.lit("_error_log")))
    )
    error = _missing_field(model)
    routed = staged.withColumn("route_error", error).withColumns(
        {
            "target_schema": F.when(F.col("route_error").isNull(), F.coalesce(F.lit(config.schema_override), schema)),
            "target_table": F.when(F.col("route_error").isNull(), table),
        }
    )
    return routed.withColumn("target", F.concat("target_schema", F.lit("."), "target_table")).drop(
        "_service", "_path", "_type", "_suffix", "_model"
    )


def _configured(rows: DataFrame, config: FlowConfig, name: str, default: Column) -> Column:
    chosen = config.fields.get(name)
    if chosen is None:
        return default
    if "hdr" not in rows.columns:
        return F.lit(chosen)
    return F.coalesce(F.try_element_at("hdr", F.lit(chosen.lower())), F.lit(chosen))


def _missing_field(model: Column) -> Column:
    columns = {"service": "_service", "servicepath": "_path", "entitytype": "_type"}
    error = F.when(~model.isin(*REQUIRED), F.concat(F.lit("Unknown datamodel: "), model))
    for name, fields in REQUIRED.items():
        for field in fields:
            empty = F.coalesce(F.col(columns[field]), F.lit("")) == ""
            error = error.when(
                (model == name) & empty, F.lit(f"Required header missing or empty: {FIELD_HEADERS[field]}")
            )
    return error


def route_documents(rows: DataFrame, prefix: str = "") -> DataFrame:
    """Add `database` and `collection` of a document; the entity type keeps its case."""
    path = sanitise_name(F.concat("service", "servicepath", F.lit("_")))
    return rows.withColumns(
        {
            "database": F.concat(F.lit(prefix), F.col("service")),
            "collection": F.concat(F.lit(prefix), path, F.coalesce("entitytype", F.lit("undefined"))),
        }
    )
