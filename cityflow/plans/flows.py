"""The three ways through the library, each one chain of narrow operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.config import FlowConfig, GraphConfig
from cityflow.operators.context import with_context, with_headers
from cityflow.operators.contract import check_contract
from cityflow.operators.decode import (
    accepted,
    classify_changes,
    explode_entities,
    explode_flagged,
    parse,
    parse_flagged,
    rejection,
    with_recvtime,
)
from cityflow.operators.documents import build_documents
from cityflow.operators.graph import build_mutations, explode_graph_entities
from cityflow.operators.routing import route, route_documents


def read_context(records: DataFrame) -> DataFrame:
    """Raw records with headers and tenant context."""
    return with_context(with_headers(records))


def flagged_entities(
    records: DataFrame,
    tables: DataFrame,
    flow: str,
    config: FlowConfig = FlowConfig(),
    received: Column | None = None,
) -> DataFrame:
    """Typed, routed and checked entities of a relational flow; `reject` says why a row cannot go on.

    One pass over the records and no shuffle. Rows without entities are included, with code
    NO_ENTITIES. `attrs` of rows for which there is no table is NULL. Columns of delete rows are not checked, as they carry a key only; their table must exist.
    """
    rows = explode_flagged(parse_flagged(read_context(records)))
    rows = classify_changes(rows, "lastdata") if flow == "lastdata" else rows.withColumn("change", F.lit("update"))
    rows = with_recvtime(route(rows, config, flow), received)
    misrouted = rejection("route", "ROUTE", F.col("route_error"))
    rows = rows.withColumn(
        "reject", F.when(F.col("reject").isNull() & F.col("route_error").isNotNull(), misrouted).otherwise(F.col("reject"))
    )
    checked = check_contract(rows, tables)
    no_table = (F.col("change") == "delete") & (F.col("reject.code") == "TABLE_MISSING")
    key_only = F.col("change").isin("delete", "ignored") & (F.col("reject.stage") == "contract") & ~no_table
    return checked.withColumn("reject", F.when(~F.coalesce(key_only, F.lit(False)), F.col("reject")))


def entities_of(records: DataFrame) -> DataFrame:
    """Usable entities of raw records with their context."""
    good, _ = parse(read_context(records))
    return explode_entities(good)


def documents_of(records: DataFrame, prefix: str = "", received: Column | None = None) -> DataFrame:
    """Documents of raw records, with the namespace each belongs to."""
    return build_documents(route_documents(with_recvtime(entities_of(records), received), prefix))


def mutations_of(records: DataFrame, config: GraphConfig = GraphConfig()) -> DataFrame:
    """Graph mutations of raw records."""
    return build_mutations(accepted(explode_graph_entities(read_context(records))), config)
