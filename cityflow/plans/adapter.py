"""The benchmark tables as notification streams.

Every function renders whole tables as raw records, so the queries run the full decode path on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.functions.times import iso_text
from cityflow.operators.contract import Contract, contract
from cityflow.sources.render import (
    as_raw,
    attribute,
    entity,
    headers_of,
    notification,
    notification_of,
    time_attribute,
)

# A prime, and the order in which the events of each block of that many arrive.
BLOCK = 100003
STEP = 7919

# Receipt time used wherever results are compared.
RECEIVED = "2024-06-01 00:00:00"

USER_TABLE = "city.devices_user"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; their times have no zone and are taken as UTC."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "timestamp_ntz"]
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else rows


def cores(spark: SparkSession) -> int:
    """Tasks that run at once."""
    return max(2, spark.sparkContext.defaultParallelism)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table whose rows are to be decoded, on all cores.

    A table of few files or row groups is read by few tasks. Its rows are dealt out before they are rendered, as decoding
    costs far more than moving a row.
    """
    rows = table(spark, sf_dir, name)
    return rows if rows.rdd.getNumPartitions() >= cores(spark) else rows.repartition(cores(spark))


def arrival(event_id: Column) -> Column:
    """Out-of-order offset of an event, unique for any number of events."""
    return (event_id * STEP) % BLOCK + F.floor(event_id / BLOCK) * BLOCK


def received() -> Column:
    """The fixed receipt time."""
    return F.lit(RECEIVED).cast("timestamp")


def user_contract(flow: str = "lastdata", with_time: bool = True) -> Contract:
    """Contract of the table the events go to."""
    suffix = "" if flow == "historic" else f"_{flow}"
    pk = ["entityid"] if flow == "lastdata" else ["entityid", "timeinstant"]
    return contract(
        USER_TABLE + suffix, {"value": "double precision", "kind": "text", "props": "json"}, pk, with_time=with_time
    )


def _event_attributes() -> dict[str, Column]:
    return {
        "TimeInstant": time_attribute(F.col("ts")),
        "value": attribute("Number", F.col("value")),
        "kind": attribute("Text", F.col("event_type")),
        "props": attribute("StructuredValue", F.parse_json("props")),
    }


def _event_headers() -> Column:
    return headers_of(F.lit("City"), F.lit("/devices"))


def events_raw(
    spark: SparkSession,
    sf_dir: str,
    flow: str = "lastdata",
    time: Column | None = None,
    with_changes: bool = False,
) -> DataFrame:
    """Events as notifications about users; with changes, an error event deletes its user."""
    attributes = _event_attributes()
    if time is not None:
        attributes["TimeInstant"] = time_attribute(time)
    if with_changes:
        change = F.when(F.col("event_type") == "error", "entityDelete").otherwise("entityUpdate")
        attributes["alterationType"] = attribute("Text", change)
    events = source(spark, sf_dir, "events")
    body = notification(F.concat(F.lit("U"), "user_id"), F.lit("User"), attributes)
    return as_raw(events, flow, body, arrival(F.col("event_id")), _event_headers(), F.col("ts"))


def partial_events_raw(spark: SparkSession, sf_dir: str, flow: str = "lastdata", hourly: bool = False) -> DataFrame:
    """Events that carry only some attributes: value on click and purchase, kind on all but view."""
    kind = F.col("event_type")
    time = F.date_trunc("hour", "ts") if hourly else F.col("ts")
    value = F.when(kind.isin("click", "purchase"), attribute("Number", F.col("value")))
    named = F.when(kind != "view", attribute("Text", kind))
    members = F.to_json(
        F.struct(
            F.concat(F.lit("U"), "user_id").alias("id"),
            F.lit("User").alias("type"),
            time_attribute(time).alias("TimeInstant"),
            value.alias("value"),
            named.alias("kind"),
        )
    )
    body = F.concat(F.lit('{"subscriptionId":"sub","data":['), members, F.lit("]}"))
    return as_raw(source(spark, sf_dir, "events"), flow, body, arrival(F.col("event_id")), _event_headers(), F.col("ts"))


def timeless_events_raw(spark: SparkSession, sf_dir: str, with_changes: bool = False) -> DataFrame:
    """Events of which views have no time; with changes, an error event deletes its user."""
    kind = F.col("event_type")
    change = F.when(kind == "error", "entityDelete").otherwise("entityUpdate")
    changes = [attribute("Text", change).alias("alterationType")] if with_changes else []
    members = F.to_json(
        F.struct(
            F.concat(F.lit("U"), "user_id").alias("id"),
            F.lit("User").alias("type"),
            F.when(kind != "view", time_attribute(F.col("ts"))).alias("TimeInstant"),
            attribute("Number", F.col("value")).alias("value"),
            attribute("Text", kind).alias("kind"),
            *changes,
        )
    )
    body = F.concat(F.lit('{"subscriptionId":"sub","data":['), members, F.lit("]}"))
    return as_raw(
        source(spark, sf_dir, "events"), "lastdata", body, arrival(F.col("event_id")), _event_headers(), F.col("ts")
    )


def renamed_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a later version of their senders writes them: `label` in place of `kind`, and the number of the event."""
    members = F.to_json(
        F.struct(
            F.concat(F.lit("U"), "user_id").alias("id"),
            F.lit("User").alias("type"),
            time_attribute(F.col("ts")).alias("TimeInstant"),
            attribute("Number", F.col("value")).alias("value"),
            attribute("Text", F.col("event_type")).alias("label"),
            attribute("Number", F.col("event_id")).alias("event"),
        )
    )
    body = F.concat(F.lit('{"subscriptionId":"sub","data":['), members, F.lit("]}"))
    return as_raw(
        source(spark, sf_dir, "events"), "lastdata", body, arrival(F.col("event_id")), _event_headers(), F.col("ts")
    )


def orders_raw(spark: SparkSession, sf_dir: str, flow: str = "historic") -> DataFrame:
    """Orders as notifications of two entities: the order, then its customer."""
    orders = source(spark, sf_dir, "orders")
    urgent = F.substring("o_orderpriority", 1, 1) == "1"
    attributes = {
        "TimeInstant": time_attribute(F.col("o_orderdate")),
        "total": attribute("Number", F.col("o_totalprice")),
        "Status": attribute("Text", F.col("o_orderstatus")),
        "ordered": attribute("DateTime", iso_text(F.col("o_orderdate"))),
        "urgent": attribute("Boolean", urgent),
        "note": attribute("Text", F.lit(None).cast("string")),
    }
    body = notification_of(
        entity(F.concat(F.lit("O"), "o_orderkey"), F.lit("Order"), attributes),
        entity(F.concat(F.lit("C"), "o_custkey"), F.lit("Customer"), attributes),
    )
    headers = headers_of(F.lit("Shop"), F.concat(F.lit("/"), F.lower("o_orderstatus")))
    return as_raw(orders, flow, body, F.col("o_orderkey"), headers, F.col("o_orderdate"))


def lineitem_raw(spark: SparkSession, sf_dir: str, flow: str = "historic") -> DataFrame:
    """Order lines as notifications of one entity."""
    lines = source(spark, sf_dir, "lineitem")
    attributes = {
        "TimeInstant": time_attribute(F.col("l_shipdate")),
        "quantity": attribute("Number", F.col("l_quantity")),
        "price": attribute("Number", F.col("l_extendedprice")),
        "shipped": attribute("DateTime", iso_text(F.col("l_shipdate"))),
        "flag": attribute("Text", F.col("l_returnflag")),
    }
    line = F.concat(F.lit("L"), "l_orderkey", F.lit("-"), "l_linenumber")
    body = notification(line, F.lit("OrderLine"), attributes)
    offset = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    return as_raw(lines, flow, body, offset, headers_of(F.lit("Shop"), F.lit("/lines")), F.col("l_shipdate"))


def customers_raw(spark: SparkSession, sf_dir: str, datamodel: Column | None = None, path: Column | None = None) -> DataFrame:
    """Customers as notifications; the tenant is the nation, the service path the market segment."""
    customers = source(spark, sf_dir, "customer")
    # Nations are a fixed list of 25, which Spark broadcasts by its size.
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"])
    body = notification(F.col("c_name"), F.lit("Key-Account"), {"balance": attribute("Number", F.col("c_acctbal"))})
    segment = F.concat(F.lit("/"), "c_mktsegment", F.lit("/")) if path is None else path
    return as_raw(joined, "historic", body, F.col("c_custkey"), headers_of(F.col("n_name"), segment, datamodel))


def documents_raw(spark: SparkSession, sf_dir: str, flow: str = "mongo") -> DataFrame:
    """Documents as notifications: the whole text, with the language as its metadata."""
    documents = source(spark, sf_dir, "documents")
    about = F.struct(F.struct(F.lit("Text").alias("type"), F.col("lang").alias("value")).alias("lang"))
    attributes = {
        "text": attribute("Text", F.col("text"), about),
        "nChars": attribute("Number", F.col("n_chars")),
    }
    body = notification(F.concat(F.lit("D"), "doc_id"), F.col("lang"), attributes)
    headers = headers_of(F.lit("Library"), F.concat(F.lit("/"), "source"))
    return as_raw(documents, flow, body, F.col("doc_id"), headers)


def plain_raw(source: DataFrame, flow: str, members: dict[str, Column], offset: Column, service: str = "graph") -> DataFrame:
    """Rows as notifications of one entity with plain values, as the graph flow gets them."""
    element = F.struct(*[v.alias(k) for k, v in members.items()])
    body = F.to_json(F.struct(F.array(element).alias("data")), {"ignoreNullFields": "false"})
    return as_raw(source, flow, body, offset, headers_of(F.lit(service), F.lit("/")))
