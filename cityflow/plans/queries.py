"""Registered queries: every operator run over whole benchmark tables.

Times are given as epoch milliseconds, so that results compare the same everywhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cityflow.config import (
    DM_FIXED_TYPE_SCHEMA,
    DM_HTTP_ERRORS,
    DM_SQL_ERRORS,
    DM_TYPE_DATABASE,
    DM_TYPE_SCHEMA,
    FlowConfig,
    GraphConfig,
    configure,
    work_dir,
)
from cityflow.functions.geometry import wkb_from_wkt
from cityflow.functions.graphtext import slug
from cityflow.functions.text import sanitise_name
from cityflow.operators import errors as err
from cityflow.operators import expect, metrics
from cityflow.operators.context import with_headers
from cityflow.operators.contract import catalogue, contract, evolve, to_wide
from cityflow.operators.decode import (
    accepted,
    classify_changes,
    explode_flagged,
    infer_types,
    no_entity_counts,
    parse,
    parse_flagged,
    rejected,
    with_attributes,
    with_recvtime,
)
from cityflow.operators.envelope import to_envelope, to_headers, to_key, with_topic
from cityflow.operators.graph import classify_response, explode_graph_entities, prepare_graph_entities
from cityflow.operators.routing import route, route_documents
from cityflow.operators.tables import (
    HIGH,
    apply_historic,
    apply_lastdata,
    apply_lastdata_fast,
    apply_mutable,
    mark_repeats,
    repeat_rejection,
)
from cityflow.plans import adapter as A
from cityflow.plans.flows import documents_of, entities_of, flagged_entities, mutations_of, read_context
from cityflow.sources.legacy import normalise_legacy
from cityflow.sources.raw import FileSource, drop_replayed, read_raw, read_rejected
from cityflow.sources.render import as_raw, attribute, headers_of, notification, time_attribute
from cityflow.streaming import stateful
from cityflow.streaming.jobs import DocumentJob, ErrorJob, GraphJob, RelationalJob, run_available
from cityflow.streaming.progress import ProgressLog
from cityflow.streaming.sinks import publish, write_documents, write_error_log, write_routed

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    _REGISTRY[build.__name__] = run
    return run


def registry() -> dict[str, Query]:
    """All registered queries by name."""
    return dict(_REGISTRY)


def _ms(name: str) -> Column:
    return F.unix_millis(F.col(name))


def _rows(records: DataFrame, flow: str = "lastdata", with_time: bool = True) -> DataFrame:
    """Change rows of the user table; only its own attributes are parsed."""
    table = A.user_contract(flow, with_time)
    entities = classify_changes(entities_of(records), "lastdata")
    wide = to_wide(entities, table, ["seq", "change"])
    return wide.drop("recvtime", "props", "fiwareservicepath", "entitytype")


def _state(rows: DataFrame) -> DataFrame:
    return rows.select("entityid", _ms("timeinstant").alias("ts_ms"), "value", "kind")


# ---- lastdata -------------------------------------------------------------------------------------


@query
def lastdata_latest(spark, sf_dir):
    """Newest value and kind per user from out-of-order notifications: one aggregate."""
    rows = _rows(A.events_raw(spark, sf_dir))
    return _state(apply_lastdata_fast(None, rows.drop("change", "present")))


@query
def lastdata_fold(spark, sf_dir):
    """The same through the general fold."""
    rows = _rows(A.events_raw(spark, sf_dir))
    return _state(apply_lastdata(None, rows))


@query
def lastdata_with_deletes(spark, sf_dir):
    """Newest row per user where error events delete their user."""
    rows = _rows(A.events_raw(spark, sf_dir, with_changes=True))
    return _state(apply_lastdata(None, rows))


@query
def lastdata_partial_columns(spark, sf_dir):
    """Newest value of every column a notification carries."""
    rows = _rows(A.partial_events_raw(spark, sf_dir))
    return _state(apply_lastdata(None, rows, partial=True))


@query
def lastdata_no_time(spark, sf_dir):
    """Rows without a time are always taken."""
    rows = _rows(A.timeless_events_raw(spark, sf_dir))
    return _state(apply_lastdata(None, rows))


def _quarters(records: DataFrame) -> list[DataFrame]:
    """Records in four parts along their offsets."""
    low, high = records.agg(F.min("offset"), F.max("offset")).first()
    borders = [low + (high - low + 1) * k // 4 for k in range(5)] if low is not None else [0] * 5
    return [records.where(F.col("offset").between(b, e - 1)) for b, e in zip(borders, borders[1:], strict=False)]


@query
def lastdata_refolded(spark, sf_dir):
    """Deletes and missing times, folded in four steps: each takes the state of the one before."""
    state = None
    for part in _quarters(A.timeless_events_raw(spark, sf_dir, with_changes=True)):
        state = apply_lastdata(state, _rows(part), with_high=True)
    return _state(state)


@query
def lastdata_onto_existing(spark, sf_dir):
    """Purchases, views and the rest applied to the state that signups left."""
    rows = _rows(A.events_raw(spark, sf_dir))
    held = apply_lastdata_fast(None, rows.where("kind = 'signup'").drop("change", "present"))
    return _state(apply_lastdata(held, rows.where("kind <> 'signup'")))


# ---- decode ---------------------------------------------------------------------------------------


@query
def entities_flat(spark, sf_dir):
    """Two entities per order notification, in order."""
    return entities_of(A.orders_raw(spark, sf_dir)).select(
        "offset", "entity_pos", "entityid", "entitytype", "service", "servicepath"
    )


@query
def attributes_long(spark, sf_dir):
    """Attributes of order lines counted by name and kind."""
    long = infer_types(entities_of(A.lineitem_raw(spark, sf_dir)))
    return long.groupBy("attr_name", "kind").agg(F.count(F.lit(1)).alias("n"))


@query
def attributes_typed(spark, sf_dir):
    """Typed values of every attribute of every order entity."""
    long = infer_types(entities_of(A.orders_raw(spark, sf_dir)))
    return long.select(
        "offset",
        "entity_pos",
        "attr_name",
        "attr_pos",
        "kind",
        "v_string",
        "v_double",
        "v_bool",
        _ms("v_ts").alias("v_ms"),
        "is_null",
    )


@query
def nested_json_text(spark, sf_dir):
    """Nested values as compact JSON text, and a plain string declared as JSON."""
    events = A.source(spark, sf_dir, "events")
    body = notification(
        F.concat(F.lit("E"), "event_id"),
        F.lit("Event"),
        {
            "props": attribute("StructuredValue", F.parse_json("props")),
            "listed": attribute("Array", F.array("event_type", F.col("user_id").cast("string"))),
            "quoted": attribute("json", F.col("event_type")),
            "loose": attribute("Float", F.col("user_id").cast("string")),
        },
    )
    raw = as_raw(events, "historic", body, F.col("event_id"))
    long = infer_types(entities_of(raw))
    return long.select("entityid", "attr_name", "kind", "v_string")


@query
def timestamps_parsed(spark, sf_dir):
    """Order dates written in many ISO forms, read back; some are no dates."""
    orders = A.source(spark, sf_dir, "orders")
    ts = F.col("o_orderdate") + F.make_interval(hours=F.col("o_custkey") % 24, mins=F.col("o_orderkey") % 60)
    form = F.col("o_orderkey") % 10
    patterns = [
        "yyyy-MM-dd",
        "yyyy-MM-dd'T'HH",
        "yyyy-MM-dd'T'HH:mm",
        "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
        "yyyy-MM-dd'T'HH:mm'Z'",
        "yyyy-MM-dd'T'HH:mm:ss'+02'",
        "yyyy-MM-dd'T'HH:mm:ss'+0200'",
        "yyyy-MM-dd'T'HH:mm:ss.SSS'-05:30'",
        "dd/MM/yyyy",
    ]
    text = F.lit(None).cast("string")
    for i, pattern in enumerate(patterns):
        text = F.when(form == i, F.date_format(ts, pattern)).otherwise(text)
    body = notification(F.concat(F.lit("O"), "o_orderkey"), F.lit("Order"), {"ordered": attribute("DateTime", text)})
    long = infer_types(entities_of(as_raw(orders, "historic", body, F.col("o_orderkey"))))
    return long.select("entityid", "kind", _ms("v_ts").alias("ms"), "date_error")


@query
def timestamps_week(spark, sf_dir):
    """Order dates written as week dates, ordinal dates and ends of days, read back; some mean no day."""
    orders = A.source(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    year, week = F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    weekday, nth = (F.weekday(day) + 1).cast("string"), F.lpad(F.dayofyear(day).cast("string"), 3, "0")
    forms = [
        F.concat(year, F.lit("-W"), week, F.lit("-"), weekday),
        F.concat(year, F.lit("-W"), week),
        F.concat(F.date_format(day, "yyyy-"), nth),
        F.concat(F.date_format(day, "yyyy"), nth, F.lit("T10:15:30Z")),
        F.concat(year, F.lit("W"), week, weekday, F.lit("T10:15+02:00")),
        F.date_format(day, "yyyy-MM-dd'T24:00'"),
        F.concat(F.date_format(day, "yyyy-"), nth, F.lit("T24:00:00Z")),
        F.concat(year, F.lit("-W54-1")),
        F.date_format(day, "yyyy-'000'"),
        F.date_format(day, "yyyy-MM-dd'T24:01'"),
    ]
    form, text = F.col("o_orderkey") % 10, F.lit(None).cast("string")
    for i, written in enumerate(forms):
        text = F.when(form == i, written).otherwise(text)
    body = notification(F.concat(F.lit("O"), "o_orderkey"), F.lit("Order"), {"ordered": attribute("DateTime", text)})
    long = infer_types(entities_of(as_raw(orders, "historic", body, F.col("o_orderkey"))))
    return long.select("entityid", "kind", _ms("v_ts").alias("ms"), "date_error")


@query
def change_counts(spark, sf_dir):
    """Changes by kind, as the lastdata and the graph flow see them."""
    events = A.source(spark, sf_dir, "events")
    named = (
        F.when(F.col("event_type") == "error", "entityDelete")
        .when(F.col("event_type") == "signup", "ENTITYCREATE")
        .when(F.col("event_type") == "view", "entityChange")
        .when(F.col("event_type") == "click", "entityUpdate")
    )
    plain = F.to_json(
        F.struct(
            F.concat(F.lit("U"), "user_id").alias("id"),
            F.lit("User").alias("type"),
            F.when(named.isNotNull(), F.struct(named.alias("value"))).alias("alterationType"),
        )
    )
    body = F.concat(F.lit('{"data":['), plain, F.lit("]}"))
    entities = entities_of(as_raw(events, "lastdata", body, F.col("event_id")))
    both = [
        classify_changes(entities, flow).groupBy("change").agg(F.count(F.lit(1)).alias("n")).withColumn("flow", F.lit(flow))
        for flow in ("lastdata", "sgtr")
    ]
    return both[0].unionByName(both[1])


@query
def deletes_in_batch(spark, sf_dir):
    """Order notifications of two entities; a finished order deletes the first and ignores the second."""
    orders = A.source(spark, sf_dir, "orders")
    change = F.when(F.col("o_orderstatus") == "F", "entityDelete").otherwise("entityUpdate")
    first = F.struct(
        F.concat(F.lit("O"), "o_orderkey").alias("id"),
        F.lit("Order").alias("type"),
        F.struct(change.alias("value")).alias("alterationType"),
    )
    second = F.struct(
        F.concat(F.lit("C"), "o_custkey").alias("id"),
        F.lit("Customer").alias("type"),
        F.struct(change.alias("value")).alias("alterationType"),
    )
    body = F.to_json(F.struct(F.array(first, second).alias("data")))
    rows = classify_changes(entities_of(as_raw(orders, "lastdata", body, F.col("o_orderkey"))), "lastdata")
    return rows.select("offset", "entity_pos", "entityid", "change")


@query
def parse_quarantine(spark, sf_dir):
    """Notifications of which some are cut short, empty, or have entities without id."""
    orders = A.source(spark, sf_dir, "orders")
    body = notification(F.concat(F.lit("O"), "o_orderkey"), F.lit("Order"), {"total": attribute("Number", F.col("o_totalprice"))})
    status = F.col("o_orderstatus")
    priority = F.substring("o_orderpriority", 1, 1)
    broken = (
        F.when(priority == "1", F.substring(body, 1, 20))
        .when(priority == "2", F.lit('{"data":[]}'))
        .when(priority == "3", F.concat(F.lit('{"data":[null,{"type":"Order"},{"id":"'), status, F.lit('"}]}')))
        .otherwise(body)
    )
    raw = read_context(as_raw(orders, "historic", broken, F.col("o_orderkey")))
    rows = explode_flagged(parse_flagged(raw))
    return rows.select("offset", F.coalesce("reject.code", F.lit("OK")).alias("code"))


@query
def empty_notifications(spark, sf_dir):
    """Notifications without entities, counted by flow."""
    orders = A.source(spark, sf_dir, "orders")
    body = F.when(F.col("o_orderstatus") == "P", '{"data":[]}').otherwise('{"data":[{"id":"x","type":"y"}]}')
    good, _ = parse(read_context(as_raw(orders, "historic", body, F.col("o_orderkey"))))
    return no_entity_counts(good)


@query
def tenant_context(spark, sf_dir):
    """Tenant of customer notifications from headers, from the body's headers, or from its top level."""
    customers = A.source(spark, sf_dir, "customer")
    which = F.col("c_custkey") % 3
    service, path = F.upper("c_mktsegment"), F.concat(F.lit("Seg/"), "c_nationkey")
    top = F.to_json(F.struct(service.alias("fiware-service"), path.alias("fiware-servicepath")))
    body = (
        F.when(which == 0, F.lit("{}"))
        .when(which == 1, F.concat(F.lit('{"headers":'), top, F.lit("}")))
        .otherwise(top)
    )
    headers = F.when(which == 0, headers_of(service, path, F.lit("")))
    rows = read_context(as_raw(customers, "historic", body, F.col("c_custkey"), headers))
    return rows.select("offset", "service", "servicepath", "datamodel", "correlator")


@query
def header_decode(spark, sf_dir):
    """Headers with repeated names in different case: the last one wins."""
    customers = A.source(spark, sf_dir, "customer")
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), F.encode(v, "utf-8").alias("value"))
    headers = F.array(
        pair("Fiware-Service", F.col("c_name")), pair("X-Note", F.lit("ñandú")), pair("fiware-SERVICE", F.col("c_mktsegment"))
    )
    raw = read_context(as_raw(customers, "historic", F.lit("{}"), F.col("c_custkey"), headers))
    return raw.select("offset", "service", F.size("hdr").alias("n_headers"), F.try_element_at("hdr", F.lit("x-note")).alias("note"))


@query
def legacy_normalise(spark, sf_dir):
    """Older order notifications rewritten, then decoded."""
    orders = A.source(spark, sf_dir, "orders")
    attr = lambda n, v, t: F.concat(
        F.lit(f'{{"attrName":"{n}","attrValue":'), v, F.lit(f',"type":"{t}"}}' if t else "}")
    )
    status = F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))
    listed = F.concat_ws(",", attr("total", F.col("o_totalprice").cast("string"), "Number"), attr("status", status, None))
    body = F.concat(
        F.lit('{"flow":"historic","headers":{"fiware-service":"Old","fiware-servicepath":"/shop"},"body":{"entityId":"O'),
        F.col("o_orderkey").cast("string"),
        F.lit('","entityType":"Order","attributes":['),
        listed,
        F.lit("]}}"),
    )
    long = infer_types(entities_of(normalise_legacy(as_raw(orders, "historic", body, F.col("o_orderkey")))))
    return long.select("entityid", "entitytype", "service", "servicepath", "attr_name", "attr_type", "kind", "v_string", "v_double")


# ---- historic and mutable -------------------------------------------------------------------------


def _hourly(spark, sf_dir, flow):
    rows = _rows(A.events_raw(spark, sf_dir, flow, time=F.date_trunc("hour", F.col("ts"))), flow)
    return rows.drop("change", "present")


_PK = ("entityid", "timeinstant")


@query
def historic_append(spark, sf_dir):
    """First event of each user and hour."""
    inserted, _ = apply_historic(None, _hourly(spark, sf_dir, "historic"), _PK)
    return _state(inserted)


@query
def historic_rejects(spark, sf_dir):
    """The other events of each user and hour, refused."""
    _, again = apply_historic(None, _hourly(spark, sf_dir, "historic"), _PK)
    return again.select("entityid", _ms("timeinstant").alias("ts_ms"), "seq.offset", "value", "reject.code")


@query
def historic_onto_existing(spark, sf_dir):
    """Events refused because signups hold their key already, or as repeats, by kind."""
    rows = _hourly(spark, sf_dir, "historic")
    held, _ = apply_historic(None, rows.where("kind = 'signup'"), _PK)
    inserted, again = apply_historic(held, rows.where("kind <> 'signup'"), _PK)
    stored = inserted.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit("stored"))
    refused = again.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit("refused"))
    return stored.unionByName(refused)


def _partitioned(records: DataFrame) -> DataFrame:
    return records.withColumn("partition", (F.col("offset") % 5).cast("int"))


#: Offsets of a piece, few enough that histories of the small tables are cut as well.
_SMALL_PIECE = 64


@query
def historic_partitions(spark, sf_dir):
    """First event of each user and hour and the refused ones, from several partitions and over borders of pieces."""
    records = A.events_raw(spark, sf_dir, "historic", time=F.date_trunc("hour", F.col("ts")))
    rows = _rows(_partitioned(records), "historic").drop("change", "present")
    marked = mark_repeats(rows, _PK, piece=_SMALL_PIECE)
    code = F.when(F.col("repeated"), repeat_rejection()["code"]).otherwise("STORED")
    return marked.select("entityid", _ms("timeinstant").alias("ts_ms"), "value", code.alias("code"))


@query
def lastdata_partitions(spark, sf_dir):
    """Newest value and kind per user through the general fold, from several partitions and over borders of pieces."""
    rows = _rows(_partitioned(A.events_raw(spark, sf_dir)))
    return _state(apply_lastdata(None, rows, piece=_SMALL_PIECE))


@query
def historic_without_key(spark, sf_dir):
    """A table without a primary key keeps every row."""
    inserted, _ = apply_historic(None, _hourly(spark, sf_dir, "historic"), ())
    return inserted.groupBy("entityid").agg(F.count(F.lit(1)).alias("n"))


@query
def mutable_upsert(spark, sf_dir):
    """Last event of each user and hour."""
    return _state(apply_mutable(None, _hourly(spark, sf_dir, "mutable"), _PK))


@query
def mutable_partial(spark, sf_dir):
    """Last carried value of each column of each user and hour."""
    rows = _rows(A.partial_events_raw(spark, sf_dir, "mutable", hourly=True), "mutable")
    return _state(apply_mutable(None, rows.drop("change"), _PK, partial=True))


# ---- routing --------------------------------------------------------------------------------------


def _routed(spark, sf_dir, config, flow="historic", **kwargs):
    return route(entities_of(A.customers_raw(spark, sf_dir, **kwargs)), config, flow)


def _target_counts(rows):
    return rows.groupBy("target_schema", "target_table").agg(F.count(F.lit(1)).alias("n"))


@query
def route_dm1(spark, sf_dir):
    """A schema per tenant, a table per path and type."""
    return _target_counts(_routed(spark, sf_dir, FlowConfig(), "lastdata"))


@query
def route_dm2(spark, sf_dir):
    """A schema per path, a table per path and type."""
    return _target_counts(_routed(spark, sf_dir, FlowConfig(datamodel=DM_TYPE_SCHEMA)))


@query
def route_dm3(spark, sf_dir):
    """A schema per path, a table per type."""
    return _target_counts(_routed(spark, sf_dir, FlowConfig(datamodel=DM_FIXED_TYPE_SCHEMA), "mutable"))


@query
def route_errors(spark, sf_dir):
    """The error table of each tenant."""
    return _target_counts(_routed(spark, sf_dir, FlowConfig(datamodel=DM_SQL_ERRORS)))


@query
def route_http_errors(spark, sf_dir):
    """The error table of each tenant of the graph flow."""
    return _target_counts(_routed(spark, sf_dir, FlowConfig(datamodel=DM_HTTP_ERRORS)))


@query
def route_precedence(spark, sf_dir):
    """The record's data model beats the configured one, and an unknown one is an error."""
    which = F.col("c_custkey") % 4
    own = (
        F.when(which == 0, DM_FIXED_TYPE_SCHEMA).when(which == 1, "").when(which == 2, DM_TYPE_DATABASE).otherwise("dm-none")
    )
    rows = _routed(spark, sf_dir, FlowConfig(datamodel=DM_TYPE_SCHEMA), datamodel=own)
    return rows.select("offset", "target", "route_error")


@query
def route_missing_path(spark, sf_dir):
    """Customers of one segment have no path: legal with a schema per tenant, an error with one per path."""
    path = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.concat(F.lit("/"), "c_mktsegment"))
    both = [
        _routed(spark, sf_dir, FlowConfig(datamodel=model), path=path)
        .groupBy("target_table", "route_error")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("model", F.lit(model))
        for model in (DM_TYPE_DATABASE, DM_TYPE_SCHEMA)
    ]
    return both[0].unionByName(both[1])


@query
def route_overrides(spark, sf_dir):
    """Fields taken from other headers or literals, a static suffix, and a schema that beats all."""
    config = FlowConfig(
        schema_override="fixed", table_suffix="_x", fields={"servicepath": "fiware-service", "entitytype": "anything"}
    )
    return _target_counts(_routed(spark, sf_dir, config))


@query
def sanitise_names(spark, sf_dir):
    """Part names and types as identifiers."""
    parts = A.table(spark, sf_dir, "part")
    name = F.concat(F.lit(" /"), "p_brand", F.lit("/"), "p_type", F.lit("//"))
    return parts.select("p_partkey", sanitise_name(F.col("p_name")).alias("name"), sanitise_name(name).alias("path"))


# ---- published form -------------------------------------------------------------------------------


@query
def envelope_publish(spark, sf_dir):
    """Published message and key of every order entity."""
    entities = with_recvtime(with_attributes(entities_of(A.orders_raw(spark, sf_dir))), A.received())
    rows = to_key(to_envelope(entities), with_time=True)
    return rows.select("offset", "entity_pos", "message", "message_key")


@query
def routing_headers(spark, sf_dir):
    """Routing headers and topic of customers."""
    entities = entities_of(A.customers_raw(spark, sf_dir))
    rows = with_topic(to_headers(entities, "lastdata"), FlowConfig(prefix="in_", suffix="_out"), "lastdata")
    text = F.array_join(
        F.transform("message_headers", lambda h: F.concat(h["key"], F.lit("="), F.decode(h["value"], "utf-8"))), ";"
    )
    return rows.select("offset", "out_topic", text.alias("headers"))


@query
def receipt_times(spark, sf_dir):
    """Receipt stamp of order entities, counted."""
    rows = with_recvtime(entities_of(A.orders_raw(spark, sf_dir)), A.received())
    return rows.groupBy("recvtime").agg(F.count(F.lit(1)).alias("n"))


# ---- contracts ------------------------------------------------------------------------------------

_ORDERS = "shop.{}_order"


def _order_contracts():
    """Tables for the three order statuses, two of which do not fit what comes, and none for customers."""
    good = {"total": "double precision", "status": "text", "ordered": "timestamp", "urgent": "boolean", "note": "text"}
    return [
        contract(_ORDERS.format("f"), good, ["entityid", "timeinstant"]),
        contract(_ORDERS.format("o"), {**good, "total": "boolean"}, ["entityid", "timeinstant"], ["note"]),
        contract(_ORDERS.format("p"), {k: v for k, v in good.items() if k != "urgent"}, ["entityid", "timeinstant"]),
    ]


def _checked_orders(spark, sf_dir):
    return flagged_entities(
        A.orders_raw(spark, sf_dir), catalogue(spark, _order_contracts()), "historic", received=A.received()
    )


@query
def contract_rejects(spark, sf_dir):
    """Violations of order entities, each with its table, column and reason."""
    rows = _checked_orders(spark, sf_dir).select("offset", "seq.pos", "target", F.explode("violations").alias("v"))
    return rows.select("offset", "pos", "target", "v.column", "v.code")


@query
def contract_missing_time(spark, sf_dir):
    """Orders of which every third comes without the time that is part of its key."""
    time = F.when(F.col("o_orderkey") % 3 != 0, time_attribute(F.col("o_orderdate")))
    body = F.to_json(
        F.struct(
            F.array(
                F.struct(F.concat(F.lit("O"), "o_orderkey").alias("id"), F.lit("Line").alias("type"), time.alias("TimeInstant"))
            ).alias("data")
        )
    )
    table = contract("default._line", {}, ["entityid", "timeinstant"])
    raw = as_raw(A.source(spark, sf_dir, "orders"), "historic", body, F.col("o_orderkey"))
    rows = flagged_entities(raw, catalogue(spark, [table]), "historic", received=A.received())
    return rows.select("offset", "reject.code", "reject.error")


@query
def contract_ok(spark, sf_dir):
    """Order entities that fit their table, in its columns."""
    table = _order_contracts()[0]
    wide = to_wide(accepted(_checked_orders(spark, sf_dir)), table, ["offset"])
    return wide.select(
        "offset",
        "entityid",
        "entitytype",
        "fiwareservicepath",
        _ms("recvtime").alias("recv_ms"),
        _ms("timeinstant").alias("ts_ms"),
        "total",
        "status",
        _ms("ordered").alias("ordered_ms"),
        "urgent",
        "note",
    )


@query
def numeric_limits(spark, sf_dir):
    """Order line prices scaled up until they leave the range of their column."""
    lines = A.source(spark, sf_dir, "lineitem")
    scaled = lambda power: attribute("Number", F.col("l_extendedprice") * F.lit(10.0**power))
    body = notification(
        F.concat(F.lit("L"), "l_orderkey"),
        F.lit("Line"),
        {
            "small": attribute("Number", F.col("l_extendedprice")),
            "whole": scaled(5),
            "big": scaled(14),
            "exact": scaled(10),
            "short": scaled(34),
            "wide": scaled(300),
        },
    )
    kinds = {
        "small": "smallint",
        "whole": "integer",
        "big": "bigint",
        "exact": "numeric(30,15)",
        "short": "real",
        "wide": "double precision",
    }
    table = contract("default._line", kinds, with_time=False)
    raw = as_raw(lines, "historic", body, F.col("l_orderkey"))
    rows = flagged_entities(raw, catalogue(spark, [table]), "historic", received=A.received())
    return rows.select("offset", F.explode("violations").alias("v")).select("offset", "v.column", "v.code")


@query
def numeric_rounding(spark, sf_dir):
    """Numbers that only rounding to the scale of their column puts out of its range, and what is stored of the others."""
    value = F.lit(99.0) + (F.col("o_orderkey") % 200) / 100
    body = notification(F.concat(F.lit("O"), "o_orderkey"), F.lit("Line"), {"n": attribute("Number", value)})
    table = contract("default._line", {"n": "numeric(3,1)"}, with_time=False)
    raw = as_raw(A.source(spark, sf_dir, "orders"), "historic", body, F.col("o_orderkey"))
    rows = flagged_entities(raw, catalogue(spark, [table]), "historic", received=A.received())
    return to_wide(rows, table, ["reject"]).select("entityid", F.col("n").cast("string").alias("stored"), F.col("reject.code").alias("code"))


@query
def delete_missing_table(spark, sf_dir):
    """Updates and deletes for a table that the catalogue does not have: each is refused and none is lost."""
    tables = catalogue(spark, [contract("city.other_lastdata", {}, ["entityid"])])
    rows = flagged_entities(A.events_raw(spark, sf_dir, with_changes=True), tables, "lastdata", received=A.received())
    return rows.select("offset", "change", F.col("reject.code").alias("code"))


@query
def contract_cast(spark, sf_dir):
    """Prices as whole numbers, reals and exact numbers, rounded the way the columns round."""
    lines = A.source(spark, sf_dir, "lineitem")
    price = lambda: attribute("Number", F.col("l_extendedprice"))
    body = notification(F.concat(F.lit("L"), "l_orderkey"), F.lit("Line"), {"n": price(), "t": price(), "d": price()})
    table = contract("default._line", {"n": "integer", "t": "text", "d": "numeric(30,15)"}, with_time=False)
    raw = as_raw(lines, "historic", body, F.col("l_orderkey"))
    wide = to_wide(entities_of(raw), table, ["offset"])
    return wide.groupBy("entityid").agg(
        F.sum("n").alias("sum_n"), F.sum("d").cast("decimal(38,2)").cast("string").alias("sum_d"), F.min("t").alias("min_t")
    )


@query
def schema_evolve(spark, sf_dir):
    """An order table whose total became text, status was renamed, note dropped and pressure added."""
    old = _order_contracts()[0]
    wide = to_wide(accepted(_checked_orders(spark, sf_dir)), old)
    new = contract(
        old.target,
        {"total": "text", "orderstatus": "text", "ordered": "timestamp", "urgent": "boolean", "pressure": "double precision"},
        ["entityid", "timeinstant"],
    )
    rows = evolve(wide.select(*old.names), new, {"status": "orderstatus"})
    return rows.select("entityid", _ms("timeinstant").alias("ts_ms"), "total", "orderstatus", "urgent", "pressure")


@query
def native_error_log(spark, sf_dir):
    """Error log rows of everything refused on the way to the order tables."""
    flagged = rejected(_checked_orders(spark, sf_dir))
    log = err.rejects_to_error_log(flagged, now=A.received())
    return log.groupBy("tenant", "stage", "code", "error").agg(F.count(F.lit(1)).alias("n"))


@query
def batch_isolation(spark, sf_dir):
    """Entities in, rows written and rows refused by table: one bad row never costs the others."""
    return expect.reconcile_flagged(_checked_orders(spark, sf_dir))


# ---- errors ---------------------------------------------------------------------------------------


def _dead_letters(spark, sf_dir):
    """Every order as a dead letter: database errors with and without statement, cause and topic."""
    orders = A.source(spark, sf_dir, "orders")
    which = F.col("o_orderkey") % 4
    key = F.col("o_orderkey").cast("string")
    statement = F.concat(F.lit('INSERT INTO "shop.orders" ("id","total") VALUES ('), key, F.lit(",1.5)"))
    message = (
        F.when(which == 0, F.concat(F.lit("Batch entry 0 "), statement, F.lit(" was aborted: ERROR: duplicate key "), key,
                                    F.lit("\n  Detail: Key exists.\nmore")))
        .when(which == 1, F.concat(F.lit("Sink failed for "), key))
        .when(which == 2, F.lit("Value too big"))
    )
    cause = F.when(which == 1, F.lit("timeout")).when(which == 2, F.lit("too big"))
    topic = F.when(which != 0, F.concat(F.lit("in_"), F.lower("o_orderstatus"), F.lit("_lastdata_processed")))
    payload = F.to_json(
        F.struct(
            F.lit("x").alias("schema"),
            F.struct(
                F.concat(F.lit("O'"), key).alias("entityid"),
                F.col("o_totalprice").alias("total"),
                F.lit(None).cast("string").alias("note"),
                (F.col("o_orderstatus") == "F").alias("done"),
            ).alias("payload"),
        ),
        {"ignoreNullFields": "false"},
    )
    value = F.when(which == 3, F.concat(F.lit('{"id": '), key, F.lit("}"))).otherwise(payload)
    pairs = [
        ("__connect.errors.exception.message", message),
        ("__connect.errors.exception.cause.message", cause),
        ("__connect.errors.topic", topic),
        ("target_table", F.when(which == 1, F.lit("orders_lastdata"))),
    ]
    listed = F.array(*[F.struct(F.lit(k).alias("key"), F.encode(v, "utf-8").alias("value")) for k, v in pairs])
    headers = F.filter(listed, lambda h: h["value"].isNotNull())
    return as_raw(orders, "errors", value, F.col("o_orderkey"), headers)


@query
def error_log(spark, sf_dir):
    """Tenant, error and statement of every dead letter."""
    records = with_headers(_dead_letters(spark, sf_dir), keep_case=True)
    rows = err.errors_from_rejected(records, FlowConfig(prefix="in_"), A.received())
    return rows.select("offset", "tenant", "error", "query")


@query
def error_events(spark, sf_dir):
    """Published form of the error rows."""
    config = FlowConfig(prefix="in_", suffix="_out")
    records = with_headers(_dead_letters(spark, sf_dir), keep_case=True)
    rows = err.to_error_events(err.errors_from_rejected(records, config, A.received()), config)
    return rows.select(
        "offset",
        "out_topic",
        F.get_json_object("message", "$.payload.timestamp").alias("stamped"),
        F.get_json_object("message", "$.payload.error").alias("error"),
        F.decode(F.get("message_headers", 1)["value"], "utf-8").alias("model"),
    )


@query
def error_truncation(spark, sf_dir):
    """Whole document texts as error messages, cut to the longest an error row takes."""
    documents = A.source(spark, sf_dir, "documents")
    headers = F.array(
        F.struct(
            F.lit("__connect.errors.exception.message").alias("key"),
            F.encode(F.concat(F.lit("Failed: "), "text"), "utf-8").alias("value"),
        )
    )
    raw = as_raw(documents, "errors", F.lit('{"a":1}'), F.col("doc_id"), headers)
    rows = err.errors_from_rejected(with_headers(raw, keep_case=True), now=A.received())
    return rows.select("offset", "tenant", F.md5("error").alias("error_md5"), F.length("error").alias("error_length"), "query")


# ---- geometry -------------------------------------------------------------------------------------


def _lon(key: str) -> Column:
    return (F.col(key) % 3600) / 10.0 - 180.0


def _lat(key: str) -> Column:
    return (F.col(key) % 1700) / 10.0 - 85.0


def _geo_entities(source, key, attributes):
    body = notification(F.concat(F.lit("G"), F.col(key).cast("string")), F.lit("Place"), attributes)
    return infer_types(entities_of(as_raw(source, "historic", body, F.col(key))))


@query
def geo_points(spark, sf_dir):
    """Customer places as `lat,lon` text, some of them broken, as point text."""
    customers = A.table(spark, sf_dir, "customer")
    text = F.concat(_lat("c_custkey").cast("string"), F.lit(", "), _lon("c_custkey").cast("string"))
    text = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("nowhere")).otherwise(text)
    rows = _geo_entities(customers, "c_custkey", {"place": attribute("geo:point", text)})
    return rows.select("entityid", "kind", "wkt", "v_string")


@query
def geo_polygons(spark, sf_dir):
    """Supplier areas as lists of `lat,lon`, as polygon text."""
    suppliers = A.table(spark, sf_dir, "supplier")
    corner = lambda dx, dy: F.concat(
        (F.col("s_suppkey") % 80 + dy).cast("string"), F.lit(","), (F.col("s_suppkey") % 170 + dx).cast("string")
    )
    area = F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 0))
    rows = _geo_entities(suppliers, "s_suppkey", {"area": attribute("geo:polygon", area)})
    return rows.select("entityid", "kind", "wkt")


def _geojson(key):
    """GeoJSON of one of eight shapes, two of them of no use, by key."""
    x, y = (F.col(key) % 170).cast("string"), (F.col(key) % 80).cast("string")
    at = lambda a, b: F.concat(F.lit("["), x, F.lit(f"{a},"), y, F.lit(f"{b}]"))
    line = F.concat(F.lit("["), at(".5", ".25"), F.lit(","), at(".75", ".5"), F.lit("]"))
    ring = F.concat(
        F.lit("["), at("", ""), F.lit(","), at(".5", ""), F.lit(","), at(".5", ".5"), F.lit(","), at("", ""), F.lit("]")
    )
    shapes = [
        ("Point", at(".5", ".25")),
        ("LineString", line),
        ("Polygon", F.concat(F.lit("["), ring, F.lit("]"))),
        ("MultiPoint", line),
        ("MultiLineString", F.concat(F.lit("["), line, F.lit("]"))),
        ("MultiPolygon", F.concat(F.lit("[["), ring, F.lit("]]"))),
        ("Circle", at("", "")),
        ("Point", F.lit('"here"')),
    ]
    text = F.lit(None).cast("string")
    for i, (name, coordinates) in enumerate(shapes):
        shape = F.concat(F.lit(f'{{"type":"{name}","coordinates":'), coordinates, F.lit("}"))
        text = F.when(F.col(key) % len(shapes) == i, shape).otherwise(text)
    return text


def _geojson_entities(spark, sf_dir):
    parts = A.source(spark, sf_dir, "part")
    return _geo_entities(parts, "p_partkey", {"place": attribute("geo:json", F.parse_json(_geojson("p_partkey")))})


@query
def geo_geojson(spark, sf_dir):
    """Places of parts as GeoJSON of all kinds, as well-known text."""
    return _geojson_entities(spark, sf_dir).select("entityid", "kind", "wkt")


@query
def geo_wkb(spark, sf_dir):
    """Well-known binary of the places of parts."""
    rows = _geojson_entities(spark, sf_dir).where(F.col("wkt").isNotNull())
    return rows.select("entityid", "wkt", F.hex(wkb_from_wkt(F.col("wkt"))).alias("wkb"))


@query
def geo_reject_counts(spark, sf_dir):
    """Places that cannot be converted, refused by the contract."""
    parts = A.source(spark, sf_dir, "part")
    body = notification(
        F.concat(F.lit("G"), "p_partkey"), F.lit("Place"), {"place": attribute("geo:json", F.parse_json(_geojson("p_partkey")))}
    )
    raw = as_raw(parts, "historic", body, F.col("p_partkey"))
    tables = catalogue(spark, [contract("default._place", {"place": "geometry"}, with_time=False)])
    rows = flagged_entities(raw, tables, "historic", received=A.received())
    return rows.groupBy(F.coalesce("reject.code", F.lit("OK")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


# ---- documents ------------------------------------------------------------------------------------


@query
def documents_build(spark, sf_dir):
    """Documents with whole texts and their metadata."""
    rows = documents_of(A.documents_raw(spark, sf_dir), "sth_", A.received())
    field = lambda path: F.get_json_object("document", path)
    return rows.select(
        field("$.entityId").alias("entity"),
        field("$.entityType").alias("type"),
        F.md5(field("$.text")).alias("text_md5"),
        field("$.text_md").alias("metadata"),
        field("$.nChars").cast("bigint").alias("n_chars"),
        field("$.recvTime").alias("received"),
        "document_key",
    )


@query
def documents_namespace(spark, sf_dir):
    """Documents by database and collection."""
    rows = route_documents(entities_of(A.documents_raw(spark, sf_dir)), "sth_")
    return rows.groupBy("database", "collection").agg(F.count(F.lit(1)).alias("n"))


# ---- graph ----------------------------------------------------------------------------------------


@query
def graph_create(spark, sf_dir):
    """Create mutations of documents with their whole texts."""
    documents = A.source(spark, sf_dir, "documents")
    members = {
        "type": F.lit("tourDOCUMENT"),
        "externalId": F.concat(F.lit("Doc:"), "doc_id"),
        "body": F.col("text"),
        "size": F.col("n_chars"),
        "ready": F.lit(True),
        "about": F.struct(F.col("lang").alias("lang"), F.array("source").alias("sources")),
    }
    raw = A.plain_raw(documents, "sgtr", members, F.col("doc_id"))
    rows = mutations_of(raw, GraphConfig(prefix="kg_", suffix="_prd", fallback_to_service=True))
    return rows.select("offset", "action", F.md5("query").alias("query_md5"), F.length("query").alias("query_length"))


@query
def graph_update(spark, sf_dir):
    """Update mutations of parts, with numbers, nulls and staging."""
    parts = A.source(spark, sf_dir, "part")
    members = {
        "alterationType": F.when(F.col("p_size") > 25, "entityUpdate").otherwise("EntityChange"),
        "type": F.lit("part"),
        "externalId": F.concat(F.lit("Part:"), "p_partkey"),
        "name": F.col("p_name"),
        "price": F.col("p_retailprice"),
        "size": F.col("p_size"),
        "gone": F.lit(None).cast("string"),
    }
    raw = A.plain_raw(parts, "sgtr", members, F.col("p_partkey"))
    rows = mutations_of(raw, GraphConfig(staging=True))
    return rows.select("offset", "action", "query")


@query
def graph_delete(spark, sf_dir):
    """Delete mutations of suppliers."""
    suppliers = A.source(spark, sf_dir, "supplier")
    members = {
        "type": F.lit("supplier"),
        "externalId": F.concat(F.lit("Supplier:"), "s_suppkey"),
        "alterationType": F.struct(F.lit("entityDelete").alias("value")),
    }
    raw = A.plain_raw(suppliers, "sgtr", members, F.col("s_suppkey"), "Tenant")
    rows = mutations_of(raw, GraphConfig(fallback_to_service=True, resource_base="http://example.org/"))
    return rows.select("offset", "action", "query")


@query
def graph_slug(spark, sf_dir):
    """Slugs of whole conversation turns, and of URIs in mutations of parts."""
    turns = A.table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", slug(F.col("text")).alias("slug"))


@query
def graph_slug_uri(spark, sf_dir):
    """Mutations of parts with slugs on: external ids and URIs change, other texts stay."""
    parts = A.source(spark, sf_dir, "part")
    members = {
        "type": F.lit("part"),
        "externalId": F.concat(F.lit("Part:"), "p_partkey"),
        "brand": F.struct(F.concat(F.lit("http://example.org/Brand/"), "p_brand").alias("uri"), F.lit(1).alias("dropped")),
        "name": F.col("p_name"),
    }
    raw = A.plain_raw(parts, "sgtr", members, F.col("p_partkey"))
    return mutations_of(raw, GraphConfig(slug_uri=True)).select("offset", "query")


@query
def graph_locations(spark, sf_dir):
    """Location entities of parts, their geometry rewritten where it is one."""
    parts = A.source(spark, sf_dir, "part")
    text = _geojson("p_partkey")
    size = F.col("p_size")
    geometry = F.when(size <= 10, F.lit("null")).when(size <= 30, text).otherwise(
        F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"'))
    )
    kind = F.when(size % 5 == 0, "Place").otherwise("Location")
    element = F.concat(
        F.lit('{"type":"'), kind, F.lit('","AsGeoJSON":'), geometry, F.lit(',"externalId":"P'),
        F.col("p_partkey").cast("string"), F.lit('"}'),
    )
    raw = as_raw(parts, "sgtr", F.concat(F.lit('{"data":['), element, F.lit("]}")), F.col("p_partkey"))
    rows = prepare_graph_entities(accepted(explode_graph_entities(read_context(raw))))
    return rows.select(
        "offset",
        F.get_json_object("prepared", "$.asWkt").alias("wkt"),
        F.array_join(F.json_object_keys("prepared"), ",").alias("members"),
    )


@query
def http_classify(spark, sf_dir):
    """Replies to order mutations: taken, there already, or failed."""
    orders = A.table(spark, sf_dir, "orders")
    priority = F.substring("o_orderpriority", 1, 1)
    body = (
        F.when(priority == "1", F.lit('{"data":{"uri":"x"}}'))
        .when(priority == "2", F.lit('{"errors":[{"message":"URI x already exists in the graph"}]}'))
        .when(priority == "3", F.lit('{"errors":[{"message":"URI y already exists"},{"message":"no such relation"}]}'))
        .otherwise(F.lit("oops"))
    )
    status = F.when(priority == "4", 500).when(priority == "5", F.lit(None)).otherwise(200)
    rows = classify_response(orders.select("o_orderkey", status.cast("int").alias("status"), body.alias("body")))
    return rows.groupBy("outcome", "error").agg(F.count(F.lit(1)).alias("n"))


# ---- metrics --------------------------------------------------------------------------------------


def _log(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    return events.select(
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("flow"),
        F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("t"), F.col("user_id") % 5)).alias("service"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("result"),
        (F.col("value") - 2.0).alias("duration_s"),
        F.col("ts").alias("processed_at"),
    )


@query
def flow_counts(spark, sf_dir):
    """Messages by flow, tenant and result."""
    return metrics.flow_counts(_log(spark, sf_dir))


@query
def flow_durations(spark, sf_dir):
    """Last, total and mean duration by flow."""
    rows = metrics.flow_durations(_log(spark, sf_dir))
    return rows.select(
        "flow",
        "last_duration_s",
        F.round("total_duration_s", 3).alias("total_duration_s"),
        F.round("mean_duration_s", 4).alias("mean_duration_s"),
        _ms("last_processed_at").alias("last_ms"),
    )


@query
def flow_summary(spark, sf_dir):
    """Totals, successes and errors by flow, sorted."""
    return metrics.flow_summary(_log(spark, sf_dir)).select("flow", "total_events", "success_events", "error_events")


@query
def pipeline_snapshot(spark, sf_dir):
    """The whole pipeline in one row."""
    return metrics.pipeline_snapshot(_log(spark, sf_dir))


def _windows(rows):
    return rows.select(_ms("window_start").alias("start_ms"), _ms("window_end").alias("end_ms"), "flow", "records", "rate")


def _event_records(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("flow"),
        F.concat(F.lit("raw_"), "event_type").alias("topic"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("kafka_ts"),
        F.lit("{}").alias("value"),
    )


@query
def throughput_1m(spark, sf_dir):
    """Events per minute and flow."""
    return _windows(metrics.throughput(_event_records(spark, sf_dir), unit_seconds=1.0))


@query
def throughput_5m(spark, sf_dir):
    """Events per five minutes, as a rate per second."""
    return _windows(metrics.throughput(_event_records(spark, sf_dir), "5 minutes"))


@query
def throughput_5m_sliding(spark, sf_dir):
    """Events per five minutes, every minute, as a rate per minute."""
    return _windows(metrics.throughput(_event_records(spark, sf_dir), "5 minutes", "1 minute", unit_seconds=60.0))


@query
def consumer_lag(spark, sf_dir):
    """Events not yet processed, by consumer group and topic."""
    records = _event_records(spark, sf_dir)
    done = records.where(F.col("kafka_ts") < F.lit("2024-01-15").cast("timestamp")).withColumn(
        "consumer_group", F.when(F.col("partition") < 3, "early").otherwise("late")
    )
    return metrics.consumer_lag(records, done)


@query
def partition_count(spark, sf_dir):
    """Partitions by topic."""
    return metrics.partition_count(_event_records(spark, sf_dir))


@query
def replay_dedup(spark, sf_dir):
    """Records read twice, counted once."""
    records = _event_records(spark, sf_dir)
    return drop_replayed(records.unionByName(records)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


# ---- expectations ---------------------------------------------------------------------------------


def _lines_table(spark, sf_dir):
    lines = A.table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("shipped"),
        F.col("l_returnflag").alias("flag"),
    )


@query
def expect_missing(spark, sf_dir):
    """Orders no line of which is dear and came back."""
    orders = A.table(spark, sf_dir, "orders")
    expected = orders.select(
        F.col("o_orderkey").alias("orderkey"), F.lit(50000.0).alias("price__gte"), F.lit("R|A").alias("flag__regex")
    )
    return expect.expect_rows(_lines_table(spark, sf_dir), expected, ["orderkey"]).select("orderkey")


@query
def expect_forbidden(spark, sf_dir):
    """Orders with a line shipped before the order date."""
    orders = A.table(spark, sf_dir, "orders")
    forbidden = orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").alias("shipped__lt"))
    return expect.expect_absent(_lines_table(spark, sf_dir), forbidden, ["orderkey"]).select("orderkey")


@query
def expect_ranges(spark, sf_dir):
    """Orders whose customers' lines are all outside the price and date asked for."""
    orders = A.table(spark, sf_dir, "orders")
    expected = orders.select(
        F.col("o_orderkey").alias("orderkey"),
        (F.col("o_totalprice") / 10).alias("price__gt"),
        F.col("o_totalprice").alias("price__lte"),
        F.when(F.col("o_orderstatus") != "P", F.lit("N")).alias("flag__contains"),
    )
    return expect.expect_rows(_lines_table(spark, sf_dir), expected, ["orderkey"]).select("orderkey")


@query
def expect_tolerance(spark, sf_dir):
    """Order rows found again with times half a millisecond off and numbers a little off."""
    orders = A.table(spark, sf_dir, "orders")
    held = orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("ordered"))
    expected = held.select(
        "orderkey",
        (F.col("total") * F.when(F.col("orderkey") % 2 == 0, F.lit(1.0000001)).otherwise(F.lit(1.001))).alias("total"),
        F.timestamp_micros(F.unix_micros("ordered") + 500).alias("ordered"),
    )
    return expect.expect_rows(held, expected, ["orderkey"]).select("orderkey")


@query
def expect_count(spark, sf_dir):
    """Whether there are as many events as one expects."""
    return expect.expect_count(A.table(spark, sf_dir, "events"), 10000)


@query
def expect_documents(spark, sf_dir):
    """Documents found again by a part of their fields."""
    built = documents_of(A.documents_raw(spark, sf_dir), "sth_", A.received())
    fields = expect.document_fields(built, {"entity": "$.entityId", "type": "$.entityType", "n": "$.nChars"})
    documents = A.table(spark, sf_dir, "documents")
    asked = documents.select(
        F.concat(F.lit("D"), "doc_id").alias("entity"),
        F.when(F.col("lang") == "de", "xx").otherwise(F.col("lang")).alias("type"),
        F.col("n_chars").cast("string").alias("n"),
    )
    return expect.expect_rows(fields, asked, ["entity"]).select("entity")


@query
def reconcile_counts(spark, sf_dir):
    """Events in, stored and refused by user."""
    rows = _hourly(spark, sf_dir, "historic")
    flagged = mark_repeats(rows, _PK).withColumn("reject", F.when(F.col("repeated"), repeat_rejection()))
    return expect.reconcile_flagged(flagged, ["entityid"])


@query
def expect_micros(spark, sf_dir):
    """Of two expected rows a microsecond apart, the one that is not met."""
    events = A.table(spark, sf_dir, "events").select("event_id", "ts")
    asked = events.select("event_id", F.explode(F.array(F.col("ts"), F.col("ts") - F.expr("interval 1 microsecond"))).alias("ts__lte"))
    return expect.expect_rows(events, asked, ["event_id"]).select("event_id", F.unix_micros("ts__lte").alias("asked_us"))


@query
def expect_geometry(spark, sf_dir):
    """Places of parts found again by their geometry; those asked for in the wrong place are missing."""
    rows = _geojson_entities(spark, sf_dir).where(F.col("wkt").startswith("POINT"))
    held = rows.select("entityid", F.struct(wkb_from_wkt(F.col("wkt")).alias("wkb"), F.lit(4326).alias("srid")).alias("place"))
    shifted = F.col("offset") % 3 == 0
    asked = rows.select("entityid", F.when(shifted, F.lit("POINT (1 1)")).otherwise(F.col("wkt")).alias("place"))
    return expect.expect_rows(held, asked, ["entityid"]).select("entityid")


# ---- writers and what is read back ----------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def sink_routed(spark, sf_dir):
    """Customers written to their tables in one write, and read again."""
    path = _folder(spark, "routed")
    write_routed(_routed(spark, sf_dir, FlowConfig()).select("entityid", "target_schema", "target_table"), path)
    return spark.read.parquet(path).select("entityid", "target_schema", "target_table")


@query
def sink_documents(spark, sf_dir):
    """Documents written as text, and read again."""
    path = _folder(spark, "documents")
    write_documents(documents_of(A.documents_raw(spark, sf_dir), "sth_", A.received()), path)
    rows = spark.read.schema("value string, database string, collection string").text(path)
    field = lambda at: F.get_json_object("value", at)
    return rows.select("collection", field("$.entityId").alias("entity"), F.md5(field("$.text")).alias("text_md5"))


@query
def sink_error_log(spark, sf_dir):
    """Error rows written by tenant, and read again."""
    path = _folder(spark, "errors")
    records = with_headers(_dead_letters(spark, sf_dir), keep_case=True)
    rows = err.errors_from_rejected(records, FlowConfig(prefix="in_"), A.received())
    write_error_log(rows.select("tenant", "timestamp", "error", "query"), path)
    return spark.read.parquet(path).select(F.col("tenant").cast("string").alias("tenant"), "error", "query")


@query
def publish_files(spark, sf_dir):
    """Error events published to files in place of topics, and read again."""
    path = _folder(spark, "topics")
    records = with_headers(_dead_letters(spark, sf_dir), keep_case=True)
    config = FlowConfig(prefix="in_", suffix="_out")
    publish(err.to_error_events(err.errors_from_rejected(records, config, A.received()), config), path=path)
    return spark.read.parquet(path).select("topic", F.get_json_object("value", "$.payload.error").alias("error"))


@query
def rejected_records(spark, sf_dir):
    """Dead letters read from files with their context headers."""
    path = _folder(spark, "rejected")
    _dead_letters(spark, sf_dir).write.parquet(path)
    rows = read_rejected(spark, FileSource(path), streaming=False)
    return rows.select("offset", F.try_element_at("hdr", F.lit("target_table")).alias("target_table"), F.size("hdr").alias("headers"))


@query
def observed_flow(spark, sf_dir):
    """Counts taken while the events are written, next to how many are there."""
    path = _folder(spark, "observed")
    seen = Observation("events")
    metrics.observe_flow(A.events_raw(spark, sf_dir), seen).write.parquet(path)
    told = {name: F.lit(value) for name, value in seen.get.items()}
    passed = spark.read.schema("offset long").parquet(path).agg(F.count(F.lit(1)).alias("passed"))
    return passed.select(
        told["rows"].cast("long").alias("rows"),
        "passed",
        F.unix_micros(told["oldest"].cast("timestamp")).alias("oldest_us"),
        F.unix_micros(told["newest"].cast("timestamp")).alias("newest_us"),
    )


@query
def backlog_marker(spark, sf_dir):
    """Whether the newest user, and one that does not exist, have arrived in the table."""
    held = apply_lastdata_fast(None, _rows(A.events_raw(spark, sf_dir)).drop("change", "present"))
    newest = A.table(spark, sf_dir, "events").agg(F.max("user_id")).first()[0]
    markers = [f"U{newest}", "nobody"]
    return spark.createDataFrame([(m, expect.backlog_complete(held, m)) for m in markers], "marker string, arrived boolean")


# ---- streaming ------------------------------------------------------------------------------------


def _staged(spark: SparkSession, name: str) -> tuple[str, str]:
    """(a new folder, a raw table in it) to stream from."""
    root = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return root, f"{root}/raw"


def _arrive(records: DataFrame, raw: str, by: str = "offset", steps: int = 4) -> None:
    """Write records so that they arrive in as many steps, each of a file for every core, along a column."""
    files = A.cores(records.sparkSession)
    low, high = records.agg(F.min(by), F.max(by)).first()
    if low is None:
        records.write.mode("append").parquet(raw)
        return
    borders = [low + (high - low) / steps * k if by != "offset" else low + (high - low + 1) * k // steps for k in range(1, steps)]
    for k in range(steps):
        part = records
        if k:
            part = part.where(F.col(by) >= F.lit(borders[k - 1]))
        if k < steps - 1:
            part = part.where(F.col(by) < F.lit(borders[k]))
        part.repartition(files).write.mode("append").parquet(raw)


def _drain(spark: SparkSession, flow: str, raw: str, handle, checkpoint: str) -> None:
    """Run a job over what has arrived, one step at a time."""
    run_available(read_raw(spark, flow, FileSource(raw, max_files=A.cores(spark))), handle, checkpoint)


@query
def stream_lastdata(spark, sf_dir):
    """Newest row per user, kept by a stream over several micro-batches."""
    root, raw = _staged(spark, "lastdata")
    _arrive(A.events_raw(spark, sf_dir), raw)
    job = RelationalJob(spark, "lastdata", [A.user_contract()], f"{root}/tables")
    _drain(spark, "lastdata", raw, job.handle, f"{root}/checkpoint")
    return _state(job.read(A.user_contract().target))


@query
def stream_restart(spark, sf_dir):
    """The same, stopped half-way and started again from its checkpoint."""
    records = A.events_raw(spark, sf_dir)
    half = F.col("offset") % 2 == 0
    root, raw = _staged(spark, "restart")
    job = RelationalJob(spark, "lastdata", [A.user_contract()], f"{root}/tables")
    for part in (records.where(half), records.where(~half)):
        _arrive(part, raw, steps=2)
        _drain(spark, "lastdata", raw, job.handle, f"{root}/checkpoint")
    return _state(job.read(A.user_contract().target))


@query
def stream_replay(spark, sf_dir):
    """The same, the second half read by another query into the same table, and all of it once more by a third."""
    records = A.events_raw(spark, sf_dir)
    middle = records.agg(F.floor((F.min("offset") + F.max("offset")) / 2)).first()[0]
    root, raw = _staged(spark, "replay")
    job = RelationalJob(spark, "lastdata", [A.user_contract()], f"{root}/tables")
    for name, part in (("a", records.where(F.col("offset") <= middle)), ("b", records.where(F.col("offset") > middle)), ("c", records)):
        _arrive(part, f"{raw}/{name}", steps=2)
        _drain(spark, "lastdata", f"{raw}/{name}", job.handle, f"{root}/checkpoint-{name}")
    return _state(job.read(A.user_contract().target))


def _hourly_events(spark, sf_dir):
    return A.events_raw(spark, sf_dir, "historic", time=F.date_trunc("hour", F.col("ts")))


def _historic_outcome(job: RelationalJob) -> DataFrame:
    stored = _state(job.read(A.USER_TABLE)).withColumn("outcome", F.lit("stored"))
    refused = job.errors().select(
        F.get_json_object("value", "$.id").alias("entityid"),
        F.lit(None).cast("long").alias("ts_ms"),
        F.get_json_object(F.get_json_object("value", "$.value"), "$.value").cast("double").alias("value"),
        F.lit(None).cast("string").alias("kind"),
        F.concat_ws(" ", "tenant", "code", F.col("seq.offset").cast("string")).alias("outcome"),
    )
    return stored.unionByName(refused)


@query
def stream_historic(spark, sf_dir):
    """First event of each user and hour, and the refused ones, kept by a stream whose batches meet earlier ones."""
    root, raw = _staged(spark, "historic")
    _arrive(_hourly_events(spark, sf_dir), raw)
    job = RelationalJob(spark, "historic", [A.user_contract("historic")], f"{root}/tables")
    _drain(spark, "historic", raw, job.handle, f"{root}/checkpoint")
    return _historic_outcome(job)


@query
def stream_backlog(spark, sf_dir):
    """A backlog of orders and customers with rows that no table takes, in many batches: what is stored and what is refused."""
    root, raw = _staged(spark, "backlog")
    _arrive(A.orders_raw(spark, sf_dir), raw, steps=5)
    tables = _order_contracts()
    job = RelationalJob(spark, "historic", tables, f"{root}/tables", period="yyyy")
    _drain(spark, "historic", raw, job.handle, f"{root}/checkpoint")
    held = [job.read(t.target).select("entityid", F.lit(t.target).alias("outcome")) for t in tables]
    origin = F.concat_ws("-", F.col("seq.offset").cast("string"), F.col("seq.pos").cast("string"))
    return reduce(DataFrame.unionByName, [*held, job.errors().select(origin.alias("entityid"), F.col("code").alias("outcome"))])


class _BrokenJob(RelationalJob):
    """Loses its database in the second batch, after the error log and before the table is written."""

    def _write(self, store, query, batch, rows, busy):
        if batch == 1:
            raise ConnectionError("the table cannot be reached")
        super()._write(store, query, batch, rows, busy)


@query
def stream_outage(spark, sf_dir):
    """The same through an outage: a batch fails half-way and is run again from the checkpoint."""
    root, raw = _staged(spark, "outage")
    _arrive(_hourly_events(spark, sf_dir), raw)
    tables = [A.user_contract("historic")]
    broken = _BrokenJob(spark, "historic", tables, f"{root}/tables")
    try:
        _drain(spark, "historic", raw, broken.handle, f"{root}/checkpoint")
    except StreamingQueryException:
        pass
    job = RelationalJob(spark, "historic", tables, f"{root}/tables")
    _drain(spark, "historic", raw, job.handle, f"{root}/checkpoint")
    return _historic_outcome(job)


@query
def repeat_errors_by_tenant(spark, sf_dir):
    """Repeated events under a data model whose schema is not the tenant: their errors stay with the tenant."""
    root, raw = _staged(spark, "tenants")
    _arrive(_hourly_events(spark, sf_dir), raw, steps=1)
    table = replace(A.user_contract("historic"), target="devices.devices_user")
    job = RelationalJob(spark, "historic", [table], f"{root}/tables", FlowConfig(datamodel=DM_TYPE_SCHEMA))
    _drain(spark, "historic", raw, job.handle, f"{root}/checkpoint")
    return job.errors().select("tenant", "code", "seq.offset", F.get_json_object("value", "$.id").alias("entityid"))


@query
def stream_documents(spark, sf_dir):
    """Documents built by a stream."""
    root, raw = _staged(spark, "documents")
    _arrive(A.documents_raw(spark, sf_dir), raw)
    job = DocumentJob(spark, root, "sth_")
    _drain(spark, "mongo", raw, job.handle, f"{root}/checkpoint")
    return job.read().select(
        "database",
        "collection",
        F.get_json_object("document", "$.entityId").alias("entity"),
        F.get_json_object("document", "$.nChars").cast("long").alias("n_chars"),
    )


@query
def stream_error_log(spark, sf_dir):
    """Error rows of dead letters, kept by a stream."""
    root, raw = _staged(spark, "errors")
    _arrive(_dead_letters(spark, sf_dir), raw)
    job = ErrorJob(spark, root, FlowConfig(prefix="in_"))
    _drain(spark, "errors", raw, job.handle, f"{root}/checkpoint")
    return job.read().select("seq.offset", "tenant", "error", "query")


def _stand_in(endpoint: str, body: str, timeout_s: float) -> tuple[int, str]:
    """A server that has some resources already and refuses others, by the size in the mutation."""
    size = int(body.split("size: ")[1].split(" ")[0].rstrip(","))
    if size % 3 == 0:
        return 200, '{"errors":[{"message":"URI x already exists in the graph"}]}'
    return (400, "no") if size % 3 == 1 else (200, '{"data":{}}')


@query
def stream_graph(spark, sf_dir):
    """Mutations of parts sent by a stream to a stand-in server: taken, there already, or in the error log."""
    parts = A.source(spark, sf_dir, "part")
    members = {"type": F.lit("part"), "externalId": F.concat(F.lit("Part:"), "p_partkey"), "size": F.col("p_size")}
    root, raw = _staged(spark, "graph")
    _arrive(A.plain_raw(parts, "sgtr", members, F.col("p_partkey")), raw)
    job = GraphJob(spark, root, "http://example.org/graph", send=_stand_in, backoff_s=0.0)
    _drain(spark, "sgtr", raw, job.handle, f"{root}/checkpoint")
    taken = job.outcomes().where("outcome <> 'failed'").select("seq.offset", "outcome", F.lit(None).cast("string").alias("tenant"))
    return taken.unionByName(job.errors().select("seq.offset", F.col("code").alias("outcome"), "tenant"))


@query
def stream_evolution(spark, sf_dir):
    """A table whose contract changes between two runs of its stream: a column renamed, one added, a number become text."""
    old = A.user_contract()
    new = contract(old.target, {"value": "text", "label": "text", "props": "json", "event": "bigint"}, old.key)
    records, later = A.events_raw(spark, sf_dir), A.renamed_events_raw(spark, sf_dir)
    middle = records.agg(F.floor((F.min("offset") + F.max("offset")) / 2)).first()[0]
    root, raw = _staged(spark, "evolution")
    before = RelationalJob(spark, "lastdata", [old], f"{root}/tables")
    _arrive(records.where(F.col("offset") <= middle), raw, steps=2)
    _drain(spark, "lastdata", raw, before.handle, f"{root}/checkpoint")
    after = RelationalJob(spark, "lastdata", [new], f"{root}/tables", renames={old.target: {"kind": "label"}})
    _arrive(later.where(F.col("offset") > middle), raw, steps=2)
    _drain(spark, "lastdata", raw, after.handle, f"{root}/checkpoint")
    return after.read(new.target).select("entityid", _ms("timeinstant").alias("ts_ms"), "value", "label", "event")


@query
def stream_folded(spark, sf_dir):
    """Deletes and missing times in a stream whose batches are folded again and again while it runs."""
    root, raw = _staged(spark, "folded")
    _arrive(A.timeless_events_raw(spark, sf_dir, with_changes=True), raw, steps=5)
    job = RelationalJob(spark, "lastdata", [A.user_contract()], f"{root}/tables", every=2, partial=False)
    _drain(spark, "lastdata", raw, job.handle, f"{root}/checkpoint")
    return _state(job.read(A.user_contract().target))


@query
def stateful_lastdata(spark, sf_dir):
    """The same from the state of a query that begins with the table of the first quarter and is started twice."""
    entities = lambda records: classify_changes(entities_of(records), "lastdata").withColumn("target", F.lit(A.USER_TABLE))
    first, *rest = _quarters(A.timeless_events_raw(spark, sf_dir, with_changes=True))
    began = stateful.changes_of(entities(first)).withColumns({"timeinstant": F.timestamp_micros("ts"), "present": F.array().cast("array<string>")})
    folded = apply_lastdata(None, began.drop("ts"), ["target", "entityid"], with_high=True)
    root, raw = _staged(spark, "stateful")
    folded.select("target", "entityid", F.unix_micros(HIGH).alias("high"), "entity").write.parquet(f"{root}/initial")
    initial = spark.read.parquet(f"{root}/initial")
    for parts in (rest[:1], rest[1:]):
        for part in parts:
            _arrive(part, raw, steps=1)
        stream = entities(read_raw(spark, "lastdata", FileSource(raw, max_files=A.cores(spark))))
        changed = stateful.newest_by_state(stateful.changes_of(stream), initial, partial=False)
        stateful.start_latest(changed, f"{root}/changed", f"{root}/checkpoint").awaitTermination()
    return _state(stateful.as_table(stateful.latest(spark, f"{root}/changed", initial), replace(A.user_contract(), target=A.USER_TABLE)))


def _logged(spark: SparkSession, root: str, rows: DataFrame, name: str) -> DataFrame:
    """Progress of a query that reads all there is and keeps nothing."""
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        writer = rows.writeStream.format("noop").queryName(name).option("checkpointLocation", f"{root}/checkpoint")
        running = writer.trigger(availableNow=True).start()
        running.awaitTermination()
        log.wait(running)
    finally:
        spark.streams.removeListener(log)
    return log.rows()


@query
def stream_flow_log(spark, sf_dir):
    """Notifications of a running flow by result, from its own progress; error events arrive broken."""
    raw_events = A.events_raw(spark, sf_dir, with_changes=True)
    broken = F.when(F.contains("value", F.lit('"entityDelete"')), F.lit("{broken")).otherwise(F.col("value"))
    root, raw = _staged(spark, "flow")
    _arrive(raw_events.withColumn("value", broken), raw)
    records = read_raw(spark, "lastdata", FileSource(raw, max_files=A.cores(spark)))
    seen = metrics.observe_flow(parse_flagged(read_context(records)), metrics.FLOW_NAME + "lastdata")
    log = metrics.progress_log(_logged(spark, root, seen.select("offset"), f"flow-{uuid.uuid4().hex}"))
    told = log.groupBy("flow", "result").agg(F.sum("messages").alias("messages"), F.min("oldest").alias("o"), F.max("newest").alias("n"))
    return told.select("flow", "result", "messages", F.unix_micros("o").alias("oldest_us"), F.unix_micros("n").alias("newest_us"))


@query
def stream_lag(spark, sf_dir):
    """What a query that has read the first half of January has still to read, by topic, from its own progress."""
    records = _event_records(spark, sf_dir).withColumn("flow", F.lit("lastdata"))
    root, raw = _staged(spark, "lag")
    _arrive(records.where(F.col("kafka_ts") < F.lit("2024-01-15").cast("timestamp")), raw, by="kafka_ts", steps=2)
    # One name for each kind of event.
    topics = {r.topic: r.n for r in records.groupBy("topic").agg((F.max("partition") + 1).alias("n")).collect()}
    source = read_raw(spark, "lastdata", FileSource(raw, max_files=A.cores(spark)))
    name = f"lag-{uuid.uuid4().hex}"
    done = metrics.observed_offsets(_logged(spark, root, metrics.observe_offsets(source, topics).select("offset"), name))
    return metrics.consumer_lag(records, done).select("topic", "lag")


@query
def stream_replay_dedup(spark, sf_dir):
    """Records that arrive twice in a stream, counted once."""
    records = _event_records(spark, sf_dir).withColumn("flow", F.lit("lastdata"))
    root, raw = _staged(spark, "dedup")
    _arrive(records.unionByName(records), raw, by="kafka_ts", steps=3)
    once = drop_replayed(read_raw(spark, "lastdata", FileSource(raw, max_files=A.cores(spark))), "1 day").select("topic", "partition", "offset")
    writer = once.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{root}/out").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_sliding(spark, sf_dir):
    """Sliding windows of a stream: counts per slide, then sums of these, in two stateful operators."""
    root, raw = _staged(spark, "sliding")
    _arrive(A.events_raw(spark, sf_dir), raw, by="kafka_ts")
    source = read_raw(spark, "lastdata", FileSource(raw, max_files=A.cores(spark)))
    counted = metrics.throughput(source, "3 days", "1 day", unit_seconds=3600.0, watermark="1 hour")
    writer = counted.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
    writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    closed = spark.read.schema(counted.schema).parquet(f"{root}/out")
    return closed.select(_ms("window_start").alias("start_ms"), "flow", "records", F.round("rate", 6).alias("rate"))


@query
def stream_throughput(spark, sf_dir):
    """Windowed counts of a stream with a watermark, late records waited for."""
    root, raw = _staged(spark, "throughput")
    _arrive(A.events_raw(spark, sf_dir), raw, by="kafka_ts")
    source = read_raw(spark, "lastdata", FileSource(raw, max_files=A.cores(spark)))
    counted = metrics.throughput(source, "1 day", unit_seconds=3600.0, watermark="1 hour")
    out = f"{root}/out"
    writer = counted.writeStream.outputMode("append").format("parquet").option("path", out)
    writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    closed = spark.read.schema(counted.schema).parquet(out)
    return closed.select(_ms("window_start").alias("start_ms"), "flow", "records", "rate")
