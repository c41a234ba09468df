"""Graph mutations from notifications with plain values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.config import GraphConfig
from cityflow.functions.binding import bind
from cityflow.functions.geometry import KINDS, wkt_from_geojson
from cityflow.functions.graphtext import nested_values, slug
from cityflow.functions.text import json_quote, number_text
from cityflow.operators.decode import json_kind, rejection


def explode_graph_entities(records: DataFrame) -> DataFrame:
    """One row per entity with its JSON text `object`, members in document order.

    Malformed bodies, empty messages and null entities are kept with `reject`.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    staged = bind(records, "_msg", F.from_json("value", "data ARRAY<STRING>, _bad STRING", options))
    bad = F.col("_msg").isNull() | F.col("_msg._bad").isNotNull()
    rows = staged.withColumn("_bad", bad).select(
        *records.columns, "_bad", F.posexplode_outer("_msg.data").alias("entity_pos", "object")
    )
    reject = (
        F.when(F.col("_bad"), rejection("parse", "BAD_JSON", "Malformed notification JSON"))
        .when(F.col("entity_pos").isNull(), rejection("explode", "NO_ENTITIES", "No entities found in payload"))
        .when(F.col("object").isNull(), rejection("explode", "NULL_ENTITY", "Null element in data"))
        .when(~F.col("object").startswith("{"), rejection("explode", "BAD_ENTITY", "Entity is no object"))
    )
    members = F.from_json("object", "type STRING, alterationType STRING")
    return (
        bind(rows.withColumn("reject", reject), "_m", members)
        .withColumns(
            {
                "entitytype": F.col("_m.type"),
                "alteration": F.lower(
                    F.coalesce(F.get_json_object("_m.alterationType", "$.value"), F.col("_m.alterationType"))
                ),
                "seq": F.struct(
                    F.col("partition"), F.col("offset"), F.coalesce(F.col("entity_pos"), F.lit(0)).alias("pos")
                ),
            }
        )
        .drop("_m", "_bad")
    )


def rewrite_location(entities: DataFrame) -> DataFrame:
    """Plan the geometry rewrite of location entities: add `geo_key` and `geo_member`.

    For entities of type location (any case) with a member `asGeoJSON` (any case): a valid geometry, as
    object or as text, gives a new member `asWkt` and the old one goes; null or the text null gives
    `asWkt: null`; anything else is left alone.
    """
    members = F.map_entries(F.from_json("object", "map<string,string>"))
    found = F.get(F.filter(members, lambda e: F.lower(e["key"]) == "asgeojson"), 0)
    staged = bind(entities, "_geo", F.when(F.lower("entitytype") == "location", found))
    text = F.col("_geo.value")
    parsed = F.from_json(text, "type STRING, coordinates STRING")
    acceptable = F.lower(parsed["type"]).isin(*KINDS) & parsed["coordinates"].startswith("[")
    staged = bind(staged, "_wkt", F.when(acceptable, wkt_from_geojson(text)))
    is_null = F.col("_geo").isNotNull() & (text.isNull() | (F.lower(F.trim(text)) == "null"))
    done = is_null | F.col("_wkt").isNotNull()
    return staged.withColumns(
        {
            "geo_key": F.when(done, F.col("_geo.key")),
            "geo_member": F.when(is_null, F.lit('{"asWkt":null}')).when(
                F.col("_wkt").isNotNull(), F.concat(F.lit('{"asWkt":'), json_quote(F.col("_wkt")), F.lit("}"))
            ),
        }
    ).drop("_geo", "_wkt")


_SCALARS = ("null", "string", "boolean", "number")


def _with_members(entities: DataFrame, config: GraphConfig) -> DataFrame:
    """Add `external_id` and `_members`: what is left of each object's members, edited, in document order.

    A member is `{key, kind, text, json}`: the text of a string, number or boolean, and the JSON text of a nested value, which
    is read in a second look at the object, and only where it has one. type and alterationType go, the location member
    becomes `asWkt`, and with slugs externalId is one.
    """
    if "geo_key" not in entities.columns:
        entities = rewrite_location(entities)
    external = F.from_json("object", "externalId STRING")["externalId"]
    if config.slug_uri:
        external = F.when(F.coalesce(external, F.lit("")) != "", slug(external)).otherwise(external)
    staged = entities.withColumn("external_id", external)
    typed = F.transform(
        F.map_entries(F.from_json("object", "map<string,variant>")),
        lambda e: F.struct(
            e["key"].alias("key"),
            e["value"].alias("value"),
            json_kind(F.schema_of_variant(e["value"])).alias("kind"),
            F.try_variant_get(e["value"], "$", "double").cast("string").alias("plain"),
        ),
    )
    # Doubles of many digits, of which this text is not always the shortest, are left to the reader of nested values.
    exact = lambda e: (e["kind"] == "number") & (e["plain"].contains("E") | (F.length(e["plain"]) > 16))
    read = F.transform(
        typed, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), F.when(exact(e), "exact").otherwise(e["kind"]).alias("kind"))
    )
    staged = bind(staged, "_read", read)
    nested = F.exists("_read", lambda e: ~e["kind"].isin(*_SCALARS))
    texts = F.when(nested, F.from_json("object", "map<string,string>"))
    staged = bind(staged, "_texts", texts)
    text = lambda e: (
        F.when(e["kind"] == "string", F.try_variant_get(e["value"], "$", "string"))
        .when(e["kind"] == "number", number_text(F.try_variant_get(e["value"], "$", "double")))
        .when(e["kind"] == "boolean", F.try_variant_get(e["value"], "$", "boolean").cast("string"))
    )
    members = F.transform(
        "_read",
        lambda e: _member(
            e["key"], e["kind"], text(e), F.when(~e["kind"].isin(*_SCALARS), F.try_element_at("_texts", e["key"]))
        ),
    )
    gone = F.array_compact(F.array(F.lit("type"), F.lit("alterationType"), F.col("geo_key")))
    members = F.filter(members, lambda m: ~F.array_contains(gone, m["key"]))
    if config.slug_uri:
        is_id = F.coalesce("external_id", F.lit("")) != ""
        members = _put(members, is_id, _member(F.lit("externalId"), F.lit("string"), F.col("external_id"), F.lit(None)))
    wkt = F.get_json_object("geo_member", "$.asWkt")
    geometry = _member(F.lit("asWkt"), F.when(wkt.isNull(), "null").otherwise("string"), wkt, F.lit(None))
    members = _put(members, F.col("geo_member").isNotNull(), geometry)
    return bind(staged, "_members", members).drop("_read", "_texts")


def _member(key: Column, kind: Column, text: Column, nested: Column) -> Column:
    return F.struct(key.alias("key"), kind.alias("kind"), text.cast("string").alias("text"), nested.cast("string").alias("json"))


def _put(members: Column, wanted: Column, member: Column) -> Column:
    """Members with one put in: in the place of the one of its name, or at the end."""
    known = F.exists(members, lambda m: m["key"] == member["key"])
    replaced = F.transform(members, lambda m: F.when(m["key"] == member["key"], member).otherwise(m))
    return F.when(wanted & known, replaced).when(wanted, F.concat(members, F.array(member))).otherwise(members)


def prepare_graph_entities(entities: DataFrame, config: GraphConfig = GraphConfig()) -> DataFrame:
    """Add `prepared` (object text without type and alterationType, location rewritten) and `external_id`.

    With slugs on, externalId is a slug, in the object too.
    """
    staged = _with_members(entities, config)
    value = lambda m: (
        F.when(m["kind"] == "string", json_quote(m["text"])).when(m["json"].isNotNull(), m["json"]).otherwise(F.coalesce(m["text"], F.lit("null")))
    )
    written = F.transform("_members", lambda m: F.concat(json_quote(m["key"]), F.lit(":"), value(m)))
    prepared = F.concat(F.lit("{"), F.array_join(written, ","), F.lit("}"))
    return staged.withColumn("prepared", prepared).drop("_members")


def graph_name(config: GraphConfig) -> Column:
    """Graph of a row: the record's, else the tenant when allowed, else none; with prefix and suffix."""
    named = F.nullif(F.col("graphname"), F.lit(""))
    if config.fallback_to_service:
        named = F.coalesce(named, F.col("service"))
    return F.concat(F.lit(config.prefix), F.coalesce(named, F.lit("")), F.lit(config.suffix))


def type_name(entity_type: Column) -> Column:
    """Entity type with a capital first letter and the rest in lower case."""
    rest = F.lower(F.substring(entity_type, F.lit(2), F.length(entity_type)))
    return F.coalesce(F.concat(F.upper(F.substring(entity_type, 1, 1)), rest), F.lit(""))


def build_mutations(entities: DataFrame, config: GraphConfig = GraphConfig()) -> DataFrame:
    """Add `graph`, `action` (create, update, delete) and `query`, the mutation text.

    Mutations are ordinary expressions; only nested values of members go to an Arrow function.
    """
    alteration = F.col("alteration")
    action = (
        F.when(alteration.isin("entityupdate", "entitychange"), F.lit("update"))
        .when(alteration == "entitydelete", F.lit("delete"))
        .otherwise(F.lit("create"))
    )
    staged = _with_members(entities, config).withColumns({"graph": graph_name(config), "action": action})
    writes = (F.col("action") != "delete") & F.exists("_members", lambda m: m["json"].isNotNull())
    staged = staged.withColumn("_nested", nested_values(config.slug_uri)(F.when(writes, F.transform("_members", lambda m: m["json"]))))
    argument = lambda m, i: (
        F.when(m["kind"] == "string", F.concat(F.lit('"'), _escaped(m["text"]), F.lit('"')))
        .when(m["json"].isNotNull(), F.get("_nested", i))
        .otherwise(F.coalesce(m["text"], F.lit("null")))
    )
    written = F.transform("_members", lambda m, i: F.concat(m["key"], F.lit(": "), argument(m, i)))
    staged = staged.withColumn("_object", F.concat(F.lit("{ "), F.array_join(written, ", "), F.lit(" }"))).drop("_members", "_nested")
    dti = F.concat(F.lit('dti: "'), F.col("graph"), F.lit('"'))
    staging = F.lit(", staging: true" if config.staging else "")
    base = F.raise_error("set GraphConfig.resource_base to delete resources") if config.resource_base is None else F.lit(config.resource_base)
    resource = F.concat(base.cast("string"), F.col("graph"), F.lit("/resource/"), F.col("external_id"))
    write = F.concat(
        F.lit("mutation { "),
        F.col("action"),
        type_name(F.col("entitytype")),
        F.lit("("),
        dti,
        F.lit(", input: { object: "),
        F.col("_object"),
        F.lit(" }"),
        staging,
        F.lit(") { uri } }"),
    )
    delete = F.concat(
        F.lit("mutation { deleteData("), dti, F.lit(', uris: ["'), _escaped(resource), F.lit('"]'), staging, F.lit(") }")
    )
    return staged.withColumn("query", F.when(F.col("action") == "delete", delete).otherwise(write)).drop("_object")


def _escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit('"'), F.lit('\\"'))
    return F.replace(text, F.lit("\n"), F.lit("\\n"))


def classify_response(responses: DataFrame) -> DataFrame:
    """Add `outcome` and `error` to rows with the `status` and `body` of a reply.

    A success whose body has errors that only say the resource is there already is `exists`: taken, not
    tried again, not logged. Any other errors in a success, and any other status, are `failed`.
    """
    errors = F.from_json("body", "errors ARRAY<STRUCT<message STRING>>")["errors"]
    staged = responses.withColumn("_errors", errors)
    existing = F.forall("_errors", lambda e: F.coalesce(e["message"], F.lit("")).rlike("(?i)already (exists|created)"))
    ok = F.col("status").between(200, 299)
    has_errors = F.coalesce(F.size("_errors"), F.lit(0)) > 0
    outcome = (
        F.when(ok & ~has_errors, F.lit("accepted"))
        .when(ok & existing, F.lit("exists"))
        .otherwise(F.lit("failed"))
    )
    said = F.concat(F.lit("Server replied with status code "), F.coalesce(F.col("status").cast("string"), F.lit("none")))
    error = F.when(ok, F.concat(said, F.lit(" and body with retryable GraphQL errors: "), F.col("body"))).otherwise(
        F.concat(said, F.lit(" and body "), F.coalesce("body", F.lit("")))
    )
    return staged.withColumn("outcome", outcome).withColumn(
        "error", F.when(F.col("outcome") == "failed", error)
    ).drop("_errors")
