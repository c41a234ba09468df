"""Decode notifications: parse, explode entities and attributes, infer types, classify changes.

Everything here is a narrow transformation: rows are parsed, exploded and typed in place, with no
shuffle. Rows that cannot go on carry a `reject` struct instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.binding import bind
from cityflow.functions.geometry import wkt_from_geojson, wkt_from_lat_lon
from cityflow.functions.text import json_quote
from cityflow.functions.times import iso_text, iso_timestamp

REJECT = "struct<stage:string,code:string,error:string>"

# Members of an entity that are no attributes, in lower case.
NOT_ATTRIBUTES = ("id", "type", "alterationtype")

# Change names by alteration type, in lower case.
CHANGES = {
    "entityupdate": "update",
    "entitycreate": "create",
    "entitychange": "change",
    "entitydelete": "delete",
}

_MESSAGE = "data ARRAY<MAP<STRING,STRING>>, _bad STRING"


def rejection(stage: str, code: str | Column, error: str | Column) -> Column:
    """A `reject` value."""
    code = F.lit(code) if isinstance(code, str) else code
    error = F.lit(error) if isinstance(error, str) else error
    return F.struct(F.lit(stage).alias("stage"), code.alias("code"), error.alias("error"))


def accepted(rows: DataFrame) -> DataFrame:
    """Rows without a `reject`, and without that column."""
    return rows.where(F.col("reject").isNull()).drop("reject")


def rejected(rows: DataFrame) -> DataFrame:
    """Rows with a `reject`."""
    return rows.where(F.col("reject").isNotNull())


def parse_flagged(records: DataFrame) -> DataFrame:
    """Add `data`, the entities of the message, and `reject` for malformed bodies."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    message = F.from_json("value", _MESSAGE, options)
    bad = F.col("_msg").isNull() | F.col("_msg._bad").isNotNull()
    return (
        bind(records, "_msg", message)
        .withColumn("data", F.col("_msg.data"))
        .withColumn("reject", F.when(bad, rejection("parse", "BAD_JSON", "Malformed notification JSON")))
        .drop("_msg")
    )


def parse(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed records with `data`, malformed ones with `reject`)."""
    flagged = parse_flagged(records)
    return accepted(flagged), rejected(flagged)


def explode_flagged(parsed: DataFrame) -> DataFrame:
    """One row per entity, in order, with `reject` for entities that are null or have no id.

    A record with no entities keeps one row, rejected with code NO_ENTITIES, so it can be counted.
    The outer form is deliberate: the inner one makes the optimizer repeat the whole JSON parse in a
    filter under the generator.
    """
    prior = F.col("reject") if "reject" in parsed.columns else F.lit(None).cast(REJECT)
    first = F.get(F.col("data"), 0)
    staged = parsed.withColumn("first_alteration", F.try_element_at(first, F.lit("alterationType")))
    keep = [c for c in staged.columns if c not in ("data", "reject")]
    rows = staged.select(
        *keep, prior.alias("_prior"), F.posexplode_outer("data").alias("entity_pos", "entity")
    )
    entity_id = F.try_element_at("entity", F.lit("id"))
    reject = (
        F.when(F.col("_prior").isNotNull(), F.col("_prior"))
        .when(F.col("entity_pos").isNull(), rejection("explode", "NO_ENTITIES", "No entities found in payload"))
        .when(F.col("entity").isNull(), rejection("explode", "NULL_ENTITY", "Null element in data"))
        .when(
            F.coalesce(entity_id, F.lit("")) == "",
            rejection("explode", "NO_ENTITY_ID", "Entity without id"),
        )
    )
    return rows.withColumns(
        {
            "entityid": entity_id,
            "entitytype": F.try_element_at("entity", F.lit("type")),
            "seq": F.struct(
                F.col("partition").alias("partition"),
                F.col("offset").alias("offset"),
                F.coalesce(F.col("entity_pos"), F.lit(0)).alias("pos"),
            ),
            "reject": reject,
        }
    ).drop("_prior")


def explode_entities(parsed: DataFrame) -> DataFrame:
    """One row per usable entity."""
    return accepted(explode_flagged(parsed))


def no_entity_counts(parsed: DataFrame) -> DataFrame:
    """Number of well-formed records without entities, by flow."""
    empty = F.coalesce(F.size("data"), F.lit(0)) <= 0
    return parsed.groupBy("flow").agg(F.count_if(empty).alias("no_entities"))


def classify_changes(entities: DataFrame, flow: str = "lastdata") -> DataFrame:
    """Add `change`.

    In the lastdata flow only the first entity of a notification is examined, and its alteration type
    must be an attribute object. When that says delete, the first entity is the one deleted and the
    others are `ignored`; anything else is an update of every entity. In the graph flow each entity
    has its own alteration type, as an attribute or as plain text, and `create` is the default.
    """
    own = F.try_element_at("entity", F.lit("alterationType"))
    if flow == "sgtr":
        named = F.lower(F.coalesce(F.get_json_object(own, "$.value"), own))
        return entities.withColumn("change", _change_of(named, "create"))
    deletes = F.lower(F.get_json_object("first_alteration", "$.value")) == "entitydelete"
    named = F.lower(F.get_json_object(own, "$.value"))
    change = (
        F.when(deletes & (F.col("entity_pos") == 0), F.lit("delete"))
        .when(deletes, F.lit("ignored"))
        # A delete that is not on the first entity is not seen, so it is an update like any other.
        .when(named == "entitydelete", F.lit("update"))
        .otherwise(_change_of(named, "update"))
    )
    return entities.withColumn("change", change)


def _change_of(named: Column, default: str) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CHANGES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, named), F.lit(default))


def with_attributes(entities: DataFrame, names: Sequence[str] | None = None, wanted: Column | None = None) -> DataFrame:
    """Add `attrs`, the typed attributes of each entity, in document order.

    Elements are `{name, pos, type, metadata, kind, v_string, v_double, v_bool, v_ts, wkt, date_error,
    is_null}`. Names are in lower case; of those that differ only by case the last one wins and takes
    the place of the first. With `names`, other attributes are left unparsed; with `wanted`, `attrs` is NULL where it does
    not hold.

    Every attribute is parsed once.
    """
    unique = F.transform_keys("entity", lambda k, v: F.lower(k))
    if names is None:
        chosen = F.map_filter(unique, lambda k, v: ~k.isin(*NOT_ATTRIBUTES))
    else:
        lowered = [n.lower() for n in names]
        chosen = F.map_filter(unique, lambda k, v: k.isin(*lowered))
    typed = _typed(F.map_entries(chosen))
    return bind(entities, "attrs", typed if wanted is None else F.when(wanted, typed))


# Names of time attributes, and declared types of JSON and of dates.
_TIMES = ("timeinstant", "recvtime")
_JSON_TYPES = ("json", "jsonb")
_DATE_TYPES = ("datetime", "iso8601")

# Declared types that most attributes have and that ask for nothing; others of the kind only take longer to be told.
_USUAL_TYPES = ("Number", "Text", "Boolean")


def _typed(entries: Column) -> Column:
    """Typed attributes of the entries of an entity.

    Functions of an array are evaluated one node at a time and copy what they return, so there are few steps. An attribute
    written the usual way is told by one pattern and needs no parser; of the others, plain values, times and dates given as text are
    typed in one step, and only what is left goes the long way.
    """
    read = F.transform(
        entries,
        lambda e, i: F.struct(
            e["key"].alias("name"),
            i.alias("pos"),
            e["value"].alias("json"),
            F.when(e["value"].startswith('{"type":"Number"'), _only_group(e["value"], _USUAL_NUMBER).try_cast("double")).alias("number"),
            F.when(
                e["value"].startswith('{"type":"Text"') | e["value"].startswith('{"type":"DateTime"'),
                _only_group(e["value"], _USUAL_TEXT),
            ).alias("text"),
        ),
    )
    return F.transform(
        read,
        lambda a: F.when(_is_usual_number(a), _usual(a, "Number", "double", v_double=a["number"]))
        .when(_is_usual_text(a), _usual(a, F.when(_is_text(a), "Text").otherwise("DateTime"), "string", v_string=a["text"]))
        .otherwise(F.get(_of_any_kind(F.array(a)), 0)),
    )


# Attributes as context brokers write them, all of the text: a number of type Number, and a text without escapes of type Text or
# DateTime. The parser copies objects without white space.
_USUAL_END = r'(?:,"metadata":\{\})?\}\z'
_USUAL_NUMBER = r'\A\{"type":"Number","value":(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)' + _USUAL_END
_USUAL_TEXT = r'\A\{"type":"(?:Text|DateTime)","value":"([^"\\\x00-\x1f]+)"' + _USUAL_END


def _only_group(json: Column, pattern: str) -> Column:
    """What stands in the group of a pattern, which is never empty, or the empty text."""
    return F.regexp_extract(json, pattern, 1)


def _is_text(a: Column) -> Column:
    return a["json"].startswith('{"type":"Text"')


def _is_usual_number(a: Column) -> Column:
    """Zeros with a sign and numbers beyond the largest double are left to the variant."""
    return (
        (F.abs(a["number"]) < float("inf"))
        & ((a["number"] != 0) | ~a["json"].contains("-"))
        & ~a["name"].isin(*_TIMES)
    )


def _is_usual_text(a: Column) -> Column:
    """A plain text, or a time; other dates are to be read."""
    return (a["text"] != "") & (_is_text(a) | a["name"].isin(*_TIMES))


def _usual(a: Column, declared: Column | str, kind: str, **value: Column) -> Column:
    metadata = F.when(a["json"].endswith(',"metadata":{}}'), "{}")
    return _made(a, kind, type=F.lit(declared) if isinstance(declared, str) else declared, metadata=metadata, **value)


def _of_any_kind(read: Column) -> Column:
    """Typed attributes of any kind of value."""
    shape = "type STRING, value VARIANT, metadata STRING"
    parsed = F.transform(
        read,
        lambda a: F.struct(
            a["name"].alias("name"), a["pos"].alias("pos"), a["json"].alias("json"), F.from_json(a["json"], shape).alias("p")
        ),
    )
    described = F.transform(
        parsed,
        lambda a: F.struct(
            a["name"].alias("name"),
            a["pos"].alias("pos"),
            F.coalesce(a["p"]["type"], F.lit("")).alias("type"),
            a["p"]["metadata"].alias("metadata"),
            a["p"]["value"].alias("value"),
            a["json"].alias("json"),
            _kind_at_once(F.schema_of_variant(a["p"]["value"])).alias("json_kind"),
            _way(a["name"], a["p"]["type"]).alias("way"),
        ),
    )
    return F.transform(
        described,
        lambda a: F.when((a["json_kind"] == "string") & a["way"].isin("plain", "time"), _text(a))
        .when(a["way"] == "plain", _other_plain(a))
        .when((a["json_kind"] == "string") & (a["way"] == "date"), _date(a))
        .otherwise(F.get(_by_steps(F.array(a)), 0)),
    )


def _way(name: Column, declared: Column) -> Column:
    """How an attribute is typed: plain, time, date, or other."""
    return (
        F.when(declared.isin(*_USUAL_TYPES) & ~name.isin(*_TIMES), "plain")
        .when(F.lower(declared).startswith("geo:"), "other")
        .when(name.isin(*_TIMES), "time")
        .when(declared.isin(*_JSON_TYPES), "other")
        .when(F.lower(declared).isin(*_DATE_TYPES), "date")
        .otherwise("plain")
    )


def _kind_at_once(schema: Column) -> Column:
    """`json_kind` that evaluates its argument once: two characters tell the schemas of JSON values apart."""
    kinds = {"VO": "null", "ST": "string", "BO": "boolean", "OB": "object", "AR": "array"}
    known = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.substring(F.coalesce(schema, F.lit("VO")), 1, 2)), F.lit("number"))


def _made(a: Column, kind: Column | str, **values: Column) -> Column:
    """A typed attribute with the given members; values that are not given are NULL, and flags false."""
    about = {name: values[name] if name in values else a[name] for name in ("name", "pos", "type", "metadata")}
    held = {name: values.get(name, F.lit(None).cast(of)) for name, of in _VALUES.items()}
    flags = {name: values.get(name, F.lit(False)) for name in ("date_error", "is_null")}
    members = {**about, "kind": F.lit(kind) if isinstance(kind, str) else kind, **held, **flags}
    return F.struct(*[member.alias(name) for name, member in members.items()])


# Value members of a typed attribute.
_VALUES = {"v_string": "string", "v_double": "double", "v_bool": "boolean", "v_ts": "timestamp", "wkt": "string"}


def _text(a: Column) -> Column:
    return _made(a, "string", v_string=F.try_variant_get(a["value"], "$", "string"))


def _other_plain(a: Column) -> Column:
    """A plain value that is no text."""
    is_boolean, is_number = a["json_kind"] == "boolean", a["json_kind"] == "number"
    return _made(
        a,
        F.when(is_number, "double").when(is_boolean, "boolean").otherwise("string"),
        v_double=F.when(is_number, F.try_variant_get(a["value"], "$", "double")),
        v_string=F.when(a["json_kind"].isin("object", "array"), F.get_json_object(a["json"], "$.value")),
        v_bool=F.when(is_boolean, F.try_variant_get(a["value"], "$", "boolean")),
        is_null=a["json_kind"] == "null",
    )


def _date(a: Column) -> Column:
    """A date given as text."""
    read = F.transform(
        F.array(F.try_variant_get(a["value"], "$", "string")), lambda t: F.struct(t.alias("text"), iso_timestamp(t).alias("ts"))
    )
    made = F.transform(
        read,
        lambda d: _made(
            a,
            F.when(d["ts"].isNotNull(), "timestamp").otherwise("string"),
            v_string=F.when(d["ts"].isNull(), d["text"]),
            v_ts=d["ts"],
            date_error=d["ts"].isNull(),
        ),
    )
    return F.get(made, 0)


def _by_steps(described: Column) -> Column:
    """Attributes of any declared type; each `transform` binds what the next one uses several times."""
    read = F.transform(
        described,
        lambda a: F.struct(
            *_keep(a, "value", "json", "json_kind"),
            a["type"].isin(*_JSON_TYPES).alias("is_json"),
            a["name"].isin(*_TIMES).alias("is_time"),
            F.lower(a["type"]).isin(*_DATE_TYPES).alias("is_date"),
            F.lower(a["type"]).startswith("geo:").alias("is_geo"),
        ),
    )
    # Numbers and booleans keep their own form, and their text is only read where something asks for it.
    texts = F.transform(
        read,
        lambda a: F.struct(
            *_keep(a, "value", "json_kind", "is_json", "is_time", "is_geo"),
            F.when(a["json_kind"] == "string", F.try_variant_get(a["value"], "$", "string"))
            .when(
                a["json_kind"].isin("object", "array")
                | ((a["json_kind"] != "null") & (a["is_json"] | a["is_time"] | a["is_date"] | a["is_geo"])),
                F.get_json_object(a["json"], "$.value"),
            )
            .alias("text"),
            (a["is_date"] & ~a["is_time"] & (a["json_kind"] != "null")).alias("is_date"),
        ),
    )
    shaped = F.transform(
        texts,
        lambda a: F.struct(
            *_keep(a, "value", "json_kind", "is_json", "is_time", "is_geo", "is_date", "text"),
            F.when(a["is_geo"], wkt_of(a["type"], a["json_kind"], a["text"])).alias("wkt"),
            F.when(a["is_date"], iso_timestamp(a["text"])).alias("ts"),
        ),
    )
    kinds = F.transform(
        shaped,
        lambda a: F.struct(
            *_keep(a, "value", "json_kind", "is_json", "is_time", "is_date", "text", "wkt", "ts"),
            _kind(a).alias("kind"),
        ),
    )
    return F.transform(kinds, _final)


def _keep(a: Column, *more: str) -> list[Column]:
    return [a[c].alias(c) for c in ("name", "pos", "type", "metadata", *more)]


def json_kind(schema: Column) -> Column:
    """Kind of a JSON value from the text of its variant schema: null, string, boolean, object, array, number."""
    return (
        F.when(schema.isNull() | (schema == "VOID"), "null")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .otherwise("number")
    )


def wkt_of(declared: Column, kind: Column, text: Column) -> Column:
    """Well-known text of an attribute value under its declared geometry type."""
    is_polygon = (declared == "geo:polygon") & (kind == "array")
    return F.when(
        ((declared == "geo:point") & (kind == "string")) | is_polygon, wkt_from_lat_lon(text, is_polygon)
    ).when((declared == "geo:json") & (kind == "object"), wkt_from_geojson(text))


def declared_json(value: Column, kind: Column, text: Column) -> Column:
    """JSON text of a value whose declared type is json or jsonb (a string gains quotes)."""
    return F.when(kind == "string", json_quote(text)).when(
        value.isNotNull(), F.coalesce(text, F.lit("null"))
    )


def _kind(a: Column) -> Column:
    return (
        F.when(a["wkt"].isNotNull(), "geometry")
        .when(a["is_time"] | a["is_json"], "string")
        .when(a["is_geo"] & (F.lower(a["type"]) == "geo:json") & (a["json_kind"] != "null"), "bad_geometry")
        .when(a["ts"].isNotNull(), "timestamp")
        .when(a["is_date"], "string")
        .when(a["json_kind"] == "boolean", "boolean")
        .when(a["json_kind"] == "number", "double")
        .otherwise("string")
    )


def _final(a: Column) -> Column:
    kind = a["kind"]
    string = (
        # A time column is always text, so a null in it is the word.
        F.when(a["is_time"], F.coalesce(a["text"], F.lit("null")))
        .when(a["is_json"], declared_json(a["value"], a["json_kind"], a["text"]))
        .when(kind.isin("string", "bad_geometry"), a["text"])
    )
    return F.struct(
        a["name"].alias("name"),
        a["pos"].alias("pos"),
        a["type"].alias("type"),
        a["metadata"].alias("metadata"),
        kind.alias("kind"),
        string.alias("v_string"),
        F.when(kind == "double", F.try_variant_get(a["value"], "$", "double")).alias("v_double"),
        F.when(kind == "boolean", F.try_variant_get(a["value"], "$", "boolean")).alias("v_bool"),
        F.when(kind == "timestamp", a["ts"]).alias("v_ts"),
        a["wkt"].alias("wkt"),
        ((kind == "string") & a["is_date"] & ~a["is_json"]).alias("date_error"),
        # A declared json value of null is the JSON text null, which is a value.
        ((a["json_kind"] == "null") & ~a["is_time"] & ~(a["is_json"] & a["value"].isNotNull())).alias("is_null"),
    )


def explode_attributes(entities: DataFrame) -> DataFrame:
    """Long form: one row per attribute of each entity.

    Entities without attributes have no rows here; the wide form keeps them.
    """
    if "attrs" not in entities.columns:
        entities = with_attributes(entities)
    keep = [c for c in entities.columns if c not in ("attrs", "entity")]
    exploded = entities.select(*keep, F.explode_outer("attrs").alias("_a")).where(F.col("_a").isNotNull())
    fields = (
        ("name", "attr_name"),
        ("pos", "attr_pos"),
        ("type", "attr_type"),
        ("metadata", "metadata"),
        ("kind", "kind"),
        ("v_string", "v_string"),
        ("v_double", "v_double"),
        ("v_bool", "v_bool"),
        ("v_ts", "v_ts"),
        ("wkt", "wkt"),
        ("date_error", "date_error"),
        ("is_null", "is_null"),
    )
    return exploded.select(*keep, *[F.col(f"_a.{source}").alias(name) for source, name in fields])


def infer_types(entities: DataFrame) -> DataFrame:
    """Typed long form of entities: `explode_attributes` over `with_attributes`."""
    return explode_attributes(with_attributes(entities))


def with_recvtime(rows: DataFrame, received: Column | None = None) -> DataFrame:
    """Add `recvtime`, the ISO text of the ingestion time (one value per batch)."""
    return rows.withColumn("recvtime", iso_text(F.current_timestamp() if received is None else received))
