"""Table contracts: check rows against the table catalogue, project them to it, evolve tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.functions.binding import bind
from cityflow.functions.geometry import geometry_struct, wkb_from_wkt
from cityflow.functions.text import number_text
from cityflow.functions.times import iso_timestamp
from cityflow.operators.decode import accepted, declared_json, json_kind, rejected, rejection, with_attributes, wkt_of

CATALOGUE_SCHEMA = "target STRING, column STRING, type STRING, nullable BOOLEAN, pk BOOLEAN"

# Columns every table row gets from the entity itself.
BASE_COLUMNS = ("entityid", "entitytype", "fiwareservicepath", "recvtime")

# Whole number column types, their lowest and highest value as doubles.
WHOLE_NUMBERS = {
    "smallint": (-32768.0, 32767.0),
    "integer": (-2147483648.0, 2147483647.0),
    # The highest double below 2^63; 2^63 itself is out of range.
    "bigint": (-9223372036854775808.0, 9223372036854774784.0),
}

REAL_MAX = 3.4028235677973366e38

SPARK_TYPES = {
    "boolean": "boolean",
    "smallint": "smallint",
    "integer": "int",
    "bigint": "bigint",
    "real": "float",
    "double precision": "double",
    "text": "string",
    "json": "string",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp_ntz",
    "geometry": "struct<wkb:binary,srid:int>",
}


@dataclass(frozen=True)
class TableColumn:
    """One column of a table: type is a key of SPARK_TYPES, `numeric(p,s)` or `geometry(<kind>)`."""

    name: str
    type: str
    nullable: bool = True
    pk: bool = False

    @property
    def spark_type(self) -> str:
        """Spark type text."""
        if self.type.startswith("numeric"):
            return self.type.replace("numeric", "decimal")
        return SPARK_TYPES[re.sub(r"\(.*", "", self.type)]


@dataclass(frozen=True)
class Contract:
    """Columns of one target table."""

    target: str
    columns: tuple[TableColumn, ...]

    @property
    def names(self) -> list[str]:
        """Column names in order."""
        return [c.name for c in self.columns]

    @property
    def key(self) -> list[str]:
        """Primary key columns."""
        return [c.name for c in self.columns if c.pk]


def contract(target: str, extra: Mapping[str, str], pk: Sequence[str] = (), not_null: Sequence[str] = (),
             with_time: bool = True) -> Contract:
    """Contract of a table with the common columns and `extra` (name to type)."""
    common = {
        "recvtime": "timestamp",
        "fiwareservicepath": "text",
        "entityid": "text",
        "entitytype": "text",
        **({"timeinstant": "timestamp"} if with_time else {}),
        **extra,
    }
    return Contract(
        target,
        tuple(
            TableColumn(name, kind, nullable=name not in not_null and name not in pk, pk=name in pk)
            for name, kind in common.items()
        ),
    )


def catalogue(spark: SparkSession, contracts: Iterable[Contract]) -> DataFrame:
    """The contracts as a DataFrame, one row per table with its columns.

    Made from an Arrow table, so that Spark knows its size and broadcasts it as long as that is small.
    """
    held = list(contracts)
    column = pa.struct([("column", pa.string()), ("type", pa.string()), ("nullable", pa.bool_()), ("pk", pa.bool_())])
    described = [
        [{"column": c.name, "type": c.type, "nullable": c.nullable, "pk": c.pk} for c in table.columns] for table in held
    ]
    return spark.createDataFrame(
        pa.table({"target": pa.array([t.target for t in held], pa.string()), "columns": pa.array(described, pa.list_(column))})
    )


def check_contract(entities: DataFrame, tables: DataFrame) -> DataFrame:
    """Add `violations`, an array of `{column, code, error}`, and `reject` with the first of them.

    Needs `target`, and `attrs` or `entity`: without `attrs` that is added for the rows that have a table, as the attributes of others
    need not be typed to refuse them. `tables` is a `catalogue`, or a frame of CATALOGUE_SCHEMA, which is folded
    to one row per table first. It is joined on the table name without a hint: Spark broadcasts a
    catalogue below its own threshold, which then needs no shuffle of the entities; above it the
    entities are shuffled by table and hot tables split at run time. All tables and tenants are checked in one pass.
    """
    if "columns" in tables.columns:
        folded = tables.select("target", F.col("columns").alias("_columns"))
    else:
        folded = tables.groupBy("target").agg(
            F.collect_list(F.struct("column", "type", "nullable", "pk")).alias("_columns")
        )
    joined = entities.join(_prepared(folded), "target", "left")
    if "attrs" not in entities.columns:
        joined = with_attributes(joined, wanted=F.col("_columns").isNotNull())
    # Most attributes fit, which takes a look or two; only the others are paired with their column, so that it is looked up once.
    doubtful = F.filter("attrs", lambda a: (a["name"] != "recvtime") & ~F.coalesce(_fits(a), F.lit(False)))
    paired = F.transform(
        doubtful,
        lambda a: F.struct(
            *[a[m].alias(m) for m in ("name", "kind", "v_string", "v_double", "wkt", "is_null")],
            F.try_element_at("_columns", a["name"]).alias("c"),
        ),
    )
    values = F.filter(F.transform(paired, lambda a: _verdict(a, a["c"])), lambda v: v.isNotNull())
    required = F.filter(
        "_required", lambda c: ~F.exists("attrs", lambda a: (a["name"] == c["column"]) & ~a["is_null"])
    )
    missing = F.transform(required, _missing)
    no_table = F.array(
        violation(F.lit(""), "TABLE_MISSING", F.concat(F.lit('ERROR: relation "'), "target", F.lit('" does not exist')))
    )
    checked = bind(
        joined,
        "violations",
        F.when(F.col("_columns").isNull(), no_table).otherwise(F.concat(values, missing)),
    )
    first = F.get("violations", 0)
    prior = F.col("reject") if "reject" in entities.columns else F.lit(None)
    reject = F.when(prior.isNotNull(), prior).when(
        F.size("violations") > 0, rejection("contract", first["code"], first["error"])
    )
    return checked.withColumn("reject", reject).drop("_columns", "_required", "_bounds", "_texts")


def _prepared(folded: DataFrame) -> DataFrame:
    """Tables with what a check asks of their columns, made once for each table: columns by name, with the limit of a `numeric`; columns
    that must have a value; sizes up to which numbers fit without a closer look; and columns that take any text."""
    precision = lambda c: F.regexp_extract(c["type"], r"\((\d+),", 1).try_cast("int")
    scale = lambda c: F.regexp_extract(c["type"], r",\s*(\d+)\)", 1).try_cast("int")
    # What is stored is rounded to the scale, so half a unit below the limit is out already.
    ten = F.lit(10.0)
    limit = lambda c: F.when(
        c["type"].startswith("numeric"), F.pow(ten, precision(c) - scale(c)) - 0.5 * F.pow(ten, -scale(c))
    )
    wanted = lambda c: F.regexp_extract(c["type"], r"\((\w+)", 1)
    listed = F.transform(
        "_columns",
        lambda c: F.struct(
            *[c[m].alias(m) for m in ("column", "type", "nullable", "pk")], limit(c).alias("limit"), wanted(c).alias("shape")
        ),
    )

    def by_name(columns: Column, value: Callable[[Column], Column]) -> Column:
        """The first column of a name counts."""
        entries = F.transform(columns, lambda c: F.struct(c["column"].alias("key"), value(c).alias("value")))
        return F.map_from_entries(F.reverse(entries))

    def bound(c: Column) -> Column:
        """Numbers next to a limit are left to the closer look."""
        whole = F.lit(None).cast("double")
        for name, (_, high) in WHOLE_NUMBERS.items():
            whole = F.when(c["type"] == name, F.lit(high)).otherwise(whole)
        return (
            F.when(c["type"].isin(*WHOLE_NUMBERS), whole)
            .when(c["type"] == "real", F.lit(3.4e38))
            .when(c["type"].startswith("numeric"), c["limit"] * (1 - 1e-9))
            .when(c["type"].isin("double precision", "text"), F.lit(1.7e308))
        )

    others = F.filter("_listed", lambda c: ~c["column"].isin(*BASE_COLUMNS) & bound(c).isNotNull())
    must = F.filter("_listed", lambda c: (~c["nullable"] | c["pk"]) & ~c["column"].isin(*BASE_COLUMNS))
    texts = F.transform(F.filter("_listed", lambda c: c["type"] == "text"), lambda c: c["column"])
    return folded.withColumn("_listed", listed).select(
        "target",
        by_name(F.col("_listed"), lambda c: c).alias("_columns"),
        must.alias("_required"),
        by_name(others, bound).alias("_bounds"),
        texts.alias("_texts"),
    )


def _fits(a: Column) -> Column:
    """Whether an attribute is a number or text that its column takes, as far as that is seen at once."""
    return F.when(
        a["kind"] == "double", F.abs(a["v_double"]) <= F.try_element_at("_bounds", a["name"])
    ).when((a["kind"] == "string") & ~a["is_null"], F.array_contains("_texts", a["name"]))


def enforce_contract(entities: DataFrame, tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows the tables take, rows they refuse with `reject`); one bad row never costs the others."""
    checked = check_contract(entities, tables)
    return accepted(checked), rejected(checked)


def violation(column: Column, code: str, error: Column) -> Column:
    """One contract violation."""
    return F.struct(column.alias("column"), F.lit(code).alias("code"), error.alias("error"))


def _missing(c: Column) -> Column:
    null_time = c["pk"] & (c["column"] == "timeinstant")
    error = F.when(null_time, F.lit("Invalid null value for required STRING field")).otherwise(
        F.concat(F.lit('ERROR: null value in column "'), c["column"], F.lit('" violates not-null constraint'))
    )
    return violation(c["column"], "NULL_VALUE", error)


def _verdict(a: Column, c: Column) -> Column:
    """Violation of one attribute against its column, NULL when they agree."""
    name, kind, column_type = a["name"], a["kind"], c["type"]
    described = (
        F.when(kind == "double", "double precision")
        .when(kind == "boolean", "boolean")
        .when(kind == "timestamp", "timestamp with time zone")
        .when(kind == "geometry", "geometry")
        .otherwise("character varying")
    )
    mismatch = violation(
        name,
        "TYPE_MISMATCH",
        F.concat(
            F.lit('ERROR: column "'), name, F.lit('" is of type '), column_type, F.lit(" but expression is of type "),
            described,
        ),
    )
    overflow = violation(
        name, "OUT_OF_RANGE", F.concat(F.lit("ERROR: value of column \""), name, F.lit('" is out of range for type '),
                                       column_type)
    )
    unknown = violation(
        name, "UNKNOWN_COLUMN", F.concat(F.lit('ERROR: column "'), name, F.lit('" of relation does not exist'))
    )
    bad_geometry = violation(name, "BAD_GEOMETRY", F.concat(F.lit('Geometry of "'), name, F.lit('" cannot be converted')))
    bad_time = violation(
        name, "BAD_TIMESTAMP", F.concat(F.lit('Field "'), name, F.lit('" is no timestamp: '), a["v_string"])
    )
    bad_json = violation(name, "BAD_JSON_VALUE", F.lit("ERROR: invalid input syntax for type json"))
    whole = F.rint(a["v_double"])
    out_of_whole = F.lit(False)
    for type_name, (low, high) in WHOLE_NUMBERS.items():
        out_of_whole = out_of_whole | ((column_type == type_name) & ~whole.between(low, high))
    out_of_numeric = F.abs(a["v_double"]) >= c["limit"]
    is_text, is_json = column_type == "text", column_type == "json"
    wants_geometry = column_type.startswith("geometry")
    wanted_kind = c["shape"]
    wrong_shape = (wanted_kind != "") & (F.lower(F.regexp_extract(a["wkt"], r"^(\w+)", 1)) != wanted_kind)
    for_double = (
        F.when(column_type.isin(*WHOLE_NUMBERS), F.when(out_of_whole, overflow))
        .when(column_type == "real", F.when(F.abs(a["v_double"]) >= REAL_MAX, overflow))
        .when(column_type.startswith("numeric"), F.when(out_of_numeric, overflow))
        .when(~column_type.isin("double precision", "text"), mismatch)
    )
    for_string = (
        F.when(is_json, F.when(F.try_parse_json(a["v_string"]).isNull(), bad_json))
        .when(
            (name == "timeinstant") & column_type.startswith("timestamp"),
            F.when(iso_timestamp(a["v_string"]).isNull(), bad_time),
        )
        .when(~is_text, mismatch)
    )
    return (
        F.when(kind == "bad_geometry", bad_geometry)
        .when(c.isNull(), unknown)
        .when(a["is_null"], F.lit(None))
        .when(kind == "boolean", F.when(~column_type.isin("boolean", "text"), mismatch))
        .when(kind == "double", for_double)
        .when(kind == "timestamp", F.when(~column_type.startswith("timestamp"), mismatch))
        .when(kind == "geometry", F.when(~wants_geometry | wrong_shape, mismatch))
        .otherwise(for_string)
    )


def to_wide(entities: DataFrame, table: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Rows in the columns of one table, plus `present` (names of the attributes the row carries) and `keep`.

    Only the attributes the table has are parsed, each once, by the expression its column type asks
    for. Entities without attributes give a row too. An attribute named like a base column takes its
    place. A value its column cannot hold becomes NULL here; `enforce_contract` is what reports it.
    """
    lowered = F.map_from_entries(
        F.transform(F.map_entries("entity"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    )
    base = {"entityid": F.col("entityid"), "entitytype": F.col("entitytype"), "fiwareservicepath": F.col("servicepath")}
    parsed = [c for c in table.columns if c.name != "recvtime"]
    staged = bind(entities, "_low", lowered)

    def side_by_side(rows: DataFrame, name: str, made: Callable[[int], Column]) -> DataFrame:
        """A struct with a member for each attribute of the table, each made once; no arrays, whose functions are interpreted."""
        return bind(rows, name, F.struct(*[made(i).alias(f"c{i}") for i in range(len(parsed))])) if parsed else rows

    def texts(i: int) -> Column:
        json = F.try_element_at("_low", F.lit(parsed[i].name))
        return F.struct(json.alias("json"), F.from_json(json, "type STRING, value VARIANT").alias("p"))

    def described(i: int) -> Column:
        a = F.col(f"_texts.c{i}")
        return F.struct(
            a["json"].alias("json"),
            F.coalesce(a["p"]["type"], F.lit("")).alias("type"),
            a["p"]["value"].alias("value"),
            F.schema_of_variant(a["p"]["value"]).alias("schema"),
        )

    def read(i: int) -> Column:
        a = F.col(f"_described.c{i}")
        # Getting a value out of a variant is dear, so it is done once for all uses, and only as what the column may take.
        name, kind = parsed[i].name, re.sub(r"\(.*", "", parsed[i].type)
        made = [_number(a).alias("number")] if name not in base and kind in _FROM_NUMBERS else []
        made += [_string(a).alias("string")] if name in base or kind in _FROM_STRINGS else []
        return F.struct(*[a[f].alias(f) for f in ("json", "type", "value", "schema")], *made)

    staged = side_by_side(side_by_side(side_by_side(staged, "_texts", texts), "_described", described), "_read", read)
    values = {}
    for i, c in enumerate(parsed):
        attr = F.col(f"_read.c{i}")
        if c.name in base:
            values[c.name] = F.coalesce(attr["string"], base[c.name])
        else:
            values[c.name] = _cast(attr, c)
    if "recvtime" in table.names:
        receipt = F.col("recvtime").try_cast("timestamp") if "recvtime" in entities.columns else F.lit(None)
        values["recvtime"] = receipt.cast(next(c for c in table.columns if c.name == "recvtime").spark_type)
    skipped = F.array(F.lit("id"), F.lit("type"), F.lit("alterationtype"))
    present = F.filter(F.map_keys("_low"), lambda n: ~F.array_contains(skipped, n))
    return staged.select(*[values[c].alias(c) for c in table.names], present.alias("present"), *[F.col(k) for k in keep])


# Column types that take numbers, and those that take texts.
_FROM_NUMBERS = (*WHOLE_NUMBERS, "real", "double precision", "numeric", "text", "json")
_FROM_STRINGS = ("text", "json", "timestamp", "timestamp_ntz", "geometry")


def _string(a: Column) -> Column:
    return F.when(a["schema"] == "STRING", F.try_variant_get(a["value"], "$", "string"))


def _number(a: Column) -> Column:
    return F.when(json_kind(a["schema"]) == "number", F.try_variant_get(a["value"], "$", "double"))


def _any_text(a: Column) -> Column:
    """Text of a value as a text column takes it: strings bare, nested values as JSON."""
    kind = json_kind(a["schema"])
    is_json = a["type"].isin("json", "jsonb")
    # Text of a number is only read where its own form is not what is wanted.
    text = F.when(kind == "string", a["string"]).when(kind != "null", F.get_json_object(a["json"], "$.value"))
    number = F.when(kind == "number", number_text(a["number"]))
    return F.when(is_json, declared_json(a["value"], kind, text)).otherwise(F.coalesce(number, text))


def _cast(a: Column, c: TableColumn) -> Column:
    number = F.when(~a["type"].isin("json", "jsonb"), a["number"])
    if c.type == "boolean":
        return F.when((a["schema"] == "BOOLEAN") & ~a["type"].isin("json", "jsonb"), F.try_variant_get(a["value"], "$", "boolean"))
    if c.type in WHOLE_NUMBERS:
        low, high = WHOLE_NUMBERS[c.type]
        whole = F.rint(number)
        return F.when(whole.between(low, high), whole).try_cast(c.spark_type)
    if c.type == "real":
        return F.when(F.abs(number) < REAL_MAX, number).cast("float")
    if c.type == "double precision":
        return number
    if c.type.startswith("numeric"):
        return number.try_cast(c.spark_type)
    if c.type == "json":
        is_text = json_kind(a["schema"]).isin("number", "boolean") & ~a["type"].isin("json", "jsonb")
        return F.when(~is_text, _any_text(a))
    if c.type == "text":
        return _any_text(a)
    if c.type.startswith("timestamp"):
        declared = F.lower(a["type"]).isin("datetime", "iso8601") if c.name != "timeinstant" else F.lit(True)
        return F.when(declared, iso_timestamp(a["string"])).cast(c.spark_type)
    if c.type.startswith("geometry"):
        text = F.coalesce(a["string"], F.get_json_object(a["json"], "$.value"))
        return geometry_struct(wkb_from_wkt(wkt_of(a["type"], json_kind(a["schema"]), text)))
    raise ValueError(f"unknown column type {c.type!r}")


def evolve(table: DataFrame, new: Contract, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a table in the columns of its new contract.

    Renamed columns keep their values (`renames`: old name to new), added ones are NULL, dropped ones
    go, and changed types are cast; numbers become text the way the text columns write them.
    """
    came_from = {new_name: old for old, new_name in (renames or {}).items()}
    existing = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    columns = []
    for c in new.columns:
        old = came_from.get(c.name, c.name)
        if old not in existing or (old in (renames or {}) and c.name not in came_from):
            value = F.lit(None).cast(c.spark_type)
        else:
            value = converted(F.col(old), existing[old], c.spark_type)
        columns.append(value.alias(c.name))
    return table.select(*columns)


def converted(value: Column, old: str, new: str) -> Column:
    """A value of one Spark type as another; what the new type cannot hold is NULL."""
    if old == new:
        return value
    if old.startswith("struct") or new.startswith("struct"):
        return F.lit(None).cast(new)
    if new == "string" and old in ("double", "float"):
        return number_text(value.cast("double"))
    return value.try_cast(new)


# ---- contracts over time ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Version:
    """One version of a table's contract; `identities` says, column by column, which stored column it is."""

    number: int
    contract: Contract
    identities: tuple[str, ...]

    def stored(self) -> dict[str, str]:
        """Name each column's values are stored under, by column: its identity and type, so that files of all versions go together."""
        return {c.name: stored_name(i, c.spark_type) for c, i in zip(self.contract.columns, self.identities, strict=True)}


def stored_name(identity: str, spark_type: str) -> str:
    """Name of stored values: of one identity and type."""
    return f"{identity}__{re.sub('[^a-z0-9]+', '_', spark_type).strip('_')}"


def next_version(history: Sequence[Version], new: Contract, renames: Mapping[str, str] | None = None) -> Version:
    """The contract as a further version of a table, or the last version if nothing has changed.

    A column keeps its identity through a rename (`renames`: old name to new) and a change of type; a name that
    was dropped or given away and comes back is another column.
    """
    if not history:
        return Version(1, new, tuple(new.names))
    last = history[-1]
    if last.contract == new:
        return last
    held = dict(zip(last.contract.names, last.identities, strict=True))
    given = {old: name for old, name in (renames or {}).items() if old in held and old not in new.names}
    came_from = {name: old for old, name in given.items()}
    used = {i for v in history for i in v.identities}
    identities = []
    for name in new.names:
        old = came_from.get(name, name)
        if old in held:
            identities.append(held[old])
            continue
        fresh, k = name, 2
        while fresh in used:
            fresh, k = f"{name}~{k}", k + 1
        used.add(fresh)
        identities.append(fresh)
    return Version(last.number + 1, new, tuple(identities))


def stored_types(history: Iterable[Version]) -> dict[str, str]:
    """Spark type of every stored column of all versions, by its name."""
    return {name: c.spark_type for v in history for name, c in zip(v.stored().values(), v.contract.columns, strict=True)}


def to_stored(rows: DataFrame, version: Version, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a table under the names they are stored by; `present` names identities then."""
    named = [F.col(c).alias(name) for c, name in version.stored().items()]
    if "present" in rows.columns:
        identity = F.create_map(*[F.lit(x) for pair in zip(version.contract.names, version.identities, strict=True) for x in pair])
        carried = F.filter(F.transform("present", lambda n: F.try_element_at(identity, n)), lambda i: i.isNotNull())
        rows = rows.withColumn("present", carried)
        named.append(F.col("present"))
    return rows.select(*named, *[F.col(k) for k in keep])


def from_stored(rows: DataFrame, history: Sequence[Version], keep: Sequence[str] = ()) -> DataFrame:
    """Stored rows of all versions in the columns of the last: each row has its value under the type it was written with."""
    last = history[-1]
    columns = []
    for c, identity in zip(last.contract.columns, last.identities, strict=True):
        # A stored name for each type the column has had, the last one first.
        types = dict.fromkeys(
            old.spark_type for v in reversed(history) for old, i in zip(v.contract.columns, v.identities, strict=True) if i == identity
        )
        held = [converted(F.col(f"`{stored_name(identity, t)}`"), t, c.spark_type) for t in types]
        columns.append(F.coalesce(*held).alias(c.name))
    if "present" in rows.columns:
        name = F.create_map(*[F.lit(x) for pair in zip(last.identities, last.contract.names, strict=True) for x in pair])
        columns.append(F.filter(F.transform("present", lambda i: F.try_element_at(name, i)), lambda n: n.isNotNull()).alias("present"))
    return rows.select(*columns, *[F.col(k) for k in keep])
