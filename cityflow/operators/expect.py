"""Expectations about tables: rows that must or must not be there, counts, reconciliation.

Expected rows are a DataFrame in which NULL means "any". A column named like a table column asks for
equality; `<column>__gte`, `__lte`, `__gt`, `__lt`, `__contains` and `__regex` ask for the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.functions.geometry import canonical_wkb

# How far equal times and equal numbers may be apart.
TIME_TOLERANCE_S = 0.001
NUMBER_TOLERANCE = 1e-6

GEOMETRY = "struct<wkb:binary,srid:int>"

OPERATORS = ("gte", "lte", "gt", "lt", "eq", "contains", "regex")


def _compare(actual: Column, expected: Column, operator: str, kind: str) -> Column:
    if operator == "gte":
        return actual >= expected
    if operator == "lte":
        return actual <= expected
    if operator == "gt":
        return actual > expected
    if operator == "lt":
        return actual < expected
    if operator == "contains":
        return F.contains(actual, expected)
    if operator == "regex":
        return F.regexp_like(actual, expected)
    return values_match(actual, expected, kind)


def values_match(actual: Column, expected: Column, kind: str) -> Column:
    """Equality with tolerances: times to the millisecond, numbers to 1e-6, JSON by value, empty as null.

    A geometry is compared with the binary form of the expected one (`canonical_wkb`).
    """
    if kind in ("timestamp", "timestamp_ntz"):
        held, wanted = actual.cast("timestamp"), expected.cast("timestamp")
        return F.abs(F.unix_micros(held) - F.unix_micros(wanted)) <= int(TIME_TOLERANCE_S * 1e6)
    if kind in ("double", "float"):
        wanted = expected.cast("double")
        margin = F.greatest(
            F.greatest(F.abs(actual.cast("double")), F.abs(wanted)) * NUMBER_TOLERANCE, F.lit(NUMBER_TOLERANCE)
        )
        return F.abs(actual - wanted) <= margin
    if kind == GEOMETRY:
        return actual["wkb"] == expected
    if kind == "string":
        same_json = F.to_json(F.try_parse_json(actual)) == F.to_json(F.try_parse_json(expected))
        both_empty = (F.coalesce(actual, F.lit("")) == "") & (expected == "")
        return F.coalesce(actual == expected, F.lit(False)) | both_empty | F.coalesce(same_json, F.lit(False))
    return actual == expected


def _numbered(expected: DataFrame) -> DataFrame:
    """Expected rows with an id that is equal for equal rows only.

    Scalars go by their text, which keeps microseconds and all digits; JSON would cut times to milliseconds.
    """
    exact = []
    for f in expected.schema.fields:
        nested = f.dataType.typeName() in ("struct", "array", "map")
        value = F.hex(f.name) if f.dataType.typeName() == "binary" else F.col(f.name).cast("string")
        exact.append((F.to_json(f.name) if nested else value).alias(f.name))
    return expected.withColumn("_id", F.to_json(F.struct(*exact)))


def _matches(table: DataFrame, expected: DataFrame, on: Sequence[str]) -> DataFrame:
    """Ids of expected rows that match some row."""
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    for name in expected.columns:
        if kinds.get(name) == GEOMETRY:
            # Packed before the join, once per expected row.
            expected = expected.withColumn(name, canonical_wkb(F.col(name)))
    checks = []
    for name in expected.columns:
        if name == "_id" or name in on:
            continue
        column, _, operator = name.rpartition("__")
        if operator not in OPERATORS or column not in kinds:
            column, operator = name, "eq"
        if column not in kinds:
            raise ValueError(f"expected column {name!r} is not in the table")
        wanted, actual = F.col(f"e.{name}"), F.col(f"t.{column}")
        met = F.coalesce(_compare(actual, wanted, operator, kinds[column]), F.lit(False))
        checks.append(wanted.isNull() | met)
    keys = [F.col(f"t.{k}") == F.col(f"e.{k}") for k in on]
    joined = table.alias("t").join(expected.alias("e"), keys, "inner")
    for check in checks:
        joined = joined.where(check)
    return joined.select("e._id").distinct()


def expect_rows(table: DataFrame, expected: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected rows that no row of the table matches.

    `on` names the columns every expected row gives, compared exactly, so that the search is an equal
    join and never a cross join. Spark broadcasts the expected rows when their size allows. The distinct
    combines before its shuffle, so a key with many rows does not pile up.
    """
    numbered = _numbered(expected)
    return numbered.join(_matches(table, numbered, on), "_id", "left_anti").drop("_id")


def expect_absent(table: DataFrame, forbidden: DataFrame, on: Sequence[str]) -> DataFrame:
    """Forbidden rows that some row of the table matches."""
    numbered = _numbered(forbidden)
    return numbered.join(_matches(table, numbered, on), "_id", "left_semi").drop("_id")


def expect_count(table: DataFrame, expected: int) -> DataFrame:
    """One row: rows, expected, ok."""
    return table.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(expected).cast("bigint").alias("expected"), (F.col("rows") == expected).alias("ok")
    )


def document_fields(documents: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Fields of documents as columns (name to JSON path), to be checked with `expect_rows`."""
    return documents.select(
        "database", "collection", *[F.get_json_object("document", path).alias(name) for name, path in paths.items()]
    )


def backlog_complete(table: DataFrame, marker: str) -> bool:
    """Whether the marker entity has arrived."""
    return not table.where(F.col("entityid") == marker).limit(1).isEmpty()


def reconcile(entities: DataFrame, written: DataFrame, rejects: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Rows per group going in, written and refused, and whether in = written + refused."""
    count = F.count(F.lit(1))
    keys = list(by)
    going_in = entities.groupBy(*keys).agg(count.alias("entities"))
    out = written.groupBy(*keys).agg(count.alias("written"))
    refused = rejects.groupBy(*keys).agg(count.alias("rejected"))
    joined = going_in.join(out, keys, "full_outer").join(refused, keys, "full_outer")
    filled = joined.select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("entities", "written", "rejected")])
    return filled.withColumn("balanced", F.col("entities") == F.col("written") + F.col("rejected"))


def reconcile_flagged(flagged: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """The same of rows that say by `reject` whether they were refused: they are made once, and counted as they are made."""
    counted = flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("reject").isNull()).alias("written"),
        F.count_if(F.col("reject").isNotNull()).alias("rejected"),
    )
    return counted.withColumn("balanced", F.col("entities") == F.col("written") + F.col("rejected"))
