"""Text expressions: names, truncation, number text, JSON quoting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitise_name(name: Column) -> Column:
    """Identifier form of a name: one leading and one trailing slash off, lower case, the rest `_`."""
    bare = F.regexp_replace(F.regexp_replace(name, r"^\s+|\s+$", ""), r"^/|/$", "")
    written = F.coalesce(F.regexp_replace(F.lower(bare), "[^a-zA-Z0-9_]", "_"), F.lit(""))
    # Most names need one look only.
    usual = F.when(name == "/", F.lit("")).when(name.rlike(r"\A/?[a-zA-Z0-9_]+\z"), F.lower(F.ltrim(name, F.lit("/"))))
    return F.coalesce(usual, written)


def strip(text: Column) -> Column:
    """Text without white space at both ends (line breaks included)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def truncate_with_note(text: Column, limit: int) -> Column:
    """At most `limit` characters, with a note of how many were cut."""
    note = F.concat(F.lit("... [truncated "), (F.length(text) - limit).cast("string"), F.lit(" chars]"))
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), note)).otherwise(text)


def json_quote(text: Column) -> Column:
    """A string as JSON text, quoted and escaped."""
    wrapped = F.to_json(F.array(text))
    # Most texts have nothing to escape, and are spared a writer of JSON.
    plain = text.rlike(r"\A[ !#-\[\]-~]*\z")
    return F.when(plain, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.substring(wrapped, F.lit(2), F.length(wrapped) - 2))


def number_text(value: Column) -> Column:
    """Shortest decimal text of a double as JSON writers print it: `25`, `0.00001`, `1e+21`."""
    plain = value.cast("string")
    magnitude = F.abs(value)
    # Few numbers are written with an exponent; as a function of an array the long way stays out of the generated code of the others,
    # which is compiled only as long as it is small.
    rare = F.get(F.transform(F.array(value), _with_exponent), 0)
    return (
        F.when(value.isNull() | F.isnan(value) | (magnitude == float("inf")), F.lit(None).cast("string"))
        .when((magnitude < 1e15) & (value == F.rint(value)), value.try_cast("bigint").cast("string"))
        .when(~plain.contains("E"), plain)
        .otherwise(rare)
    )


def _with_exponent(value: Column) -> Column:
    """`number_text` of a double that Spark writes with an exponent."""
    plain = value.cast("string")
    exponent = F.substring_index(plain, "E", -1).try_cast("int")
    mantissa = F.substring_index(plain, "E", 1)
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.translate(mantissa, "-.", ""), "0+$", "")
    fraction = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    long_number = F.concat(
        sign,
        F.when(
            F.length(digits) > exponent + 1,
            F.concat(
                F.substring(digits, F.lit(1), exponent + 1),
                F.lit("."),
                F.substring(digits, exponent + 2, F.length(digits)),
            ),
        ).otherwise(F.rpad(digits, exponent + 1, "0")),
    )
    scientific = F.concat(
        sign,
        F.substring(digits, 1, 1),
        F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), F.length(digits)))).otherwise(
            F.lit("")
        ),
        F.when(exponent > 0, F.lit("e+")).otherwise(F.lit("e")),
        exponent.cast("string"),
    )
    return (
        F.when((exponent < 0) & (exponent >= -6), fraction)
        .when((exponent >= 0) & (exponent < 21), long_number)
        .otherwise(scientific)
    )
