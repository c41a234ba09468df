"""Arrow functions for graph mutations: nested values as mutation text, and slugs."""

from __future__ import annotations

import json
import math
import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MARKS = re.compile("[\u0300-\u036f]")
_GAPS = re.compile("[^a-z0-9]+")


def slug_of(text: str) -> str:
    """Lower-case ASCII words joined by hyphens."""
    plain = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return _GAPS.sub("-", plain.lower()).strip("-")


def slug_last_part(uri: str) -> str:
    """A URI whose part after the last slash is a slug."""
    base, slash, last = uri.rpartition("/")
    return base + slash + slug_of(last)


def number_of(value: int | float) -> str:
    """Shortest number text, all numbers being doubles."""
    value = float(value)
    if math.isinf(value):
        return "Infinity" if value > 0 else "-Infinity"
    if value == int(value) and abs(value) < 2**53:
        return str(int(value))
    mantissa, _, exponent = repr(value).partition("e")
    if not exponent:
        return mantissa
    power, sign = int(exponent), "-" if value < 0 else ""
    digits = mantissa.lstrip("-").replace(".", "")
    if 0 < power < 21:
        return sign + digits.ljust(power + 1, "0")
    if -7 < power < 0:
        return f"{sign}0.{'0' * (-power - 1)}{digits}"
    return f"{mantissa}e{power:+d}"


def mutation_value(value, slug_uri: bool) -> str:
    """A JSON value in the argument syntax of a mutation: bare keys, escaped strings."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return number_of(value)
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
        return f'"{escaped}"'
    if isinstance(value, list):
        return "[" + ", ".join(mutation_value(v, slug_uri) for v in value) + "]"
    if slug_uri and isinstance(value.get("uri"), str):
        return f'{{ uri: "{slug_last_part(value["uri"])}" }}'
    return "{ " + ", ".join(f"{k}: {mutation_value(v, slug_uri)}" for k, v in value.items()) + " }"


@F.pandas_udf(T.StringType())
def slug(text: pd.Series) -> pd.Series:
    """Slug of a text column."""
    return text.map(slug_of, na_action="ignore")


def nested_values(slug_uri: bool):
    """Arrow function: lists of JSON texts of nested values, null where a member is flat, as lists of argument texts."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def render(texts: pa.Array) -> pa.Array:
        flat = texts.flatten()
        held = pc.is_valid(flat)
        written = [mutation_value(json.loads(t), slug_uri) for t in flat.filter(held).to_pylist()]
        # Back to the places the nested values had.
        places = pa.array(np.cumsum(held.to_numpy(zero_copy_only=False)) - 1, mask=~held.to_numpy(zero_copy_only=False))
        rendered = pa.array(written, pa.string()).take(places)
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int32)
        borders = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        made = pa.ListArray.from_arrays(borders, rendered)
        return pc.if_else(pc.is_valid(texts), made, pa.nulls(len(texts), made.type))

    return render
