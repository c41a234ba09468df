"""Evaluate a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression is evaluated exactly once per row.

    A plain `withColumn` lets the optimizer copy the expression into filters that are pushed below it
    and into every later use, so that a JSON parse runs many times. The output of a generator is
    never copied, and a generator over a one-element array keeps every row. The array is made in a projection of its own:
    a generator interprets its argument node by node where any function in it has no generated code, a projection only
    that function.
    """
    others = [F.col(c) for c in rows.columns if c != name]
    made = rows.select(*others, F.array(value).alias(name))
    return made.select(*others, F.explode_outer(name).alias(name))
