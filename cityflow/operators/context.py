"""Record headers and tenant context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = ("service", "servicepath", "datamodel", "correlator", "graphname")

# Header names of the context fields.
HEADER_OF = {
    "service": "fiware-service",
    "servicepath": "fiware-servicepath",
    "datamodel": "fiware-datamodel",
    "correlator": "fiware-correlator",
    "graphname": "graphname",
}


def with_headers(records: DataFrame, keep_case: bool = False) -> DataFrame:
    """Add `hdr`, the headers as a map of texts; keys in lower case unless kept, the last of equals wins."""

    def entry(h: Column) -> Column:
        key = h["key"] if keep_case else F.lower(h["key"])
        return F.struct(key.alias("key"), F.decode(h["value"], "utf-8").alias("value"))

    listed = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    return records.withColumn("hdr", F.map_from_entries(F.transform(listed, entry)))


def with_context(records: DataFrame) -> DataFrame:
    """Add service, servicepath, datamodel, correlator and graphname.

    They come from the record headers when there are any, else from `headers` in the message body,
    else from its top level.
    """
    if "hdr" not in records.columns:
        records = with_headers(records)
    in_body = F.from_json("value", "headers MAP<STRING,STRING>")["headers"]
    at_top = F.from_json(
        "value", ", ".join(f"`{name}` STRING" for name in HEADER_OF.values())
    )
    no_headers = F.size("hdr") == 0
    staged = records.withColumn("_body", F.when(no_headers, in_body)).withColumn(
        "_top", F.when(no_headers & F.col("_body").isNull(), at_top)
    )

    def field(name: str) -> Column:
        header = HEADER_OF[name]
        return F.coalesce(
            F.try_element_at("hdr", F.lit(header)),
            F.try_element_at("_body", F.lit(header)),
            F.col("_top").getField(header),
        )

    path = F.lower(F.coalesce(F.nullif(field("servicepath"), F.lit("")), F.lit("/")))
    return staged.withColumns(
        {
            "service": F.lower(F.coalesce(F.nullif(field("service"), F.lit("")), F.lit("default"))),
            "servicepath": F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)),
            "datamodel": F.nullif(field("datamodel"), F.lit("")),
            "correlator": F.nullif(field("correlator"), F.lit("")),
            "graphname": field("graphname"),
        }
    ).drop("_body", "_top")
