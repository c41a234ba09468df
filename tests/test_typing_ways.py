import json

from pyspark.sql import functions as F

from cityflow.operators import decode

VALUES = [None, True, 1, 1.5, 25.0, 1e30, -0.0, 12345678901234567890123, "", "text", "2024-02-30T00:00:00Z", "2024-05-01T10:11:12.345Z",
          "2024-05-01T24:00:00Z", "2024-W05-3", "2024-123", "2024", 2024, {"a": 25.0, "b": [1, None]}, [1, "x"], "1,2", [[1, 2], [3, 4]]]
TYPES = [None, "", "Number", "Text", "DateTime", "ISO8601", "datetime", "json", "jsonb", "JSON", "geo:point", "geo:polygon", "geo:json", "GEO:x", 5]


def test_direct_way_agrees_with_the_steps(spark):
    bodies = [json.dumps({"type": t, "value": v, "metadata": {"m": 1}}) for t in TYPES for v in VALUES]
    bodies += ["plain", "5", "true", "[]", "{}", "{\"value\": 1}", "{\"type\": \"Text\"}", "", None]
    names = ["n", "timeinstant", "recvtime"]
    rows = spark.createDataFrame([(n, b) for n in names for b in bodies], "key string, value string").repartition(4)
    entry = F.array(F.struct("key", "value"))
    read = F.transform(
        F.transform(entry, lambda e: F.struct(e["key"].alias("name"), e["value"].alias("json"),
                                              F.from_json(e["value"], "type STRING, value VARIANT, metadata STRING").alias("p"))),
        lambda a, i: F.struct(
            a["name"].alias("name"), i.alias("pos"), F.coalesce(a["p"]["type"], F.lit("")).alias("type"),
            a["p"]["metadata"].alias("metadata"), a["p"]["value"].alias("value"), a["json"].alias("json"),
            decode.json_kind(F.schema_of_variant(a["p"]["value"])).alias("json_kind"),
        ),
    )
    both = rows.select("key", "value", decode._typed(entry).alias("new"), decode._by_steps(read).alias("old")).collect()
    assert len(both) == len(names) * len(bodies)
    assert [(r.key, r.value, r.new, r.old) for r in both if repr(r.new) != repr(r.old)] == []
