"""Attributes written the usual way, and numbers that fit: the short ways give what the long ones give, and cost less."""

import json

import pytest
from conftest import HEADERS, raw_rows
from pyspark.sql import functions as F

from cityflow.operators import decode
from cityflow.operators.contract import catalogue, check_contract, contract
from cityflow.plans.flows import flagged_entities
from cityflow.plans.queries import registry

NUMBERS = ["1", "-1", "25.0", "1.50", "-0", "-0.0", "0", "0.0", "0e5", "-0e5", "1e5", "1E-7", "-2.5e+30", "1e400", "-1e400", "5e-324", "1e-400", "01", "1.", ".5",
           "+1", "12345678901234567890123", "12345678901234567890.12345", "0.1000000000000000055511151231257827", "123456789012345678901234567890123456789012.5",
           "9223372036854775808", "2.2250738585072011e-308", "NaN", "Infinity", "null", "true", '"5"', "[1]", "{}", "1,\"value\":2", "1,\"type\":\"Text\"", ""]
TEXTS = ['""', '"a"', '"null"', '"5"', '"a\\"b"', '"\\u00e9"', '"é☃😀"', '"line\\n"', '"line\n"', '"2024-05-01T10:11:12.345Z"', '"2024-W05-3"', '"a","value":"b"', '"a"}{"', "5", "null"]
ENDS = ["}", ',"metadata":{}}', ',"metadata":{"m":1}}', ',"metadata":null}', "} ", "}}", ""]


def test_usual_forms_agree_with_the_steps(spark):
    bodies = [f'{{"type":"{t}","value":{v}{end}' for t in ("Number", "Text", "DateTime", "Boolean") for v in (*NUMBERS, *TEXTS) for end in ENDS]
    bodies += ['{"value":5,"type":"Number"}', '{"type": "Number","value":5}', '{"type":"Number","value":5,"x":1}', ' {"type":"Number","value":5}']
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


def test_usual_attributes_are_told_by_one_pattern(spark):
    rows = spark.createDataFrame([('{"type":"Number","value":5}',), ('{"type":"Text","value":"a"}',)], "value string")
    read = rows.select(
        F.regexp_extract("value", decode._USUAL_NUMBER, 1).alias("n"), F.regexp_extract("value", decode._USUAL_TEXT, 1).alias("t")
    )
    assert [tuple(r) for r in read.collect()] == [("5", ""), ("", "a")]


TYPES = ["smallint", "integer", "bigint", "real", "numeric(3,1)", "numeric(5,0)", "numeric(2,2)", "double precision", "text", "boolean", "json"]
LIMITS = [0, 1, -1.5, 32767, 32767.4, 32767.5, 32768, -32768, -32768.5, -32768.6, 99.94, 99.95, 99.96, -99.95, 0.99, 0.995, 99999.4, 99999.5, 2147483647,
          2147483647.5, -2147483648.5, -2147483649, 9223372036854774784, 9223372036854775808, 3.4e38, 3.4028235e38, 3.4028235677973366e38, -3.5e38, 1e300, "x", True, None]


def _wanted(kind, value):
    """Code of the violation of one value, by the rules of the columns."""
    if value is None:
        return None
    if isinstance(value, bool):
        return None if kind in ("boolean", "text") else "TYPE_MISMATCH"
    if isinstance(value, str):
        return {"text": None, "json": "BAD_JSON_VALUE"}.get(kind, "TYPE_MISMATCH")
    if kind in ("boolean", "json"):
        return "TYPE_MISMATCH"
    whole = {"smallint": 2**15, "integer": 2**31, "bigint": 2**63}
    if kind in whole:
        return None if -whole[kind] <= round(float(value)) < whole[kind] else "OUT_OF_RANGE"
    if kind == "real":
        return None if abs(value) < 3.4028235677973366e38 else "OUT_OF_RANGE"
    if kind.startswith("numeric"):
        p, s = map(int, kind[8:-1].split(","))
        return None if abs(value) < 10.0 ** (p - s) - 0.5 * 10.0**-s else "OUT_OF_RANGE"
    return None


def test_every_value_against_every_type(spark):
    table = contract("test.date_t", {f"c{i}": kind for i, kind in enumerate(TYPES)}, with_time=False)
    bodies = [
        {"data": [{"id": f"e{k}", "type": "T", **{f"c{i}": {"type": "Number", "value": v} for i in range(len(TYPES))}}]} for k, v in enumerate(LIMITS)
    ]
    raw = raw_rows(spark, [json.dumps(b) for b in bodies], headers=HEADERS)
    rows = flagged_entities(raw, catalogue(spark, [table]), "historic").select("entityid", "violations").collect()
    found = {(r.entityid, v.column): v.code for r in rows for v in r.violations}
    wanted = {(f"e{k}", f"c{i}"): _wanted(kind, v) for k, v in enumerate(LIMITS) for i, kind in enumerate(TYPES)}
    assert found == {key: code for key, code in wanted.items() if code}


def test_required_columns_and_base_columns(spark):
    table = contract("test.date_t", {"a": "integer", "b": "text"}, ["entityid", "timeinstant"], ["b"])
    attribute = lambda v: {"type": "Text", "value": v}
    bodies = [
        {"data": [{"id": "e1", "type": "T", "B": attribute("x"), "TimeInstant": attribute("2024-01-01T00:00:00Z")}]},
        {"data": [{"id": "e2", "type": "T", "b": attribute(None), "entityType": {"type": "Number", "value": 5}, "recvTime": attribute("no time")}]},
        {"data": [{"id": "e3", "type": "T", "b": attribute("x"), "TimeInstant": attribute("no time"), "c": {"type": "Number", "value": 5}}]},
    ]
    rows = flagged_entities(raw_rows(spark, bodies, headers=HEADERS), catalogue(spark, [table]), "historic")
    found = {r.entityid: [(v.column, v.code) for v in r.violations] for r in rows.select("entityid", "violations").collect()}
    assert found == {
        "e1": [],
        "e2": [("timeinstant", "NULL_VALUE"), ("b", "NULL_VALUE")],
        "e3": [("timeinstant", "BAD_TIMESTAMP"), ("c", "UNKNOWN_COLUMN")],
    }


def test_limits_are_read_once_for_a_table(spark):
    """The types of columns are taken apart with the tables, not with every attribute of every row."""
    rows = registry()["numeric_limits"](spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above = [line for line in plan.split("Join LeftOuter")[0].splitlines() if "violations" in line]
    assert above and not any(r"\((\d+)," in line for line in above)


@pytest.mark.parametrize("listed", [True, False])
def test_tables_in_either_form(spark, listed):
    tables = catalogue(spark, [contract("t", {"n": "numeric(3,1)"}, with_time=False)])
    if not listed:
        tables = tables.select("target", F.explode("columns").alias("c")).select("target", "c.*")
    entities = spark.createDataFrame(
        [("t", {"n": '{"type":"Number","value":99.96}'}), ("u", {"n": '{"type":"Number","value":1}'})], "target string, entity map<string,string>"
    )
    rows = check_contract(entities, tables).select("target", "reject.code").collect()
    assert sorted(tuple(r) for r in rows) == [("t", "OUT_OF_RANGE"), ("u", "TABLE_MISSING")]
