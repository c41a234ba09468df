import json

import pytest
from conftest import HEADERS, raw_rows
from pyspark.sql import functions as F

from cityflow.functions.text import number_text, truncate_with_note
from cityflow.functions.times import iso_timestamp
from cityflow.operators.contract import catalogue, contract, to_wide
from cityflow.operators.decode import explode_flagged, infer_types, parse, parse_flagged, with_attributes
from cityflow.operators.envelope import to_envelope, to_headers, to_key
from cityflow.operators.decode import with_recvtime
from cityflow.plans.flows import documents_of, entities_of, flagged_entities, read_context

ENTITY = {
    "id": "a",
    "type": "T",
    "TimeInstant": {"type": "DateTime", "value": "2031-02-27T12:00:02.123Z"},
    "text": {"type": "Text", "value": "plain"},
    "number": {"type": "Number", "value": 5},
    "floatText": {"type": "Float", "value": "3.14"},
    "flag": {"value": True},
    "nothing": {"value": None},
    "empty": {"type": "x"},
    "bare": 5,
    "gone": None,
    "obj": {"value": {"z": 1, "a": [1, 2.5]}, "metadata": {"u": {"value": 1}}},
    "list": {"type": "MultiRelation", "value": ["A:1", "B:2"]},
    "asJson": {"type": "json", "value": "quoted"},
    "when": {"type": "iso8601", "value": "2031-02-27T12:01Z"},
    "never": {"type": "DateTime", "value": "not-a-date"},
    "spot": {"type": "geo:point", "value": "41.5, 2"},
    "area": {"type": "geo:polygon", "value": ["41.0,2.0", "41.5,2.5", "41.0,3.0", "41.0,2.0"]},
    "line": {"type": "geo:json", "value": {"type": "LineString", "coordinates": [[1, 2], [3.25, 4e-05]]}},
    "odd": {"type": "geo:json", "value": {"type": "Circle", "coordinates": [1, 2]}},
    "Case": {"value": 1},
    "cASE": {"value": 2},
}


@pytest.fixture(scope="module")
def typed(spark):
    rows = infer_types(entities_of(raw_rows(spark, [{"data": [ENTITY]}], headers=HEADERS))).collect()
    return {r.attr_name: r for r in rows}


def test_kinds(typed):
    kinds = {name: r.kind for name, r in typed.items()}
    assert kinds == {
        "timeinstant": "string", "text": "string", "number": "double", "floattext": "string", "flag": "boolean",
        "nothing": "string", "empty": "string", "bare": "string", "gone": "string", "obj": "string", "list": "string",
        "asjson": "string", "when": "timestamp", "never": "string", "spot": "geometry", "area": "geometry",
        "line": "geometry", "odd": "bad_geometry", "case": "double",
    }


def test_values(typed):
    assert typed["timeinstant"].v_string == "2031-02-27T12:00:02.123Z"
    assert typed["number"].v_double == 5.0
    assert typed["floattext"].v_string == "3.14"
    assert typed["obj"].v_string == '{"z":1,"a":[1,2.5]}'
    assert typed["list"].v_string == '["A:1","B:2"]'
    assert typed["asjson"].v_string == '"quoted"'
    assert typed["never"].v_string == "not-a-date" and typed["never"].date_error
    assert typed["spot"].wkt == "POINT (2 41.5)"
    assert typed["area"].wkt == "POLYGON ((2 41, 2.5 41.5, 3 41, 2 41))"
    assert typed["line"].wkt == "LINESTRING (1 2, 3.25 0.00004)"
    for name in ("nothing", "empty", "bare", "gone"):
        assert typed[name].is_null and typed[name].v_string is None


def test_last_of_case_variants_wins_in_the_place_of_the_first(typed):
    assert typed["case"].v_double == 2.0
    assert typed["case"].attr_pos == 18


def test_rejects(spark):
    values = ["{bad", "null", "", {"data": []}, {}, {"data": [None, {"type": "x"}, {"id": "z"}]}]
    rows = explode_flagged(parse_flagged(read_context(raw_rows(spark, values)))).collect()
    codes = [(r.offset, r.reject.code if r.reject else None) for r in rows]
    assert codes == [
        (1, "BAD_JSON"), (2, "BAD_JSON"), (3, "BAD_JSON"), (4, "NO_ENTITIES"), (5, "NO_ENTITIES"),
        (6, "NULL_ENTITY"), (6, "NO_ENTITY_ID"), (6, None),
    ]
    good, bad = parse(read_context(raw_rows(spark, values)))
    assert (good.count(), bad.count()) == (3, 3)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2031-02-27", "2031-02-27 00:00:00.000"),
        ("2031-02-27T12:00:01", "2031-02-27 12:00:01.000"),
        ("2031-02-27T12:00:02.123Z", "2031-02-27 12:00:02.123"),
        ("2031-02-27T12:00:03.123+02:00", "2031-02-27 10:00:03.123"),
        ("2031-02-27T12:00:04+02", "2031-02-27 10:00:04.000"),
        ("2031-02-27T12:00:05+0200", "2031-02-27 10:00:05.000"),
        ("2031-02-27T12:01Z", "2031-02-27 12:01:00.000"),
        ("2031-02-27T12:02", "2031-02-27 12:02:00.000"),
        ("2031-02-27T13", "2031-02-27 13:00:00.000"),
        ("2031-02-27T13Z", "2031-02-27 13:00:00.000"),
        ("20310227T131415Z", "2031-02-27 13:14:15.000"),
        ("2031-02-27T12:00:02,1239", "2031-02-27 12:00:02.123"),
        ("2031-13-27", None),
        ("27/02/2031", None),
        (" 2031-02-27", None),
        ("word", None),
    ],
)
def test_iso_forms(spark, text, expected):
    shown = F.date_format(iso_timestamp(F.lit(text)), "yyyy-MM-dd HH:mm:ss.SSS")
    assert spark.range(1).select(shown).first()[0] == expected


def test_number_text(spark):
    numbers = [25.0, -0.0, 0.1, 1e-6, 1e-7, 1.5e-5, 12345678.5, 1e20, 1e21, 9223372036854775808.0, -2.5e-9]
    rows = spark.createDataFrame([(n,) for n in numbers], "n double").select(number_text(F.col("n"))).collect()
    assert [r[0] for r in rows] == [
        "25", "0", "0.1", "0.000001", "1e-7", "0.000015", "12345678.5", "100000000000000000000", "1e+21",
        "9223372036854776000", "-2.5e-9",
    ]


def test_truncation(spark):
    row = spark.range(1).select(truncate_with_note(F.lit("x" * 12), 10), truncate_with_note(F.lit("short"), 10)).first()
    assert row[0] == "x" * 10 + "... [truncated 2 chars]" and row[1] == "short"


def test_context_sources(spark):
    top = {"fiware-service": "Top", "fiware-servicepath": "noslash"}
    rows = raw_rows(spark, [top, {"headers": {"fiware-service": "Inner"}, **top}, {}]).unionByName(
        raw_rows(spark, [top], headers=[("Fiware-Service", b"Head"), ("fiware-datamodel", b"")])
    )
    got = [(r.service, r.servicepath, r.datamodel) for r in read_context(rows).collect()]
    assert got == [("top", "/noslash", None), ("inner", "/", None), ("default", "/", None), ("head", "/", None)]


def test_envelope_key_and_headers(spark):
    body = {"data": [{"id": "Dev:1", "type": "Dev", "t": {"value": 1.5}, "p": ENTITY["spot"], "n": {"value": None}}]}
    entities = with_recvtime(with_attributes(entities_of(raw_rows(spark, [body], headers=HEADERS))), F.lit("2024-01-01").cast("timestamp"))
    row = to_headers(to_key(to_envelope(entities), with_time=True), "lastdata").first()
    message = json.loads(row.message)
    assert [f["field"] for f in message["schema"]["fields"]] == [
        "entityid", "entitytype", "fiwareservicepath", "t", "p", "n", "recvtime",
    ]
    assert message["payload"]["t"] == 1.5 and message["payload"]["n"] is None
    assert message["payload"]["p"] == {"wkb": "AQEAAAAAAAAAAAAAQAAAAAAAwERA", "srid": 4326}
    assert message["schema"]["fields"][5] == {"field": "n", "type": "string", "optional": True}
    key = json.loads(row.message_key)
    assert key["payload"] == {"entityid": "Dev:1"} and len(key["schema"]["fields"]) == 2
    headers = {h.key: bytes(h.value).decode() for h in row.message_headers}
    assert headers == {
        "fiware-service": "test", "fiware-servicepath": "date", "fiware-datamodel": "", "entityType": "dev",
        "entityId": "dev_1", "suffix": "_lastdata",
    }


def test_documents_keep_case_order_and_metadata(spark):
    body = {
        "data": [{"id": "E", "type": "Kind", "B": {"value": 1, "metadata": {"m": {"value": 2}}}, "a": {"value": 'x"y\n'},
                  "none": {"metadata": {}}, "alterationType": {"value": "entityUpdate"}}]
    }
    row = documents_of(raw_rows(spark, [body], headers=HEADERS), "sth_", F.lit("2024-01-01").cast("timestamp")).first()
    assert json.loads(row.document) == {
        "recvTime": "2024-01-01T00:00:00.000Z", "entityId": "E", "entityType": "Kind", "B": 1,
        "B_md": {"m": {"value": 2}}, "a": 'x"y\n', "alterationType": "entityUpdate",
    }
    assert list(json.loads(row.document))[3:6] == ["B", "B_md", "a"]
    assert (row.database, row.collection) == ("sth_test", "sth_test_date_Kind")


def test_contract_rules(spark):
    table = contract(
        "test.date_t",
        {"flag": "boolean", "text": "text", "need": "text", "int": "integer", "big": "bigint", "doc": "json", "spot": "geometry(point)"},
        ["entityid", "timeinstant"],
        ["need"],
    )
    time = {"type": "DateTime", "value": "2025-05-05T11:35:00Z"}
    base = {"id": "e", "type": "T", "TimeInstant": time, "need": {"value": "x"}}
    cases = [
        ({**base, "flag": {"value": True}, "int": {"value": 2147483647}}, None),
        ({**base, "flag": {"value": 1}}, "TYPE_MISMATCH"),
        ({k: v for k, v in base.items() if k != "need"}, "NULL_VALUE"),
        ({**base, "int": {"value": "1"}}, "TYPE_MISMATCH"),
        ({**base, "int": {"value": 2147483648}}, "OUT_OF_RANGE"),
        ({**base, "big": {"value": 9223372036854775808}}, "OUT_OF_RANGE"),
        ({**base, "big": {"value": 9223372030000000000}}, None),
        ({**base, "doc": {"value": "no json"}}, "BAD_JSON_VALUE"),
        ({**base, "doc": {"value": {"a": 1}}}, None),
        ({**base, "extra": {"value": 1}}, "UNKNOWN_COLUMN"),
        ({**base, "spot": {"type": "geo:point", "value": "1,2"}}, None),
        ({**base, "spot": {"type": "geo:polygon", "value": ["1,2", "1,2"]}}, "TYPE_MISMATCH"),
        ({**base, "spot": {"type": "geo:json", "value": {"type": "?"}}}, "BAD_GEOMETRY"),
        ({k: v for k, v in base.items() if k != "TimeInstant"}, "NULL_VALUE"),
        ({**base, "TimeInstant": {"value": "soon"}}, "BAD_TIMESTAMP"),
        ({**base, "type": "Other"}, "TABLE_MISSING"),
    ]
    raw = raw_rows(spark, [{"data": [entity]} for entity, _ in cases], headers=HEADERS)
    rows = flagged_entities(raw, catalogue(spark, [table]), "historic").orderBy("offset").collect()
    assert [r.reject.code if r.reject else None for r in rows] == [code for _, code in cases]
    assert rows[1].reject.error == 'ERROR: column "flag" is of type boolean but expression is of type double precision'
    assert rows[13].reject.error == "Invalid null value for required STRING field"


def test_wide_agrees_with_the_typed_attributes(spark):
    kinds = {
        "text": "text", "number": "double precision", "floattext": "text", "flag": "boolean", "nothing": "text",
        "obj": "json", "list": "json", "asjson": "json", "when": "timestamp", "never": "text", "spot": "geometry",
        "line": "geometry", "case": "integer",
    }
    table = contract("x.y", kinds)
    entities = entities_of(raw_rows(spark, [{"data": [ENTITY]}], headers=HEADERS))
    wide = to_wide(entities, table).first()
    long = {r.attr_name: r for r in infer_types(entities).collect()}
    for name in ("text", "floattext", "nothing", "obj", "list", "asjson", "never"):
        assert wide[name] == long[name].v_string, name
    assert (wide.number, wide.flag, wide.when, wide.case) == (5.0, True, long["when"].v_ts, 2)
    assert bytes(wide.spot.wkb).hex() == "010100000000000000000000400000000000c04440" and wide.spot.srid == 4326
    assert wide.line.wkb is not None
    assert wide.entityid == "a" and wide.fiwareservicepath == "/date"
    assert set(wide.present) == set(long)
