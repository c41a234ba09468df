"""Envelopes without Python: no row waits on disk, and geometries and texts are written as before."""

import json
import random
import struct

import pytest
from conftest import HEADERS, raw_rows
from pyspark.sql import functions as F

from cityflow.functions.geometry import wkb_by_steps, wkt_to_wkb
from cityflow.functions.text import json_quote
from cityflow.operators.decode import with_attributes, with_recvtime
from cityflow.operators.envelope import to_envelope
from cityflow.plans.flows import entities_of
from cityflow.plans.queries import registry


def test_no_row_waits_for_python(spark):
    rows = registry()["envelope_publish"](spark, "/root/testdata/sf0.001")
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def _numbers(r, n):
    for _ in range(n):
        x = r.choice(
            [
                struct.unpack("<d", struct.pack("<Q", r.getrandbits(64)))[0],
                r.choice([1, -1]) * 2.0 ** r.randint(-1074, 1023),
                r.choice([0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 1 - 2**-53]),
                round(r.uniform(-180, 180), r.randint(0, 9)),
            ]
        )
        yield repr(x) if x == x and abs(x) != float("inf") else "12"


def _texts():
    r = random.Random(5)
    listed = lambda part: " (" + ", ".join(part() for _ in range(r.randint(1, 3))) + ") "
    for _ in range(400):
        width = r.choice([2, 3])
        position = lambda: " ".join(_numbers(r, width))  # noqa: E731, B023
        line = lambda: listed(position)  # noqa: E731, B023
        rings = lambda: listed(line)  # noqa: E731, B023
        bodies = {
            "POINT": lambda: f"({position()})",  # noqa: B023
            "LineString": line,
            "POLYGON": rings,
            "MULTIPOINT": lambda: listed(lambda: r.choice(["{}", "({})"]).format(position())),  # noqa: B023
            "MULTILINESTRING": rings,
            "MULTIPOLYGON": lambda: listed(rings),  # noqa: B023
        }
        kind = r.choice(list(bodies))
        text = f"{kind}{' Z' if width == 3 else ''} {bodies[kind]()}"
        place = r.randrange(len(text))
        yield from (text, text[:place] + r.choice("(), p1Z-") + text[place + 1 :])
    yield from ("POINT (p)", "LINESTRING (l)", "MULTIPOINT (1 2),(3 4)", "POINTZ (1 2 3)", "POINT (01 2)", "POINT (1d 2)", "POINT (1e400 -1e400)")
    yield from ("LINESTRING (1 2 3, 4 5 6)", "POINT ((1 2))", "POINT EMPTY", "CIRCLE (1 2)", "", None)


def test_binary_form_agrees_with_the_whole_columns_way(spark):
    texts = list(_texts())
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", wkb_by_steps(F.col("t")).alias("wkb"))
    made = {r.i: None if r.wkb is None else bytes(r.wkb) for r in rows.collect()}
    assert [t for i, t in enumerate(texts) if made[i] != wkt_to_wkb(t)] == []
    assert sum(w is not None for w in made.values()) > 400


@pytest.mark.parametrize("text", ["", "plain ~", 'a "quote"', "back\\slash", "line\n", "\ttab", "snow ☃", "\x7f", "a/b", "😀", None])
def test_quoting_of_any_text(spark, text):
    made = spark.createDataFrame([(text,)], "t string").select(json_quote(F.col("t")), F.to_json(F.array("t"))).first()
    assert made[0] == made[1][1:-1]
    assert json.loads(made[0]) == text


def test_attribute_named_like_a_base_column_takes_its_place(spark):
    body = {"data": [{"id": "e", "type": "T", "EntityType": {"type": "Text", "value": "a\"b"}, "at": {"type": "geo:point", "value": "2,1"}}]}
    entities = with_recvtime(with_attributes(entities_of(raw_rows(spark, [body], headers=HEADERS))), F.lit("2024-01-01").cast("timestamp"))
    message = json.loads(to_envelope(entities).first().message)
    assert [f["field"] for f in message["schema"]["fields"]] == ["entityid", "entitytype", "fiwareservicepath", "at", "recvtime"]
    assert message["payload"]["entitytype"] == 'a"b' and list(message["payload"]) == ["entityid", "entitytype", "fiwareservicepath", "at", "recvtime"]
    assert message["payload"]["at"] == {"wkb": "AQEAAAAAAAAAAADwPwAAAAAAAABA", "srid": 4326}
