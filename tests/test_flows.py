import json
import random
import tempfile

import pytest
from conftest import HEADERS, raw_rows
from pyspark.sql import functions as F

from cityflow.config import DM_TYPE_SCHEMA, FlowConfig, GraphConfig
from cityflow.functions.geometry import wkb_from_wkt, wkt_from_geojson, wkt_to_wkb
from cityflow.functions.graphtext import mutation_value, number_of, slug_last_part, slug_of
from cityflow.operators.context import with_headers
from cityflow.operators.contract import catalogue, contract, evolve
from cityflow.operators.errors import errors_from_rejected
from cityflow.operators.expect import backlog_complete, expect_absent, expect_rows
from cityflow.operators.graph import classify_response
from cityflow.operators.metrics import observe_flow, pipeline_snapshot, throughput
from cityflow.operators.routing import route
from cityflow.plans.flows import entities_of, flagged_entities, mutations_of
from cityflow.sources.raw import FileSource, KafkaSource, read_raw
from cityflow.streaming.jobs import RelationalJob, run_available
from cityflow.streaming.store import checkpoint_id
from cityflow.streaming.sinks import delete_statement, dispatch, last_per_key, publish, quoted, upsert_statement, write_documents, write_error_log, write_routed

GEOMETRIES = [
    ({"type": "Point", "coordinates": [12.0625, -7.25]}, "POINT (12.0625 -7.25)"),
    ({"type": "point", "coordinates": [1.0, 2e-06]}, "POINT (1 0.000002)"),
    ({"type": "Point", "coordinates": [1, 2, 3]}, "POINT Z (1 2 3)"),
    ({"type": "LineString", "coordinates": [[1, 2], [3, 4.5]]}, "LINESTRING (1 2, 3 4.5)"),
    ({"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}, "MULTIPOINT (1 2, 3 4)"),
    ({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "POLYGON ((0 0, 1 0, 1 1, 0 0))"),
    ({"type": "MultiLineString", "coordinates": [[[1, 2], [3, 4]], [[5, 6], [7, 8]]]}, "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8))"),
    ({"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [0, 0]]]]}, "MULTIPOLYGON (((0 0, 1 0, 0 0)))"),
    ({"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}}, "POINT (1 2)"),
    ({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}}]}, "POINT (1 2)"),
    ({"type": "FeatureCollection", "features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}}] * 2}, None),
    ({"type": "Point", "coordinates": "invalid"}, None),
    ({"type": "Polygon", "coordinates": [[1, 2], [3, 4]]}, None),
    ({"type": "LineString", "coordinates": [[1, 2], [[3, 4]]]}, None),
    ({"type": "Circle", "coordinates": [1, 2]}, None),
]


def test_geojson_to_text(spark):
    rows = spark.createDataFrame([(i, json.dumps(g)) for i, (g, _) in enumerate(GEOMETRIES)], "i int, g string")
    got = [r[0] for r in rows.orderBy("i").select(wkt_from_geojson(F.col("g"))).collect()]
    assert got == [text for _, text in GEOMETRIES]


def test_a_long_ring_does_not_exhaust_the_stack(spark):
    ring = [[i / 100, i / 200] for i in range(20000)]
    text = json.dumps({"type": "Polygon", "coordinates": [ring]})
    row = spark.createDataFrame([(text,)], "g string").select(wkt_from_geojson(F.col("g")).alias("w"))
    wkb = row.select(wkb_from_wkt("w")).first()[0]
    assert len(wkb) == 1 + 4 + 4 + 4 + 16 * 20000


def test_binary_form():
    assert wkt_to_wkb("POINT (2 41)").hex() == "010100000000000000000000400000000000804440"
    assert wkt_to_wkb("MULTIPOINT (1 2, 3 4)") == wkt_to_wkb("MULTIPOINT ((1 2), (3 4))")
    assert wkt_to_wkb("POINT Z (1 2 3)")[1:5] == b"\xe9\x03\x00\x00"
    assert wkt_to_wkb("NOT A WKT") is None and wkt_to_wkb(None) is None


def test_mutation_values():
    value = {"s": 'a"b\\c\nd', "l": ["x", 1], "o": {"on": True, "none": None}, "f": 25.0}
    assert mutation_value(value, False) == '{ s: "a\\"b\\\\c\\nd", l: ["x", 1], o: { on: true, none: null }, f: 25 }'
    assert mutation_value({"uri": "http://e.org/Kos/Descripción:001", "x": 1}, True) == '{ uri: "http://e.org/Kos/descripcion-001" }'
    assert slug_of("Ñandú, el  Ágil!") == "nandu-el-agil" and slug_last_part("plain X") == "plain-x"
    assert [number_of(n) for n in (1e21, 1e-7, 9223372036854775808, 0.1, -2.5e-5)] == ["1e+21", "1e-7", "9223372036854776000", "0.1", "-0.000025"]


def test_mutations(spark):
    body = {
        "data": [
            {"type": "hOTEL", "externalId": "Hotel:1", "stars": 4, "label": {"value": "X", "lang": "es"}},
            {"type": "location", "externalId": "L:1", "AsGeoJSON": '{"type":"Point","coordinates":[1,2]}', "n": 1},
            {"type": "Location", "externalId": "L:2", "asGeoJSON": None},
            {"type": "hotel", "externalId": "Hotel:1", "alterationType": "entityDelete"},
            {"type": "hotel", "externalId": "Hotel:1", "alterationType": {"value": "ENTITYCHANGE"}},
        ]
    }
    config = GraphConfig(prefix="kg_", suffix="_prd", staging=True, fallback_to_service=True, resource_base="http://example.org/")
    rows = mutations_of(raw_rows(spark, [body], "sgtr", HEADERS), config).orderBy("entity_pos").collect()
    assert rows[0].query == (
        'mutation { createHotel(dti: "kg_test_prd", input: { object: { externalId: "Hotel:1", stars: 4, '
        'label: { value: "X", lang: "es" } } }, staging: true) { uri } }'
    )
    assert 'object: { externalId: "L:1", n: 1, asWkt: "POINT (1 2)" }' in rows[1].query
    assert 'object: { externalId: "L:2", asWkt: null }' in rows[2].query
    assert rows[3].query == (
        'mutation { deleteData(dti: "kg_test_prd", uris: ["http://example.org/kg_test_prd/resource/Hotel:1"], staging: true) }'
    )
    assert rows[4].query.startswith("mutation { updateHotel(")


def test_members_of_mutations_against_a_reader_of_whole_objects(spark):
    """Random objects: what the expressions write is what a reader of the whole JSON text writes."""
    rng = random.Random(8)
    scalars = [0, 1, -7, 2.5, 1e-7, 1e21, 25.0, True, False, None, "", 'a"b\\c\nd', "Ñandú {x}", "null", "12", 2**60]

    def value(depth=0):
        if depth < 2 and rng.random() < 0.25:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        if depth < 2 and rng.random() < 0.25:
            return {rng.choice(["z", "a", "uri", "x y"]): value(depth + 1) for _ in range(rng.randint(0, 3))}
        return rng.choice(scalars)

    objects = []
    for i in range(150):
        members = {"type": "hotel", "externalId": f"Hotel:{i}", **{f"m{k}": value() for k in range(rng.randint(0, 5))}}
        keys = list(members)
        rng.shuffle(keys)
        objects.append({k: members[k] for k in keys})
    rows = mutations_of(raw_rows(spark, [{"data": objects}], "sgtr", HEADERS), GraphConfig()).orderBy("entity_pos").collect()
    for row, given in zip(rows, objects, strict=True):
        kept = {k: v for k, v in given.items() if k != "type"}
        assert f"object: {mutation_value(kept, False)} }}" in row.query


def test_binary_form_of_whole_batches():
    """Texts of all kinds in one batch, good and bad ones next to each other, against one position at a time."""
    import struct

    import pyarrow as pa

    from cityflow.functions.geometry import wkb_of_texts

    rng = random.Random(3)
    number = lambda: rng.choice(["0", "1.5", "-2e-3", "179.25", "7E2"])

    def line(width, n):
        return [[number() for _ in range(width)] for _ in range(n)]

    def pack(points):
        return struct.pack("<I", len(points)) + b"".join(struct.pack(f"<{len(p)}d", *map(float, p)) for p in points)

    def text(points):
        return "(" + ", ".join(" ".join(p) for p in points) + ")"

    texts, expected = [], []
    for _ in range(400):
        width = rng.choice([2, 3])
        axis, more = (" Z ", 1000) if width == 3 else (" ", 0)
        head = lambda code: struct.pack("<BI", 1, code + more)
        rings = [line(width, rng.randint(1, 4)) for _ in range(rng.randint(1, 3))]
        made = {
            "POINT": (text(rings[0][:1]), head(1) + pack(rings[0][:1])[4:]),
            "LINESTRING": (text(rings[0]), head(2) + pack(rings[0])),
            "POLYGON": ("(" + ",".join(map(text, rings)) + ")", head(3) + struct.pack("<I", len(rings)) + b"".join(map(pack, rings))),
            "MULTIPOINT": (text(rings[0]), head(4) + struct.pack("<I", len(rings[0])) + b"".join(head(1) + pack([p])[4:] for p in rings[0])),
            "MULTILINESTRING": ("(" + ",".join(map(text, rings)) + ")", head(5) + struct.pack("<I", len(rings)) + b"".join(head(2) + pack(r) for r in rings)),
            "MULTIPOLYGON": ("((" + ",".join(map(text, rings)) + "))", head(6) + struct.pack("<I", 1) + head(3) + struct.pack("<I", len(rings)) + b"".join(map(pack, rings))),
        }
        kind = rng.choice(list(made))
        body, packed = made[kind]
        texts.append(kind + axis + body)
        expected.append(packed)
        if rng.random() < 0.3:
            texts.append(rng.choice([None, "", "POINT", "POINT EMPTY", kind + axis + body[:-1], "POINT (1 2 3)", "POINT (01 2)", "CIRCLE (1 2)", "LINESTRING ()"]))
            expected.append(None)
    assert wkb_of_texts(pa.array(texts, pa.string())).to_pylist() == expected
    assert wkb_of_texts(pa.array(texts, pa.string()).slice(7, 50)).to_pylist() == expected[7:57]
    assert wkb_of_texts(pa.array([None, "x"], pa.string())).to_pylist() == [None, None]


def test_routing_needs_a_path_only_where_the_schema_is_one(spark):
    raw = raw_rows(spark, [{"data": [{"id": "s", "type": "Sensor"}]}], headers=[("fiware-service", b"test")])
    entities = entities_of(raw)
    assert route(entities).first().target == "test._sensor"
    refused = route(entities, FlowConfig(datamodel=DM_TYPE_SCHEMA)).first()
    assert refused.target is None and refused.route_error == "Required header missing or empty: fiware-servicepath"
    assert route(entities, FlowConfig(schema_override="fixed"), "lastdata").first().target == "fixed._sensor_lastdata"


def test_error_rows(spark):
    message = (
        'Batch entry INSERT INTO "tests"."test"."t" ("a","b") VALUES (1,2) ERROR: null value in column "b"\n'
        "  Detail: Failing row contains (1).\nrest"
    )
    headers = [("__connect.errors.exception.message", message.encode()), ("__connect.errors.topic", b"in_test_historic_processed")]
    bare = [("__connect.errors.exception.message", b"Oops"), ("__connect.errors.exception.cause.message", b"Why"), ("target_table", b"t")]
    rows = raw_rows(spark, [{"payload": {}}], "errors", headers).unionByName(
        raw_rows(spark, [{"payload": {"a": "it's", "n": None, "x": 25.0, "o": True}}, "null", "{bad"], "errors", bare)
    )
    got = errors_from_rejected(with_headers(rows, keep_case=True), FlowConfig(prefix="in_")).collect()
    assert len(got) == 2
    assert got[0].tenant == "test"
    assert got[0].error == 'ERROR: null value in column "b" - Detail: Failing row contains (1).'
    assert got[0].query == 'INSERT INTO "tests"."test"."t" ("a","b") VALUES (1,2)'
    assert got[1].error == "Oops\nCaused by: Why"
    assert got[1].query == """INSERT INTO "unknown"."t" ("a","n","x","o") VALUES ('it''s',NULL,25,true)"""


def test_dispatch_retries_and_replies_are_classified(spark):
    def send(url, body, timeout):
        query = json.loads(body)["query"]
        if query == "down":
            raise ConnectionError("refused")
        if query == "exists":
            return 200, '{"errors":[{"message":"URI x already exists in the graph"}]}'
        if query == "bad":
            return 200, '{"errors":[{"message":"no such relation"}]}'
        return 200, '{"data":{}}'

    rows = spark.createDataFrame([("t", q) for q in ("ok", "exists", "bad", "down")], "service string, query string")
    replies = dispatch(rows, "http://nowhere", send, backoff_s=0.0, keep=("service", "query"))
    got = {r.query: (r.outcome, r.attempts, r.error) for r in classify_response(replies).collect()}
    assert got["ok"] == ("accepted", 1, None) and got["exists"] == ("exists", 1, None)
    assert got["bad"][0] == "failed" and "retryable GraphQL errors" in got["bad"][2]
    assert got["down"][:2] == ("failed", 2)


def test_expectations(spark):
    held = spark.createDataFrame([("a", 1.0, '{"x": 1}'), ("b", 2.0, "")], "entityid string, v double, doc string")
    asked = spark.createDataFrame(
        [("a", 1.0000001, '{"x":1}', None), ("a", 1.1, None, None), ("b", None, "", 1.5), ("c", None, None, None)],
        "entityid string, v double, doc string, v__gt double",
    )
    assert sorted((r.entityid, r.v) for r in expect_rows(held, asked, ["entityid"]).collect()) == [("a", 1.1), ("c", None)]
    assert expect_absent(held, asked, ["entityid"]).count() == 2
    assert backlog_complete(held, "b") and not backlog_complete(held, "z")


def test_snapshot_of_nothing_and_observation(spark):
    from pyspark.sql import Observation

    empty = spark.createDataFrame([], "flow string, service string, result string, duration_s double, processed_at timestamp")
    assert pipeline_snapshot(empty).first().success_rate == 1.0
    seen = Observation("seen")
    observe_flow(spark.range(7), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}


def test_evolution(spark):
    old = spark.createDataFrame([("e", 40.0, "north", 1)], "entityid string, level double, old_side string, spare int")
    new = contract("t.t", {"level": "text", "side": "text", "flow": "double precision"})
    row = evolve(old, new, {"old_side": "side"}).first()
    assert (row.level, row.side, row.flow) == ("40", "north", None) and "spare" not in row


def test_writers(spark):
    root = tempfile.mkdtemp()
    routed = route(entities_of(raw_rows(spark, [{"data": [{"id": "s", "type": "A"}, {"id": "t", "type": "B"}]}], headers=HEADERS)))
    write_routed(routed.select("entityid", "target_schema", "target_table"), f"{root}/routed")
    back = spark.read.parquet(f"{root}/routed")
    assert {(r.target_table, r.entityid) for r in back.collect()} == {("date_a", "s"), ("date_b", "t")}
    documents = spark.createDataFrame([("d", "c", '{"a":1}')], "database string, collection string, document string")
    write_documents(documents, f"{root}/documents")
    assert spark.read.json(f"{root}/documents").first().a == 1
    write_error_log(spark.createDataFrame([("t", "e")], "tenant string, error string"), f"{root}/errors")
    assert spark.read.parquet(f"{root}/errors").first().tenant == "t"
    publish(spark.createDataFrame([("out", "{}")], "out_topic string, message string"), path=f"{root}/topics")
    assert spark.read.parquet(f"{root}/topics").first().value == "{}"


def test_statements_and_source_options():
    table = contract("s.t", {"v": "text"}, ["entityid"])
    statement = upsert_statement(table, "s.t_staging", "timeinstant")
    assert 'ON CONFLICT ("entityid") DO UPDATE SET' in statement
    held, new = '"s"."t"."timeinstant"', 'excluded."timeinstant"'
    assert statement.endswith(f"WHERE {new} > {held} OR {new} IS NULL OR {held} IS NULL")
    assert delete_statement(table, "s.t_staging") == (
        'DELETE FROM "s"."t" USING "s"."t_staging" WHERE "s"."t"."entityid" = "s"."t_staging"."entityid"'
    )
    assert quoted('a.b"c') == '"a"."b""c"'
    options = KafkaSource("b:9092", prefix="in_", max_offsets=10).reader_options("historic", True)
    assert options["subscribe"] == "in_raw_historic" and options["maxOffsetsPerTrigger"] == "10"
    assert options["startingOffsets"] == "earliest" and options["includeHeaders"] == "true"
    assert KafkaSource("b:9092", pattern="in_.*").reader_options("errors", True)["subscribePattern"] == "in_.*"


def test_unknown_flow_is_refused(spark):
    with pytest.raises(ValueError):
        read_raw(spark, "other", FileSource("/nowhere"))


def _sensor(i, value, minute, change=None):
    entity = {"id": f"s{i}", "type": "Sensor", "TimeInstant": {"type": "DateTime", "value": f"2024-01-01T00:{minute:02d}:00Z"}}
    entity["temperature"] = {"type": "Number", "value": value}
    if change:
        entity["alterationType"] = {"value": change}
    return {"data": [entity]}


def _stream(spark, flow, batches, table, **kwargs):
    """Run each list of bodies as one file, one micro-batch per file, with a restart after each."""
    root = tempfile.mkdtemp()
    job = RelationalJob(spark, flow, [table], f"{root}/tables", **kwargs)
    offset = 1
    for bodies in batches:
        raw_rows(spark, bodies, flow, HEADERS, offset).coalesce(1).write.mode("append").parquet(f"{root}/raw")
        offset += len(bodies)
        stream = read_raw(spark, flow, FileSource(f"{root}/raw", max_files=1))
        run_available(stream, job.handle, f"{root}/checkpoint")
    return job


def test_stream_keeps_lastdata_over_restarts(spark):
    table = contract("test.date_sensor_lastdata", {"temperature": "double precision"}, ["entityid"])
    batches = [
        [_sensor(1, 1.0, 30), _sensor(2, 2.0, 10), _sensor(3, 3.0, 1)],
        [_sensor(1, 9.0, 10), _sensor(2, 4.0, 20), _sensor(3, 0.0, 5, "entityDelete"), _sensor(4, "hot", 1)],
        [_sensor(1, 5.0, 40), "{bad"],
    ]
    job = _stream(spark, "lastdata", batches, table)
    assert {(r.entityid, r.temperature) for r in job.read(table.target).collect()} == {("s1", 5.0), ("s2", 4.0)}
    assert sorted(r.code for r in job.errors().collect()) == ["BAD_JSON", "TYPE_MISMATCH"]
    # A batch that is run again after its commit changes nothing.
    query = checkpoint_id(spark, f"{job.root}/../checkpoint")
    job.handle(raw_rows(spark, [_sensor(1, 100.0, 59)], "lastdata", HEADERS), 2, query)
    assert {(r.entityid, r.temperature) for r in job.read(table.target).collect()} == {("s1", 5.0), ("s2", 4.0)}


def test_stream_keeps_historic_and_its_errors(spark):
    table = contract("test.date_sensor", {"temperature": "double precision"}, ["entityid", "timeinstant"])
    batches = [[_sensor(1, 1.0, 1), _sensor(1, 2.0, 1), _sensor(1, 3.0, 2)], [_sensor(1, 4.0, 1), _sensor(2, 5.0, 1)]]
    job = _stream(spark, "historic", batches, table)
    assert sorted(r.temperature for r in job.read(table.target).collect()) == [1.0, 3.0, 5.0]
    assert [r.code for r in job.errors().collect()] == ["DUPLICATE_KEY", "DUPLICATE_KEY"]


def test_stream_keeps_mutable(spark):
    table = contract("test.date_sensor_mutable", {"temperature": "double precision"}, ["entityid", "timeinstant"])
    job = _stream(spark, "mutable", [[_sensor(1, 1.0, 1), _sensor(1, 2.0, 1)], [_sensor(1, 3.0, 1), _sensor(1, 4.0, 2)]], table)
    assert sorted(r.temperature for r in job.read(table.target).collect()) == [3.0, 4.0]


def test_another_checkpoint_is_another_query(spark):
    """Batches of a new checkpoint are not taken for those of an old one."""
    table = contract("test.date_sensor_mutable", {"temperature": "double precision"}, ["entityid", "timeinstant"])
    job = _stream(spark, "mutable", [[_sensor(1, 1.0, 1)], [_sensor(2, 2.0, 1)]], table)
    raw_rows(spark, [_sensor(3, 3.0, 1)], "mutable", HEADERS, 1).write.parquet(f"{job.root}/other")
    stream = read_raw(spark, "mutable", FileSource(f"{job.root}/other", max_files=1))
    run_available(stream, job.handle, f"{job.root}/checkpoint-2")
    assert sorted(r.temperature for r in job.read(table.target).collect()) == [1.0, 2.0, 3.0]


def test_deletes_come_before_later_batches_however_they_are_stored(spark):
    """Changes give the same rows before and after they are folded."""
    table = contract("test.date_sensor_lastdata", {"temperature": "double precision"}, ["entityid"])
    job = RelationalJob(spark, "lastdata", [table], f"{tempfile.mkdtemp()}/tables", every=2)
    steps = [
        ([_sensor(1, 1.0, 30), _sensor(2, 2.0, 10)], {"s1": 1.0, "s2": 2.0}),
        ([_sensor(1, 0.0, 31, "entityDelete")], {"s2": 2.0}),
        ([_sensor(1, 3.0, 5)], {"s1": 3.0, "s2": 2.0}),
        ([_sensor(2, 4.0, 9)], {"s1": 3.0, "s2": 2.0}),
        ([_sensor(1, 5.0, 4), _sensor(2, 6.0, 11)], {"s1": 3.0, "s2": 6.0}),
        ([_sensor(2, 0.0, 12, "entityDelete"), _sensor(1, 7.0, 40)], {"s1": 7.0}),
        ([_sensor(2, 8.0, 1)], {"s1": 7.0, "s2": 8.0}),
    ]
    for batch, (bodies, expected) in enumerate(steps):
        job.handle(raw_rows(spark, bodies, "lastdata", HEADERS), batch)
        assert {r.entityid: r.temperature for r in job.read(table.target).collect()} == expected, batch


def test_one_staging_row_per_key(spark):
    table = contract("s.t", {"v": "double precision"}, ["entityid"], with_time=False)
    rows = spark.createDataFrame([("a", 1.0, (0, 1, 0)), ("a", 2.0, (0, 2, 0)), ("b", 3.0, (0, 0, 0))], "entityid string, v double, seq struct<partition:int,offset:bigint,pos:int>")
    assert {(r.entityid, r.v) for r in last_per_key(rows, table).collect()} == {("a", 2.0), ("b", 3.0)}


def test_catalogue_is_broadcast_and_entities_stay_where_they_are(spark, tmp_path):
    """On a file source the contract check shuffles no entity."""
    raw_rows(spark, [_sensor(1, 1.0, 1)], "historic", HEADERS).write.parquet(str(tmp_path / "raw"))
    table = contract("test.date_sensor", {"temperature": "double precision"}, ["entityid", "timeinstant"])
    rows = flagged_entities(read_raw(spark, "historic", FileSource(str(tmp_path / "raw")), streaming=False), catalogue(spark, [table]), "historic")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(target" not in plan


def test_sliding_counts_are_made_before_they_are_spread(spark):
    rows = spark.range(100).selectExpr("timestamp_seconds(id * 30) AS kafka_ts", "'f' AS flow")
    direct = throughput(rows, "90 seconds", "1 minute")
    counted = throughput(rows, "5 minutes", "1 minute")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")
    assert {r.rate for r in counted.collect()} <= {r / 300 for r in (2, 4, 6, 8, 10)}
    assert sum(r.records for r in direct.collect()) > 100
