import json
import random
import tempfile
from dataclasses import replace

import pytest
from conftest import HEADERS, raw_rows
from pyspark.sql import functions as F

from cityflow.operators.contract import (
    Contract,
    contract,
    evolve,
    from_stored,
    next_version,
    stored_types,
    to_stored,
)
from cityflow.operators.metrics import consumer_lag, observed_offsets, progress_log, progress_rows, source_offsets, throughput
from cityflow.sources.raw import FileSource, read_raw
from cityflow.streaming.jobs import DocumentJob, RelationalJob, run_available
from cityflow.streaming.stateful import step
from cityflow.streaming.store import TOGETHER, BatchStore, key_words, parts_with, words_for

from test_tables import history, model


def entity(i, day=1, change=None, kind="Probe", **values):
    made = {"id": f"p{i}", "type": kind, "TimeInstant": {"type": "DateTime", "value": f"2031-03-{day:02d}T08:00:00Z"}}
    made |= {k: {"type": "Number" if isinstance(v, (int, float)) else "Text", "value": v} for k, v in values.items()}
    if change:
        made["alterationType"] = {"value": change}
    return made


def rows_of(spark, entities, flow, first_offset=1):
    return raw_rows(spark, [{"data": [e]} for e in entities], flow, HEADERS, first_offset)


# ---- contracts that change ------------------------------------------------------------------------


def of(columns, pk=("entityid",)):
    return contract("test.date_probe_lastdata", columns, pk)


def test_identities_outlive_names_and_types():
    first = next_version([], of({"level": "double precision", "side": "text"}))
    assert first.identities == tuple(first.contract.names)
    same = next_version([first], of({"level": "double precision", "side": "text"}))
    assert same is first
    second = next_version([first], of({"level": "text", "bank": "text"}), {"side": "bank"})
    held = dict(zip(second.contract.names, second.identities))
    assert (held["level"], held["bank"]) == ("level", "side") and second.number == 2
    # The old name comes back as another column, and so does one that was dropped.
    third = next_version([first, second], of({"bank": "text", "side": "integer"}))
    held = dict(zip(third.contract.names, third.identities))
    assert (held["bank"], held["side"]) == ("side", "side~2")
    fourth = next_version([first, second, third], of({"level": "text"}))
    assert dict(zip(fourth.contract.names, fourth.identities))["level"] == "level~2"
    assert stored_types([first, second])["level__double"] == "double" and stored_types([first, second])["level__string"] == "string"


def test_rows_of_all_versions_are_read_as_evolve_reads_them(spark):
    first = next_version([], Contract("t", tuple(c for c in of({"level": "double precision", "side": "text", "spare": "integer"}).columns)))
    second = next_version([first], of({"level": "text", "bank": "text", "flow": "numeric(8,2)"}), {"side": "bank"})
    names = first.contract.names
    old = spark.createDataFrame([(None, "/", "e", "E", None, 40.0, "north", 3), (None, "/", "f", "E", None, None, None, None)], ", ".join(f"{c.name} {c.spark_type}" for c in first.contract.columns))
    new = old.limit(0).select(*names).selectExpr("recvtime", "fiwareservicepath", "entityid", "entitytype", "timeinstant", "'x' level", "'y' bank", "cast(1.5 as decimal(8,2)) flow")
    stored = to_stored(old, first).unionByName(to_stored(new, second), allowMissingColumns=True)
    read = from_stored(stored, [first, second])
    assert read.columns == second.contract.names
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(map(tuple, evolve(old, second.contract, {"side": "bank"}).collect()), key=repr)


@pytest.mark.parametrize("flow", ["historic", "lastdata", "mutable"])
def test_a_table_whose_contract_changes_twice(spark, flow):
    """Renamed, added, dropped columns and a number become text, between batches and through a compaction."""
    suffix = "" if flow == "historic" else f"_{flow}"
    key = ["entityid"] if flow == "lastdata" else ["entityid", "timeinstant"]
    table = lambda columns: contract(f"test.date_probe{suffix}", columns, key)
    root = f"{tempfile.mkdtemp()}/tables"
    versions = [
        (table({"level": "double precision", "side": "text"}), {}, [entity(1, level=2.5, side="n"), entity(2, level=40.0, side="s")]),
        (table({"level": "text", "bank": "text", "flow": "double precision"}), {"side": "bank"}, [entity(3, level="high", bank="w", flow=1.5)]),
        (table({"level": "text", "flow": "text"}), {}, [entity(1, day=2, level="low", flow="none")]),
    ]
    expected = {("p1", "2.5", None), ("p2", "40", None), ("p3", "high", "1.5"), ("p1", "low", "none")}
    if flow == "lastdata":
        expected.discard(("p1", "2.5", None))
    for batch, (version, renames, entities) in enumerate(versions):
        job = RelationalJob(spark, flow, [version], root, renames={version.target: renames})
        job.handle(rows_of(spark, entities, flow, 10 * batch), batch)
        if batch == 1:
            rows = {(r.entityid, r.level, r.bank, r.flow) for r in job.read(version.target).collect()}
            assert rows == {("p1", "2.5", "n", None), ("p2", "40", "s", None), ("p3", "high", "w", 1.5)}
            job.compact(whole=True)
    for _ in range(2):
        assert {(r.entityid, r.level, r.flow) for r in job.read(version.target).collect()} == expected
        job.compact(whole=True)
    assert job.errors().count() == 0
    # The versions are known to a job that starts later.
    assert [v.number for v in job.history()[version.target]] == [1, 2, 3]


def test_late_rows_are_judged_alike_however_often_batches_are_folded(spark):
    """A row without a time replaces the newest; a late row does not come back after a fold."""
    table = of({"level": "double precision"})
    steps = [entity(1, day=9, level=1.0), {**entity(1, level=2.0), "TimeInstant": None}, entity(1, day=5, level=3.0)]
    steps[1].pop("TimeInstant")
    job = RelationalJob(spark, "lastdata", [table], f"{tempfile.mkdtemp()}/t", every=2, partial=False)
    for batch, e in enumerate(steps):
        job.handle(rows_of(spark, [e], "lastdata", batch + 1), batch)
    assert [(r.entityid, r.timeinstant, r.level) for r in job.read(table.target).collect()] == [("p1", None, 2.0)]


# ---- batches and folders ----------------------------------------------------------------------------


def test_all_tables_of_a_batch_go_out_in_one_write(spark, monkeypatch):
    kinds = []
    write = BatchStore.write
    monkeypatch.setattr(BatchStore, "write", lambda self, kind, *args: (kinds.append(kind), write(self, kind, *args))[1])
    tables = [contract(f"test.date_{k}", {"level": "double precision"}, ["entityid", "timeinstant"]) for k in ("a", "b", "c")]
    tables.append(contract("test.date_d", {"note": "text", "level": "text"}, ["entityid"]))
    job = RelationalJob(spark, "historic", tables, f"{tempfile.mkdtemp()}/t")
    job.handle(rows_of(spark, [entity(i, kind=k, level=1.0) for i, k in enumerate("abca")] + [entity(9, kind="d", note="x", level="y")], "historic"), 0)
    assert kinds == ["log", "rows", "keys"]
    assert [job.read(t.target).count() for t in tables] == [2, 1, 1, 1]
    assert job.read("test.date_d").first().level == "y"


def files_below(path):
    import pathlib

    return [f for f in pathlib.Path(path).rglob("*.parquet")]


def test_repeats_are_looked_for_only_where_the_key_may_be(spark, monkeypatch):
    """New keys open no stored file; a repeated one opens those of the batch and day it is in."""
    table = contract("test.date_probe", {"level": "double precision"}, ["entityid", "timeinstant"])
    job = RelationalJob(spark, "historic", [table], f"{tempfile.mkdtemp()}/t")
    opened = []
    held = RelationalJob.held_keys
    monkeypatch.setattr(RelationalJob, "held_keys", lambda self, *args: opened.append(held(self, *args)) or opened[-1])
    for batch in range(2):
        job.handle(rows_of(spark, [entity(100 * batch + i, day=1 + i % 4, level=1.0) for i in range(40)], "historic", 100 * batch), batch)
    assert all(frame is None for frame in opened)
    job.handle(rows_of(spark, [entity(105, day=2, level=9.0), entity(999, day=2, level=9.0)], "historic", 900), 2)
    names = opened[-1].inputFiles()
    assert names and all("batch=1/" in n and "part=2031-03-02" in n for n in names)
    assert [r.code for r in job.errors().collect()] == ["DUPLICATE_KEY"] and job.read(table.target).count() == 81
    # Also after batches were put together.
    job.compact()
    job.handle(rows_of(spark, [entity(107, day=4, level=9.0), entity(1000, level=9.0)], "historic", 1000), 3)
    assert all(f"origin={TOGETHER}" in n and "part=2031-03-04" in n for n in opened[-1].inputFiles())
    assert job.read(table.target).count() == 82 and job.errors().count() == 2


def test_filters_have_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).selectExpr("'t' AS target", "'d' AS part", "concat('k', id) AS entityid")
    words = words_for(20_000)
    made = key_words(keys, ["entityid"], ["target", "part"], words).withColumns({"origin": F.lit("q"), "batch": F.lit(0).cast("long")})
    assert words == 8192 and made.count() <= words

    def met(rows):
        return parts_with(rows, ["entityid"], ["target", "part"], made).count()

    for i in (0, 7, 19_999):
        assert met(spark.sql(f"SELECT 't' target, 'd' part, 'k{i}' entityid")) == 1
    assert met(spark.sql("SELECT 't' target, 'other' part, 'k7' entityid")) == 0
    others = spark.range(20_000, 22_000).selectExpr("'t' AS target", "'d' AS part", "concat('k', id) AS entityid")
    single = [parts_with(others.where(f"entityid = 'k{20_000 + i}'"), ["entityid"], ["target", "part"], made).count() for i in range(0, 40)]
    assert sum(single) <= 4


def test_batches_are_put_together_and_old_folders_go(spark, tmp_path):
    """Files and commits stay few over many batches, and every row stays."""
    import pathlib

    job = DocumentJob(spark, str(tmp_path), "sth_", every=4)
    for batch in range(14):
        body = {"data": [{"id": f"d{batch}", "type": "Doc", "text": {"type": "Text", "value": "x"}}]}
        job.handle(raw_rows(spark, [body], "mongo", HEADERS, batch), batch, "q")
        # A batch that is run again changes nothing.
        if batch % 7 == 0:
            job.handle(raw_rows(spark, [body], "mongo", HEADERS, batch), batch, "q")
    assert sorted(json.loads(r.document)["entityId"] for r in job.read().collect()) == sorted(f"d{i}" for i in range(14))
    top = pathlib.Path(tmp_path) / "documents"
    assert len(list(top.glob("rows/*/*"))) <= 4 + 2 * 4 + 14 // 4
    assert len(list(top.glob("commits/*/*"))) <= 4 + 2 * 4 + 14 // 4
    store = job.store
    assert store.committed("q", 13) and not store.committed("q", 14) and not store.committed("other", 0)


def test_a_write_without_its_commit_is_not_read_and_is_replaced(spark, tmp_path):
    job = DocumentJob(spark, str(tmp_path), "sth_")
    body = lambda name: {"data": [{"id": name, "type": "Doc"}]}
    job.handle(raw_rows(spark, [body("one")], "mongo", HEADERS), 0, "q")
    store = job.store
    store.write("rows", "q", 1, spark.createDataFrame([("half", "a", "b")], "document string, database string, collection string"))
    store.write("rows", "gone", 0, spark.createDataFrame([("orphan", "a", "b")], "document string, database string, collection string"))
    assert job.read().count() == 1
    job.handle(raw_rows(spark, [body("two")], "mongo", HEADERS), 1, "q")
    assert sorted(json.loads(r.document)["entityId"] for r in job.read().collect()) == ["one", "two"]
    replace(store, orphan_hours=-1.0).clean(store.commits())
    left = {f.parent.name for f in files_below(f"{tmp_path}/documents/rows")}
    assert not any("origin=gone" in str(f) for f in files_below(f"{tmp_path}/documents/rows")) and left
    assert job.read().count() == 2


# ---- state ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("partial", [False, True])
@pytest.mark.parametrize("ties", ["keep", "replace"])
def test_steps_of_the_state_equal_the_model(partial, ties):
    rows = history(1500, 25, deletes=0.08, no_time=0.2, seed=31)
    held = {}
    for key, time, a, b, _, change, present in rows:
        values = {c: v for c, v in {"timeinstant": None if time is None else time.isoformat(), "a": a, "b": b}.items() if not partial or c in present}
        ts = None if time is None else round(time.timestamp() * 1e6)
        now = step(held.get(key), change, ts, json.dumps(values), partial, ties)
        if now is None:
            held.pop(key, None)
        else:
            held[key] = now
    told = {k: json.loads(e) for k, (_, e) in held.items()}
    expected = {
        k: tuple(None if v is None else v.isoformat() if hasattr(v, "isoformat") else v for v in row) for k, row in model(rows, {}, partial, ties).items()
    }
    assert {k: (v.get("timeinstant"), v.get("a"), v.get("b")) for k, v in told.items()} == expected


# ---- numbers of running queries --------------------------------------------------------------------


def progress(batch, end, latest, rows, rejects):
    return json.dumps(
        {
            "id": "11111111-2222-3333-4444-555555555555",
            "runId": "r",
            "name": "group-a",
            "timestamp": f"2031-05-01T10:00:0{batch}.000Z",
            "batchId": batch,
            "durationMs": {"triggerExecution": 1500, "addBatch": 1200},
            "observedMetrics": {"flow/historic": {"rows": rows, "rejects": rejects, "oldest_us": 1935395940000000, "newest_us": 1935395970000000}},
            "sources": [{"description": "KafkaV2[Subscribe[raw_historic]]", "startOffset": None, "endOffset": {"raw_historic": end}, "latestOffset": {"raw_historic": latest}}],
        }
    )


def test_lag_and_flow_log_of_reported_progress(spark):
    texts = [progress(0, {"0": 10, "1": 0}, {"0": 12, "1": 4}, 10, 3), progress(1, {"0": 20, "1": 2}, {"0": 25, "1": 4}, 12, 0)]
    rows = progress_rows(spark.createDataFrame([(t,) for t in [*texts, texts[0], "not progress"]], "value string"))
    lag = consumer_lag(source_offsets(rows, "latestOffset").drop("consumer_group"), source_offsets(rows))
    assert [tuple(r) for r in lag.collect()] == [("group-a", "raw_historic", 25 - 20 + 4 - 2)]
    log = sorted((r.batch, r.result, r.messages, r.duration_s) for r in progress_log(rows).collect())
    assert log == [(0, "error", 3, 1.5), (0, "success", 7, 1.5), (1, "success", 12, 1.5)]
    assert observed_offsets(rows).count() == 0


def test_names_with_slashes_in_observed_offsets(spark):
    text = json.dumps({"id": "i", "runId": "r", "batchId": 0, "timestamp": "t", "observedMetrics": {"offsets": {"a/b/0": 5, "a/b/11": None, "c/2": 7}}})
    rows = observed_offsets(progress_rows(spark.createDataFrame([(text,)], "value string")))
    assert sorted(tuple(r) for r in rows.collect()) == [("i", "a/b", 0, 5), ("i", "c", 2, 7)]


def test_sliding_counts_of_a_stream_are_made_before_they_are_spread(spark, tmp_path):
    raw_rows(spark, [entity(1)], "historic", HEADERS).write.parquet(str(tmp_path / "raw"))
    stream = read_raw(spark, "historic", FileSource(str(tmp_path / "raw")))
    plan = throughput(stream, "5 minutes", "1 minute", watermark="1 minute")._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate") == 2 and plan.index("Expand") < plan.rindex("Aggregate")


def test_lastdata_over_restarts_and_folds_is_the_fold_of_all(spark):
    """Random changes in many batches, folded every other batch and read by two checkpoints."""
    rng = random.Random(4)
    table = of({"level": "double precision"})
    entities = []
    for i in range(60):
        e = entity(rng.randrange(6), day=rng.randrange(1, 28), level=float(i), change="entityDelete" if rng.random() < 0.1 else None)
        if rng.random() < 0.3:
            e.pop("TimeInstant")
        entities.append(e)
    one = RelationalJob(spark, "lastdata", [table], f"{tempfile.mkdtemp()}/one")
    one.handle(rows_of(spark, entities, "lastdata"), 0)
    expected = sorted((r.entityid, str(r.timeinstant), r.level) for r in one.read(table.target).collect())
    root = tempfile.mkdtemp()
    many = RelationalJob(spark, "lastdata", [table], f"{root}/many", every=2)
    for k in range(4):
        rows_of(spark, entities[15 * k : 15 * k + 15], "lastdata", 1 + 15 * k).coalesce(1).write.mode("append").parquet(f"{root}/raw{k // 2}")
        run_available(read_raw(spark, "lastdata", FileSource(f"{root}/raw{k // 2}", max_files=1)), many.handle, f"{root}/checkpoint{k // 2}")
    assert sorted((r.entityid, str(r.timeinstant), r.level) for r in many.read(table.target).collect()) == expected
