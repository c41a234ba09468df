import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cityflow.operators.tables import apply_historic, apply_lastdata, apply_lastdata_fast, apply_mutable

SCHEMA = (
    "entityid string, timeinstant timestamp, a double, b string, "
    "seq struct<partition:int,offset:bigint,pos:int>, change string, present array<string>"
)
START = datetime(2024, 1, 1)


def history(n, keys, deletes=0.08, no_time=0.1, seed=1):
    """Random changes in arrival order; one key owns a third of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(keys)}"
        deleted = rng.random() < deletes
        time = None if rng.random() < no_time else START + timedelta(seconds=rng.randrange(500))
        present = ["timeinstant"] * (time is not None) + [c for c in "ab" if rng.random() < 0.7]
        a = float(i) if "a" in present and rng.random() < 0.9 else None
        b = f"b{i}" if "b" in present else None
        rows.append((key, time, a, b, (0, i, 0), "delete" if deleted else "update", present))
    return rows


def model(rows, state, partial, ties="keep"):
    """The fold one row at a time."""
    state = {k: dict(v) for k, v in state.items()}
    highest = {k: v["timeinstant"] for k, v in state.items()}
    for key, time, a, b, _, change, present in rows:
        if change == "delete":
            state.pop(key, None)
            highest.pop(key, None)
            continue
        high = highest.get(key)
        newer = time is None or high is None or (time > high if ties == "keep" else time >= high)
        if time is not None and (high is None or time > high):
            highest[key] = time
        if not newer:
            state.setdefault(key, dict.fromkeys(("timeinstant", "a", "b")))
            continue
        values = {"timeinstant": time, "a": a, "b": b}
        if partial and key in state:
            state[key].update({c: v for c, v in values.items() if c in present})
        elif partial:
            state[key] = {c: (v if c in present else None) for c, v in values.items()}
        else:
            state[key] = values
    return {k: (v["timeinstant"], v["a"], v["b"]) for k, v in state.items()}


def as_dict(df):
    return {r.entityid: (r.timeinstant, r.a, r.b) for r in df.collect()}


@pytest.mark.parametrize("partial", [False, True])
@pytest.mark.parametrize("ties", ["keep", "replace"])
def test_fold_equals_the_row_by_row_model(spark, partial, ties):
    rows = history(1500, 40)
    changes = spark.createDataFrame(rows, SCHEMA).repartition(4)
    # Small pieces, so that every key spans many of them.
    got = as_dict(apply_lastdata(None, changes, partial=partial, ties=ties, piece=37))
    assert got == model(rows, {}, partial, ties)


def test_fold_onto_a_state_in_two_batches(spark):
    rows = history(800, 20, seed=5)
    first = spark.createDataFrame(rows[:400], SCHEMA)
    second = spark.createDataFrame(rows[400:], SCHEMA)
    state = apply_lastdata(None, first, partial=False, piece=50)
    held = {r.entityid: {"timeinstant": r.timeinstant, "a": r.a, "b": r.b} for r in state.collect()}
    got = as_dict(apply_lastdata(state, second, partial=False, piece=50))
    assert got == model(rows[400:], held, False)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("partial", [False, True])
@pytest.mark.parametrize("ties", ["keep", "replace"])
def test_folds_in_any_number_of_steps_give_the_rows_of_one(spark, partial, ties, seed):
    """Also where a row without a time has replaced the one with the greatest time, and late rows follow."""
    rows = history(600, 15, deletes=0.05, no_time=0.3, seed=20 + seed)
    rng = random.Random(seed)
    borders = [0, *sorted(rng.sample(range(1, len(rows)), 5)), len(rows)]
    state = None
    for begin, end in zip(borders, borders[1:]):
        changes = spark.createDataFrame(rows[begin:end], SCHEMA)
        folded = apply_lastdata(state, changes, partial=partial, ties=ties, piece=40, with_high=True)
        state = spark.createDataFrame(folded.collect(), folded.schema)
    whole = apply_lastdata(None, spark.createDataFrame(rows, SCHEMA), partial=partial, ties=ties)
    assert as_dict(state) == as_dict(whole) == model(rows, {}, partial, ties)


def test_a_late_row_stays_late_after_a_fold(spark):
    """Times 10, none, 5: the row without a time stays, whether or not the first two were folded before."""
    rows = [("e", START + timedelta(minutes=m) if m else None, v, None, (0, i, 0), "update", ["timeinstant", "a"] if m else ["a"]) for i, (m, v) in enumerate([(10, 1.0), (None, 2.0), (5, 3.0)])]
    for partial in (False, True):
        folded = apply_lastdata(None, spark.createDataFrame(rows[:2], SCHEMA), partial=partial, with_high=True)
        late = apply_lastdata(folded, spark.createDataFrame(rows[2:], SCHEMA), partial=partial)
        assert as_dict(late) == as_dict(apply_lastdata(None, spark.createDataFrame(rows, SCHEMA), partial=partial))
        assert late.first().a == 2.0 and late.columns == ["entityid", "timeinstant", "a", "b"]


def test_fast_path_equals_the_fold(spark):
    rows = [r for r in history(800, 20, deletes=0, no_time=0, seed=3)]
    changes = spark.createDataFrame(rows, SCHEMA).withColumn("timeinstant", F.coalesce("timeinstant", F.lit(START)))
    fold = as_dict(apply_lastdata(None, changes))
    fast = as_dict(apply_lastdata_fast(None, changes.drop("change", "present")))
    assert fold == fast


def _updates(spark, rows):
    return spark.createDataFrame(
        [(k, START + timedelta(minutes=m), v, None, (0, i, 0), c, ["timeinstant", "a"]) for i, (k, m, v, c) in enumerate(rows)],
        SCHEMA,
    )


def test_out_of_order_updates_keep_the_newest(spark):
    changes = _updates(spark, [("e", 30, 1.0, "update"), ("e", 10, 2.0, "update"), ("e", 20, 3.0, "update")])
    assert as_dict(apply_lastdata(None, changes)) == {"e": (START + timedelta(minutes=30), 1.0, None)}


def test_delete_ignores_time_and_rows_may_come_back(spark):
    rows = [("x", 30, 1.0, "update"), ("x", 5, None, "delete"), ("x", 1, 2.0, "update"), ("y", 1, 1.0, "update"),
            ("y", 9, None, "delete"), ("z", 1, 9.0, "ignored")]
    assert as_dict(apply_lastdata(None, _updates(spark, rows))) == {"x": (START + timedelta(minutes=1), 2.0, None)}


def test_historic_first_write_wins(spark):
    changes = _updates(spark, [("e", 1, 1.0, "u"), ("e", 1, 2.0, "u"), ("e", 2, 3.0, "u"), ("f", 1, 4.0, "u")])
    changes = changes.drop("change", "present")
    current = _updates(spark, [("f", 1, 0.0, "u")]).drop("change", "present", "seq")
    inserted, again = apply_historic(current, changes, ["entityid", "timeinstant"])
    assert sorted((r.entityid, r.a) for r in inserted.collect()) == [("e", 1.0), ("e", 3.0)]
    assert sorted((r.entityid, r.a, r.reject.code) for r in again.collect()) == [
        ("e", 2.0, "DUPLICATE_KEY"), ("f", 4.0, "DUPLICATE_KEY"),
    ]
    everything, none = apply_historic(None, changes)
    assert (everything.count(), none.count()) == (4, 0)


def test_mutable_last_write_wins_and_partial_keeps_columns(spark):
    rows = [("e", START, 1.0, "x", (0, 0, 0), "u", ["a", "b"]), ("e", START, None, None, (0, 1, 0), "u", ["a"])]
    changes = spark.createDataFrame(rows, SCHEMA).drop("change")
    assert as_dict(apply_mutable(None, changes)) == {"e": (START, None, None)}
    assert as_dict(apply_mutable(None, changes, partial=True)) == {"e": (START, None, "x")}


def test_folds_never_gather_a_key(spark):
    changes = spark.createDataFrame(history(10, 3), SCHEMA)
    plan = apply_lastdata(None, changes)._jdf.queryExecution().executedPlan().toString()
    # Rows are exchanged on key and piece; only summaries are exchanged on the key alone.
    assert plan.count("hashpartitioning(entityid") == 2 and "_piece" in plan
    fast = apply_lastdata_fast(None, changes.drop("change", "present"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in fast and "Window" not in fast


def test_repeats_are_found_in_one_pass(spark, tmp_path):
    """Heads of pieces and repeats share a shuffle, so what the changes come from is read once."""
    spark.createDataFrame(history(500, 5, 0, 0), SCHEMA).write.parquet(str(tmp_path / "changes"))
    changes = spark.read.parquet(str(tmp_path / "changes")).drop("change", "present")
    _, again = apply_historic(None, changes, ["entityid", "timeinstant"], piece=100)
    again.collect()
    plan = again._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


def test_pieces_and_partitions(spark):
    """Repeats and stored rows are the same however the history is cut."""
    rows = history(900, 4, 0, 0)
    changes = spark.createDataFrame([(*r[:4], (i % 3, i * 50, 0)) for i, r in enumerate(rows)], SCHEMA.split(", change")[0])
    outcomes = []
    for piece in (1 << 17, 100, 7):
        inserted, again = apply_historic(None, changes, ["entityid", "timeinstant"], piece=piece)
        outcomes.append((sorted(map(repr, inserted.collect())), sorted(map(repr, again.collect()))))
    assert outcomes[0] == outcomes[1] == outcomes[2]
