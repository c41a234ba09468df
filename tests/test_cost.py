"""What a row costs: expressions that are made once, and work that is left out where nothing needs it."""

from pyspark.sql import functions as F

from cityflow.functions.binding import bind
from cityflow.functions.times import iso_timestamp
from cityflow.operators.contract import catalogue, contract, to_wide
from cityflow.plans import adapter as A
from cityflow.plans.flows import entities_of, flagged_entities
from cityflow.plans.queries import _geojson_entities

SF = "/root/testdata/sf0.001"


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_a_bound_value_is_made_by_a_projection(spark):
    """A generator would interpret the whole value as soon as one of its functions has no generated code."""
    made = bind(spark.range(5), "x", F.transform(F.array("id"), lambda v: v + 1))
    generators = [line for line in plan_of(made).splitlines() if "Generate" in line]
    assert len(generators) == 1 and "transform" not in generators[0]
    assert sorted((r.id, r.x) for r in made.collect()) == [(i, [i + 1]) for i in range(5)]


def test_the_text_of_a_time_is_made_once(spark):
    rows = spark.createDataFrame([("2031-W05-3",), ("2031-123",), ("nothing",)], "t string").withColumn("v", F.to_variant_object(F.array("t")))
    read = rows.select(iso_timestamp(F.try_variant_get("v", "$[0]", "string")).cast("string").alias("ts"))
    assert read._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get") == 1
    assert [r.ts for r in read.collect()] == ["2031-01-29 00:00:00", "2031-05-03 00:00:00", None]


def test_places_are_read_on_all_cores(spark):
    assert _geojson_entities(spark, SF).rdd.getNumPartitions() >= A.cores(spark)


def test_a_number_is_taken_once_from_its_variant(spark):
    table = contract("default._line", {"n": "integer", "t": "text", "d": "numeric(30,15)"}, with_time=False)
    wide = to_wide(entities_of(A.lineitem_raw(spark, SF)), table).select("n", "t", "d")
    # Numbers for n, t and d, strings for t and the three columns of the entity itself.
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get") == 7


def test_attributes_of_rows_without_a_table_are_not_typed(spark):
    known = catalogue(spark, [contract("city.devices_user_lastdata", {"value": "double precision"}, ["entityid"])])
    other = catalogue(spark, [contract("city.other_lastdata", {}, ["entityid"])])
    for tables, typed in ((known, True), (other, False)):
        rows = flagged_entities(A.events_raw(spark, SF), tables, "lastdata", received=A.received())
        assert {r[0] for r in rows.select(F.col("attrs").isNotNull()).distinct().collect()} == {typed}
    assert {r[0] for r in rows.select("reject.code").distinct().collect()} == {"TABLE_MISSING"}
