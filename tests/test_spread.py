import glob

from pyspark.sql import functions as F

from cityflow.plans import adapter as A
from cityflow.plans.queries import _arrive


def test_rows_of_one_file_are_decoded_on_all_cores(spark, tmp_path):
    spark.range(2000).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    rows = A.source(spark, str(tmp_path), "orders")
    sizes = [len(p) for p in rows.rdd.glom().collect()]
    assert len(sizes) >= A.cores(spark) >= 4 and min(sizes) > 0
    assert sorted(r.id for r in rows.collect()) == list(range(2000))


def test_events_are_rendered_on_all_cores(spark, tmp_path):
    rows = spark.range(2000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds("id").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.lit('{"k":1}').alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    raw = A.events_raw(spark, str(tmp_path))
    assert raw.rdd.getNumPartitions() >= 4 and raw.select("offset").distinct().count() == 2000


def test_every_step_arrives_as_a_file_for_each_core(spark, tmp_path):
    records = spark.range(2000).select(F.col("id").alias("offset"))
    _arrive(records, f"{tmp_path}/raw", steps=3)
    assert len(glob.glob(f"{tmp_path}/raw/*.parquet")) == 3 * A.cores(spark)
    assert spark.read.parquet(f"{tmp_path}/raw").distinct().count() == 2000
