import pytest
from pyspark.sql import functions as F

from cityflow.operators import decode
from cityflow.operators.expect import reconcile, reconcile_flagged
from cityflow.plans.queries import registry


@pytest.mark.parametrize("name", ["batch_isolation", "reconcile_counts", "historic_partitions"])
def test_rows_are_decoded_once(spark, name):
    rows = registry()[name](spark, "/root/testdata/sf0.001")
    rows.collect()
    # A shuffle that is used again is not listed with what is below it.
    ran = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ran.count("FileScan parquet") == 1


def test_counts_of_flagged_rows_are_those_of_the_parts(spark):
    rows = spark.createDataFrame(
        [("a", None), ("a", "x"), ("b", None), ("c", "y"), ("c", "y")], "target string, why string"
    ).withColumn("reject", F.when(F.col("why").isNotNull(), decode.rejection("s", F.col("why"), "e")))
    apart = reconcile(rows, decode.accepted(rows), decode.rejected(rows))
    assert sorted(reconcile_flagged(rows).collect()) == sorted(apart.collect())
