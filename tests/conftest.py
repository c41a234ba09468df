import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cityflow import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def raw_rows(spark, values, flow="historic", headers=None, first_offset=1):
    """Raw records with the given bodies (objects are written as JSON), offsets counting up."""
    import json

    from cityflow.sources.raw import RAW_SCHEMA

    rows = []
    for i, value in enumerate(values):
        text = value if isinstance(value, str) or value is None else json.dumps(value, ensure_ascii=False)
        rows.append((flow, f"raw_{flow}", 0, first_offset + i, None, None, text, headers))
    return spark.createDataFrame(rows, RAW_SCHEMA)


HEADERS = [("fiware-service", b"test"), ("fiware-servicepath", b"/date")]
