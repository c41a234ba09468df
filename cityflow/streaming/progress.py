"""Progress of streaming queries, kept as it is reported.

A listener gets the progress of every micro-batch with what was observed on its way; the functions of
`operators/metrics.py` turn it into rows of the flow log and into lag.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cityflow.operators.metrics import progress_rows
from cityflow.streaming.store import hadoop_path


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the session's queries to a folder, one small file per micro-batch.

    Listeners are told in the order of events, but after the fact: `wait` returns when all of an ended query is there.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self._ended: set[str] = set()
        self._told = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        """Nothing to keep yet."""

    def onQueryProgress(self, event) -> None:  # noqa: N802
        """Keep the progress of one micro-batch."""
        text = " ".join(event.progress.json.split("\n"))
        fs, draft = hadoop_path(self.spark, f"{self.path}/_draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        _, place = hadoop_path(self.spark, f"{self.path}/{event.progress.runId}-{event.progress.batchId}-{uuid.uuid4().hex[:8]}.json")
        fs.rename(draft, place)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """Nothing has happened."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        """All events of the query have been told."""
        with self._told:
            self._ended.add(str(event.runId))
            self._told.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the progress of an ended query is written."""
        with self._told:
            if not self._told.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no word of the end of query {query.id} within {seconds} s")

    def rows(self) -> DataFrame:
        """What has been kept, one row per micro-batch."""
        return progress_rows(self.spark.read.text(self.path, wholetext=True))
