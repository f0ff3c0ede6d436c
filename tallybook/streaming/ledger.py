"""What the batches of a stream left out or found at fault, counted over the stream's whole life.

Spark keeps the progress of the last hundred batches only, and none of those before a restart. A listener notes every
batch that left rows out, or whose observed checks failed, in a small file beside the checkpoint, named by the batch: a
batch that is run again counts once, and a resumed stream goes on counting.
"""

from __future__ import annotations

import json
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tallybook.streaming.files import put

LATE, REPEATED = "late", "repeated"
#: Seconds that a stream's last events may take to reach the listener.
PATIENCE = 120

_NOTE = "batch long, what string, rows long"


class Ledger(StreamingQueryListener):
    """Notes the batches of the query called ``name``, which writes to ``checkpoint``."""

    def __init__(self, spark: SparkSession, checkpoint: str, name: str):
        self.spark, self.path, self.name = spark, f"{checkpoint}/ledger", name
        self._ended: set[str] = set()
        self._news = threading.Condition()
        self._fault: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name:
            return
        counts = {LATE: 0, REPEATED: 0}
        for state in progress.stateOperators:
            counts[LATE] += state.numRowsDroppedByWatermark
            counts[REPEATED] += int(state.customMetrics.get("numDroppedDuplicateRows", 0))
        for metrics in progress.observedMetrics.values():
            for check, violations in metrics.asDict().items():
                counts[check] = counts.get(check, 0) + (violations or 0)
        notes = [{"batch": progress.batchId, "what": what, "rows": n} for what, n in counts.items() if n]
        if notes:
            try:
                put(self.spark, f"{self.path}/batch-{progress.batchId}.json", "\n".join(map(json.dumps, notes)) + "\n")
            except Exception as fault:  # noqa: BLE001 - raised where the run is waited for
                self._fault = fault

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait(self, query: StreamingQuery) -> None:
        """Until all events of a query that has ended are noted."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, PATIENCE):
                raise RuntimeError("the stream's progress was not reported to its end")
        if self._fault:
            raise self._fault


def counted(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """Rows by what befell them: late, repeated, or the name of an observed check that they violate."""
    try:
        notes = spark.read.schema(_NOTE).json(f"{checkpoint}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {row["what"]: row["n"] for row in notes.groupBy("what").agg(F.sum("rows").alias("n")).collect()}
