"""A quality report that the writing query makes itself: its observed counts, kept for each batch."""

import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fareloom.operators.quality import OBSERVATION_NAME, Constraint, write_report
from fareloom.session import matching_paths

#: Seconds to wait for the last counts of a query that has ended.
PATIENCE = 120


class ReportKeeper(StreamingQueryListener):
    """Writes the counts that a query observes to the report table, under the query's own batch numbers.

    Rows are counted as the query writes them, so nothing is scanned again. The counts come with the progress, right after the
    batch is committed; were the driver lost in between, the next start marks the batch as unknown. A report that cannot
    be written stops the query, and ``finish`` raises what went wrong.
    """

    def __init__(self, spark: SparkSession, folder: str, checkpoint: str, constraints: Sequence[Constraint]) -> None:
        self.spark, self.folder, self.constraints = spark, folder.rstrip("/"), constraints
        self.name = f"report-{uuid.uuid4().hex}"
        self.error: Exception | None = None
        self._run_id = ""
        self._ended = threading.Event()
        self._mark_lost(checkpoint)
        spark.streams.addListener(self)

    def _mark_lost(self, checkpoint: str) -> None:
        batches = lambda pattern: {path.rsplit("/", 1)[-1].rsplit("=", 1)[-1] for path in matching_paths(self.spark, pattern)}
        written = batches(f"{checkpoint.rstrip('/')}/commits/[0-9]*")
        for batch in sorted(written - batches(f"{self.folder}/batch_id=*"), key=int):
            write_report(self.spark, self.folder, int(batch), [(c.name, None, None) for c in self.constraints])

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(OBSERVATION_NAME) if progress.name == self.name else None
        if counts is None or self.error:
            return
        try:
            rows = [(c.name, counts[f"passed_{i}"], counts["total"]) for i, c in enumerate(self.constraints)]
            write_report(self.spark, self.folder, progress.batchId, rows)
        except Exception as error:
            self.error = error
            # Not from this thread: the query may be waiting for it.
            threading.Thread(target=self._stop, args=(str(progress.id),), daemon=True).start()

    def _stop(self, query_id: str) -> None:
        query = self.spark.streams.get(query_id)
        if query is not None:
            query.stop()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run_id:
            self._ended.set()

    def finish(self, query: StreamingQuery) -> None:
        """Wait until the query has ended and its last counts are kept."""
        try:
            query.awaitTermination()
            if not self._ended.wait(PATIENCE):
                raise TimeoutError("the last counts of the report did not come")
        finally:
            self.spark.streams.removeListener(self)
        if self.error:
            raise RuntimeError(f"the quality report could not be kept in {self.folder}") from self.error
