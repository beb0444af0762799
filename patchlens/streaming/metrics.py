"""Counts that a job takes in passing, kept as a table of its micro-batches."""

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRICS = "at timestamp, rows_read long, ms long, metric string, value long"


class BatchMetrics(StreamingQueryListener):
    """Stores what ``observe`` counted under ``name`` in each micro-batch of any query of the session, below ``out``.

    The counts run with the batch's own job, such as ``observe_pushes`` ahead of ``flatten_push``. A batch has
    one folder, so a batch that is done again replaces its counts. Spark reports a batch after its commit: the
    counts of a batch are lost if the driver dies in between, its rows are not. Counts are of what was
    computed, so a batch that is read more than once should be persisted by its job, as ``run_stream`` does.

    Use it as a context, which adds it to the session and takes it off again; ``wait`` for a query's last batch.
    """

    def __init__(self, spark: SparkSession, out: str, name: str = "pushes"):
        self.spark, self.out, self.name = spark, out, name
        self.seen: dict[str, int] = {}

    def __enter__(self) -> "BatchMetrics":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counted = (progress.observedMetrics or {}).get(self.name)
        if counted is not None and progress.numInputRows:
            at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
            rows = [(at, progress.numInputRows, progress.batchDuration, k, v) for k, v in counted.asDict().items()]
            target = f"{self.out}/stream_id={progress.id}/batch_id={progress.batchId}"
            self.spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("overwrite").parquet(target)
        self.seen[str(progress.id)] = progress.batchId

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the last batch of a query that has ended is stored."""
        last = query.lastProgress
        end = time.monotonic() + seconds
        while last is not None and self.seen.get(str(query.id), -1) < last["batchId"]:
            if time.monotonic() > end:
                raise TimeoutError(f"batch {last['batchId']} was not reported")
            time.sleep(0.1)


def batch_metrics(spark: SparkSession, out: str) -> DataFrame:
    """(stream_id, batch_id, at, rows_read, ms, metric, value), a row for each batch and count."""
    return spark.read.schema(f"{METRICS}, stream_id string, batch_id long").parquet(out)
