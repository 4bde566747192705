"""Counts of a stream's micro-batches, as metrics.

A stage of a stream names an observation (``DataFrame.observe``), which Spark counts while the rows pass; a
listener gets the counts with each micro-batch's progress and writes them to the ``metrics`` table, a
row a count. A batch has a folder of its own there (run ``<query id>-counts``), so a batch that is run
again after a restart replaces its counts. Micro-batches without rows are passed over.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tsquality.operators import tables as T

#: The meter that counts of a whole micro-batch stand under, as metrics of unreadable payloads do.
NO_METER = "unknown"


def observe_errors(validated: DataFrame, name: str = "validation") -> DataFrame:
    """``validated`` (operators.validate, or parsed messages: ``error`` is null when valid), counting its rows
    (``rows``), the invalid ones (``invalid``) and, of these, payloads that could not be parsed (``unparsed``)."""
    error = F.col("error")
    return validated.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(error.isNotNull()).alias("invalid"),
                             F.count_if(error.startswith("processing_error")).alias("unparsed"))


class BatchCounts(StreamingQueryListener):
    """Writes the observed counts of the query ``query_name`` to ``<out_dir>/metrics``: metric types are
    ``<observation>_<count>`` and the tags hold the batch."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.session, self.path = spark, f"{out_dir}/metrics"
        self.query_name = f"counts-{uuid.uuid4().hex}"
        self._ended, self._run, self.error = threading.Event(), None, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.query_name:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.query_name or not p.observedMetrics:
            return
        counts = [(f"{name}_{k}", float(v)) for name, row in sorted(p.observedMetrics.items()) for k, v in row.asDict().items()]
        if not any(v for _, v in counts):
            return
        try:
            rows = self.session.createDataFrame(counts, "metric_type STRING, value DOUBLE").coalesce(1).select(
                F.lit(p.timestamp).cast("timestamp").alias("time"), "metric_type", F.lit(NO_METER).alias("meter_id"), "value",
                F.create_map(F.lit("batch"), F.lit(str(p.batchId))).alias("tags"), F.monotonically_increasing_id().alias("seq"))
            T.write_batch(rows, self.path, "metrics", p.batchId, f"{p.id}-counts")
        except Exception as e:  # Spark only logs what a listener raises
            self.error = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self._ended.set()

    def wait(self, seconds: float = 120) -> None:
        """Until the counts of the ended query are all written; events come after the batches."""
        try:
            if not self._ended.wait(seconds):
                raise TimeoutError("the query's last event has not come")
            if self.error:
                raise self.error
        finally:
            self.session.streams.removeListener(self)


def counted(spark: SparkSession, out_dir: str) -> BatchCounts:
    """A listener for the next query, which must be started with its ``query_name``."""
    listener = BatchCounts(spark, out_dir)
    spark.streams.addListener(listener)
    return listener
