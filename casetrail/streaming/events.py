"""Structured Streaming path for the append-only event feed.

T1: ``readStream`` of raw events -> the same staging expressions as batch -> the event log.
The stream itself drops nothing: rows that are late, or have no load time, reach the log like any
other, so the result doesn't depend on how the feed is cut into micro-batches.  A micro-batch adds
the events that the log lacks, under its batch id and their load dates; it reads the log at those
dates only and rewrites nothing (:mod:`casetrail.sources.runs`).

T2: the upload state per assignment is kept by Spark's own streaming aggregation, in update mode
on the RocksDB state store with changelog checkpoints, below a streaming deduplication by natural
key.  A micro-batch therefore gets the assignments that it changed, each with its whole state,
and appends just those; no batch reads what earlier ones stored.  The attempts are the newest
state of every assignment, and the daily funnel is built from them once the feed is drained.

A batch whose id is committed is skipped and one that failed before its commit is invisible and
replaced by its replay, so any number of triggers, restarts and replays gives what one run gives.
The deduplication remembers the keys of all upload events (32 bytes each, on the executors'
disks): a feed may repeat an event at any time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental, intermediate, marts, staging
from ..session import checkpoint_dir, spread
from ..sources import runs, sinks

STATE, DAILY = "upload_state", "file_upload_daily"
#: Settings of the stateful query.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def staged_event_stream(raw_stream: DataFrame) -> DataFrame:
    """Typed event stream."""
    return staging.stg_events(raw_stream)


def upload_state_stream(events: DataFrame) -> DataFrame:
    """The upload state of every assignment (built-in stateful operators only)."""
    uploads = events.where(intermediate.is_upload_event()).dropDuplicates(["event_natural_key"])
    return intermediate.upload_state(intermediate.upload_events(uploads))


def batch_run(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


class EventSink:
    """Adds the unseen events of each micro-batch to the log under ``root``."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = runs.last(spark, self.root)
        if before is not None and before.number > batch_id:
            return                                     # a replay of a committed batch
        run_id = batch_run(batch_id)
        rows, newest = incremental.unseen_events(
            batch, incremental.read_events(spark, self.root, before),
            f"{self.root}/_landed/{runs.RUN}={run_id}")
        mark = before.watermark if before else None
        runs.append(rows, self.root, incremental.EVENTS_TABLE, run_id, before, batch_id + 1,
                    incremental.later(mark, newest), [incremental.EVENT_PARTITION])

    def events(self, spark: SparkSession) -> DataFrame | None:
        log = incremental.read_events(spark, self.root)
        return None if log is None else log.drop(runs.RUN, incremental.EVENT_PARTITION)


class StateSink:
    """Appends the changed assignments of each micro-batch with their whole state."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = runs.last(spark, self.root)
        if before is None or before.number <= batch_id:
            runs.append(batch, self.root, STATE, batch_run(batch_id), before, batch_id + 1, None)

    def attempts(self, spark: SparkSession) -> DataFrame | None:
        """B7 rows from the newest state of every assignment (batch ids ascend)."""
        now = runs.last(spark, self.root)
        if now is None:
            return None
        schema = runs.read(spark, f"{self.root}/{STATE}", now.history[-1]).schema
        states = runs.read_log(spark, f"{self.root}/{STATE}", now.history, schema)
        newest = states.groupBy("task_assignment_id").agg(
            F.max_by(F.struct(*[c for c in schema.names if c != "task_assignment_id"]), runs.RUN)
            .alias("state"))
        return intermediate.attempts_of_state(newest.select("task_assignment_id", "state.*"))

    def refresh_daily(self, spark: SparkSession) -> None:
        """Write the daily funnel as of the newest committed batch, if there is one."""
        now = runs.last(spark, self.root)
        if now is not None:
            runs.write(marts.file_upload_daily(self.attempts(spark)), f"{self.root}/{DAILY}",
                       now.run_id)

    def daily(self, spark: SparkSession) -> DataFrame | None:
        now = runs.last(spark, self.root)
        return None if now is None else runs.read(spark, f"{self.root}/{DAILY}", now.run_id)


class UploadRefresh:
    """The tables that the stream keeps under ``root``: event log, attempts and daily funnel."""

    def __init__(self, root: str):
        self._events, self._state = EventSink(f"{root}/log"), StateSink(f"{root}/state")

    def events(self, spark: SparkSession) -> DataFrame | None:
        return self._events.events(spark)

    def attempts(self, spark: SparkSession) -> DataFrame | None:
        return self._state.attempts(spark)

    def daily(self, spark: SparkSession) -> DataFrame | None:
        return self._state.daily(spark)


def _drain(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
           mode: str) -> None:
    query = (stream.writeStream.outputMode(mode).foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def run_available(spark: SparkSession, raw_path: str, root: str,
                  refresh_marts: bool = True, max_files_per_trigger: int | None = None) -> UploadRefresh:
    """Process everything available under ``raw_path`` once (``availableNow``) and stop."""
    options = {}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    tables = UploadRefresh(root)

    def staged() -> DataFrame:
        # a micro-batch of few files would be parsed by as few tasks
        return staged_event_stream(spread(sinks.stream_raw_events(spark, raw_path, options=options)))

    _drain(staged(), tables._events, f"{root}/_checkpoint_events", "append")
    if refresh_marts:
        _drain(upload_state_stream(staged()), tables._state, f"{root}/_checkpoint_state", "update")
        tables._state.refresh_daily(spark)
    return tables


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
