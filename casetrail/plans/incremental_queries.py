"""Registered incremental runs (I1-I7): build from an earlier batch, then upsert the rest.

The event feed is split at the midpoint of its load times (a scalar
subquery over the data).  The first batch -- everything loaded
before the midpoint, plus rows without a load time -- builds the existing
target, which is written as a table under the shared checkpoint folder, as the
stored target would be.  The incremental function then runs over the whole feed and
upserts into it.  The oracle for each key is the *full-refresh* SQL: the
incremental result must equal a rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import safe_timestamp
from ..operators import incremental, intermediate, staging
from . import oracle
from .models import Models
from .registry import query


def first_batch(raw_events: DataFrame) -> DataFrame:
    """Raw events loaded before the midpoint of all load times (or never stamped)."""
    t = safe_timestamp("ingestion_timestamp")
    cut = raw_events.select(F.timestamp_seconds(
        F.floor((F.unix_seconds(F.min(t)) + F.unix_seconds(F.max(t))) / 2))).scalar()
    return raw_events.where((t < cut) | t.isNull())


def stored(df: DataFrame) -> DataFrame:
    """Materialise an existing target as a table written in the shared checkpoint folder."""
    from .refresh import table_store
    return table_store(df.sparkSession)("target", df)


class IncrementalRun:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.m = Models.shared(spark, sf_dir)
        raw = self.m.raw
        self.events_then = staging.stg_events(first_batch(raw.events))
        self.events_now = self.m.stg_events
        self.static = (self.m.stg_assignments, self.m.stg_tasks, self.m.stg_cases)


@query("incr_stage_events", oracle.model("stg_events"))
def q_incr_stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events upserted from the whole feed into the first batch."""
    run = IncrementalRun(spark, sf_dir)
    target = stored(run.events_then)
    return incremental.stage_events(run.m.raw.events, target)


@query("incr_upload_attempts", oracle.model("file_upload_attempts"))
def q_incr_upload_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed assignments re-aggregated from all their events."""
    run = IncrementalRun(spark, sf_dir)
    target = stored(intermediate.file_upload_attempts(run.events_then))
    return incremental.upload_attempts(run.events_now, target)


@query("incr_questionnaire_assignments", oracle.model("questionnaire_assignments"))
def q_incr_questionnaire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments whose two-source watermark moved, upserted."""
    run = IncrementalRun(spark, sf_dir)
    a, t, c = run.static
    target = stored(intermediate.questionnaire_assignments(a, t, c, run.events_then))
    return incremental.questionnaire_assignments(a, t, c, run.events_now, target)


@query("incr_upload_daily", oracle.model("file_upload_daily"))
def q_incr_upload_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Touched date x product groups rebuilt, vacated groups repaired."""
    run = IncrementalRun(spark, sf_dir)
    prior = stored(intermediate.file_upload_attempts(run.events_then))
    from ..operators import marts
    target = stored(marts.file_upload_daily(prior))
    attempts = incremental.upload_attempts(run.events_now, prior)
    changed = incremental.changed_upload_assignments(run.events_now, prior)
    return incremental.upload_daily(attempts, target, prior_attempts=prior,
                                    changed_assignments=changed)


@query("incr_questionnaire_daily", oracle.model("questionnaire_daily"))
def q_incr_questionnaire_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 for the questionnaire mart."""
    run = IncrementalRun(spark, sf_dir)
    a, t, c = run.static
    from ..operators import marts
    prior = stored(intermediate.questionnaire_assignments(a, t, c, run.events_then))
    target = stored(marts.questionnaire_daily(prior))
    now = incremental.questionnaire_assignments(a, t, c, run.events_now, prior)
    return incremental.questionnaire_daily(now, target, prior_assignments=prior)


def _stream_from_tables(spark: SparkSession, sf_dir: str, refresh_marts: bool, files: int = 0):
    """Land the feed as files for the file stream source (derived from the driver tables).

    With ``files`` it lands in that many files that mix all load days, one per trigger.
    """
    from ..streaming import events as streaming
    root = streaming.scratch_root(spark, "stream")
    raw_path = f"{root}/raw_events"
    feed = Models.shared(spark, sf_dir).raw.events
    if files:
        feed = feed.repartition(files, F.xxhash64("event_properties", "event_time"))
    feed.write.mode("overwrite").parquet(raw_path)
    sink = streaming.run_available(spark, raw_path, root, refresh_marts=refresh_marts,
                                   max_files_per_trigger=1 if files else None)
    return sink.daily(spark) if refresh_marts else sink.events(spark)


@query("stream_stage_events", oracle.model("stg_events"))
def q_stream_stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed through readStream and a foreachBatch upsert by natural key."""
    return _stream_from_tables(spark, sf_dir, refresh_marts=False)


@query("stream_many_triggers", oracle.model("stg_events"))
def q_stream_many_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed in files that mix all days, one file per trigger."""
    return _stream_from_tables(spark, sf_dir, refresh_marts=False, files=6)


@query("stream_daily_many_triggers", oracle.model("file_upload_daily"))
def q_stream_daily_many_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart after many triggers over mixed files."""
    return _stream_from_tables(spark, sf_dir, refresh_marts=True, files=4)


@query("stream_upload_daily", oracle.model("file_upload_daily"))
def q_stream_upload_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batch refresh of attempts and the daily funnel mart."""
    return _stream_from_tables(spark, sf_dir, refresh_marts=True)


def earlier_frames(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables as an earlier run may have seen them: the first batch of events without
    half of the never stamped ones, a third of the tasks under other names, no case deleted and
    some cases deleted that are not any more.  None of these changes moves a load time."""
    events = first_batch(raw["wf_events"])
    unstamped = safe_timestamp("ingestion_timestamp").isNull()
    some = F.crc32(F.col("event_properties").cast("binary")) % 2 == 0
    task_name = F.when(F.col("id") % 3 == 0, F.concat("name", F.lit(" (old)"))).otherwise(F.col("name"))
    gone = F.when(F.col("id") % 11 == 0, F.col("created_at"))
    return {**raw, "wf_events": events.where(~(unstamped & some)),
            "wf_task": raw["wf_task"].withColumn("name", task_name),
            "wf_case": raw["wf_case"].withColumn("deleted_at", gone)}


@query("refresh_two_runs", oracle.with_models("""
select 'file_upload_daily' as mart, * from file_upload_daily
union all by name
select 'questionnaire_daily' as mart, * from questionnaire_daily"""))
def q_refresh_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gated pipeline over landed raw tables, first as they were earlier and
    then as they are; the second run merges into the first by what differs."""
    from ..session import shuffles_dropped
    from ..sources import runs
    from ..sources.sinks import SOURCE_OF_FRAME, RawTables
    from ..streaming.events import scratch_root
    from . import refresh
    root = scratch_root(spark, "pipeline")
    raw = Models.shared(spark, sf_dir).raw.frames()
    then = earlier_frames(raw)
    changed = [name for name in SOURCE_OF_FRAME if then[name] is not raw[name]]
    early, now = {}, {}
    for name, source in SOURCE_OF_FRAME.items():
        now[source] = f"{root}/raw/{source}"
        early[source] = f"{root}/raw/early_{source}" if name in changed else now[source]

    def land(frames: dict[str, DataFrame], names: list[str], paths: dict[str, str]) -> None:
        with shuffles_dropped(spark):
            for name in names:
                path = paths[SOURCE_OF_FRAME[name]]
                frames[name].write.option("compression", "zstd").parquet(path)

    def run(paths: dict[str, str]) -> None:
        # the given tables are old and dirty on purpose: no freshness by today's clock, no gate
        refresh.run_layers(spark, RawTables.read(spark, paths), f"{root}/out",
                           fail_on_error=False, error_after_hours=None)

    land(then, list(SOURCE_OF_FRAME), early)
    run(early)
    for name in changed:                                   # what the source was is landed over
        runs.drop(spark, early[SOURCE_OF_FRAME[name]])
    land(raw, changed, now)
    run(now)
    built = refresh.read_run(spark, f"{root}/out")
    return (built["file_upload_daily"].withColumn("mart", F.lit("file_upload_daily"))
            .unionByName(built["questionnaire_daily"].withColumn(
                "mart", F.lit("questionnaire_daily")), allowMissingColumns=True))
