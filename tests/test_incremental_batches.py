"""Full refresh == incremental refresh over arriving batches (SURVEY section 5 (c)).

The feed of the smallest scale factor arrives in five chunks of load days;
a third of the events arrive one day late (still inside the 2-day lookback).
After each arrival the staged events, upload attempts and the daily funnel
mart are refreshed incrementally and stored as new table versions.
"""

from pyspark.sql import functions as F

from casetrail.functions.casts import safe_timestamp
from casetrail.operators import incremental, intermediate, marts, staging
from casetrail.sources import sinks
from casetrail.sources.fixtures import RawSources
from casetrail.streaming import events as streaming


def _bag(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_batches_equal_full_refresh(spark, sf_small, scratch):
    raw = RawSources(spark, sf_small).events
    day = F.datediff(F.to_date(safe_timestamp("ingestion_timestamp")), F.lit("2024-01-01"))
    late = (F.crc32(F.col("event_properties")) % 3 == 0).cast("int")
    arrival = F.coalesce(F.floor((day + late) / 6), F.lit(0))       # chunk of 6 load days
    landed = raw.withColumn("chunk", arrival)
    chunks = sorted(r.chunk for r in landed.select("chunk").distinct().collect())
    assert len(chunks) >= 4

    t_events, t_attempts, t_daily = (f"{scratch}/{n}" for n in ("events", "attempts", "daily"))
    for c in chunks:
        feed = landed.where(F.col("chunk") <= c).drop("chunk")
        prev_events = sinks.read_current(spark, t_events)
        sinks.write_version(incremental.stage_events(feed, prev_events), t_events)
        events = sinks.read_current(spark, t_events)

        prior = sinks.read_current(spark, t_attempts)
        changed = None if prior is None else incremental.changed_upload_assignments(events, prior)
        sinks.write_version(incremental.upload_attempts(events, prior), t_attempts)
        attempts = sinks.read_current(spark, t_attempts)

        daily = sinks.read_current(spark, t_daily)
        sinks.write_version(incremental.upload_daily(attempts, daily, prior_attempts=prior,
                                                     changed_assignments=changed), t_daily)

    full_events = staging.stg_events(raw)
    full_attempts = intermediate.file_upload_attempts(full_events)
    full_daily = marts.file_upload_daily(full_attempts)
    assert _bag(sinks.read_current(spark, t_events), ["event_natural_key"]) == \
        _bag(full_events, ["event_natural_key"])
    cols = full_attempts.columns
    assert _bag(sinks.read_current(spark, t_attempts), cols) == _bag(full_attempts, cols)
    cols = full_daily.columns
    assert _bag(sinks.read_current(spark, t_daily), cols) == _bag(full_daily, cols)


def test_logs_over_batches_equal_full_refresh(spark, sf_small, scratch):
    """Same arrival as above through the run tables: the event log, and the streaming sinks."""
    raw = RawSources(spark, sf_small).events
    day = F.datediff(F.to_date(safe_timestamp("ingestion_timestamp")), F.lit("2024-01-01"))
    late = (F.crc32(F.col("event_properties")) % 3 == 0).cast("int")
    landed = raw.withColumn("chunk", F.coalesce(F.floor((day + late) / 10), F.lit(0)))
    chunks = sorted(r.chunk for r in landed.select("chunk").distinct().collect())

    for c in chunks:
        feed = landed.where(F.col("chunk") <= c).drop("chunk")
        incremental.stage_events_into(feed, f"{scratch}/batch")
        feed.write.mode("append").parquet(f"{scratch}/raw")     # overlaps all earlier batches
        sink = streaming.run_available(spark, f"{scratch}/raw", f"{scratch}/stream")

    full_events = staging.stg_events(raw)
    full_attempts = intermediate.file_upload_attempts(full_events)
    full_daily = marts.file_upload_daily(full_attempts)
    keys = ["event_natural_key"]
    batch_events = incremental.read_events(spark, f"{scratch}/batch")
    assert _bag(batch_events, keys) == _bag(full_events, keys) == _bag(sink.events(spark), keys)
    cols = full_attempts.columns
    assert _bag(sink.attempts(spark), cols) == _bag(full_attempts, cols)
    cols = full_daily.columns
    assert _bag(sink.daily(spark), cols) == _bag(full_daily, cols)
