"""Structured Streaming over small landed files: batch boundaries, replays, crashes."""

import json
import re

import pytest

from casetrail.operators import incremental, intermediate, marts, staging
from casetrail.sources import runs
from casetrail.streaming import events as streaming

SCHEMA = "event_time string, ingestion_timestamp string, event_type string, event_properties string"
NAMES = ["cw_task_plugin_opened", "cw_doc_upload_started", "cw_doc_upload_completed"]


def rows(days, offset=0):
    out = []
    for i, d in enumerate(days):
        payload = {"task_assignment_id": str(offset + i % 4), "actor_role": "Beneficiary",
                   "task_plugin_type": "file_upload", "catalog_product_id": str(i % 2),
                   "file_count": 2, "success_count": i % 3}
        loaded = f"2024-01-{d:02d} 11:00:00" if d else "null"
        out.append((f"2024-01-{max(d, 1):02d} 10:00:00", loaded, NAMES[i % 3], json.dumps(payload)))
    return out


def bag(df):
    cols = sorted(df.columns)
    return sorted(repr([r[c] for c in cols]) for r in df.collect())


def full(spark, feed):
    events = staging.stg_events(spark.createDataFrame(feed, SCHEMA)).dropDuplicates(["event_natural_key"])
    return events, marts.file_upload_daily(intermediate.file_upload_attempts(events))


FEED = rows([1, 2, 3, 4, 5, 6]) + rows([20, 6, 1, 7, 0, 28], 2) + rows([0, 0, 3, 9], 1)
FEED += [FEED[0], FEED[7], FEED[10], FEED[10]]         # copies, with and without a load time


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [2, 4, 0, 3, 1]])
def test_result_does_not_depend_on_batches(spark, scratch, order):
    chunks = [FEED[i::5] for i in range(5)]
    for i in order:                                     # one file per arrival, far out of order
        spark.createDataFrame(chunks[i], SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
    sink = streaming.run_available(spark, f"{scratch}/raw", f"{scratch}/out", max_files_per_trigger=1)
    events, daily = full(spark, FEED)
    assert bag(sink.events(spark).select("event_natural_key")) == bag(events.select("event_natural_key"))
    assert bag(sink.daily(spark)) == bag(daily)
    # nothing new: the tables stay as they are
    streaming.run_available(spark, f"{scratch}/raw", f"{scratch}/out")
    assert bag(sink.daily(spark)) == bag(daily)


def test_arrivals_between_runs(spark, scratch):
    for part in (FEED[:9], FEED[9:]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(f"{scratch}/raw")
        sink = streaming.run_available(spark, f"{scratch}/raw", f"{scratch}/out")
    assert bag(sink.daily(spark)) == bag(full(spark, FEED)[1])


@pytest.mark.parametrize("step", ["commit:log", "write:upload_state", "commit:state"])
def test_a_crash_at_any_step_and_a_restart(spark, scratch, monkeypatch, step):
    """The second part of the feed fails at one step; the stream is started again."""
    def land(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/raw")

    def run():
        return streaming.run_available(spark, f"{scratch}/raw", f"{scratch}/out")
    land(FEED[:9])
    sink = run()
    before, events_before = bag(sink.daily(spark)), sink.events(spark).count()
    land(FEED[9:])
    write, commit = runs.write, runs.commit

    def failing_write(df, table, *a, **k):
        done = write(df, table, *a, **k)
        if step == f"write:{table.rsplit('/', 1)[1]}":
            raise OSError("lost")
        return done

    def failing_commit(spark, root, run):
        if step == f"commit:{root.rsplit('/', 1)[1]}":
            raise OSError("lost")
        return commit(spark, root, run)
    with monkeypatch.context() as m:
        m.setattr(runs, "write", failing_write)
        m.setattr(runs, "commit", failing_commit)
        with pytest.raises(Exception, match="lost"):
            run()
    if step == "commit:log":
        assert sink.events(spark).count() == events_before       # nothing half done is visible
        assert bag(sink.daily(spark)) == before
    events, daily = full(spark, FEED)
    run()
    assert sink.events(spark).count() == events.count()
    assert bag(sink.daily(spark)) == bag(daily)


def test_a_replayed_batch_changes_nothing(spark, scratch):
    sink = streaming.EventSink(f"{scratch}/log")
    batch = staging.stg_events(spark.createDataFrame(FEED, SCHEMA))
    sink(batch, 0)
    files = sink.events(spark).inputFiles()
    sink(batch, 0)                                       # committed: skipped
    sink(batch, 1)                                       # the same rows again: nothing unseen
    assert sorted(sink.events(spark).inputFiles()) == sorted(files)


def test_a_state_batch_reads_no_stored_state(spark, scratch, monkeypatch):
    """A micro-batch appends the changed assignments alone and scans none of the sink's tables."""
    plans = []
    write = runs.write

    def watching(df, table, *a, **k):
        plans.append((table, df._jdf.queryExecution().executedPlan().toString(), df.count()))
        return write(df, table, *a, **k)
    parts = [rows([1, 2, 3, 4], 10 * i) for i in range(3)] + [rows([5], 10)]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
    monkeypatch.setattr(runs, "write", watching)
    sink = streaming.run_available(spark, f"{scratch}/raw", f"{scratch}/out", max_files_per_trigger=1)
    states = [(plan, n) for table, plan, n in plans if table.endswith("/upload_state")]
    assert sorted(n for _, n in states if n) == [1, 4, 4, 4]      # only what each batch changed
    assert all("upload_state" not in plan for plan, _ in states)
    feed = [r for part in parts for r in part]
    assert bag(sink.daily(spark)) == bag(full(spark, feed)[1])


def test_two_writers_do_not_mix(spark, scratch):
    """Two runs from the same state: each is consistent, one is current."""
    def add(run_id, day):
        before = runs.last(spark, scratch)
        rows_of_run = staging.stg_events(spark.createDataFrame(rows([day]), SCHEMA))
        unseen, newest = incremental.unseen_events(
            rows_of_run, incremental.read_events(spark, scratch, before), f"{scratch}/_landed/{run_id}")
        return lambda: runs.append(unseen, scratch, "stg_events", run_id, before,
                                   before.number + 1 if before else 1, newest, ["ingestion_date"])
    add("a", 1)()
    one, two = add("b", 2), add("c", 3)
    two()
    one()
    days = {r.ingestion_date.day for r in incremental.read_events(spark, scratch).collect()}
    assert runs.last(spark, scratch).run_id == "c" and days == {1, 3}


def test_retention_and_compaction(spark, scratch):
    import datetime as dt
    for day in (1, 2, 3):
        incremental.stage_events_into(spark.createDataFrame(rows([day, day]), SCHEMA), scratch)
    runs.write(spark.range(1), f"{scratch}/stg_events", "unfinished")
    before = bag(incremental.read_events(spark, scratch).drop("run_id"))
    tables = ["stg_events", "_landed"]
    assert [d for d in runs.forget(spark, scratch, tables, keep=1) if "stg" in d] == []
    schema = incremental.event_schema(spark)
    runs.compact(spark, scratch, "stg_events", schema, ["ingestion_date"])
    assert len(runs.last(spark, scratch).history) == 1
    dropped = runs.forget(spark, scratch, tables, keep=1)
    assert len([d for d in dropped if d.startswith("stg_events/")]) == 3  # the compacted runs
    gone = runs.forget(spark, scratch, tables, keep=1, unfinished_after=dt.timedelta(0))
    assert gone == ["stg_events/unfinished"]
    assert bag(incremental.read_events(spark, scratch).drop("run_id")) == before


def test_a_batch_reads_and_writes_only_its_own_dates(spark, scratch):
    incremental.stage_events_into(spark.createDataFrame(rows(range(1, 11)), SCHEMA), scratch)
    before = set(incremental.read_events(spark, scratch).inputFiles())
    changed = rows(range(1, 11)) + rows([9], 5)
    seen = incremental.read_events(spark, scratch)
    unseen, _ = incremental.unseen_events(
        staging.stg_events(spark.createDataFrame(rows([9], 5), SCHEMA)), seen, f"{scratch}/landing")
    plan = unseen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date#\d+ = 2024-01-09", plan)
    incremental.stage_events_into(spark.createDataFrame(changed, SCHEMA), scratch)
    added = set(incremental.read_events(spark, scratch).inputFiles()) - before
    assert {f.rsplit("ingestion_date=", 1)[1][:10] for f in added} == {"2024-01-09"}
    assert before <= set(incremental.read_events(spark, scratch).inputFiles())


def test_a_batch_of_one_file_is_parsed_by_many_tasks(spark, scratch, monkeypatch):
    spark.createDataFrame(FEED, SCHEMA).coalesce(1).write.parquet(f"{scratch}/raw")
    seen = []
    staged = streaming.staged_event_stream

    def watched(raw):
        seen.append(raw._jdf.queryExecution().analyzed().toString())
        return staged(raw)

    monkeypatch.setattr(streaming, "staged_event_stream", watched)
    sink = streaming.run_available(spark, f"{scratch}/raw", f"{scratch}/out", refresh_marts=False)
    assert len(seen) == 1 and seen[0].lstrip("~").startswith("RepartitionByExpression")
    assert sink.events(spark).count() == full(spark, FEED)[0].count()
