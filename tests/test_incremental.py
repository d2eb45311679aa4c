"""Incremental refresh vs full refresh (late data, vacated groups, replays)."""

import datetime as dt
import json

from casetrail.operators import incremental, intermediate, marts
from casetrail.sources import sinks

from .test_intermediate import EV_SCHEMA, OPEN, START

EV = dt.datetime


def e(aid, name, day, ing_day, product="p1"):
    return (aid, "t", "c", product, name, EV(2024, 1, day, 12), EV(2024, 1, ing_day, 12),
            1, 1, 0, "beneficiary", "file_upload")


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_late_within_lookback_and_too_late(spark):
    first = spark.createDataFrame([e("a", OPEN, 1, 10), e("b", OPEN, 2, 2)], EV_SCHEMA)
    target = intermediate.file_upload_attempts(first)            # watermark: Jan 10 - 2 days
    late_ok = e("a", START, 3, 9)                                 # ingested Jan 9 >= Jan 8
    too_late = e("b", START, 3, 5)                                # ingested Jan 5 < Jan 8
    allev = spark.createDataFrame([e("a", OPEN, 1, 10), e("b", OPEN, 2, 2), late_ok, too_late],
                                  EV_SCHEMA)
    out = {r.task_assignment_id: r for r in incremental.upload_attempts(allev, target).collect()}
    assert out["a"].started_upload == 1
    assert out["b"].started_upload == 0        # same as the reference: not re-read


def test_vacated_group_repair(spark):
    first = spark.createDataFrame([e("a", OPEN, 5, 10, "p1"), e("b", OPEN, 5, 2, "p1")], EV_SCHEMA)
    prior = intermediate.file_upload_attempts(first)
    target = marts.file_upload_daily(prior)
    # a late open for "a" with an earlier event time moves its first-open date to Jan 3
    allev = spark.createDataFrame([e("a", OPEN, 5, 10, "p1"), e("b", OPEN, 5, 2, "p1"),
                                   e("a", OPEN, 3, 11, "p1")], EV_SCHEMA)
    attempts = incremental.upload_attempts(allev, prior)
    changed = incremental.changed_upload_assignments(allev, prior)
    full = marts.file_upload_daily(intermediate.file_upload_attempts(allev))
    cols = ("metric_date", "catalog_product_id", "opened_upload_plugin_count")
    plain = incremental.upload_daily(attempts, target)
    repaired = incremental.upload_daily(attempts, target, prior_attempts=prior,
                                        changed_assignments=changed)
    assert _rows(repaired, *cols) == _rows(full, *cols)
    assert _rows(plain, *cols) != _rows(full, *cols)      # stale Jan 5 count without repair
    assert (dt.date(2024, 1, 5), "p1", 2) in _rows(plain, *cols)


def _raw(spark, rows):
    return spark.createDataFrame(
        [(t, i, "cw_task_plugin_opened", json.dumps({"task_assignment_id": k})) for t, i, k in rows],
        "event_time string, ingestion_timestamp string, event_type string, event_properties string")


def test_stage_events_null_ingestion_and_replay(spark, scratch):
    batch1 = _raw(spark, [("2024-01-01 00:00:00", "2024-01-10 00:00:00", "1")])
    table = f"{scratch}/stg_events"
    sinks.write_version(incremental.stage_events(batch1), table)
    everything = _raw(spark, [("2024-01-01 00:00:00", "2024-01-10 00:00:00", "1"),
                              ("2024-01-02 00:00:00", "null", "2"),
                              ("2024-01-03 00:00:00", "2024-01-09 00:00:00", "3")])
    for _ in range(2):                                      # the same batch twice
        target = sinks.read_current(spark, table)
        sinks.write_version(incremental.stage_events(everything, target), table)
    out = sinks.read_current(spark, table)
    assert sorted(r.task_assignment_id for r in out.collect()) == ["1", "2", "3"]
    assert len(sinks.versions(spark, table)) == 3


def test_stage_events_into_survives_a_lost_commit(spark, scratch, monkeypatch):
    """A run that fails after writing but before its commit loses no days on the retry."""
    import pytest

    from casetrail.sources import runs

    def feed(days):
        return spark.createDataFrame(
            [(f"2024-01-{d:02d} 10:00:00", f"2024-01-{d:02d} 11:00:00" if d < 20 else None, OPEN,
              json.dumps({"task_assignment_id": str(d)})) for d in days],
            "event_time string, ingestion_timestamp string, event_type string, event_properties string")

    def days():
        return sorted(r.event_time.day for r in incremental.read_events(spark, scratch).collect())
    incremental.stage_events_into(feed([1, 25]), scratch)
    assert days() == [1, 25]
    with monkeypatch.context() as m:
        m.setattr(runs, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            incremental.stage_events_into(feed([1, 25, *range(2, 12)]), scratch)
    assert days() == [1, 25]
    everything = feed([1, 25, *range(2, 12)])
    incremental.stage_events_into(everything, scratch)
    assert days() == [*range(1, 12), 25]
    before = set(incremental.read_events(spark, scratch).inputFiles())
    incremental.stage_events_into(everything.unionByName(feed([9])), scratch)   # copies, late rows
    assert days() == [*range(1, 12), 25]
    assert before <= set(incremental.read_events(spark, scratch).inputFiles())  # nothing rewritten


def test_stage_events_into_keeps_the_lookback(spark, scratch):
    batch1 = _raw(spark, [("2024-01-01 00:00:00", "2024-01-10 00:00:00", "1"),
                          ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "0")])
    incremental.stage_events_into(batch1, scratch)
    everything = _raw(spark, [("2024-01-01 00:00:00", "2024-01-10 00:00:00", "1"),
                              ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "0"),
                              ("2024-01-02 00:00:00", "null", "2"),
                              ("2024-01-03 00:00:00", "2024-01-09 00:00:00", "3"),
                              ("2024-01-03 00:00:00", "2024-01-05 00:00:00", "late")])
    for _ in range(2):                                      # the same run twice
        incremental.stage_events_into(everything, scratch)
    got = sorted(r.task_assignment_id for r in
                 incremental.read_events(spark, scratch).collect())
    assert got == ["0", "1", "2", "3"]                      # "late" is behind the lookback


def test_deactivated_assignment_leaves_no_stale_group(spark):
    """An assignment whose activation is cleared takes its old date x product group with it."""
    from datetime import datetime

    from casetrail.operators import incremental, marts

    ts = datetime(2024, 1, 5, 10)

    def assignments(activated, updated):
        return spark.createDataFrame(
            [(1, activated, updated), (2, datetime(2024, 1, 6), datetime(2024, 1, 6))],
            "task_assignment_id long, activated_ts timestamp, source_updated_at timestamp").selectExpr(
            "*", "'p' as catalog_product_id", "cast(activated_ts as date) as activation_date",
            "cast(date_trunc('week', activated_ts) as date) as activation_week",
            "cast(activated_ts is not null as int) as is_activated", "0 as is_submitted",
            "0 as is_reviewer_completed", "cast(null as timestamp) as submitted_ts",
            "cast(null as timestamp) as completed_ts",
            "1 as matched_task_name_signal", "0 as matched_action_signal",
            "0 as matched_amplitude_signal", "cast(null as timestamp) as first_questionnaire_event_at",
            "1L as case_id", "1L as beneficiary_id", "1L as task_id", "0L as iteration_count",
            "cast(null as long) as questionnaire_event_count")
    before, after = assignments(ts, ts), assignments(None, datetime(2024, 1, 7))
    target = marts.questionnaire_daily(before)
    got = incremental.questionnaire_daily(after, target, prior_assignments=before)
    want = marts.questionnaire_daily(after)
    days = lambda df: sorted(str(r.metric_date) for r in df.collect())
    assert days(target) == ["2024-01-05", "2024-01-06"]
    assert days(got) == days(want) == ["2024-01-06"]


def test_an_unstamped_event_marks_its_assignment(spark):
    """An event without a load time can have arrived at any time: its assignment is rebuilt."""
    from casetrail.operators import intermediate, staging
    def upload(name, stamp):
        return ("2024-01-05 10:00:00", stamp, name, json.dumps({
            "task_assignment_id": "7", "actor_role": "Beneficiary",
            "task_plugin_type": "file_upload", "file_count": 1}))
    schema = ("event_time string, ingestion_timestamp string, event_type string, "
              "event_properties string")
    first = [upload(OPEN, "2024-01-05 11:00:00")]
    later = first + [upload("cw_doc_upload_started", "null")] + [
        ("2024-02-01 10:00:00", "2024-02-01 11:00:00", OPEN, "{}")]
    then, now = (staging.stg_events(spark.createDataFrame(r, schema)) for r in (first, later))
    target = intermediate.file_upload_attempts(then)
    got = incremental.upload_attempts(now, target).collect()
    assert got == intermediate.file_upload_attempts(now).collect()
    assert [r.started_upload for r in got] == [1]


def test_version_diff(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType()),
                           T.StructField("b", T.StringType()), T.StructField("side", T.IntegerType())])
    before = [(1, "x", None, 0), (2, "x", "y", 0), (3, None, None, 0), (4, "p", "q", 0),
              (5, "r", "r", 0), (5, "r", "r", 0), (None, "n", None, 0), (8, "d", "d", 0)]
    now = [(1, None, "x", 0), (2, "x", "y", 0), (3, None, None, 1), (4, "p", "q", 0), (4, "p", "q", 0),
           (5, "s", "s", 0), (5, "s", "s", 0), (None, "m", None, 0), (6, None, None, None)]
    def diff(a, b):
        return {r.k: r.change for r in incremental.version_diff(
            spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "k").collect()}
    assert diff(before, now) == {1: "changed", 3: "changed", 4: "changed", 5: "changed",
                                 None: "changed", 6: "inserted", 8: "deleted"}
    assert diff(before, before[::-1]) == diff([], []) == {}
