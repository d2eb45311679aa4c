"""The load ledger equals a recount, reads only the days inside its lookback, and serves the gate."""

import datetime as dt

from pyspark.sql import functions as F

from casetrail.operators import contract, quality
from casetrail.plans import checks as C
from casetrail.plans import load_ledger, refresh, source_checks
from casetrail.sources import runs
from casetrail.sources.fixtures import RawSources
from casetrail.sources.sinks import RawTables


def _rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def _until(frames, cut):
    return {s: df.where(source_checks.loaded_at(s) < F.lit(cut)) if s in C.SOURCES else df
            for s, df in frames.items()}


def test_two_runs_equal_a_recount(spark, sf_small, scratch):
    frames = RawSources(spark, sf_small).frames()
    newest = source_checks.loads(frames).agg(F.max("loaded_at").alias("at")).first()["at"]
    store = lambda name, df: runs.write(df, f"{scratch}/{name}", "r")
    whole = store("whole", load_ledger.count_loads(frames))
    first = store("first", load_ledger.advance(_until(frames, newest - dt.timedelta(days=9)), None))
    second = store("second", load_ledger.advance(frames, first))
    assert first.count() < second.count()
    assert _rows(second) == _rows(whole)
    # the same numbers as the checks that read the raw sources
    found = source_checks.loads(frames)
    assert _rows(source_checks.daily_volume_frame(load_ledger.volumes(second))) == _rows(
        source_checks.volume_frame(found))
    assert _rows(source_checks.freshness_frame(load_ledger.loads(second))) == _rows(
        source_checks.freshness_frame(found))
    profile = source_checks.table_profile(frames).unionByName(
        source_checks.event_profile(frames).withColumn("source", F.lit("wf_events")))
    assert _rows(load_ledger.profile(second)) == _rows(profile)


def _feed(spark, rows):
    return spark.createDataFrame(
        rows, "event_time string, ingestion_timestamp string, event_type string, "
              "event_properties string")


def test_late_rows_inside_the_lookback_and_undated_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(C, "SOURCES", {"wf_events": C.SOURCES["wf_events"]} if isinstance(
        C.SOURCES, dict) else ("wf_events",))
    old = [("2024-01-01 00:00:00", f"2024-01-0{d} 10:00:00+00:00", "cw_a", '{"k": 1}')
           for d in (1, 2, 5)] + [("x", None, "cw_a", None)]
    new = [("y", "2024-01-04 09:00:00+00:00", "cw_a", '{"k": "text", "z": null}'),
           ("y", "2024-01-06 09:00:00+00:00", None, "not json"), ("y", "never", "cw_a", "{}")]
    first = runs.write(load_ledger.advance({"wf_events": _feed(spark, old)}, None),
                       f"{scratch}/a", "r")
    both = {"wf_events": _feed(spark, old + new)}
    assert _rows(load_ledger.advance(both, first)) == _rows(load_ledger.count_loads(both))
    assert {(r.day, r.n_rows) for r in load_ledger.volumes(load_ledger.advance(both, first))
            .select("day", F.col("value").alias("n_rows")).collect()} == {
        (dt.date(2024, 1, d), 1) for d in (1, 2, 4, 5, 6)}
    empty = load_ledger.advance({"wf_events": _feed(spark, [])}, None)
    assert empty.collect() == []
    assert _rows(load_ledger.advance(both, empty)) == _rows(load_ledger.count_loads(both))


def test_the_lookback_reaches_the_scan(spark, sf_small, scratch):
    frames = RawSources(spark, sf_small).frames()
    stored = {s: runs.write(df, f"{scratch}/{s}", "r") for s, df in frames.items()}
    since = {s: dt.date(2030, 1, 1) for s in C.SOURCES}
    plan = load_ledger.count_loads(stored, since)._jdf.queryExecution().executedPlan().toString()
    tables = len([s for s in C.SOURCES if s != load_ledger.FEED])
    assert plan.count("GreaterThanOrEqual(ingestion_timestamp,2030-01-01") == tables
    assert plan.count("FileScan") == len(C.SOURCES)              # one scan a source


def test_pipeline_runs_hand_the_ledger_on(spark, sf_small, scratch, monkeypatch):
    """The second run counts from the lookback on and stores the whole ledger again."""
    frames = RawSources(spark, sf_small).frames()
    newest = source_checks.loads(frames).agg(F.max("loaded_at").alias("at")).first()["at"]
    seen = []
    count = load_ledger.count_loads
    monkeypatch.setattr(load_ledger, "count_loads",
                        lambda f, since=None: seen.append(since) or count(f, since))
    kw = {"fail_on_error": False, "error_after_hours": None}
    refresh.run_layers(spark, RawTables(spark, _until(frames, newest - dt.timedelta(days=5))),
                       scratch, **kw)
    refresh.run_layers(spark, RawTables(spark, frames), scratch, **kw)
    assert seen[0] is None and set(seen[1]) == set(C.SOURCES)
    ledger = load_ledger.read(spark, scratch, runs.last(spark, scratch))
    assert _rows(ledger) == _rows(count(frames))
    # the run also leaves the value counts that roll-ups merge
    run = runs.last(spark, scratch)
    values = runs.read(spark, f"{scratch}/{refresh.DURATION_VALUES}", run.run_id)
    stored = contract.rollup_percentile_stored(values, "case_duration_daily",
                                               "p90_kickoff_to_filing_days", "month")
    base = contract.rollup_percentile(refresh.read_run(spark, scratch)["case_durations"],
                                      "case_duration_daily", "p90_kickoff_to_filing_days", "month")
    assert stored.count() > 0 and _rows(stored) == _rows(base)
    assert load_ledger.read(spark, f"{scratch}/none", runs.last(spark, scratch)) is None


def test_counted_volumes_score_like_loads(spark):
    rows = [("a", dt.datetime(2024, 1, d, 3)) for d in range(1, 29) for _ in range(1 + d % 3)]
    loads = spark.createDataFrame(rows, "source string, loaded_at timestamp")
    daily = loads.groupBy(F.col("source").alias("series"), F.to_date("loaded_at").alias("day")).agg(
        F.count(F.lit(1)).alias("value"))
    assert _rows(quality.daily_volume_anomalies(daily)) == _rows(quality.volume_anomalies(loads))
