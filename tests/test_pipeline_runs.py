"""The gated pipeline over raw tables: runs, commits, freshness, stored failures."""

import pytest
from pyspark.sql import functions as F

from casetrail.operators.quality import QualityGateError
from casetrail.plans import incremental_queries, refresh
from casetrail.sources import runs, sinks
from casetrail.sources.fixtures import RawSources
from casetrail.sources.sinks import RawTables


def _rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def test_stale_and_missing_sources_stop_the_first_layer(spark, sf_small, scratch):
    frames = RawSources(spark, sf_small).frames()
    raw = RawTables(spark, {k: v for k, v in frames.items() if k != "cm_recommender"})
    with pytest.raises(QualityGateError, match="cm_recommender.freshness"):
        refresh.run_layers(spark, raw, f"{scratch}/stale")
    import os
    assert not os.path.exists(f"{scratch}/stale/stg_cases")
    assert refresh.read_run(spark, f"{scratch}/stale") == {}         # nothing was committed


def test_unknown_source_is_refused(spark):
    with pytest.raises(KeyError, match="nothing"):
        RawTables(spark, {"nothing": spark.range(1)})


def test_a_run_that_stops_halfway_is_not_the_earlier_state(spark, sf_small, scratch, monkeypatch):
    """Run 1 commits; run 2 stops after its intermediate layer; run 3 equals a rebuild."""
    frames = RawSources(spark, sf_small).frames()
    early = incremental_queries.earlier_frames(frames)
    kw = {"fail_on_error": False, "error_after_hours": None}
    root = f"{scratch}/runs"
    refresh.run_layers(spark, RawTables(spark, early), root, **kw)
    first = _rows(refresh.read_run(spark, root)["file_upload_daily"])

    broken = refresh.MODELS["custom_tasks_daily"]
    with monkeypatch.context() as m:
        def crash(*_):
            raise RuntimeError("lost")
        m.setitem(refresh.MODELS, "custom_tasks_daily",
                  refresh.Model(broken.layer, broken.inputs, crash))
        with pytest.raises(RuntimeError, match="lost"):
            refresh.run_layers(spark, RawTables(spark, frames), root, **kw)
    assert _rows(refresh.read_run(spark, root)["file_upload_daily"]) == first

    refresh.run_layers(spark, RawTables(spark, frames), root, store_failures=True, **kw)
    refresh.run_layers(spark, RawTables(spark, frames), f"{scratch}/whole", full_refresh=True, **kw)
    now, whole = refresh.read_run(spark, root), refresh.read_run(spark, f"{scratch}/whole")
    for name in refresh.MODELS:
        assert _rows(now[name]) == _rows(whole[name]), name

    # every failed check has its rows stored, relationships and load checks too
    stored = {r.check for r in spark.read.parquet(f"{root}/_failures").select("check").distinct().collect()}
    run = runs.last(spark, root)
    assert {r.run_id for r in spark.read.parquet(f"{root}/_failures").select("run_id")
            .distinct().collect()} == {run.run_id}
    summary = runs.read(spark, f"{root}/_checks/mart", run.run_id).where("status <> 'pass'")
    assert {r.check_name for r in summary.collect()} <= stored
    assert any(name.startswith("relationships") for name in stored)


def test_only_the_models_that_the_checks_read_are_built(spark, sf_small):
    built = []

    def store(name, df):
        built.append(name)
        return df
    refresh.build_stored(RawSources(spark, sf_small), store, names=["case_duration_daily"])
    assert built == ["stg_cases", "case_durations", "case_duration_daily"]


def test_a_retry_replaces_its_own_failures(spark, scratch):
    """K3: under the same run id the second attempt's rows stay, also where fewer checks fail."""
    def fail(run_id, names):
        rows = [sinks.failure_rows(spark.range(2), name) for name in names]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        sinks.store_failures(out, f"{scratch}/_failures", run_id, "staging")
    fail("one", ["a", "b"])
    fail("one", ["a"])
    fail("two", ["b"])
    stored = spark.read.parquet(f"{scratch}/_failures").groupBy("run_id", "check").count().collect()
    assert sorted(map(tuple, stored)) == [("one", "a", 2), ("two", "b", 2)]


def test_changes_without_a_load_time_reach_the_questionnaires(spark, sf_small):
    """A renamed task, a soft-deleted and a restored case, an unstamped event."""
    from casetrail.operators import incremental, intermediate, staging
    frames = RawSources(spark, sf_small).frames()

    def models(raw):
        return {"stg_cases": staging.stg_cases(raw["wf_case"]),
                "stg_tasks": staging.stg_tasks(raw["wf_task"]),
                "stg_assignments": staging.stg_assignments(raw["wf_assignment"]),
                "stg_events": staging.stg_events(raw["wf_events"])}
    then, now = models(incremental_queries.earlier_frames(frames)), models(frames)
    order = ("stg_assignments", "stg_tasks", "stg_cases", "stg_events")
    target = intermediate.questionnaire_assignments(*[then[n] for n in order])
    added = now["stg_events"].join(then["stg_events"], "event_natural_key", "left_anti")
    changed = incremental.changed_questionnaires(then, now, added)
    got = incremental.questionnaires_of(changed, *[now[n] for n in order], target)
    want = intermediate.questionnaire_assignments(*[now[n] for n in order])
    assert _rows(got) == _rows(want)
    old = set(_rows(target))
    assert set(_rows(want)) - old and old - set(_rows(want))     # the changes were felt
    assert changed.count() < now["stg_assignments"].count()


def test_a_run_leaves_no_shuffle_files_and_no_parsed_feed(spark, sf_small, scratch):
    import os
    from casetrail.session import SHUFFLE_CLEANUP

    def shuffle_files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = disk.getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    raw = RawTables(spark, RawSources(spark, sf_small).frames())
    before, setting = shuffle_files(), spark.conf.get(SHUFFLE_CLEANUP)
    refresh.run_layers(spark, raw, scratch, fail_on_error=False, error_after_hours=None)
    assert shuffle_files() <= before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    files = [f"{d}/{f}" for d, _, names in os.walk(scratch) for f in names if f.endswith(".parquet")]
    assert not [f for f in files if "/_landed/" in f]
    assert not [f for f in files if "/_runs/" not in f and not f.endswith(".zstd.parquet")]
