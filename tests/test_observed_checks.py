"""Row checks counted by the writing jobs: same summary, no second scan, gate and repeats."""

import re

import pytest

from casetrail.operators import quality
from casetrail.operators.quality import Check, RowCounts
from casetrail.plans import checks as C
from casetrail.plans import dq_queries, refresh, source_checks
from casetrail.plans.models import Models
from casetrail.sources.fixtures import RawSources

CHECKS = [Check("not_null", "t", "a"), Check("non_negative", "t", "a"),
          Check("accepted_values", "t", "ok", values=(True,)),
          Check("accepted_values", "t", "name", values=("x", "y")),
          Check("accepted_values", "t", "a", values=(1, 2, -1)),
          Check("value_between", "t", "a", min_value=0, max_value=1),
          Check("expression_is_true", "t", expression="a < 2 or ok"), Check("unique", "t", "a")]
ROWS = [(1, True, "x"), (2, False, "z"), (-1, None, "q"), (None, False, "z"), (1, True, None)]


def summary(found):
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
def test_observed_counts_equal_a_scan(spark, scratch, rows):
    df = spark.createDataFrame(rows, "a int, ok boolean, name string").repartition(3)
    counts = RowCounts(CHECKS)
    counts.watch("t", df).write.parquet(f"{scratch}/t")
    frames = {"t": spark.read.schema(df.schema).parquet(f"{scratch}/t")}
    assert counts.rows("t") == len(rows) and counts.rows("other") is None
    want = summary(quality.run_checks(frames, CHECKS))
    assert summary(quality.run_checks(frames, CHECKS, counts=counts)) == want


def test_only_offending_columns_are_read_again(spark, scratch):
    counts = RowCounts(CHECKS)
    df = spark.createDataFrame(ROWS, "a int, ok boolean, name string")
    counts.watch("t", df).write.parquet(f"{scratch}/t")
    frames = {"t": spark.read.schema(df.schema).parquet(f"{scratch}/t")}
    row_checks = [c for c in CHECKS if c.kind in quality.ROW_KINDS]
    plan = quality.run_checks(frames, row_checks, counts=counts
                              )._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"ReadSchema: struct<(.*?)>", plan)) == {"name:string"}


def test_a_model_without_row_checks_is_left_alone(spark):
    df = spark.range(3)
    assert RowCounts([Check("unique", "t", "id")]).watch("t", df) is df


def test_summary_of_all_models_scans_no_model_for_row_checks(spark, sf_small):
    m = Models.shared(spark, sf_small)
    found = dq_queries.check_models(m, C.ALL_CHECKS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [(path.rsplit("/", 1)[1], columns) for path, columns in re.findall(
        r"Location: InMemoryFileIndex\(1 paths\)\[(\S*?)\].*?ReadSchema: struct<(.*?)>", plan)
        if "tables-" in path]
    keys = {(c.model, c.column) for c in C.ALL_CHECKS if c.kind in ("unique", "relationships")}
    keys |= {(c.to_model, c.to_column) for c in C.ALL_CHECKS if c.kind == "relationships"}
    values = {(c.model, c.column) for c in C.ALL_CHECKS if c.kind == "accepted_values"}
    read = {(model, c.split(":")[0]) for model, columns in scans for c in columns.split(",")}
    assert scans and read <= keys | values
    again = read - keys                       # columns with offending values, and no others
    failed = {(r.model, r.column_name) for r in found.collect()
              if r.kind == "accepted_values" and r.failures}
    assert again <= failed


def test_observed_summary_equals_scans_of_the_same_tables(spark, sf_small):
    counts = RowCounts(C.ALL_CHECKS)
    frames = refresh.build_stored(RawSources(spark, sf_small), refresh.table_store(spark),
                                  counts=counts, count_sources=True)
    got = summary(quality.run_checks(frames, C.ALL_CHECKS, counts=counts))
    assert got == summary(quality.run_checks(frames, C.ALL_CHECKS))
    for name in refresh.MODELS:
        assert counts.rows(name) == frames[name].count()


def test_only_columns_that_are_read_later_are_stored(spark, sf_small):
    m, checks = Models.shared(spark, sf_small), C.checks_of(kind="non_negative")
    stored, write = {}, refresh.table_store(spark)

    def store(name, df):
        stored[name] = write(name, df)
        return stored[name]

    names = {c.model for c in checks}
    counts = RowCounts(checks)
    frames = refresh.build_stored(m.raw, store, names=names, counts=counts,
                                  columns=refresh.columns_read(names, checks))
    assert summary(quality.run_checks(frames, checks, counts=counts)) == summary(
        quality.run_checks({**m.raw.frames(), **{n: m.get(n) for n in stored}}, checks))
    assert "event_properties" not in stored["stg_events"].columns
    assert set(stored["custom_tasks"].columns) == set(
        refresh.READS["custom_tasks_daily"]["custom_tasks"])
    everything = refresh.columns_read(refresh.MODELS, C.ALL_CHECKS)
    for model, columns in everything.items():
        if model in refresh.MODELS:
            assert columns <= set(m.get(model).columns)


def test_the_event_feed_is_parsed_by_many_tasks(spark, sf_small):
    kept = spark.conf.get("spark.casetrail.eventTasks", None)
    spark.conf.unset("spark.casetrail.eventTasks")
    try:
        events = RawSources(spark, sf_small).events
        late = events.where("try_cast(ingestion_timestamp as timestamp) > '2024-01-15'")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert late.rdd.getNumPartitions() == events.rdd.getNumPartitions() == tasks > 1
        plan = late._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Filter") < plan.index("RepartitionByExpression")   # parsed after the deal
        assert "date_format" not in plan[plan.index("RepartitionByExpression"):]
    finally:
        if kept is not None:
            spark.conf.set("spark.casetrail.eventTasks", kept)


def test_daily_loads_judge_as_all_loads_do(spark, sf_small):
    found = dq_queries.loads(Models.shared(spark, sf_small))
    daily = source_checks.daily_loads(found)
    fresh = source_checks.freshness_frame(daily)
    volume = source_checks.daily_volume_frame(daily.where("day is not null").selectExpr(
        "source as series", "day", "n_rows as value"))
    assert summary(fresh) == summary(source_checks.freshness_frame(found))
    assert summary(volume) == summary(source_checks.volume_frame(found))
