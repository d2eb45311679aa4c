"""Quality operators on frames with known failing rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casetrail.operators import quality
from casetrail.operators.quality import Check, QualityGateError


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame([
        (1, 5, 0.5, "a", 1, 1), (2, -1, 1.5, "b", 1, 0), (2, None, None, None, None, 1),
        (None, 3, -0.1, "z", 0, 1), (4, 0, 0.0, "z", 2, 2),
    ], "id long, n long, r double, v string, lo long, hi long")


def test_row_checks(spark, frame):
    checks = [
        Check("not_null", "t", "id"), Check("non_negative", "t", "n"),
        Check("value_between", "t", "r", min_value=0, max_value=1),
        Check("accepted_values", "t", "v", values=("a", "b")),
        Check("expression_is_true", "t", expression="lo <= hi"),
        Check("value_between", "t", "r", max_value=1, label="only_max"),
    ]
    got = {r.check_name: r.failures for r in quality.run_checks({"t": frame}, checks).collect()}
    assert got[checks[0].name] == 1          # one null id
    assert got[checks[1].name] == 1          # -1 fails, null passes
    assert got[checks[2].name] == 2          # 1.5 and -0.1; null passes
    assert got[checks[3].name] == 1          # distinct offending values: 'z'
    assert got[checks[4].name] == 2          # 1 > 0, and NULL counts as failure
    assert got["only_max"] == 1
    rows = quality.failing_rows(frame, checks[4]).select("id").collect()
    assert sorted(r.id for r in rows) == [2, 2]


def test_unique_and_relationships(spark, frame):
    parent = spark.createDataFrame([(1,), (4,)], "id long")
    child = spark.createDataFrame([(1,), (2,), (None,), (3,)], "pid long")
    frames = {"t": frame, "p": parent, "c": child}
    checks = [Check("unique", "t", "id"),
              Check("relationships", "c", "pid", to_model="p", to_column="id")]
    got = {r.kind: r.failures for r in quality.run_checks(frames, checks).collect()}
    assert got == {"unique": 1, "relationships": 2}


def test_gate_raises_on_error_only(spark, frame):
    warn = Check("not_null", "t", "id", severity="warn", layer="x")
    summary = quality.run_checks({"t": frame}, [warn])
    quality.gate(summary, "x")
    err = Check("not_null", "t", "id", layer="x")
    with pytest.raises(QualityGateError):
        quality.gate(quality.run_checks({"t": frame}, [err]), "x")


def _loads(spark, counts, source="s"):
    rows = []
    start = dt.date(2024, 1, 1)
    for i, n in enumerate(counts):
        rows += [(source, dt.datetime.combine(start + dt.timedelta(days=i), dt.time(12)))] * n
    return spark.createDataFrame(rows, "source string, loaded_at timestamp")


def test_volume_anomaly_same_weekday(spark):
    counts = [10, 20, 30, 40, 50, 60, 70] * 5
    counts[-1] = 500                        # spike on the last (detection) day
    counts[30] = 0                          # zero day in the middle -> fail_on_zero
    counts = [c for c in counts]
    loads = _loads(spark, [c for c in counts if True])
    out = {r.day: r for r in quality.volume_anomalies(loads, fail_on_zero={"s": True}).collect()}
    last = max(out)
    assert out[last].is_detection_day and out[last].is_anomaly is True
    assert out[dt.date(2024, 1, 31)].row_count == 0 and out[dt.date(2024, 1, 31)].is_anomaly is True
    assert out[dt.date(2024, 1, 1)].is_anomaly is None            # no training points yet
    assert out[dt.date(2024, 1, 22)].is_anomaly is False          # stddev 0, equal to mean


def test_freshness(spark):
    loads = _loads(spark, [1, 0, 0, 1], "a").unionByName(_loads(spark, [1], "b"))
    out = {r.source: r for r in quality.freshness(loads).collect()}
    assert out["a"].status == "pass" and out["a"].hours_since_load == 0.0
    assert out["b"].status == "error" and out["b"].hours_since_load == 72.0


def test_schema_drift(spark):
    ev = spark.createDataFrame([
        (dt.date(2024, 1, 1), '{"a": 1, "b": "x"}'), (dt.date(2024, 1, 2), '{"a": "1", "c": true}'),
    ], "d date, p string")
    prof = quality.payload_profile(ev, F.col("d"), "p")
    got = {(r.field, r.kind): r.status for r in quality.schema_drift(prof).collect()}
    assert got == {("a", "string"): "kind_added", ("a", "number"): "kind_removed",
                   ("b", "string"): "field_removed", ("c", "boolean"): "field_added"}


def test_event_profile_is_payload_plus_column_profile(spark):
    ev = spark.createDataFrame([
        (dt.date(2024, 1, 1), '{"a": 1, "b": "x"}', "t1"), (dt.date(2024, 1, 1), None, None),
        (dt.date(2024, 1, 2), '{"a": [1], "c": {"d": null}}', "t2"),
    ], "d date, p string, e string")
    one = quality.event_profile(ev, F.col("d"), ["p", "e"], payload_col="p")
    two = quality.payload_profile(ev, F.col("d"), "p").unionByName(
        quality.column_profile(ev, F.col("d"), ["p", "e"]))
    key = lambda df: sorted(tuple(r) for r in df.select("day", "field", "kind", "n_rows").collect())
    assert key(one) == key(two)


def test_stopped_and_empty_sources_are_reported(spark):
    """Declared sources end on the common last day; one without rows is there and fails."""
    loads = spark.sql("""
        select 'live' as source, timestamp(d) as loaded_at
        from (select explode(sequence(date'2024-01-01', date'2024-02-28')) as d)
        union all
        select 'stopped', timestamp(d) from (select explode(sequence(date'2024-01-01', date'2024-02-10')) as d)
    """)
    declared = ["live", "stopped", "empty"]
    fresh = {r.source: r.status for r in quality.freshness(loads, sources=declared).collect()}
    assert fresh == {"live": "pass", "stopped": "error", "empty": "error"}
    rules = {"stopped": True, "empty": True}
    out = {r.source: r for r in quality.volume_anomalies(loads, fail_on_zero=rules, sources=declared)
           .where("is_detection_day").collect()}
    assert {s: (str(r.day), r.row_count, bool(r.is_anomaly)) for s, r in out.items()} == {
        "live": ("2024-02-28", 1, False), "stopped": ("2024-02-28", 0, True),
        "empty": ("2024-02-28", 0, True)}


def test_gate_names_every_failing_check(spark):
    import pytest
    rows = [("l", "m", f"check_{i}", "not_null", "c", "error", 1) for i in range(45)]
    summary = spark.createDataFrame(rows, "layer string, model string, check_name string, kind string, "
                                          "column_name string, severity string, failures long")
    with pytest.raises(quality.QualityGateError) as e:
        quality.gate(summary)
    assert all(f"m.check_{i}=1" in str(e.value) for i in range(45))


def test_schema_drift_over_a_gap_and_undated_rows(spark):
    """A field that vanishes over days without rows is reported; undated rows are counted."""
    prof = spark.createDataFrame([
        ("s", dt.date(2024, 1, 1), "a", "column", 3), ("s", dt.date(2024, 1, 1), "b", "column", 3),
        ("s", dt.date(2024, 1, 9), "a", "column", 2), ("s", None, "a", "column", 4),
        ("t", dt.date(2024, 1, 9), "z", "column", 1)],
        "source string, day date, field string, kind string, n_rows long")
    got = {tuple(r) for r in quality.schema_drift(prof).collect()}
    assert got == {("s", dt.date(2024, 1, 9), "a", "column", 2, 3, "unchanged"),
                   ("s", dt.date(2024, 1, 9), "b", "column", 0, 3, "field_removed"),
                   ("s", None, "a", "column", 4, 0, "undated")}


def test_accepted_values_counts_distinct_values_without_expand(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2), (None, None), ("ok", 3)], "a string, b int")
    checks = [quality.Check("accepted_values", "m", "a", values=("ok",)),
              quality.Check("accepted_values", "m", "b", values=(1, 2, 3)),
              quality.Check("not_null", "m", "a")]
    out = quality.row_check_counts(df, checks)
    assert {r.check_name: r.failures for r in out.collect()} == {
        "accepted_values__m__a": 2, "accepted_values__m__b": 0, "not_null__m__a": 1}
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_null_rate_keeps_undated_rows(spark):
    df = spark.createDataFrame([(None, None), (None, "x")], "d date, c string")
    r = quality.null_rate_by_day(df, F.col("d"), ["c"]).first()
    assert (r.day, r.n_rows, r.n_nulls) == (None, 2, 1)
