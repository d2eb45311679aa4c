"""Threshold alerts with rolling context, denominator cliffs, reconciliation, null rates."""

import datetime as dt

from pyspark.sql import functions as F

from casetrail.operators import alerts, quality


def _mart(spark, rates):
    d0 = dt.date(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=i), "p", r, 0.2, r > 0.2, 100, int(r * 100))
            for i, r in enumerate(rates)]
    return spark.createDataFrame(rows, "metric_date date, catalog_product_id string, "
                                 "manually_added_task_rate double, manual_task_rate_target double, "
                                 "is_above_pm_target boolean, total_tasks long, manually_added_tasks long")


def test_rolling_context_windows_include_own_day(spark):
    rates = [0.1] * 20 + [0.3, 0.25, 0.1, 0.4]
    m = _mart(spark, rates)
    latest = alerts.threshold_alert_context(m).collect()
    assert len(latest) == 1
    r = latest[0]
    assert r.metric_date == dt.date(2024, 1, 24) and r.excess_over_target == 0.2
    assert r.days_above_target_7d == 3 and r.days_above_target_30d == 3
    assert r.median_excess_7d == 0.1          # median of 0.1, 0.05, 0.2
    assert len(alerts.threshold_alert(m).collect()) == 1
    assert alerts.threshold_alert(m, day="2024-01-23").count() == 0


def test_denominator_cliff_flags_drops_only(spark):
    d0 = dt.date(2024, 1, 1)
    vals = [100] * 36
    vals[35] = 10                 # drop on the last day
    vals[29] = 1000               # spike: not a cliff
    daily = spark.createDataFrame([("s", d0 + dt.timedelta(days=i), v) for i, v in enumerate(vals)],
                                  "series string, day date, value long")
    out = {r.day: r.is_cliff for r in quality.denominator_cliffs(daily).collect()}
    assert out[d0 + dt.timedelta(days=35)] is True
    assert out[d0 + dt.timedelta(days=29)] is False


def test_reconcile_and_null_rate(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 1)], "day date, n long")
    b = spark.createDataFrame([(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 3), 2)], "day date, n long")
    out = {r.day: (r.left, r.right, r.status) for r in quality.reconcile_daily(a, b, "left", "right").collect()}
    assert out == {dt.date(2024, 1, 1): (3, 3, "match"), dt.date(2024, 1, 2): (1, 0, "mismatch"),
                   dt.date(2024, 1, 3): (0, 2, "mismatch")}
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None), (dt.date(2024, 1, 1), "x"),
                                (dt.date(2024, 1, 1), None)], "d date, c string")
    r = quality.null_rate_by_day(df, F.col("d"), ["c"]).first()
    assert (r.n_rows, r.n_nulls, r.null_rate) == (3, 2, 0.6667)
