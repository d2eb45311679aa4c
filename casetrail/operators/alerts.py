"""Business-threshold alerts on the custom-task mart.

Rolling context is computed with range windows over a day number, per
product.  A window partition holds one product's days, so its size is bounded
by the calendar, not by data volume.  Windows are evaluated before filtering
to the alert day so the context sees the preceding days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .marts import MANUAL_TASK_TARGET

ALERT_COLUMNS = ("catalog_product_id", "metric_date", "manually_added_task_rate",
                 "manual_task_rate_target", "excess_over_target", "total_tasks",
                 "manually_added_tasks")


def _day_no(c: str = "metric_date") -> Column:
    return F.datediff(F.col(c), F.lit("1970-01-01"))


def _with_excess(mart: DataFrame) -> DataFrame:
    excess = F.round(F.col("manually_added_task_rate") - F.col("manual_task_rate_target"), 4)
    return mart.withColumn("excess_over_target", excess)


def _latest_day(mart: DataFrame) -> Column:
    """The newest mart day, as a scalar subquery."""
    return mart.select(F.max("metric_date")).scalar()


def threshold_alert(mart: DataFrame, day: str | None = None) -> DataFrame:
    """Products above the manual-task target on ``day`` (default: latest day)."""
    m = _with_excess(mart).where(F.col("is_above_pm_target"))
    if day is None:
        m = m.where(F.col("metric_date") == _latest_day(mart))
    else:
        m = m.where(F.col("metric_date") == F.lit(day).cast("date"))
    return m.select(*ALERT_COLUMNS)


def rolling_context(mart: DataFrame, short_days: int = 7, long_days: int = 30) -> DataFrame:
    """Per product and day, exceeded days and median excess over the last N days.

    Windows include the row's own day.  The median covers days above target
    only; it is reported in rate points to 5 decimals.
    """
    m = _with_excess(mart).withColumn("_d", _day_no())
    above = F.col("is_above_pm_target").cast("int")
    excess_above = F.when(F.col("is_above_pm_target"), F.col("excess_over_target"))
    base = Window.partitionBy("catalog_product_id").orderBy("_d")
    w_short = base.rangeBetween(-(short_days - 1), 0)
    w_long = base.rangeBetween(-(long_days - 1), 0)
    return m.select(
        "*",
        F.sum(above).over(w_short).cast("long").alias(f"days_above_target_{short_days}d"),
        F.sum(above).over(w_long).cast("long").alias(f"days_above_target_{long_days}d"),
        F.round(F.percentile(excess_above, 0.5).over(w_short), 5).alias(f"median_excess_{short_days}d"),
        F.round(F.percentile(excess_above, 0.5).over(w_long), 5).alias(f"median_excess_{long_days}d"),
    ).drop("_d")


CONTEXT_COLUMNS = ("days_above_target_7d", "days_above_target_30d", "median_excess_7d",
                   "median_excess_30d")


def threshold_alert_context(mart: DataFrame, day: str | None = None,
                            all_days: bool = False) -> DataFrame:
    """N1 rows with rolling context; ``all_days`` keeps every alerting day."""
    ctx = rolling_context(mart).where(F.col("is_above_pm_target"))
    if not all_days:
        if day is None:
            ctx = ctx.where(F.col("metric_date") == _latest_day(mart))
        else:
            ctx = ctx.where(F.col("metric_date") == F.lit(day).cast("date"))
    return ctx.select(*ALERT_COLUMNS, *CONTEXT_COLUMNS)


__all__ = ["threshold_alert", "threshold_alert_context", "rolling_context", "MANUAL_TASK_TARGET"]
