"""Registered contract roll-ups (M1-M7) and threshold alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import alerts, contract
from . import oracle
from .models import Models
from .refresh import table_store
from .registry import query


def _ctx(metric: str, grain: str, source: str, time_dim: str = "metric_date") -> str:
    return (f"'{metric}' as metric_name, '1.0' as metric_version, '{grain}' as time_grain, "
            f"'{time_dim}' as time_dimension, '{source}' as source_model")


def _period(col: str, grain: str) -> str:
    return f"CAST(date_trunc('{grain}', {col}) AS DATE)"


@query("rollup_additive", oracle.with_models(f"""
select {_period('metric_date', 'month')} as period_start, catalog_product_id,
 CAST(sum(total_tasks) AS BIGINT) as value, {_ctx('total_tasks', 'month', 'custom_tasks_daily')}
from custom_tasks_daily group by 1, 2"""))
def q_rollup_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: monthly task counts per product, summed from the daily mart."""
    mart = Models.shared(spark, sf_dir).custom_tasks_daily
    return contract.rollup_additive(mart, "custom_tasks_daily", "total_tasks", "month")


@query("rollup_ratio", oracle.with_models(f"""
select {_period('metric_date', 'week')} as period_start, catalog_product_id,
 {oracle.rate('sum(submitted_assignments)', 'sum(activated_assignments)')} as value,
 CAST(sum(submitted_assignments) AS BIGINT) as numerator,
 CAST(sum(activated_assignments) AS BIGINT) as denominator,
 'submitted_assignments' as numerator_name, 'activated_assignments' as denominator_name,
 {_ctx('assignment_submission_rate', 'week', 'questionnaire_daily')}
from questionnaire_daily group by 1, 2"""))
def q_rollup_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: weekly questionnaire submission rate from summed components."""
    mart = Models.shared(spark, sf_dir).questionnaire_daily
    return contract.rollup_ratio(mart, "questionnaire_daily", "assignment_submission_rate", "week")


@query("rollup_average", oracle.with_models(f"""
select {_period('filing_date', 'month')} as period_start, catalog_product_id,
 {oracle.rate('sum(kickoff_to_filing_days)', 'count(kickoff_to_filing_days)', 2)} as value,
 count(kickoff_to_filing_days) as base_rows,
 {_ctx('avg_kickoff_to_filing_days', 'month', 'case_durations')}
from case_durations group by 1, 2"""))
def q_rollup_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: monthly average kickoff-to-filing days from case rows."""
    base = Models.shared(spark, sf_dir).case_durations
    return contract.rollup_average(base, "case_duration_daily", "avg_kickoff_to_filing_days", "month")


_PERCENTILE = oracle.with_models(oracle.with_percentiles(f"""
select {_period('filing_date', 'month')} as period_start, catalog_product_id,
 count(kickoff_to_filing_days) as base_rows,
 {_ctx('median_kickoff_to_filing_days', 'month', 'case_durations')}
from case_durations group by 1, 2""",
    f"(select {_period('filing_date', 'month')} as period_start, * from case_durations)",
    ["period_start", "catalog_product_id"], {"value": ("kickoff_to_filing_days", 0.5)},
    ["period_start", "catalog_product_id", "value", "base_rows", "metric_name", "metric_version",
     "time_grain", "time_dimension", "source_model"]))


@query("rollup_percentile", _PERCENTILE)
def q_rollup_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: monthly median kickoff-to-filing days recomputed from case rows."""
    base = Models.shared(spark, sf_dir).case_durations
    return contract.rollup_percentile(base, "case_duration_daily",
                                      "median_kickoff_to_filing_days", "month")


@query("rollup_percentile_stored", _PERCENTILE)
def q_rollup_percentile_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 from the value counts stored per day: equal to recomputing from case rows."""
    values = table_store(spark)("case_duration_values",
                                Models.shared(spark, sf_dir).case_duration_values)
    return contract.rollup_percentile_stored(values, "case_duration_daily",
                                             "median_kickoff_to_filing_days", "month")


_O, _S = "sum(opened_upload_plugin_count)", "sum(started_upload_count)"
_A, _F = "sum(completed_upload_with_any_success_count)", "sum(completed_upload_with_full_success_count)"


@query("rollup_funnel", oracle.with_models(f"""
select {_period('metric_date', 'week')} as period_start, catalog_product_id,
 CAST({_O} AS BIGINT) as opened_upload_plugin_count, CAST({_S} AS BIGINT) as started_upload_count,
 CAST({_A} AS BIGINT) as completed_upload_with_any_success_count,
 CAST({_F} AS BIGINT) as completed_upload_with_full_success_count,
 {oracle.rate(_S, _O)} as open_to_start_rate, {oracle.rate(_A, _S)} as start_to_any_success_rate,
 {oracle.rate(_F, _S)} as start_to_full_success_rate, {oracle.rate(_A, _O)} as overall_any_success_rate,
 {oracle.rate(_F, _O)} as overall_full_success_rate,
 {_ctx('file_upload_funnel', 'week', 'file_upload_daily')}
from file_upload_daily group by 1, 2"""))
def q_rollup_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: weekly upload funnel: steps summed, then divided."""
    return contract.rollup_funnel(Models.shared(spark, sf_dir).file_upload_daily, "week")


@query("metric_freshness", oracle.with_models("""
select 'questionnaire_daily' as mart, 'max_source_updated_at' as freshness_field,
 max(max_source_updated_at) as fresh_as_of from questionnaire_daily
union all
select 'file_upload_daily', 'max_ingestion_timestamp', max(max_ingestion_timestamp) from file_upload_daily"""))
def q_metric_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: freshness of the marts that declare a freshness field."""
    m = Models.shared(spark, sf_dir)
    return contract.metric_freshness({
        "questionnaire_daily": m.questionnaire_daily, "custom_tasks_daily": m.custom_tasks_daily,
        "case_duration_daily": m.case_duration_daily, "file_upload_daily": m.file_upload_daily})


_EXCESS = "round(manually_added_task_rate - manual_task_rate_target, 4)"
_ALERT_COLS = ("catalog_product_id, metric_date, manually_added_task_rate, manual_task_rate_target, "
               "excess_over_target, total_tasks, manually_added_tasks")


@query("threshold_alert", oracle.with_models(f"""
select {_ALERT_COLS} from (select *, {_EXCESS} as excess_over_target from custom_tasks_daily) m
where is_above_pm_target and metric_date = (select max(metric_date) from custom_tasks_daily)"""))
def q_threshold_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products above the manual-task target on the latest day."""
    return alerts.threshold_alert(Models.shared(spark, sf_dir).custom_tasks_daily)


_ABOVE_EXCESS = "CASE WHEN is_above_pm_target THEN excess_over_target END"


@query("threshold_alert_context", oracle.with_models(f"""
select {_ALERT_COLS}, days_above_target_7d, days_above_target_30d, median_excess_7d, median_excess_30d
from (
  select *,
   CAST(sum(CAST(is_above_pm_target AS INTEGER)) over w7 AS BIGINT) as days_above_target_7d,
   CAST(sum(CAST(is_above_pm_target AS INTEGER)) over w30 AS BIGINT) as days_above_target_30d,
   round(quantile_cont({_ABOVE_EXCESS}, 0.5) over w7, 5) as median_excess_7d,
   round(quantile_cont({_ABOVE_EXCESS}, 0.5) over w30, 5) as median_excess_30d
  from (select *, {_EXCESS} as excess_over_target,
               date_diff('day', DATE '1970-01-01', metric_date) as d from custom_tasks_daily) m
  window w7 as (partition by catalog_product_id order by d range between 6 preceding and current row),
         w30 as (partition by catalog_product_id order by d range between 29 preceding and current row)
) x where is_above_pm_target"""))
def q_threshold_alert_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 + W1/W2: every alerting product-day with 7/30-day rolling context."""
    return alerts.threshold_alert_context(Models.shared(spark, sf_dir).custom_tasks_daily, all_days=True)
