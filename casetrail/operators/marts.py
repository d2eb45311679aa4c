"""Daily marts (B9-B12): ``metric_date x catalog_product_id``.

All counts are conditional counts in one aggregate per mart (partial +
final aggregation, so a hot product/day does not pile up in one task).
Percentiles come from :mod:`.percentiles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import md5_key
from ..functions.ratios import above_threshold, count_if, rate, rounded_mean
from .percentiles import cell_count, cell_sum, percentiles, value_lists

MANUAL_TASK_TARGET = 0.20
DAY_PRODUCT = ("metric_date", "catalog_product_id")


def duration_measures(*names: str) -> dict:
    """Measures counted per (group, value) for the duration marts.

    Flags and a constant are counted as well, so row counts come from the
    same pass as the percentiles (no second aggregation, no join back).
    """
    all_measures = {
        "_rows": F.lit(1),
        "_valid": F.when(F.col("is_valid_primary_duration") == 1, F.lit(1)),
        "_legacy": F.when(F.col("has_legacy_case_link") == 1, F.lit(1)),
        "kickoff": "kickoff_to_filing_days",
        "initialized": "initialized_to_filing_days",
        "created": "created_to_filing_days",
        "classification": "classification_to_filing_days",
    }
    return {n: all_measures[n] for n in names}


def case_duration_daily(durations: DataFrame) -> DataFrame:
    """Filed cases by filing date and product, with exact percentiles."""
    d = durations.withColumnRenamed("filing_date", "metric_date")
    out = percentiles(
        d, DAY_PRODUCT,
        duration_measures("_rows", "_valid", "_legacy", "kickoff", "initialized", "created"),
        {"median_kickoff_to_filing_days": ("kickoff", 0.5),
         "p75_kickoff_to_filing_days": ("kickoff", 0.75),
         "p90_kickoff_to_filing_days": ("kickoff", 0.9),
         "median_initialized_to_filing_days": ("initialized", 0.5),
         "median_created_to_filing_days": ("created", 0.5)},
        extra={
            "filed_cases": cell_count("_rows"),
            "kickoff_population_cases": cell_count("_valid"),
            "avg_kickoff_to_filing_days": rounded_mean(cell_sum("kickoff"), cell_count("kickoff")),
            "initialized_population_cases": cell_count("initialized"),
            "created_population_cases": cell_count("created"),
            "cases_with_legacy_link": cell_count("_legacy"),
        },
    )
    return out.select(
        "metric_date", "catalog_product_id", "filed_cases", "kickoff_population_cases",
        "avg_kickoff_to_filing_days", "median_kickoff_to_filing_days",
        "p75_kickoff_to_filing_days", "p90_kickoff_to_filing_days",
        "initialized_population_cases", "median_initialized_to_filing_days",
        "created_population_cases", "median_created_to_filing_days", "cases_with_legacy_link",
    )


def case_duration_values(durations: DataFrame) -> DataFrame:
    """The counted durations behind :func:`case_duration_daily`, by day, product and measure.

    Stored beside the mart they are all that a longer period's percentiles, averages and counts
    need (:func:`casetrail.operators.contract.rollup_percentile_stored`); case rows aren't read.
    """
    return value_lists(durations.withColumnRenamed("filing_date", "metric_date"), DAY_PRODUCT,
                       duration_measures("_rows", "kickoff", "initialized", "created"))


def task_share_aggs(target: float = MANUAL_TASK_TARGET):
    """Aggregates shared by the custom-task mart and the lifetime metric."""
    total = F.count(F.lit(1))
    manual = count_if(F.col("is_manually_added_task") == 1)
    non_template = count_if(F.col("is_non_template_task") == 1)
    broad = count_if(F.col("is_custom_task_broad") == 1)
    return [
        total.alias("total_tasks"),
        manual.alias("manually_added_tasks"),
        non_template.alias("non_template_tasks"),
        broad.alias("broad_custom_tasks"),
        F.lit(target).cast("double").alias("manual_task_rate_target"),
        rate(manual, total).alias("manually_added_task_rate"),
        rate(non_template, total).alias("non_template_task_rate"),
        rate(broad, total).alias("broad_custom_task_rate"),
        above_threshold(manual, total, target).alias("is_above_pm_target"),
    ]


def custom_tasks_daily(tasks: DataFrame) -> DataFrame:
    """Task counts and manual-task share by creation date and product."""
    return (tasks.withColumnRenamed("task_created_date", "metric_date")
            .groupBy(*DAY_PRODUCT).agg(*task_share_aggs()))


def upload_funnel_aggs():
    """Assignment-grain funnel counts and the five rates."""
    opened = F.count(F.lit(1))
    started = count_if(F.col("started_upload") == 1)
    any_ok = count_if(F.col("has_successful_upload") == 1)
    full_ok = count_if(F.col("uploaded_all_selected_files") == 1)
    return [
        opened.alias("opened_upload_plugin_count"),
        started.alias("started_upload_count"),
        any_ok.alias("completed_upload_with_any_success_count"),
        full_ok.alias("completed_upload_with_full_success_count"),
        rate(started, opened).alias("open_to_start_rate"),
        rate(any_ok, opened).alias("overall_any_success_rate"),
        rate(any_ok, started).alias("start_to_any_success_rate"),
        rate(full_ok, started).alias("start_to_full_success_rate"),
        rate(full_ok, opened).alias("overall_full_success_rate"),
        F.sum("total_files_selected_across_attempts").alias("total_files_selected_across_attempts"),
        F.sum("total_successful_files_uploaded").alias("total_successful_files_uploaded"),
        F.sum("total_failed_files_uploaded").alias("total_failed_files_uploaded"),
    ]


def file_upload_daily(attempts: DataFrame) -> DataFrame:
    """Upload funnel by first plugin-open date and product, keyed by md5."""
    agg = (attempts.withColumnRenamed("plugin_opened_date", "metric_date")
           .groupBy(*DAY_PRODUCT)
           .agg(*upload_funnel_aggs(), F.max("max_ingestion_timestamp").alias("max_ingestion_timestamp")))
    return agg.select(
        md5_key(F.col("metric_date"), F.col("catalog_product_id")).alias("metric_day_product_key"),
        *agg.columns,
    )


def _beneficiary_rollup(rows: DataFrame, keys) -> DataFrame:
    """First phase: one row per ``(keys, beneficiary)`` with assignment counts
    and whether the beneficiary has any submitted / reviewed assignment.

    Distinct beneficiaries are then plain counts of these rows, so no
    ``count(DISTINCT ...)`` expansion (one copy of every row per distinct
    aggregate) is needed, and both phases combine map-side.
    """
    sub, rev = F.col("is_submitted") == 1, F.col("is_reviewer_completed") == 1
    return rows.groupBy(*keys, "beneficiary_id").agg(
        F.count(F.lit(1)).alias("_n"),
        count_if(sub).alias("_n_sub"),
        count_if(rev).alias("_n_rev"),
        F.max(sub.cast("int")).alias("_any_sub"),
        F.max(rev.cast("int")).alias("_any_rev"),
        F.max("source_updated_at").alias("_max_src"),
    )


def questionnaire_daily_aggs():
    """Second phase over :func:`_beneficiary_rollup` rows."""
    has_ben = F.col("beneficiary_id").isNotNull()
    total = F.sum("_n")
    submitted = F.sum("_n_sub")
    reviewed = F.sum("_n_rev")
    ben = count_if(has_ben)
    ben_sub = count_if(has_ben & (F.col("_any_sub") == 1))
    ben_rev = count_if(has_ben & (F.col("_any_rev") == 1))
    return [
        total.alias("activated_assignments"),
        submitted.alias("submitted_assignments"),
        reviewed.alias("reviewer_completed_assignments"),
        ben.alias("activated_beneficiaries"),
        ben_sub.alias("beneficiaries_with_any_submitted_assignment"),
        ben_rev.alias("beneficiaries_with_any_reviewer_completed_assignment"),
        rate(submitted, total).alias("assignment_submission_rate"),
        rate(reviewed, total).alias("assignment_reviewer_completion_rate"),
        rate(ben_sub, ben).alias("beneficiary_any_submission_rate"),
        rate(ben_rev, ben).alias("beneficiary_any_reviewer_completion_rate"),
        F.max("_max_src").alias("max_source_updated_at"),
    ]


def activated_questionnaires(assignments: DataFrame) -> DataFrame:
    return assignments.where((F.col("is_activated") == 1) & F.col("activation_date").isNotNull())


def questionnaire_daily(assignments: DataFrame) -> DataFrame:
    """Questionnaire completion by activation date and product."""
    rows = activated_questionnaires(assignments).withColumnRenamed("activation_date", "metric_date")
    agg = (_beneficiary_rollup(rows, DAY_PRODUCT)
           .groupBy(*DAY_PRODUCT).agg(*questionnaire_daily_aggs()))
    return agg.select(
        md5_key(F.col("metric_date"), F.col("catalog_product_id")).alias("metric_day_product_key"),
        *agg.columns,
    )
