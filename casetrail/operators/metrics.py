"""Analyst metric queries (B13-B16), each with its reporting order (O1, O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import count_if, rate, rounded_mean
from .marts import activated_questionnaires, duration_measures, task_share_aggs, upload_funnel_aggs
from .percentiles import cell_count, cell_sum, percentiles


def _asc(*cols: str):
    # Postgres sorts NULLs last in ascending order; Spark sorts them first.
    return [F.col(c).asc_nulls_last() for c in cols]


def questionnaire_weekly(assignments: DataFrame) -> DataFrame:
    """Questionnaire submission and review rates by activation week and product."""
    base = activated_questionnaires(assignments).where(F.col("activation_week").isNotNull())
    total = F.count(F.lit(1))
    submitted = count_if(F.col("is_submitted") == 1)
    reviewed = count_if(F.col("is_reviewer_completed") == 1)
    return (
        base.withColumnRenamed("activation_week", "metric_week")
        .groupBy("metric_week", "catalog_product_id")
        .agg(
            total.alias("activated_questionnaire_assignments"),
            submitted.alias("submitted_questionnaire_assignments"),
            reviewed.alias("reviewer_completed_questionnaire_assignments"),
            rate(submitted, total).alias("questionnaire_submission_rate"),
            rate(reviewed, total).alias("questionnaire_reviewer_completion_rate"),
        )
        .orderBy(*_asc("metric_week", "catalog_product_id"))
    )


def custom_task_share(tasks: DataFrame) -> DataFrame:
    """Lifetime manual-task share per product, highest rate first."""
    return (
        tasks.withColumnRenamed("catalog_product_id", "visa_type_key")
        .groupBy("visa_type_key").agg(*task_share_aggs())
        .orderBy(F.col("manually_added_task_rate").desc_nulls_first(),
                 F.col("visa_type_key").asc_nulls_last())
    )


def case_duration(durations: DataFrame) -> DataFrame:
    """Duration per product over cases with a valid primary duration (one pass)."""
    d = durations.where(F.col("is_valid_primary_duration") == 1)
    out = percentiles(
        d, ["catalog_product_id"],
        duration_measures("_rows", "_legacy", "kickoff", "initialized", "created", "classification"),
        {"median_kickoff_to_filing_days": ("kickoff", 0.5),
         "p75_kickoff_to_filing_days": ("kickoff", 0.75),
         "p90_kickoff_to_filing_days": ("kickoff", 0.9),
         "median_initialized_to_filing_days": ("initialized", 0.5),
         "median_created_to_filing_days": ("created", 0.5),
         "median_classification_to_filing_days": ("classification", 0.5)},
        extra={
            "case_count": cell_count("_rows"),
            "avg_kickoff_to_filing_days": rounded_mean(cell_sum("kickoff"), cell_count("kickoff")),
            "initialized_population_cases": cell_count("initialized"),
            "created_population_cases": cell_count("created"),
            "classification_population_cases": cell_count("classification"),
            "cases_with_legacy_link": cell_count("_legacy"),
        },
    )
    return out.select(
        "catalog_product_id", "case_count", "avg_kickoff_to_filing_days",
        "median_kickoff_to_filing_days", "p75_kickoff_to_filing_days",
        "p90_kickoff_to_filing_days", "initialized_population_cases",
        "median_initialized_to_filing_days", "created_population_cases",
        "median_created_to_filing_days", "classification_population_cases",
        "median_classification_to_filing_days", "cases_with_legacy_link",
    ).orderBy(*_asc("catalog_product_id"))


def upload_funnel(attempts: DataFrame) -> DataFrame:
    """Upload funnel by first plugin-open date and product."""
    return (
        attempts.withColumnRenamed("plugin_opened_date", "metric_date")
        .groupBy("metric_date", "catalog_product_id").agg(*upload_funnel_aggs())
        .orderBy(*_asc("metric_date", "catalog_product_id"))
    )
