"""Declared checks per layer and model (the YAML test declarations as config)."""

from __future__ import annotations

from ..operators.quality import Check

# Accepted workflow event names.
EVENT_NAMES = (
    "cw_case_page_viewed", "cw_case_view_toggled", "cw_task_viewed", "cw_task_started",
    "cw_task_completed", "cw_task_status_changed", "cw_task_dependency_bypassed",
    "cw_task_plugin_opened", "cw_doc_upload_started", "cw_doc_upload_completed",
    "cw_questionnaire_session_started", "cw_questionnaire_session_submitted",
    "cw_task_assignment_claimed",
)
FLAG_VALUES = (0, 1)


def _nn(layer, model, *cols):
    return [Check("not_null", model, c, layer=layer) for c in cols]


def _uq(layer, model, *cols):
    return [Check("unique", model, c, layer=layer) for c in cols]


def _nonneg(layer, model, *cols):
    return [Check("non_negative", model, c, layer=layer) for c in cols]


def _flags(layer, model, *cols):
    return [Check("accepted_values", model, c, values=FLAG_VALUES, layer=layer) for c in cols]


def _rate01(layer, model, *cols):
    return [Check("value_between", model, c, min_value=0, max_value=1, layer=layer) for c in cols]


def _expr(layer, model, *exprs):
    return [Check("expression_is_true", model, expression=e, layer=layer) for e in exprs]


SOURCE = "source"
STAGING = "staging"
INTERMEDIATE = "intermediate"
MART = "mart"

SOURCE_CHECKS = (
    _nn(SOURCE, "wf_case", "id", "ingestion_timestamp", "flow_template_id", "status", "created_at")
    + _uq(SOURCE, "wf_case", "id")
    + _nn(SOURCE, "wf_task", "id", "ingestion_timestamp", "case_id", "creation_source", "status",
          "created_at")
    + _uq(SOURCE, "wf_task", "id")
    + _nn(SOURCE, "wf_assignment", "id", "ingestion_timestamp", "task_id", "role_binding",
          "action", "status", "created_at")
    + _uq(SOURCE, "wf_assignment", "id")
    + _nn(SOURCE, "wf_events", "event_time", "ingestion_timestamp", "event_type", "event_properties")
    + _nn(SOURCE, "wf_task_predecessor", "task_id", "predecessor_task_id", "ingestion_timestamp")
    + _nn(SOURCE, "cm_case", "id", "ingestion_timestamp", "beneficiary_id", "status", "created_at")
    + _uq(SOURCE, "cm_case", "id")
    + _nn(SOURCE, "cm_evidence_document", "id", "ingestion_timestamp", "evidence_id", "created_at")
    + _uq(SOURCE, "cm_evidence_document", "id")
    + _nonneg(SOURCE, "cm_evidence_document", "iteration_count")
    + _nn(SOURCE, "cm_evidence_property", "id", "ingestion_timestamp", "evidence_id",
          "property_type", "created_at")
    + _uq(SOURCE, "cm_evidence_property", "id")
    + _nn(SOURCE, "cm_recommender", "id", "ingestion_timestamp", "case_id", "status", "created_at")
    + _uq(SOURCE, "cm_recommender", "id")
    + [Check("relationships", "wf_task_predecessor", "predecessor_task_id", to_model="wf_task",
             to_column="id", layer=SOURCE, severity="warn")]
)

STAGING_CHECKS = (
    _nn(STAGING, "stg_cases", "case_id", "ingestion_timestamp") + _uq(STAGING, "stg_cases", "case_id")
    + _nn(STAGING, "stg_tasks", "task_id", "case_id", "ingestion_timestamp")
    + _uq(STAGING, "stg_tasks", "task_id")
    + _nn(STAGING, "stg_assignments", "task_assignment_id", "task_id", "ingestion_timestamp")
    + _uq(STAGING, "stg_assignments", "task_assignment_id")
    + _nonneg(STAGING, "stg_assignments", "active_time_ms")
    + _nn(STAGING, "stg_events", "event_natural_key", "event_time", "event_date",
          "ingestion_timestamp", "event_name", "has_numeric_parse_error",
          "has_timestamp_parse_error")
    + _uq(STAGING, "stg_events", "event_natural_key")
    + [Check("accepted_values", "stg_events", "event_name", values=EVENT_NAMES, layer=STAGING)]
    + _nonneg(STAGING, "stg_events", "file_count", "success_count", "error_count",
              "session_number", "instance_count", "duration_ms", "duration_seconds")
    + [Check("accepted_values", "stg_events", c, values=(False,), layer=STAGING)
       for c in ("has_numeric_parse_error", "has_timestamp_parse_error")]
)

# The rules of the expression checks.
FUNNEL_ATTEMPT_RULES = (
    "started_upload <= opened_plugin",
    "has_successful_upload <= started_upload",
    "uploaded_all_selected_files <= has_successful_upload",
)
FUNNEL_MART_RULES = (
    "started_upload_count <= opened_upload_plugin_count",
    "completed_upload_with_any_success_count <= started_upload_count",
    "completed_upload_with_full_success_count <= completed_upload_with_any_success_count",
)
PERCENTILE_RULES = (
    "p75_kickoff_to_filing_days is null or median_kickoff_to_filing_days is null "
    "or p75_kickoff_to_filing_days >= median_kickoff_to_filing_days",
    "p90_kickoff_to_filing_days is null or p75_kickoff_to_filing_days is null "
    "or p90_kickoff_to_filing_days >= p75_kickoff_to_filing_days",
)
POPULATION_RULES = {
    "questionnaire_daily": (
        "submitted_assignments <= activated_assignments",
        "reviewer_completed_assignments <= activated_assignments",
        "beneficiaries_with_any_submitted_assignment <= activated_beneficiaries",
        "beneficiaries_with_any_reviewer_completed_assignment <= activated_beneficiaries",
    ),
    "custom_tasks_daily": (
        "manually_added_tasks <= total_tasks",
        "non_template_tasks <= total_tasks",
        "broad_custom_tasks <= total_tasks",
    ),
    "case_duration_daily": (
        "kickoff_population_cases <= filed_cases",
        "initialized_population_cases <= filed_cases",
        "created_population_cases <= filed_cases",
        "cases_with_legacy_link <= filed_cases",
    ),
}

INTERMEDIATE_CHECKS = (
    _nn(INTERMEDIATE, "questionnaire_assignments", "task_assignment_id", "case_id", "task_id",
        "source_updated_at")
    + _uq(INTERMEDIATE, "questionnaire_assignments", "task_assignment_id")
    + _nonneg(INTERMEDIATE, "questionnaire_assignments", "iteration_count")
    + _flags(INTERMEDIATE, "questionnaire_assignments", "is_activated", "is_submitted",
             "is_reviewer_completed")
    + _nn(INTERMEDIATE, "custom_tasks", "task_id", "case_id", "task_created_date")
    + _uq(INTERMEDIATE, "custom_tasks", "task_id")
    + _flags(INTERMEDIATE, "custom_tasks", "is_manually_added_task", "is_non_template_task",
             "is_custom_task_broad")
    + _nn(INTERMEDIATE, "case_durations", "case_id", "filing_date")
    + _uq(INTERMEDIATE, "case_durations", "case_id")
    + _nonneg(INTERMEDIATE, "case_durations", "created_to_filing_days",
              "initialized_to_filing_days", "kickoff_to_filing_days",
              "classification_to_filing_days")
    + _flags(INTERMEDIATE, "case_durations", "is_valid_primary_duration", "has_legacy_case_link")
    + _expr(INTERMEDIATE, "file_upload_attempts", *FUNNEL_ATTEMPT_RULES)
    + _nn(INTERMEDIATE, "file_upload_attempts", "task_assignment_id", "plugin_opened_date",
          "max_ingestion_timestamp")
    + _uq(INTERMEDIATE, "file_upload_attempts", "task_assignment_id")
    + _flags(INTERMEDIATE, "file_upload_attempts", "opened_plugin", "started_upload",
             "has_successful_upload", "uploaded_all_selected_files")
    + _nonneg(INTERMEDIATE, "file_upload_attempts", "total_files_selected_across_attempts",
              "total_successful_files_uploaded", "total_failed_files_uploaded")
)

MART_CHECKS = (
    _expr(MART, "questionnaire_daily", *POPULATION_RULES["questionnaire_daily"])
    + _nn(MART, "questionnaire_daily", "metric_day_product_key", "metric_date",
          "max_source_updated_at")
    + _uq(MART, "questionnaire_daily", "metric_day_product_key")
    + _nonneg(MART, "questionnaire_daily", "activated_assignments", "submitted_assignments",
              "reviewer_completed_assignments", "activated_beneficiaries",
              "beneficiaries_with_any_submitted_assignment",
              "beneficiaries_with_any_reviewer_completed_assignment")
    + _rate01(MART, "questionnaire_daily", "assignment_submission_rate",
              "assignment_reviewer_completion_rate", "beneficiary_any_submission_rate",
              "beneficiary_any_reviewer_completion_rate")
    + _expr(MART, "custom_tasks_daily", *POPULATION_RULES["custom_tasks_daily"])
    + _nn(MART, "custom_tasks_daily", "metric_date")
    + _nonneg(MART, "custom_tasks_daily", "total_tasks", "manually_added_tasks",
              "non_template_tasks", "broad_custom_tasks")
    + _rate01(MART, "custom_tasks_daily", "manual_task_rate_target", "manually_added_task_rate",
              "non_template_task_rate", "broad_custom_task_rate")
    + [Check("accepted_values", "custom_tasks_daily", "is_above_pm_target",
             values=(True, False), layer=MART)]
    + _expr(MART, "case_duration_daily", *POPULATION_RULES["case_duration_daily"], *PERCENTILE_RULES)
    + _nn(MART, "case_duration_daily", "metric_date")
    + _nonneg(MART, "case_duration_daily", "filed_cases", "kickoff_population_cases",
              "avg_kickoff_to_filing_days", "median_kickoff_to_filing_days",
              "p75_kickoff_to_filing_days", "p90_kickoff_to_filing_days",
              "initialized_population_cases", "median_initialized_to_filing_days",
              "created_population_cases", "median_created_to_filing_days",
              "cases_with_legacy_link")
    + _expr(MART, "file_upload_daily", *FUNNEL_MART_RULES)
    + _nn(MART, "file_upload_daily", "metric_day_product_key", "metric_date",
          "max_ingestion_timestamp")
    + _uq(MART, "file_upload_daily", "metric_day_product_key")
    + _nonneg(MART, "file_upload_daily", "opened_upload_plugin_count", "started_upload_count",
              "completed_upload_with_any_success_count",
              "completed_upload_with_full_success_count", "total_files_selected_across_attempts",
              "total_successful_files_uploaded", "total_failed_files_uploaded")
    + _rate01(MART, "file_upload_daily", "open_to_start_rate", "start_to_any_success_rate",
              "start_to_full_success_rate", "overall_any_success_rate",
              "overall_full_success_rate")
)

# Intended foreign keys.  Tasks of soft-deleted cases are orphans by design (the models drop
# them), so these warn and don't stop the next layer.
RELATIONSHIP_CHECKS = [
    Check("relationships", "stg_tasks", "case_id", to_model="stg_cases", to_column="case_id",
          layer=STAGING, severity="warn"),
    Check("relationships", "stg_assignments", "task_id", to_model="stg_tasks",
          to_column="task_id", layer=STAGING, severity="warn"),
    Check("relationships", "questionnaire_assignments", "task_id", to_model="stg_tasks",
          to_column="task_id", layer=INTERMEDIATE, severity="warn"),
]

ALL_CHECKS = (SOURCE_CHECKS + STAGING_CHECKS + INTERMEDIATE_CHECKS + MART_CHECKS
              + RELATIONSHIP_CHECKS)
LAYERS = (SOURCE, STAGING, INTERMEDIATE, MART)

# Sources and their loaded-at fields (raw tables; event loads are text).
FAIL_ON_ZERO = {"wf_case": True, "wf_task": True, "wf_assignment": True, "wf_events": True,
                "wf_task_predecessor": False, "cm_case": True, "cm_evidence_document": False,
                "cm_evidence_property": False, "cm_recommender": False}
SOURCES = tuple(FAIL_ON_ZERO)
FRESHNESS_ERROR_HOURS = 30.0
ANOMALY_TRAINING_DAYS = 28
ANOMALY_SENSITIVITY = 3.0

def lineage() -> list[tuple[str, str]]:
    """``(mart, model)``: every mart with itself and all that it reads (for degraded markers)."""
    from .refresh import MODELS, upstream
    return [(mart, name) for mart, m in MODELS.items() if m.layer == MART
            for name in sorted(upstream([mart]))]


def checks_of(kind: str | None = None, layer: str | None = None,
              model: str | None = None) -> list[Check]:
    return [c for c in ALL_CHECKS if (kind is None or c.kind == kind)
            and (layer is None or c.layer == layer) and (model is None or c.model == model)]
