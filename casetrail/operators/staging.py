"""Staging models (B1-B4): typed, renamed, soft deletes removed.

Each function is ``raw DataFrame -> staged DataFrame`` and stays lazy; the
soft-delete filter and the event-name prefix are plain predicates that
Catalyst pushes into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts
from ..functions.keys import md5_key
from ..functions.payload import BOOLEAN_KEYS, NUMBER_KEYS, TEXT_KEYS, payload_keys

EVENT_PREFIX = "cw_"


def stg_cases(raw: DataFrame) -> DataFrame:
    """B1: non-deleted cases with model column names."""
    return raw.where(F.col("deleted_at").isNull()).select(
        F.col("id").alias("case_id"),
        "beneficiary_id",
        "catalog_product_id",
        "flow_template_id",
        "flow_template_version_id",
        F.col("stage").cast("string").alias("case_stage"),
        F.col("status").cast("string").alias("case_status"),
        "stage_instance_id",
        "kickoff_date",
        "classification_date",
        "filing_date_actual",
        "receipt_date",
        "decision_date",
        "initialized_at",
        "case_matter_case_id",
        F.col("created_at").alias("case_created_at"),
        F.col("updated_at").alias("case_updated_at"),
        F.col("deleted_at").alias("case_deleted_at"),
        "ingestion_timestamp",
    )


def stg_tasks(raw: DataFrame) -> DataFrame:
    """B2: non-deleted tasks."""
    return raw.where(F.col("deleted_at").isNull()).select(
        F.col("id").alias("task_id"),
        "case_id",
        F.col("name").alias("task_name"),
        F.col("description").alias("task_description"),
        "task_template_id",
        F.col("creation_source").cast("string").alias("task_creation_source"),
        F.col("case_stage_scope").cast("string").alias("case_stage_scope"),
        F.col("sub_stage").alias("task_sub_stage"),
        F.col("status").cast("string").alias("task_status"),
        F.col("blocked_reason").cast("string").alias("blocked_reason"),
        "force_unblocked",
        F.col("activation_ts").alias("task_activated_ts"),
        F.col("completion_ts").alias("task_completed_ts"),
        F.col("created_at").alias("task_created_at"),
        F.col("updated_at").alias("task_updated_at"),
        F.col("deleted_at").alias("task_deleted_at"),
        "ingestion_timestamp",
    )


def stg_assignments(raw: DataFrame) -> DataFrame:
    """Non-deleted task assignments."""
    return raw.where(F.col("deleted_at").isNull()).select(
        F.col("id").alias("task_assignment_id"),
        "task_id",
        F.col("role_binding").cast("string").alias("assignment_role_binding"),
        F.col("role").alias("assignee_role"),
        F.col("action").cast("string").alias("assignment_action"),
        F.col("status").cast("string").alias("assignment_status"),
        "iteration_count",
        "active_time_ms",
        "auto_activate",
        "activated_ts",
        "submitted_ts",
        "completed_ts",
        F.col("created_at").alias("assignment_created_at"),
        F.col("updated_at").alias("assignment_updated_at"),
        F.col("deleted_at").alias("assignment_deleted_at"),
        "ingestion_timestamp",
    )


def extract_events(raw: DataFrame) -> DataFrame:
    """Workflow events with payload values as text.

    Keeps ``cw_``-prefixed events only (a literal prefix, pushed to the scan),
    parses the payload once (``json_tuple``), trims text keys to NULL when blank
    and keeps boolean/number keys untouched for the safe casts.
    """
    base = raw.where(F.col("event_type").startswith(EVENT_PREFIX)).select(
        "event_time", "ingestion_timestamp", "event_type", "event_properties",
        payload_keys("event_properties"),
    )
    return base.select(
        casts.blank_to_null("event_time").alias("raw_event_time"),
        casts.blank_to_null("ingestion_timestamp").alias("raw_ingestion_timestamp"),
        "event_type",
        "event_properties",
        *[casts.blank_to_null(F.col(f"_j_{k}")).alias(f"raw_{k}") for k in TEXT_KEYS],
        *[F.col(f"_j_{k}").alias(f"raw_{k}") for k in BOOLEAN_KEYS + NUMBER_KEYS],
    )


def stg_events(raw: DataFrame) -> DataFrame:
    """Typed workflow events with raw values kept beside typed ones.

    Output: natural key, parsed timestamps, 13 text keys, 2 booleans, 6
    integers, seconds, 10 raw columns and the two parse-error flags.
    """
    ex = extract_events(raw)
    r = lambda k: F.col(f"raw_{k}")
    typed = ex.select(
        "*",
        casts.safe_timestamp(r("event_time")).alias("event_time"),
        casts.safe_timestamp(r("ingestion_timestamp")).alias("ingestion_timestamp"),
        *[casts.safe_int64(r(k)).alias(k) for k in NUMBER_KEYS],
        (casts.safe_float64(r("duration_ms")) / F.lit(1000.0)).alias("duration_seconds"),
    )
    numeric_flag = casts.any_parse_failed([(r(k), F.col(k)) for k in NUMBER_KEYS])
    ts_flag = casts.any_parse_failed([
        (r("event_time"), F.col("event_time")),
        (r("ingestion_timestamp"), F.col("ingestion_timestamp")),
    ])
    return typed.select(
        md5_key(r("event_time"), r("ingestion_timestamp"), F.col("event_type"),
                r("case_id"), r("task_id"), r("task_assignment_id"),
                F.col("event_properties")).alias("event_natural_key"),
        "event_time",
        F.to_date("event_time").alias("event_date"),
        "ingestion_timestamp",
        F.col("event_type").alias("event_name"),
        "event_properties",
        r("case_id").alias("case_id"),
        r("task_id").alias("task_id"),
        r("task_assignment_id").alias("task_assignment_id"),
        r("task_assignee_role").alias("task_assignee_role"),
        r("task_active_assignment_action").alias("task_active_assignment_action"),
        F.lower(r("task_plugin_type")).alias("task_plugin_type"),
        r("task_sub_stage").alias("task_sub_stage"),
        r("task_workflow_status").alias("task_workflow_status"),
        r("catalog_product_id").alias("catalog_product_id"),
        r("catalog_product_name").alias("catalog_product_name"),
        r("catalog_product_service_name").alias("catalog_product_service_name"),
        r("flow_template_id").alias("flow_template_id"),
        F.lower(r("actor_role")).alias("actor_role"),
        casts.safe_boolean(r("user_can_act")).alias("user_can_act"),
        casts.safe_boolean(r("user_can_claim")).alias("user_can_claim"),
        *NUMBER_KEYS,
        "duration_seconds",
        "raw_user_can_act",
        "raw_user_can_claim",
        "raw_event_time",
        "raw_ingestion_timestamp",
        *[f"raw_{k}" for k in NUMBER_KEYS],
        numeric_flag.alias("has_numeric_parse_error"),
        ts_flag.alias("has_timestamp_parse_error"),
    )
