"""Business-grain models (B5-B8): case, task and assignment level.

Joins are plain equi-joins; Spark picks broadcast only when a side's
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks
at run time), and AQE splits skewed join partitions otherwise.  Event
aggregates are computed at assignment grain *before* any join (A15), so a hot
assignment collapses to one row in the map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import flag

# Task creation sources by class.
MANUAL_SOURCES = ("manual", "custom", "user_added")
LIBRARY_SOURCES = ("library", "shared_library")
AI_SOURCES = ("ai_suggested", "ai_generated")

# Events that make up the beneficiary upload funnel.
PLUGIN_OPENED = "cw_task_plugin_opened"
UPLOAD_STARTED = "cw_doc_upload_started"
UPLOAD_COMPLETED = "cw_doc_upload_completed"
UPLOAD_EVENTS = (PLUGIN_OPENED, UPLOAD_STARTED, UPLOAD_COMPLETED)
UPLOAD_ACTOR = "beneficiary"
UPLOAD_PLUGIN = "file_upload"
QUESTIONNAIRE_PLUGIN = "questionnaire"
QUESTIONNAIRE_WORD = "questionnaire"

EPOCH_FLOOR = "1900-01-01 00:00:00"


def _days_if_ordered(end: Column, start: Column) -> Column:
    """``end - start`` in days when both exist and end >= start, else NULL."""
    return F.when(end.isNotNull() & start.isNotNull() & (end >= start),
                  F.datediff(end, start))


def case_durations(cases: DataFrame) -> DataFrame:
    """Filed cases with four start-to-filing durations side by side."""
    filing = F.col("filing_date_actual")
    created_d = F.to_date("case_created_at")
    init_d = F.to_date("initialized_at")
    kickoff = F.col("kickoff_date")
    return cases.where(filing.isNotNull()).select(
        "case_id", "beneficiary_id", "catalog_product_id", "flow_template_id",
        "flow_template_version_id", "case_stage", "case_status", "case_matter_case_id",
        "case_created_at",
        created_d.alias("case_created_date"),
        "initialized_at",
        init_d.alias("initialized_date"),
        "kickoff_date",
        "classification_date",
        filing.alias("filing_date"),
        "receipt_date",
        "decision_date",
        _days_if_ordered(filing, created_d).alias("created_to_filing_days"),
        _days_if_ordered(filing, init_d).alias("initialized_to_filing_days"),
        _days_if_ordered(filing, kickoff).alias("kickoff_to_filing_days"),
        _days_if_ordered(filing, F.col("classification_date")).alias("classification_to_filing_days"),
        flag(filing.isNotNull() & kickoff.isNotNull() & (filing >= kickoff))
        .alias("is_valid_primary_duration"),
        flag(F.col("case_matter_case_id").isNotNull()).alias("has_legacy_case_link"),
    )


def creation_source_class(source: Column, template_id: Column) -> tuple[Column, Column, Column]:
    """(manual, non-template, broad custom) 0/1 flags for a normalised source.

    ``source`` must already be lower-cased and coalesced to ``''`` so the
    ``NOT IN`` tests cannot meet a NULL.
    """
    manual = source.isin(*MANUAL_SOURCES)
    non_template = template_id.isNull()
    broad = manual | (non_template & ~source.isin(*LIBRARY_SOURCES) & ~source.isin(*AI_SOURCES))
    return flag(manual), flag(non_template), flag(broad)


def custom_tasks(tasks: DataFrame, cases: DataFrame) -> DataFrame:
    """Tasks of live cases with strict and broad custom-task flags."""
    c = cases.select("case_id", "beneficiary_id", "catalog_product_id",
                     "flow_template_id", "flow_template_version_id")
    source = F.lower(F.coalesce(F.col("task_creation_source"), F.lit("")))
    base = tasks.join(c, "case_id").select(
        "task_id", "case_id", "beneficiary_id", "catalog_product_id", "flow_template_id",
        "flow_template_version_id", "task_name", "task_template_id",
        source.alias("task_creation_source"), "task_sub_stage", "task_status",
        "task_created_at", F.to_date("task_created_at").alias("task_created_date"),
    )
    manual, non_template, broad = creation_source_class(
        F.col("task_creation_source"), F.col("task_template_id"))
    return base.select(
        "*",
        manual.alias("is_manually_added_task"),
        non_template.alias("is_non_template_task"),
        broad.alias("is_custom_task_broad"),
    )


def is_upload_event() -> Column:
    return ((F.col("actor_role") == UPLOAD_ACTOR)
            & (F.col("task_plugin_type") == UPLOAD_PLUGIN)
            & F.col("task_assignment_id").isNotNull()
            & F.col("event_name").isin(*UPLOAD_EVENTS))


def upload_events(events: DataFrame) -> DataFrame:
    """Beneficiary file-upload funnel events with an assignment id."""
    return events.where(is_upload_event()).select("task_assignment_id", "task_id", "case_id", "catalog_product_id",
             "event_name", "event_time", "ingestion_timestamp", "file_count",
             "success_count", "error_count")


def upload_state(upload: DataFrame) -> DataFrame:
    """Funnel steps and counts per assignment, whether or not the plugin was opened.

    Every column is a min, max or sum, so the states of two sets of events merge into
    the state of both (:func:`merge_upload_states`).  The partial aggregate before the
    shuffle bounds a hot assignment to one row per task.
    """
    name = F.col("event_name")
    ts = F.col("event_time")
    files = F.coalesce(F.col("file_count"), F.lit(0))
    ok = F.coalesce(F.col("success_count"), F.lit(0))
    is_open, is_start, is_done = (name == PLUGIN_OPENED), (name == UPLOAD_STARTED), (name == UPLOAD_COMPLETED)
    return upload.groupBy("task_assignment_id").agg(
        F.min("case_id").alias("case_id"),
        F.min("task_id").alias("task_id"),
        F.min("catalog_product_id").alias("catalog_product_id"),
        F.min(F.when(is_open, ts)).alias("first_plugin_opened_at"),
        F.min(F.when(is_start, ts)).alias("first_upload_started_at"),
        F.min(F.when(is_done & (ok > 0), ts)).alias("first_successful_upload_at"),
        F.min(F.when(is_done & (files > 0) & (ok == files), ts)).alias("first_full_success_upload_at"),
        F.max("ingestion_timestamp").alias("max_ingestion_timestamp"),
        F.count(F.when(is_open, 1)).alias("plugin_open_event_count"),
        F.count(F.when(is_start, 1)).alias("upload_started_event_count"),
        F.count(F.when(is_done, 1)).alias("upload_completed_event_count"),
        F.coalesce(F.sum(F.when(is_start, F.col("file_count"))), F.lit(0)).alias("total_files_selected_across_attempts"),
        F.coalesce(F.max(F.when(is_start, F.col("file_count"))), F.lit(0)).alias("max_files_selected_in_single_attempt"),
        F.coalesce(F.sum(F.when(is_done, F.col("success_count"))), F.lit(0)).alias("total_successful_files_uploaded"),
        F.coalesce(F.sum(F.when(is_done, F.col("error_count"))), F.lit(0)).alias("total_failed_files_uploaded"),
    )


def merge_upload_states(states: DataFrame) -> DataFrame:
    """One state per assignment from several (disjoint sets of events)."""
    def merged(c: str) -> Column:
        if c.startswith(("max_",)):
            return F.max(c).alias(c)
        if c.endswith("_event_count") or c.startswith("total_"):
            return F.sum(c).alias(c)
        return F.min(c).alias(c)

    return states.groupBy("task_assignment_id").agg(
        *[merged(c) for c in states.columns if c != "task_assignment_id"])


def attempts_of_state(state: DataFrame) -> DataFrame:
    """B7 rows: the assignments whose plugin was opened, with their flags."""
    return state.where(F.col("first_plugin_opened_at").isNotNull()).select(
        "task_assignment_id", "case_id", "task_id", "catalog_product_id",
        "first_plugin_opened_at", "first_upload_started_at", "first_successful_upload_at",
        "first_full_success_upload_at", "max_ingestion_timestamp",
        "plugin_open_event_count", "upload_started_event_count", "upload_completed_event_count",
        "total_files_selected_across_attempts", "max_files_selected_in_single_attempt",
        "total_successful_files_uploaded", "total_failed_files_uploaded",
        F.to_date("first_plugin_opened_at").alias("plugin_opened_date"),
        flag(F.col("first_plugin_opened_at").isNotNull()).alias("opened_plugin"),
        flag(F.col("first_upload_started_at").isNotNull()).alias("started_upload"),
        flag(F.col("first_successful_upload_at").isNotNull()).alias("has_successful_upload"),
        flag(F.col("first_full_success_upload_at").isNotNull()).alias("uploaded_all_selected_files"),
    )


def rollup_upload_attempts(upload: DataFrame) -> DataFrame:
    """B7 core: assignment-grain funnel steps from upload events."""
    return attempts_of_state(upload_state(upload))


def file_upload_attempts(events: DataFrame) -> DataFrame:
    """One row per assignment whose beneficiary opened the upload plugin."""
    return rollup_upload_attempts(upload_events(events))


def questionnaire_events(events: DataFrame) -> DataFrame:
    """Questionnaire plugin events that name an assignment."""
    return events.where(F.col("task_assignment_id").isNotNull()
                        & (F.col("task_plugin_type") == QUESTIONNAIRE_PLUGIN))


def questionnaire_event_signal(events: DataFrame) -> DataFrame:
    """Questionnaire plugin events pre-aggregated to assignment grain."""
    return (
        questionnaire_events(events)
        .groupBy("task_assignment_id")
        .agg(
            F.min("event_time").alias("first_questionnaire_event_at"),
            F.max("ingestion_timestamp").alias("max_questionnaire_event_ingestion_timestamp"),
            F.count(F.lit(1)).alias("questionnaire_event_count"),
        )
    )


def _contains_word(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit(""))).contains(QUESTIONNAIRE_WORD)


def questionnaire_candidates(assignments: DataFrame, tasks: DataFrame, cases: DataFrame,
                             events: DataFrame) -> DataFrame:
    """Assignments of live tasks/cases with at least one of the three questionnaire signals.

    The signals filter the assignments before the case join, so that join reads and
    shuffles questionnaire assignments only.
    """
    a = assignments.select(
        "task_assignment_id", "task_id", "assignment_action", "assignment_status",
        "assignment_role_binding", "assignee_role", "iteration_count", "activated_ts",
        "submitted_ts", "completed_ts", "assignment_created_at", "assignment_updated_at",
        _contains_word(F.col("assignment_action")).alias("_by_action"))
    t = tasks.select("task_id", "case_id", "task_name", "task_sub_stage", "task_creation_source",
                     _contains_word(F.col("task_name")).alias("_by_name"))
    c = cases.select("case_id", "beneficiary_id", "catalog_product_id", "flow_template_id",
                     "flow_template_version_id")
    base = a.join(t, "task_id")
    sig = questionnaire_event_signal(events).withColumnRenamed("task_assignment_id", "sig_id")
    joined = base.join(sig, base.task_assignment_id.cast("string") == sig.sig_id, "left")
    by_name, by_action = F.col("_by_name"), F.col("_by_action")
    by_event = F.col("sig_id").isNotNull()
    return joined.where(by_name | by_action | by_event).select(
        "*",
        flag(by_name).alias("matched_task_name_signal"),
        flag(by_action).alias("matched_action_signal"),
        flag(by_event).alias("matched_amplitude_signal"),
    ).drop("_by_name", "_by_action").join(c, "case_id")


def source_updated_at() -> Column:
    """Later of the assignment update and the newest questionnaire event load."""
    floor = F.lit(EPOCH_FLOOR).cast("timestamp")
    return F.greatest(F.coalesce(F.col("assignment_updated_at"), floor),
                      F.coalesce(F.col("max_questionnaire_event_ingestion_timestamp"), floor))


QUESTIONNAIRE_COLUMNS = (
    "task_assignment_id", "task_id", "case_id", "beneficiary_id", "catalog_product_id",
    "flow_template_id", "flow_template_version_id", "task_name", "task_sub_stage",
    "task_creation_source", "assignment_action", "assignment_status",
    "assignment_role_binding", "assignee_role", "iteration_count", "activated_ts",
    "submitted_ts", "completed_ts", "assignment_created_at", "assignment_updated_at",
    "first_questionnaire_event_at", "max_questionnaire_event_ingestion_timestamp",
    "questionnaire_event_count", "matched_task_name_signal", "matched_action_signal",
    "matched_amplitude_signal",
)


def questionnaire_assignments(assignments: DataFrame, tasks: DataFrame, cases: DataFrame,
                              events: DataFrame) -> DataFrame:
    """Questionnaire assignments found by task name, action or event signal."""
    cand = questionnaire_candidates(assignments, tasks, cases, events)
    activated = F.col("activated_ts")
    return cand.select(
        *QUESTIONNAIRE_COLUMNS,
        F.to_date(activated).alias("activation_date"),
        F.date_trunc("week", activated).cast("date").alias("activation_week"),
        flag(activated.isNotNull()).alias("is_activated"),
        flag(F.col("submitted_ts").isNotNull()).alias("is_submitted"),
        flag(F.col("completed_ts").isNotNull()).alias("is_reviewer_completed"),
        source_updated_at().alias("source_updated_at"),
    )
