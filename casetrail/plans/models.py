"""The model graph as lazy DataFrames: raw -> staging -> intermediate -> marts.

``Models`` wires the operator functions together once per source folder.
Nothing runs until an action; models used by several consumers are shared
sub-plans, so Spark reuses their exchanges within one query where it can.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import intermediate, marts, metrics, staging
from ..sources.fixtures import RawSources


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str, raw: RawSources | None = None):
        self.spark = spark
        self.raw = raw or RawSources(spark, sf_dir)

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Models":
        """The model graph of a source folder as it is now.

        Built per call: a DataFrame keeps the file listing it was made with, so a graph
        kept for the process would never see files that arrive later.
        """
        return cls(spark, sf_dir)

    # staging
    @cached_property
    def stg_cases(self) -> DataFrame:
        return staging.stg_cases(self.raw.cases)

    @cached_property
    def stg_tasks(self) -> DataFrame:
        return staging.stg_tasks(self.raw.tasks)

    @cached_property
    def stg_assignments(self) -> DataFrame:
        return staging.stg_assignments(self.raw.assignments)

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.raw.events)

    # intermediate
    @cached_property
    def case_durations(self) -> DataFrame:
        return intermediate.case_durations(self.stg_cases)

    @cached_property
    def custom_tasks(self) -> DataFrame:
        return intermediate.custom_tasks(self.stg_tasks, self.stg_cases)

    @cached_property
    def file_upload_attempts(self) -> DataFrame:
        return intermediate.file_upload_attempts(self.stg_events)

    @cached_property
    def questionnaire_assignments(self) -> DataFrame:
        return intermediate.questionnaire_assignments(
            self.stg_assignments, self.stg_tasks, self.stg_cases, self.stg_events)

    # marts
    @cached_property
    def case_duration_daily(self) -> DataFrame:
        return marts.case_duration_daily(self.case_durations)

    @cached_property
    def case_duration_values(self) -> DataFrame:
        return marts.case_duration_values(self.case_durations)

    @cached_property
    def custom_tasks_daily(self) -> DataFrame:
        return marts.custom_tasks_daily(self.custom_tasks)

    @cached_property
    def file_upload_daily(self) -> DataFrame:
        return marts.file_upload_daily(self.file_upload_attempts)

    @cached_property
    def questionnaire_daily(self) -> DataFrame:
        return marts.questionnaire_daily(self.questionnaire_assignments)

    # analyst metrics
    @cached_property
    def metric_questionnaire_weekly(self) -> DataFrame:
        return metrics.questionnaire_weekly(self.questionnaire_assignments)

    @cached_property
    def metric_custom_task_share(self) -> DataFrame:
        return metrics.custom_task_share(self.custom_tasks)

    @cached_property
    def metric_case_duration(self) -> DataFrame:
        return metrics.case_duration(self.case_durations)

    @cached_property
    def metric_upload_funnel(self) -> DataFrame:
        return metrics.upload_funnel(self.file_upload_attempts)

    def get(self, name: str) -> DataFrame:
        """A model by name (``stg_events``, ``file_upload_daily``, ...)."""
        if not hasattr(type(self), name):
            raise KeyError(f"unknown model {name!r}")
        return getattr(self, name)


MODEL_NAMES = (
    "stg_cases", "stg_tasks", "stg_assignments", "stg_events",
    "case_durations", "custom_tasks", "file_upload_attempts", "questionnaire_assignments",
    "case_duration_daily", "custom_tasks_daily", "file_upload_daily", "questionnaire_daily",
)
