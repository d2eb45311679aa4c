"""Registered queries: one Spark builder and (where SQL can say it) one oracle SQL.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables.  Builders are registered with :func:`query`; modules with
more queries import this one and register theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .models import Models

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional oracle SQL."""
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models.shared(spark, sf_dir)


def _model_query(name: str, select: str | None = None):
    sql = oracle.with_models(select) if select else oracle.model(name)

    @query(name, sql)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return models(spark, sf_dir).get(name)
    build.__name__ = f"q_{name}"
    return build


for _name in ("stg_cases", "stg_tasks", "stg_assignments", "stg_events",
              "case_durations", "custom_tasks", "file_upload_attempts",
              "questionnaire_assignments", "case_duration_daily", "custom_tasks_daily",
              "file_upload_daily", "questionnaire_daily", "metric_questionnaire_weekly",
              "metric_custom_task_share", "metric_case_duration", "metric_upload_funnel"):
    _model_query(_name)


def load_all() -> None:
    """Import every module that registers queries."""
    from . import column_queries, dq_queries, incremental_queries, more_queries  # noqa: F401
