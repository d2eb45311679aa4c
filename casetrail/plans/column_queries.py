"""Registered column-level queries: payload extraction, safe casts, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts
from ..functions.payload import BOOLEAN_KEYS, NUMBER_KEYS
from ..operators import intermediate, staging
from . import oracle
from .models import Models
from .registry import query


@query("event_json_extract", oracle.with_models("select * from raw_events"))
def q_event_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cw_`` events with every payload key as trimmed text."""
    return staging.extract_events(Models.shared(spark, sf_dir).raw.events)


def cast_profile(raw_events: DataFrame, fields, parse) -> DataFrame:
    """Distinct raw values of ``fields`` with their parsed value and error flag.

    Values are unpivoted, counted per ``(field, raw_value)`` (map-side
    combined), and parsed once per distinct raw value.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"raw_{f}").alias("raw_value")) for f in fields
    ])).alias("c")
    counted = (raw_events.select(cells).select("c.field", "c.raw_value")
               .groupBy("field", "raw_value").agg(F.count(F.lit(1)).alias("n_rows")))
    parsed = parse(F.col("raw_value"))
    return counted.select(
        "field", "raw_value", parsed.alias("parsed_value"),
        casts.parse_failed(F.col("raw_value"), parsed).alias("is_parse_error"), "n_rows",
    )


def _cast_sql(fields, parse_sql) -> str:
    names = ", ".join(f"'{f}'" for f in fields)
    vals = ", ".join(f"raw_{f}" for f in fields)
    p = parse_sql("raw_value")
    return oracle.with_models(
        f"select field, raw_value, {p} as parsed_value, "
        f"(raw_value IS NOT NULL AND {p} IS NULL) as is_parse_error, n_rows from ("
        f"select field, raw_value, count(*) as n_rows from ("
        f"select unnest([{names}]) as field, unnest([{vals}]) as raw_value from raw_events) u "
        f"group by field, raw_value) g")


_TS_FIELDS = ("event_time", "ingestion_timestamp")


def _register_cast(key: str, fields, parse, parse_sql):
    @query(key, _cast_sql(fields, parse_sql))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = staging.extract_events(Models.shared(spark, sf_dir).raw.events)
        return cast_profile(raw, fields, parse)
    return build


_register_cast("safe_int64_cast", NUMBER_KEYS, casts.safe_int64, oracle.int64)
_register_cast("safe_float64_cast", NUMBER_KEYS, casts.safe_float64, oracle.float64)
_register_cast("safe_boolean_cast", BOOLEAN_KEYS, casts.safe_boolean, oracle.boolean)
_register_cast("safe_timestamp_cast", _TS_FIELDS, casts.safe_timestamp, oracle.timestamp)

_FLAG_COLS = ("event_natural_key", "has_numeric_parse_error", "has_timestamp_parse_error",
              "raw_event_time", "event_time", "raw_ingestion_timestamp", "ingestion_timestamp",
              *[c for k in NUMBER_KEYS for c in (f"raw_{k}", k)], "duration_seconds")


@query("event_parse_error_flags", oracle.with_models(
    f"select {', '.join(_FLAG_COLS)} from stg_events "
    "where has_numeric_parse_error or has_timestamp_parse_error"))
def q_parse_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged events with each raw value beside its typed value."""
    ev = Models.shared(spark, sf_dir).stg_events
    return ev.where(F.col("has_numeric_parse_error") | F.col("has_timestamp_parse_error")).select(*_FLAG_COLS)


@query("event_natural_key", oracle.with_models(
    "select event_natural_key, count(*) as n_events, min(event_name) as event_name "
    "from stg_events group by event_natural_key"))
def q_natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural keys and how many events share each."""
    ev = Models.shared(spark, sf_dir).stg_events
    return ev.groupBy("event_natural_key").agg(F.count(F.lit(1)).alias("n_events"),
                                               F.min("event_name").alias("event_name"))


@query("questionnaire_event_signal", oracle.with_models("select * from questionnaire_event_signal"))
def q_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questionnaire events rolled up to assignment grain."""
    return intermediate.questionnaire_event_signal(Models.shared(spark, sf_dir).stg_events)


@query("creation_source_classification", oracle.with_models(
    "select task_creation_source, is_non_template_task, is_manually_added_task, "
    "is_custom_task_broad, count(*) as n_tasks from custom_tasks group by 1, 2, 3, 4"))
def q_creation_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task counts per normalised creation source and resulting class."""
    t = Models.shared(spark, sf_dir).custom_tasks
    return (t.groupBy("task_creation_source", "is_non_template_task", "is_manually_added_task",
                      "is_custom_task_broad").agg(F.count(F.lit(1)).alias("n_tasks")))
