"""Event staging on a small hand-written feed."""

import json

from pyspark.sql import functions as F

from casetrail.operators import staging


def _feed(spark, rows):
    return spark.createDataFrame(
        [(et, it, typ, json.dumps(p) if isinstance(p, dict) else p) for et, it, typ, p in rows],
        "event_time string, ingestion_timestamp string, event_type string, event_properties string")


def test_stg_events_types_flags_and_prefix(spark):
    feed = _feed(spark, [
        ("2026-05-29T12:31:45Z", "1716986100000", "cw_doc_upload_started",
         {"task_assignment_id": " 42 ", "task_plugin_type": " File_Upload ", "actor_role": "Beneficiary",
          "file_count": "1,200", "success_count": "n/a", "duration_ms": "1520.5",
          "user_can_act": "yes"}),
        ("not-a-date", "null", "cw_task_viewed", {"file_count": 3, "duration_ms": "1520.0"}),
        ("2026-05-29 12:31:45+00", "2026-05-29 13:00:00", "app_error", {"file_count": 1}),
        ("cwx", "", "cwxtask", {}),
    ])
    out = staging.stg_events(feed).orderBy("event_name").collect()
    assert [r.event_name for r in out] == ["cw_doc_upload_started", "cw_task_viewed"]
    a, b = out
    assert a.task_assignment_id == "42" and a.task_plugin_type == "file_upload"
    assert a.actor_role == "beneficiary" and a.user_can_act is True
    assert a.file_count == 1200 and a.success_count is None and a.duration_ms is None
    assert abs(a.duration_seconds - 1.5205) < 1e-12
    assert a.has_numeric_parse_error is True and a.has_timestamp_parse_error is False
    assert a.raw_file_count == "1,200"
    assert b.event_time is None and b.ingestion_timestamp is None
    assert b.has_timestamp_parse_error is True and b.has_numeric_parse_error is False
    assert b.file_count == 3 and b.duration_ms == 1520 and b.duration_seconds == 1.52
    assert len(a.event_natural_key) == 32 and a.event_natural_key != b.event_natural_key


def test_prefix_filter_reaches_parquet_scan(spark, tmp_path):
    feed = _feed(spark, [("2026-01-01", "2026-01-01", "cw_task_viewed", {})])
    path = str(tmp_path / "raw")
    feed.write.parquet(path)
    plan = staging.stg_events(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(event_type,cw_)" in plan


def test_soft_deletes_removed(spark):
    raw = spark.createDataFrame([(1, None), (2, "2024-01-01")], "id long, deleted_at string")
    raw = raw.select("id", F.col("deleted_at").cast("timestamp"))
    for col in ("beneficiary_id", "catalog_product_id", "flow_template_id", "flow_template_version_id",
                "stage", "status", "stage_instance_id", "kickoff_date", "classification_date",
                "filing_date_actual", "receipt_date", "decision_date", "initialized_at",
                "case_matter_case_id", "created_at", "updated_at", "ingestion_timestamp"):
        raw = raw.withColumn(col, F.lit(None).cast("string"))
    assert [r.case_id for r in staging.stg_cases(raw).collect()] == [1]


def test_soft_delete_filter_reaches_parquet_scan(spark, tmp_path):
    from casetrail.sources import sinks
    path = str(tmp_path / "cw_case")
    spark.createDataFrame([], sinks.CASE_SCHEMA).write.parquet(path)
    raw = sinks.read_raw(spark, "cw_case", path)
    plan = staging.stg_cases(raw)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(deleted_at)]" in plan
