"""Business-grain models on small frames (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from casetrail.operators import intermediate

EV_SCHEMA = ("task_assignment_id string, task_id string, case_id string, catalog_product_id string, "
             "event_name string, event_time timestamp, ingestion_timestamp timestamp, "
             "file_count long, success_count long, error_count long, actor_role string, "
             "task_plugin_type string")


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def ev(aid, name, day, files=None, ok=None, err=None, role="beneficiary", plugin="file_upload",
       product="p1"):
    return (aid, "t" + str(aid), "c1", product, name, ts(day), ts(day, 1), files, ok, err, role, plugin)


OPEN, START, DONE = intermediate.UPLOAD_EVENTS


def test_upload_funnel_steps(spark):
    rows = [
        # a1: re-opens, retries, completion with success 0 then partial then full
        ev("a1", OPEN, 1), ev("a1", OPEN, 2), ev("a1", START, 2, files=3), ev("a1", START, 3, files=2),
        ev("a1", DONE, 3, files=3, ok=0, err=3), ev("a1", DONE, 4, files=3, ok=1, err=2),
        ev("a1", DONE, 5, files=2, ok=2, err=0),
        # a2: completion without start, start before open
        ev("a2", DONE, 3, files=1, ok=1, err=0), ev("a2", START, 1, files=1), ev("a2", OPEN, 2),
        # a3: attorney rows are ignored; beneficiary open only
        ev("a3", OPEN, 4, role="attorney"), ev("a3", START, 4, role="attorney"), ev("a3", OPEN, 6),
        # a4: never opened -> not in the cohort
        ev("a4", START, 1, files=1),
        # missing assignment id -> dropped
        ev(None, OPEN, 1),
        # other plugin -> ignored
        ev("a5", OPEN, 1, plugin="questionnaire"),
    ]
    df = spark.createDataFrame(rows, EV_SCHEMA)
    out = {r.task_assignment_id: r for r in intermediate.file_upload_attempts(df).collect()}
    assert set(out) == {"a1", "a2", "a3"}
    a1, a2, a3 = out["a1"], out["a2"], out["a3"]
    assert a1.plugin_opened_date == dt.date(2024, 1, 1)
    assert (a1.plugin_open_event_count, a1.upload_started_event_count, a1.upload_completed_event_count) == (2, 2, 3)
    assert a1.first_successful_upload_at == ts(4) and a1.first_full_success_upload_at == ts(5)
    assert a1.total_files_selected_across_attempts == 5 and a1.max_files_selected_in_single_attempt == 3
    assert a1.total_successful_files_uploaded == 3 and a1.total_failed_files_uploaded == 5
    assert (a1.opened_plugin, a1.started_upload, a1.has_successful_upload, a1.uploaded_all_selected_files) == (1, 1, 1, 1)
    assert (a2.started_upload, a2.has_successful_upload, a2.uploaded_all_selected_files) == (1, 1, 1)
    assert a2.first_upload_started_at < a2.first_plugin_opened_at
    assert (a3.plugin_open_event_count, a3.started_upload) == (1, 0)
    assert a3.total_files_selected_across_attempts == 0


CASE_SCHEMA = ("case_id long, beneficiary_id long, catalog_product_id string, flow_template_id long, "
               "flow_template_version_id long, case_stage string, case_status string, "
               "case_matter_case_id long, case_created_at timestamp, initialized_at timestamp, "
               "kickoff_date date, classification_date date, filing_date_actual date, "
               "receipt_date date, decision_date date")


def _case(cid, created, init, kickoff, classification, filing, legacy=None, product="p"):
    return (cid, 1, product, 1, 1, "s", "st", legacy, created, init, kickoff, classification,
            filing, None, None)


def test_case_durations_guards(spark):
    d = dt.date
    rows = [
        _case(1, ts(1), ts(2), d(2024, 1, 3), d(2024, 1, 4), d(2024, 1, 10), legacy=9),
        _case(2, None, None, None, None, d(2024, 1, 10)),              # each start null
        _case(3, ts(20), ts(20), d(2024, 1, 20), d(2024, 1, 20), d(2024, 1, 10)),  # end before start
        _case(4, ts(10, 23), ts(10), d(2024, 1, 10), d(2024, 1, 10), d(2024, 1, 10)),  # same day
        _case(5, ts(1), ts(1), d(2024, 1, 1), d(2024, 1, 1), None),     # not filed
    ]
    cases = spark.createDataFrame(rows, CASE_SCHEMA)
    out = {r.case_id: r for r in intermediate.case_durations(cases).collect()}
    assert set(out) == {1, 2, 3, 4}
    r1 = out[1]
    assert (r1.created_to_filing_days, r1.initialized_to_filing_days, r1.kickoff_to_filing_days,
            r1.classification_to_filing_days) == (9, 8, 7, 6)
    assert r1.is_valid_primary_duration == 1 and r1.has_legacy_case_link == 1
    assert out[2].kickoff_to_filing_days is None and out[2].is_valid_primary_duration == 0
    assert out[3].kickoff_to_filing_days is None and out[3].is_valid_primary_duration == 0
    assert out[4].kickoff_to_filing_days == 0 and out[4].created_to_filing_days == 0


def test_custom_task_classes(spark):
    tasks = spark.createDataFrame([
        (1, 10, "Manual", 5), (2, 10, None, None), (3, 10, "library", None), (4, 10, "ai_generated", None),
        (5, 10, "template", None), (6, 10, "user_added", 7), (7, 99, "manual", 1), (8, 11, "custom", 1),
    ], "task_id long, case_id long, task_creation_source string, task_template_id long")
    for c in ("task_name", "task_sub_stage", "task_status"):
        tasks = tasks.withColumn(c, F.lit("x"))
    tasks = tasks.withColumn("task_created_at", F.lit(ts(1)))
    cases = spark.createDataFrame([(10, 1, "p", 1, 1), (11, 1, "q", 1, 1)],
                                  "case_id long, beneficiary_id long, catalog_product_id string, "
                                  "flow_template_id long, flow_template_version_id long")
    out = {r.task_id: (r.is_manually_added_task, r.is_non_template_task, r.is_custom_task_broad)
           for r in intermediate.custom_tasks(tasks, cases).collect()}
    # orphan task 7 (case 99, e.g. a deleted case) is dropped by the inner join
    assert out == {1: (1, 0, 1), 2: (0, 1, 1), 3: (0, 1, 0), 4: (0, 1, 0), 5: (0, 1, 1),
                   6: (1, 0, 1), 8: (1, 0, 1)}


def test_questionnaire_signals(spark):
    a = spark.createDataFrame([
        (1, 1, "review", ts(1), None, None), (2, 2, "fill_Questionnaire", None, ts(2), None),
        (3, 3, "review", ts(3), ts(3), ts(4)), (4, 4, "review", ts(1), None, None),
    ], "task_assignment_id long, task_id long, assignment_action string, activated_ts timestamp, "
       "submitted_ts timestamp, completed_ts timestamp")
    for c in ("assignment_status", "assignment_role_binding", "assignee_role"):
        a = a.withColumn(c, F.lit("x"))
    a = (a.withColumn("iteration_count", F.lit(0)).withColumn("assignment_created_at", F.lit(ts(1)))
         .withColumn("assignment_updated_at", F.lit(ts(1))))
    t = spark.createDataFrame([(1, 10, "Client Questionnaire"), (2, 10, "Review"), (3, 10, "Review"),
                               (4, 10, "Review")], "task_id long, case_id long, task_name string")
    t = t.withColumn("task_sub_stage", F.lit("s")).withColumn("task_creation_source", F.lit("x"))
    c = spark.createDataFrame([(10, 7, "p", 1, 1)], "case_id long, beneficiary_id long, "
                              "catalog_product_id string, flow_template_id long, flow_template_version_id long")
    e = spark.createDataFrame([("3", "questionnaire", ts(5), ts(8))],
                              "task_assignment_id string, task_plugin_type string, event_time timestamp, "
                              "ingestion_timestamp timestamp")
    out = {r.task_assignment_id: r for r in intermediate.questionnaire_assignments(a, t, c, e).collect()}
    assert set(out) == {1, 2, 3}
    assert (out[1].matched_task_name_signal, out[1].matched_action_signal, out[1].matched_amplitude_signal) == (1, 0, 0)
    assert (out[2].matched_action_signal, out[2].is_activated, out[2].is_submitted) == (1, 0, 1)
    assert out[3].matched_amplitude_signal == 1 and out[3].source_updated_at == ts(8)
    assert out[3].activation_week == dt.date(2024, 1, 1)  # Monday
    assert out[3].is_reviewer_completed == 1
