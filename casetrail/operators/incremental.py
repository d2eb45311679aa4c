"""Incremental refresh with a late-data lookback.

Every model follows the same shape: read the watermark from the current
target (``max(ts) - 2 days``, or 1900-01-01 when the target is empty), find
what changed since, recompute only that, and upsert by the model key.  The
watermark is a scalar subquery, so it stays inside the plan (no driver round
trip) and is computed once.

``target=None`` is a first run and gives the full build (I7).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import runs
from ..sources.sinks import EVENT_SCHEMA, replace_groups, upsert_frame
from . import intermediate, marts, staging

LOOKBACK = "2 days"
FLOOR = "1900-01-01 00:00:00"


def watermark(target: DataFrame, ts_col: str, lookback: str = LOOKBACK) -> Column:
    """``coalesce(max(ts), 1900-01-01) - lookback`` as a scalar subquery.

    Spark evaluates it once (a partial + final ``max``) and uses the value in
    the filter; nothing is collected to the driver.
    """
    top = F.coalesce(F.max(F.col(ts_col)), F.lit(FLOOR).cast("timestamp"))
    return target.select(top - F.expr(f"INTERVAL {lookback}")).scalar()


def since(df: DataFrame, ts: Column, wm: Column, keep_null: bool = False) -> DataFrame:
    """Rows with ``ts >= watermark`` (and NULL ``ts`` rows when ``keep_null``, I2)."""
    cond = ts >= wm
    if keep_null:
        cond = cond | ts.isNull()
    return df.where(cond)


def stage_events(raw_events: DataFrame, target: DataFrame | None = None,
                 deduplicate: bool = False) -> DataFrame:
    """B4 incremental: new events since the watermark, upserted by natural key."""
    staged = staging.stg_events(raw_events)
    if target is None:
        new = staged
    else:
        new = since(staged, F.col("ingestion_timestamp"),
                    watermark(target, "ingestion_timestamp"), keep_null=True)
    if deduplicate:
        new = new.dropDuplicates(["event_natural_key"])
    return upsert_frame(target, new, "event_natural_key")


EVENT_PARTITION = "ingestion_date"
EVENTS_TABLE = "stg_events"


def event_schema(spark: SparkSession) -> T.StructType:
    """Schema of the event log: staged events and their load date."""
    staged = staging.stg_events(spark.createDataFrame([], EVENT_SCHEMA)).schema
    return T.StructType([*staged.fields, T.StructField(EVENT_PARTITION, T.DateType())])


def unseen_events(new: DataFrame, seen: DataFrame | None, landing: str,
                  ) -> tuple[DataFrame, dt.datetime | None]:
    """The events of ``new`` that the log ``seen`` lacks, with their load date, and the newest
    load time in ``new`` (I1, I2, K2).

    ``new`` is parsed once, into ``landing``.  A natural key fixes the load date, so only the
    load dates of the new events are compared, as literals that prune the log's partitions;
    there are as many as the calendar has days.
    """
    spark = new.sparkSession
    day = F.to_date("ingestion_timestamp")
    unique = new.dropDuplicates(["event_natural_key"]).withColumn(EVENT_PARTITION, day)
    unique.write.mode("overwrite").option("compression", "zstd").parquet(landing)
    rows = spark.read.schema(unique.schema).parquet(landing)
    days = rows.groupBy(EVENT_PARTITION).agg(F.max("ingestion_timestamp").alias("newest")).collect()
    if seen is not None and days:
        dates = [d[EVENT_PARTITION] for d in days if d[EVENT_PARTITION] is not None]
        here = F.col(EVENT_PARTITION).isin(dates)
        if len(dates) < len(days):
            here = here | F.col(EVENT_PARTITION).isNull()
        rows = rows.join(seen.where(here).select("event_natural_key"), "event_natural_key",
                         "left_anti")
    return rows, max((d["newest"] for d in days if d["newest"] is not None), default=None)


def events_since(raw_events: DataFrame, mark: dt.datetime | None) -> DataFrame:
    """Staged events loaded since a literal watermark less the lookback, or never stamped."""
    new = staging.stg_events(raw_events)
    if mark is None:
        return new
    return since(new, F.col("ingestion_timestamp"),
                 F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {LOOKBACK}"), keep_null=True)


def later(*times: dt.datetime | None) -> dt.datetime | None:
    return max((t for t in times if t is not None), default=None)


def stage_events_into(raw_events: DataFrame, root: str, run_id: str | None = None) -> runs.Run:
    """B4 incremental against the stored event log.

    The log is append-only: a run adds the events that it lacks, under its own id and their load
    dates, and rewrites nothing.  The watermark is committed with the run, so a run that fails
    before its commit leaves both as they were and a retry reads the same days again.
    """
    spark = raw_events.sparkSession
    before = runs.last(spark, root)
    run_id = run_id or runs.new_id()
    mark = before.watermark if before else None
    rows, newest = unseen_events(events_since(raw_events, mark), read_events(spark, root, before),
                                 f"{root}/_landed/{runs.RUN}={run_id}")
    return runs.append(rows, root, EVENTS_TABLE, run_id, before, before.number + 1 if before else 1,
                       later(mark, newest), [EVENT_PARTITION])


def read_events(spark: SparkSession, root: str, run: runs.Run | None = None) -> DataFrame | None:
    """The event log as of a run (default: the newest committed one), with its partition columns;
    None before the first run."""
    run = run or runs.last(spark, root)
    if run is None:
        return None
    return runs.read_log(spark, f"{root}/{EVENTS_TABLE}", run.history, event_schema(spark))


# ------------------------------------------------------------- version diffs
def version_diff(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """``(key, change)`` of the keys whose rows differ between two versions of a table:
    ``inserted``, ``changed`` or ``deleted``.

    Both versions are reduced to key and row hash (two hashes over all columns and their null
    marks), so the one shuffle carries 40 bytes a row whatever the table's width.  Keys may
    repeat or be null: the rows of a key are compared as a bag.
    """
    def hashed(df: DataFrame, side: int) -> DataFrame:
        cols = [F.col(f"`{c}`") for c in now.columns]
        marks = [c.isNull() for c in cols]              # a hash passes over a null column
        both = F.xxhash64(*cols, *marks), F.hash(*cols, *marks).cast("bigint")
        return df.select(F.col(f"`{key}`").alias(key), F.lit(side).alias("side"),
                         *[h.cast("decimal(20,0)").alias(f"h{i}") for i, h in enumerate(both)])

    rows = hashed(before, 0).unionByName(hashed(now, 1))

    def total(column: str, side: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col(column))), F.lit(0))

    had, has = (F.count(F.when(F.col("side") == s, 1)) for s in (0, 1))
    same = (had == has) & (total("h0", 0) == total("h0", 1)) & (total("h1", 0) == total("h1", 1))
    change = F.when(had == 0, "inserted").when(has == 0, "deleted").when(~same, "changed")
    return rows.groupBy(key).agg(change.alias("change")).where(F.col("change").isNotNull())


def changed_questionnaires(before: dict[str, DataFrame], now: dict[str, DataFrame],
                           added_events: DataFrame) -> DataFrame:
    """I5 without a watermark: ids of the assignments whose row can differ from the last run.

    These are the assignments that changed, those of changed tasks and of changed cases (renamed,
    soft-deleted, restored; tasks as they were and as they are), and those of added events,
    stamped or not.  Column ``task_assignment_id``, as text.
    """
    cases = version_diff(before["stg_cases"], now["stg_cases"], "case_id").select("case_id")
    tasks = version_diff(before["stg_tasks"], now["stg_tasks"], "task_id").select("task_id")
    moved = tasks
    for version in (before, now):
        moved = moved.unionByName(version["stg_tasks"].join(cases, "case_id", "left_semi")
                                  .select("task_id"))
    ids = version_diff(before["stg_assignments"], now["stg_assignments"], "task_assignment_id"
                       ).select(F.col("task_assignment_id").cast("string"))
    for version in (before, now):
        ids = ids.unionByName(version["stg_assignments"].join(moved, "task_id", "left_semi")
                              .select(F.col("task_assignment_id").cast("string")))
    asked = intermediate.questionnaire_events(added_events).select("task_assignment_id")
    return ids.unionByName(asked).distinct()


def questionnaires_of(changed: DataFrame, assignments: DataFrame, tasks: DataFrame,
                      cases: DataFrame, events: DataFrame, target: DataFrame) -> DataFrame:
    """B8 for known changes: the changed assignments are rebuilt, or leave the table."""
    ids = changed.select(F.col("task_assignment_id").alias("changed_id"))

    def only(df: DataFrame) -> DataFrame:
        return df.join(ids, F.col("task_assignment_id").cast("string") == F.col("changed_id"),
                       "left_semi")

    new = intermediate.questionnaire_assignments(
        only(assignments), tasks, cases, only(intermediate.questionnaire_events(events)))
    kept = target.join(ids, F.col("task_assignment_id").cast("string") == F.col("changed_id"),
                       "left_anti")
    return kept.unionByName(new.select(*target.columns))


def attempts_of(changed: DataFrame, events: DataFrame, target: DataFrame) -> DataFrame:
    """B7 for known changes: all events of the changed assignments are aggregated again."""
    up = intermediate.upload_events(events).join(changed, "task_assignment_id", "left_semi")
    return replace_groups(target, intermediate.rollup_upload_attempts(up), "task_assignment_id",
                          changed)


def changed_upload_assignments(events: DataFrame, target: DataFrame) -> DataFrame:
    """Assignments with upload events ingested since the target's watermark, or never stamped
    (a watermark can't tell when those arrived, so their assignments are always rebuilt)."""
    up = intermediate.upload_events(events)
    wm = watermark(target, "max_ingestion_timestamp")
    return (since(up, F.col("ingestion_timestamp"), wm, keep_null=True)
            .select("task_assignment_id").distinct())


def upload_attempts(events: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """B7 incremental: re-aggregate *all* events of changed assignments (J4 semi join)."""
    if target is None:
        return intermediate.rollup_upload_attempts(intermediate.upload_events(events))
    return attempts_of(changed_upload_assignments(events, target), events, target)


def questionnaire_assignments(assignments: DataFrame, tasks: DataFrame, cases: DataFrame,
                              events: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """B8 incremental: assignments whose two-source watermark moved.

    The changed ids come first, from both sources; only their assignments and their events
    enter the aggregate and the joins.
    """
    if target is None:
        return intermediate.questionnaire_assignments(assignments, tasks, cases, events)
    wm = watermark(target, "source_updated_at")
    asked = intermediate.questionnaire_events(events)
    floor = F.lit(intermediate.EPOCH_FLOOR).cast("timestamp")
    changed = (
        since(assignments, F.coalesce("assignment_updated_at", floor), wm)
        .select(F.col("task_assignment_id").cast("string").alias("changed_id"))
        .unionByName(since(asked, F.col("ingestion_timestamp"), wm, keep_null=True)
                     .select(F.col("task_assignment_id").alias("changed_id")))
        .distinct())
    new = intermediate.questionnaire_assignments(
        assignments.join(changed, F.col("task_assignment_id").cast("string") == F.col("changed_id"),
                         "left_semi"),
        tasks, cases,
        asked.join(changed, F.col("task_assignment_id") == F.col("changed_id"), "left_semi"))
    return upsert_frame(target, new, "task_assignment_id")


def _group_key(date_col: str) -> Column:
    return F.coalesce(F.col("catalog_product_id").cast("string"), F.lit(""))


def _touched_groups(rows: DataFrame, date_col: str) -> DataFrame:
    return rows.select(F.col(date_col).alias("_g_date"),
                       _group_key(date_col).alias("_g_product")).distinct()


def _rows_of_groups(rows: DataFrame, groups: DataFrame, date_col: str) -> DataFrame:
    """Rows in the touched groups, product compared through ``coalesce(x, '')``."""
    cond = (F.col(date_col) == F.col("_g_date")) & (_group_key(date_col) == F.col("_g_product"))
    return rows.join(groups, cond, "left_semi")


def _group_keys_df(groups: DataFrame) -> DataFrame:
    from ..functions.keys import md5_key
    return groups.select(md5_key(F.col("_g_date"), F.nullif(F.col("_g_product"), F.lit("")))
                         .alias("metric_day_product_key"))


def upload_daily(attempts: DataFrame, target: DataFrame | None = None,
                 prior_attempts: DataFrame | None = None,
                 changed_assignments: DataFrame | None = None) -> DataFrame:
    """B11 incremental (I4): rebuild whole ``date x product`` groups that changed.

    With ``prior_attempts`` and ``changed_assignments`` (``repair_vacated``),
    groups the changed assignments belonged to before are rebuilt too and
    deleted when they became empty.
    """
    if target is None:
        return marts.file_upload_daily(attempts)
    wm = watermark(target, "max_ingestion_timestamp")
    changed = since(attempts, F.col("max_ingestion_timestamp"), wm)
    groups = _touched_groups(changed, "plugin_opened_date")
    if prior_attempts is not None and changed_assignments is not None:
        old = prior_attempts.join(changed_assignments, "task_assignment_id", "left_semi")
        groups = groups.unionByName(_touched_groups(old, "plugin_opened_date")).distinct()
    new = marts.file_upload_daily(_rows_of_groups(attempts, groups, "plugin_opened_date"))
    return replace_groups(target, new, "metric_day_product_key", _group_keys_df(groups))


def changed_rows(before: DataFrame, now: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the keys that differ between two versions, as they were and as they are."""
    ids = version_diff(before, now, key).select(key)
    return before.join(ids, key, "left_semi"), now.join(ids, key, "left_semi")


def daily_of_diff(before: DataFrame, now: DataFrame, target: DataFrame, date_col: str,
                  build) -> DataFrame:
    """I4 for known changes: the date x product groups that changed assignments are in, or were
    in, are rebuilt by ``build``; the ones that became empty leave the mart."""
    was, is_now = changed_rows(before, now, "task_assignment_id")
    groups = (_touched_groups(was, date_col).unionByName(_touched_groups(is_now, date_col))
              .distinct())
    new = build(_rows_of_groups(now, groups, date_col))
    return replace_groups(target, new, "metric_day_product_key", _group_keys_df(groups))


def questionnaire_daily(assignments: DataFrame, target: DataFrame | None = None,
                        prior_assignments: DataFrame | None = None) -> DataFrame:
    """B12 incremental (I4) with the same optional vacated-group repair.

    Changes are taken from all assignments, so one that lost its activation still
    marks the group it was in before.
    """
    if target is None:
        return marts.questionnaire_daily(assignments)
    act = marts.activated_questionnaires(assignments)
    wm = watermark(target, "max_source_updated_at")
    changed = since(assignments, F.col("source_updated_at"), wm)
    groups = _touched_groups(marts.activated_questionnaires(changed), "activation_date")
    if prior_assignments is not None:
        old = marts.activated_questionnaires(prior_assignments).join(
            changed.select("task_assignment_id"), "task_assignment_id", "left_semi")
        groups = groups.unionByName(_touched_groups(old, "activation_date")).distinct()
    new = marts.questionnaire_daily(_rows_of_groups(act, groups, "activation_date"))
    return replace_groups(target, new, "metric_day_product_key", _group_keys_df(groups))
