"""Gated layer-by-layer refresh.

Raw checks -> staging -> checks -> intermediate -> checks -> marts -> checks.
Each layer is written as a new table version and re-read by the next layer,
so lineage is cut at every layer boundary and a lost executor only costs the
current layer's tasks.  An error-severity failure raises before the next
layer is written; failing rows of failed checks can be stored (K3).

Everything is written under the run's id (:mod:`casetrail.sources.runs`), and a run that
passes commits it.  The next run reads its earlier state from the last committed run alone, so a
run that stopped halfway (a failed check, a crash) never serves as the earlier state of an
incremental model.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental, intermediate, marts, quality, staging
from ..sources import runs, sinks
from ..session import checkpoint_dir, shuffles_dropped
from . import checks as C
from . import load_ledger, source_checks

Frames = dict[str, DataFrame]


class RawData(Protocol):
    def frames(self) -> Frames: ...


@dataclass(frozen=True)
class Model:
    """A model of the graph: its layer, what it reads, and how to build it."""
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


MODELS = {
    "stg_cases": Model(C.STAGING, ("wf_case",), staging.stg_cases),
    "stg_tasks": Model(C.STAGING, ("wf_task",), staging.stg_tasks),
    "stg_assignments": Model(C.STAGING, ("wf_assignment",), staging.stg_assignments),
    "stg_events": Model(C.STAGING, ("wf_events",), staging.stg_events),
    "case_durations": Model(C.INTERMEDIATE, ("stg_cases",), intermediate.case_durations),
    "custom_tasks": Model(C.INTERMEDIATE, ("stg_tasks", "stg_cases"), intermediate.custom_tasks),
    "file_upload_attempts": Model(C.INTERMEDIATE, ("stg_events",),
                                  intermediate.file_upload_attempts),
    "questionnaire_assignments": Model(
        C.INTERMEDIATE, ("stg_assignments", "stg_tasks", "stg_cases", "stg_events"),
        intermediate.questionnaire_assignments),
    "case_duration_daily": Model(C.MART, ("case_durations",), marts.case_duration_daily),
    "custom_tasks_daily": Model(C.MART, ("custom_tasks",), marts.custom_tasks_daily),
    "file_upload_daily": Model(C.MART, ("file_upload_attempts",), marts.file_upload_daily),
    "questionnaire_daily": Model(C.MART, ("questionnaire_assignments",),
                                 marts.questionnaire_daily),
}


#: The columns that a model reads of its inputs; a wrong list fails when the model is built.
_DURATIONS = ("filing_date", "catalog_product_id", "kickoff_to_filing_days",
              "initialized_to_filing_days", "created_to_filing_days",
              "is_valid_primary_duration", "has_legacy_case_link")
_CASE = ("case_id", "beneficiary_id", "catalog_product_id", "flow_template_id",
         "flow_template_version_id")
READS: dict[str, dict[str, tuple[str, ...]]] = {
    "case_durations": {"stg_cases": (
        *_CASE, "case_stage", "case_status", "case_matter_case_id", "case_created_at",
        "initialized_at", "kickoff_date", "classification_date", "filing_date_actual",
        "receipt_date", "decision_date")},
    "custom_tasks": {"stg_cases": _CASE, "stg_tasks": (
        "task_id", "case_id", "task_name", "task_template_id", "task_creation_source",
        "task_sub_stage", "task_status", "task_created_at")},
    "file_upload_attempts": {"stg_events": (
        "actor_role", "task_plugin_type", "task_assignment_id", "event_name", "task_id", "case_id",
        "catalog_product_id", "event_time", "ingestion_timestamp", "file_count", "success_count",
        "error_count")},
    "questionnaire_assignments": {
        "stg_assignments": (
            "task_assignment_id", "task_id", "assignment_action", "assignment_status",
            "assignment_role_binding", "assignee_role", "iteration_count", "activated_ts",
            "submitted_ts", "completed_ts", "assignment_created_at", "assignment_updated_at"),
        "stg_tasks": ("task_id", "case_id", "task_name", "task_sub_stage", "task_creation_source"),
        "stg_cases": _CASE,
        "stg_events": ("task_assignment_id", "task_plugin_type", "event_time",
                       "ingestion_timestamp")},
    "case_duration_daily": {"case_durations": _DURATIONS},
    "custom_tasks_daily": {"custom_tasks": (
        "task_created_date", "catalog_product_id", "is_manually_added_task",
        "is_non_template_task", "is_custom_task_broad")},
    "file_upload_daily": {"file_upload_attempts": (
        "plugin_opened_date", "catalog_product_id", "started_upload", "has_successful_upload",
        "uploaded_all_selected_files", "total_files_selected_across_attempts",
        "total_successful_files_uploaded", "total_failed_files_uploaded",
        "max_ingestion_timestamp")},
    "questionnaire_daily": {"questionnaire_assignments": (
        "is_activated", "activation_date", "catalog_product_id", "beneficiary_id", "is_submitted",
        "is_reviewer_completed", "source_updated_at")},
}

#: The events that a merging run added to the log, among its frames.
ADDED = "added_events"

#: The incremental models: the new table from this run's frames and the last committed run.
#: What changed is known from the added events and from the differences between the two
#: versions of a table, not from watermarks.
MERGES: dict[str, Callable[[Frames, Frames], DataFrame]] = {
    "file_upload_attempts": lambda now, before: incremental.attempts_of(
        intermediate.upload_events(now[ADDED]).select("task_assignment_id").distinct(),
        now["stg_events"], before["file_upload_attempts"]),
    "questionnaire_assignments": lambda now, before: incremental.questionnaires_of(
        incremental.changed_questionnaires(before, now, now[ADDED]),
        now["stg_assignments"], now["stg_tasks"], now["stg_cases"], now["stg_events"],
        before["questionnaire_assignments"]),
    "file_upload_daily": lambda now, before: incremental.daily_of_diff(
        before["file_upload_attempts"], now["file_upload_attempts"], before["file_upload_daily"],
        "plugin_opened_date", marts.file_upload_daily),
    "questionnaire_daily": lambda now, before: incremental.daily_of_diff(
        marts.activated_questionnaires(before["questionnaire_assignments"]),
        marts.activated_questionnaires(now["questionnaire_assignments"]),
        before["questionnaire_daily"], "activation_date", marts.questionnaire_daily),
}


def upstream(names: Iterable[str]) -> set[str]:
    """The given models and sources with all that they read, directly or not."""
    found, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += MODELS[name].inputs if name in MODELS else ()
    return found


def columns_read(names: Iterable[str], checks: Iterable[quality.Check]) -> dict[str, set[str]]:
    """The columns of each model that the models ``names`` and ``checks`` read once it is stored.

    Row checks are counted while a model is written; only offending accepted values are looked
    up again.
    """
    models = [n for n in upstream(names) if n in MODELS]
    found: dict[str, set[str]] = {n: set() for n in models}
    for n in models:
        for source, columns in READS.get(n, {}).items():
            found[source].update(columns)
    for c in checks:
        if c.kind not in quality.ROW_KINDS or c.kind == "accepted_values":
            found.setdefault(c.model, set()).add(c.column)
        if c.to_model:
            found.setdefault(c.to_model, set()).add(c.to_column or c.column)
    return found


def build_stored(raw: RawData, store: Callable[[str, DataFrame], DataFrame],
                 after_layer: Callable[[str, Frames], None] | None = None,
                 names: Iterable[str] | None = None, before: Frames | None = None,
                 add_events: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
                 counts: quality.RowCounts | None = None, count_sources: bool = False,
                 columns: dict[str, set[str]] | None = None) -> Frames:
    """The raw sources, then staging -> intermediate -> marts, storing each model once.

    Each layer reads the *stored* layer below, so no model is recomputed by its consumers and
    lineage is cut at every layer boundary.  With ``names`` only these models and what they
    read are built.  With ``before`` (the stored frames of an earlier run) the incremental
    models are merged into it instead of rebuilt.  ``add_events`` stores the events that the raw
    feed adds to the log and returns the whole log and what was added.  With ``counts`` the jobs that write the
    models count the failures of their row checks; with ``count_sources`` the staging jobs
    also count those of the raw sources that they read (once all of staging is written: a gate
    before staging can't wait for that).  With ``columns`` only these columns of a model are
    stored, whatever its checks count (one at least).
    """
    wanted = upstream(MODELS if names is None else names)
    # Raw sources are stored tables already (here: derived from the given tables by narrow
    # projections and one grouping); they are used in place.
    frames = raw.frames()
    # each raw source is read once, by narrow steps of one staging job
    staged = {i for n in wanted if n in MODELS for i in MODELS[n].inputs}
    watched = {n: counts.watch(n, df) for n, df in frames.items() if n in staged
               } if counts is not None and count_sources else {}
    for layer in C.LAYERS:
        todo = [n for n, m in MODELS.items() if m.layer == layer and n in wanted]
        inputs = {**frames, **watched}
        if add_events is not None and EVENTS in todo:
            frames[EVENTS], frames[ADDED] = add_events(frames["wf_events"])
            todo.remove(EVENTS)
        models = {n: MERGES[n](frames, before) if before and n in MERGES
                  else MODELS[n].build(*[inputs[i] for i in MODELS[n].inputs]) for n in todo}
        if counts is not None:
            models = {n: counts.watch(n, df) for n, df in models.items()}
        if columns is not None:
            models = {n: df.select(*([c for c in df.columns if c in columns[n]] or df.columns[:1]))
                      for n, df in models.items()}
        if models:
            # Models of one layer are independent: submit their jobs concurrently so
            # the scheduler can overlap them (small ones would otherwise idle the cluster).
            with ThreadPoolExecutor(max_workers=len(models)) as pool:
                futures = {name: pool.submit(store, name, df) for name, df in models.items()}
                frames.update({name: f.result() for name, f in futures.items()})
        if after_layer is not None:
            after_layer(layer, frames)
    return frames


def table_store(spark: SparkSession) -> Callable[[str, DataFrame], DataFrame]:
    """A store that writes each model once as Parquet under a fresh folder of the
    session's shared checkpoint folder and reads it back (column-pruned scans).

    Unlike an eager ``checkpoint()``, which counts and then writes (two
    computations), a write is one computation and leaves a columnar table.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex[:12]}"

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return store


def _failing_rows(frames: Frames, checks: list[quality.Check], summary: DataFrame) -> DataFrame:
    """K3: the failing rows of every failed check; one pass per model for its row checks."""
    failing = summary.where("status != 'pass'")
    # as many rows as declared checks at most
    failed = {r.check_name for r in failing.select("check_name").collect()}
    loads_failed = failing.where(F.col("check_name") == F.col("kind"))
    found = [sinks.failure_rows(loads_failed.where(F.col("kind") == kind), kind)
             for kind in ("freshness", "volume_anomaly", "schema_drift")]
    by_model: dict[str, dict[str, Column]] = {}
    for c in checks:
        if c.name not in failed:
            continue
        if c.kind in quality.ROW_KINDS:
            by_model.setdefault(c.model, {})[c.name] = quality.failing_predicate(c)
        else:
            parent = frames[c.to_model] if c.to_model else None
            found.append(sinks.failure_rows(
                quality.failing_rows(frames[c.model], c, parent), c.name))
    found += [sinks.row_failure_rows(frames[model], predicates)
              for model, predicates in by_model.items()]
    return quality.union_all(found)


def _check_layer(frames: Frames, layer: str, out_root: str, run_id: str, fail_on_error: bool,
                 store_failures: bool, load_summary: DataFrame | None,
                 counts: quality.RowCounts) -> DataFrame:
    checks = C.checks_of(layer=layer)
    found = quality.run_checks(frames, checks, counts=counts)
    if load_summary is not None:
        found = found.unionByName(load_summary)
    summary = runs.write(quality.with_status(found), f"{out_root}/_checks/{layer}", run_id)
    if store_failures:
        sinks.store_failures(_failing_rows(frames, checks, summary), f"{out_root}/_failures",
                             run_id, layer)
    if fail_on_error:
        quality.gate(summary, layer)
    return summary


EVENTS = incremental.EVENTS_TABLE


#: Value counts by day beside the duration mart, for the percentiles of longer periods.
DURATION_VALUES = "case_duration_values"


def _events(spark: SparkSession, root: str, run: runs.Run) -> DataFrame:
    return incremental.read_events(spark, root, run).drop(runs.RUN, incremental.EVENT_PARTITION)


def read_run(spark: SparkSession, out_root: str) -> Frames:
    """The models of the last committed run; empty before the first."""
    run = runs.last(spark, out_root)
    if run is None:
        return {}
    return {name: _events(spark, out_root, run) if name == EVENTS
            else runs.read(spark, f"{out_root}/{name}", run.run_id) for name in MODELS}


def run_layers(spark: SparkSession, raw: RawData, out_root: str, fail_on_error: bool = True,
               store_failures: bool = False, full_refresh: bool = False,
               as_of: Column | None = None, error_after_hours: float | None = C.FRESHNESS_ERROR_HOURS,
               run_id: str | None = None) -> dict[str, DataFrame]:
    """Build and check every layer, commit the run, and return the check summaries by layer.

    ``raw`` is anything with ``frames()``: :class:`~casetrail.sources.sinks.RawTables` over
    real tables, or the derived :class:`~casetrail.sources.fixtures.RawSources`.  The
    incremental models are merged into the last committed run unless ``full_refresh`` is set;
    the event log gains only the events that it lacks.  Everything is written under ``run_id``
    (default: a new id); a retry under the same id replaces what the run wrote, stored failures
    included.  Shuffle files and parsed events that the log has go as soon as they are used, so the
    disk that a run needs is its tables and its largest query.  Freshness is judged at ``as_of`` (default: now) and is an error like any other;
    ``error_after_hours=None`` leaves it out, for backfills of old tables.
    """
    results: dict[str, DataFrame] = {}
    committed = runs.last(spark, out_root)
    last = None if full_refresh else committed
    before = read_run(spark, out_root) if last else None
    run_id = run_id or runs.new_id()
    mark = last.watermark if last else None
    newest = []

    def write(name: str, df: DataFrame) -> DataFrame:
        return runs.write(df, f"{out_root}/{name}", run_id)

    def add_events(raw_events: DataFrame) -> tuple[DataFrame, DataFrame]:
        seen = None if last is None else incremental.read_events(spark, out_root, last)
        landing = f"{out_root}/_landed/{runs.RUN}={run_id}"
        rows, stamp = incremental.unseen_events(incremental.events_since(raw_events, mark), seen,
                                                landing)
        if last is None:
            rows = counts.watch(EVENTS, rows)
        added = runs.write(rows, f"{out_root}/{EVENTS}", run_id, [incremental.EVENT_PARTITION])
        runs.drop(spark, landing)                          # the log has what it held
        newest.append(stamp)
        return _events(spark, out_root, this_run()), added.drop(incremental.EVENT_PARTITION)

    def this_run() -> runs.Run:
        return runs.Run(run_id, committed.number + 1 if committed else 1,
                        (*(last.history if last else ()), run_id), incremental.later(mark, *newest))

    def check(layer: str, frames: Frames) -> None:
        load_summary = None
        if layer == C.SOURCE:
            judged = error_after_hours is not None
            ledger = runs.write(
                load_ledger.advance(frames, load_ledger.read(spark, out_root, last)),
                f"{out_root}/{load_ledger.TABLE}", run_id)
            load_summary = source_checks.summary(
                load_ledger.loads(ledger), load_ledger.volumes(ledger), load_ledger.profile(ledger),
                (F.current_timestamp() if as_of is None else as_of) if judged else None,
                error_after_hours or C.FRESHNESS_ERROR_HOURS)
            if not judged:
                load_summary = load_summary.where("kind <> 'freshness'")
        results[layer] = _check_layer(frames, layer, out_root, run_id, fail_on_error,
                                      store_failures, load_summary, counts)

    counts = quality.RowCounts(C.ALL_CHECKS)
    with shuffles_dropped(spark):
        frames = build_stored(raw, write, check, before=before, add_events=add_events,
                              counts=counts)
        write(DURATION_VALUES, marts.case_duration_values(frames["case_durations"]))
        runs.commit(spark, out_root, this_run())
    return results
