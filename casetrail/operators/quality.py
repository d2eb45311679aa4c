"""Data-quality operators (Q1-Q18).

Row checks return failing rows (zero rows = pass).  For reporting, all row
checks of one model are evaluated in a *single* aggregate over the model --
one scan, one partial+final aggregation producing one row of counts, which
is then unpivoted to one row per check.  ``unique`` needs a group-by on its
column and ``relationships`` an anti join; each is one shuffle.

Failure counts follow the usual test semantics: rows for ``not_null``,
``non_negative``, ``value_between`` and ``expression_is_true``; distinct
offending values for ``unique`` and ``accepted_values``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_KINDS = ("not_null", "accepted_values", "non_negative", "value_between", "expression_is_true")

SUMMARY_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
])


class QualityGateError(RuntimeError):
    """An error-severity check failed; the next layer must not be written."""


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str | None = None
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    expression: str | None = None
    severity: str = "error"
    layer: str = "model"
    to_model: str | None = None
    to_column: str | None = None
    label: str | None = field(default=None, compare=False)

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        target = self.column or (self.expression or "")
        slug = "".join(ch if ch.isalnum() else "_" for ch in target).strip("_")
        while "__" in slug:
            slug = slug.replace("__", "_")
        return f"{self.kind}__{self.model}__{slug}"


# ------------------------------------------------------------ row predicates
def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def predicate_sql(check: Check) -> str:
    """The failing-row predicate of a row check as Spark SQL text.

    Text keeps plan construction to one driver call per model (see
    :func:`row_check_counts`); it is the single definition used for both the
    counts and :func:`failing_rows`.
    """
    col = f"`{check.column}`" if check.column else None
    if check.kind == "not_null":
        return f"{col} IS NULL"
    if check.kind == "accepted_values":
        values = ", ".join(sql_literal(v) for v in check.values)
        return f"{col} IS NOT NULL AND NOT {col} IN ({values})"
    if check.kind == "non_negative":
        return f"{col} < 0"
    if check.kind == "value_between":
        parts = []
        if check.min_value is not None:
            parts.append(f"{col} < {sql_literal(check.min_value)}")
        if check.max_value is not None:
            parts.append(f"{col} > {sql_literal(check.max_value)}")
        return f"{col} IS NOT NULL AND ({' OR '.join(parts) or 'FALSE'})"
    if check.kind == "expression_is_true":
        return f"NOT coalesce(({check.expression}), FALSE)"
    raise ValueError(f"{check.kind} is not a row check")


def failing_predicate(check: Check) -> Column:
    return F.expr(predicate_sql(check))


# -------------------------------------------------------------- failing rows
def failing_rows(df: DataFrame, check: Check, parent: DataFrame | None = None) -> DataFrame:
    """The rows a check returns (Q1-Q7); empty means the check passes."""
    if check.kind in ROW_KINDS:
        return df.where(F.coalesce(failing_predicate(check), F.lit(False)))
    if check.kind == "unique":
        return duplicated_values(df, check.column)
    if check.kind == "relationships":
        return orphans(df, check.column, parent, check.to_column or check.column)
    raise ValueError(check.kind)


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Q2: non-null values of ``column`` that occur more than once."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q7: child rows whose non-null key has no parent row (anti join on the key)."""
    keys = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())
    return (child.where(F.col(fk).isNotNull())
            .join(keys, F.col(fk) == F.col("_pk"), "left_anti"))


# ------------------------------------------------------------- check counts
def failure_count_sql(check: Check) -> str:
    """Failing rows of a row check (``accepted_values`` counts values: :func:`accepted_counts`)."""
    return f"count(CASE WHEN coalesce({predicate_sql(check)}, FALSE) THEN 1 END)"


def _label_sql(check: Check) -> list[str]:
    col = sql_literal(check.column) if check.column else "CAST(NULL AS STRING)"
    return [sql_literal(check.layer), sql_literal(check.model), sql_literal(check.name),
            sql_literal(check.kind), col, sql_literal(check.severity)]


def row_check_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row checks of one model in one aggregate, unpivoted to check rows.

    One scan and one (partial + final) global aggregate produce a single row
    of counts; ``stack`` turns it into one row per check.
    """
    accepted = [c for c in checks if c.kind == "accepted_values"]
    checks = [c for c in checks if c.kind in ROW_KINDS and c.kind != "accepted_values"]
    if accepted and checks:
        return row_check_counts(df, checks).unionByName(accepted_counts(df, accepted))
    if accepted:
        return accepted_counts(df, accepted)
    if not checks:
        return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    counts = df.selectExpr(*[f"{failure_count_sql(c)} AS c{i}" for i, c in enumerate(checks)])
    cells = ", ".join(", ".join(_label_sql(c) + [f"CAST(c{i} AS BIGINT)"])
                      for i, c in enumerate(checks))
    return counts.selectExpr(
        f"stack({len(checks)}, {cells}) AS "
        "(layer, model, check_name, kind, column_name, severity, failures)")


def accepted_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Q3 for all ``accepted_values`` checks of one model: distinct offending values.

    A row emits only its offending cells, so a clean table shuffles nothing; the values are
    made distinct with a map-side-combined aggregate instead of ``count(DISTINCT ...)``,
    whose Expand copies every row once per check.
    """
    cells = ", ".join(f"CASE WHEN coalesce({predicate_sql(c)}, FALSE) THEN named_struct("
                      f"'check_name', {sql_literal(c.name)}, 'value', CAST(`{c.column}` AS STRING)) END"
                      for c in checks)
    bad = df.selectExpr(f"inline(filter(array({cells}), cell -> cell IS NOT NULL))")
    counted = bad.distinct().groupBy("check_name").agg(F.count(F.lit(1)).alias("n"))
    declared = df.sparkSession.createDataFrame(
        [(c.layer, c.model, c.name, c.kind, c.column, c.severity, 0) for c in checks],
        SUMMARY_SCHEMA).drop("failures")
    return declared.join(counted, "check_name", "left").select(
        "layer", "model", "check_name", "kind", "column_name", "severity",
        F.coalesce("n", F.lit(0)).cast("long").alias("failures"))


def unique_count(df: DataFrame, check: Check) -> DataFrame:
    dup = duplicated_values(df, check.column).agg(F.count(F.lit(1)).alias("failures"))
    return _one_check_row(dup, check)


def relationship_count(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    bad = orphans(child, check.column, parent, check.to_column or check.column)
    return _one_check_row(bad.agg(F.count(F.lit(1)).alias("failures")), check)


def _one_check_row(counted: DataFrame, check: Check) -> DataFrame:
    return counted.select(
        F.lit(check.layer).alias("layer"), F.lit(check.model).alias("model"),
        F.lit(check.name).alias("check_name"), F.lit(check.kind).alias("kind"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.lit(check.severity).alias("severity"), F.col("failures").cast("long"),
    )


class RowCounts:
    """Row checks counted by the job that writes a frame, so that the gate reads no table again.

    ``watch`` attaches the failure counts to a frame as observed metrics
    (``DataFrame.observe``): they are added up by the very tasks that write it.  Observed
    metrics must not be distinct, so ``accepted_values`` observes failing rows -- per value for
    a boolean column, where that gives the number of offending values; any other column with
    failing rows is the only one to be read again (:func:`accepted_counts`).

    Watch a frame at the top of the plan that is written, or below narrow steps only: the
    metrics of a job's last stage count each task once, also when a lost executor's tasks are
    run again.
    """

    def __init__(self, checks: Sequence[Check]):
        self._checks: dict[str, list[Check]] = {}
        for c in checks:
            if c.kind in ROW_KINDS:
                self._checks.setdefault(c.model, []).append(c)
        self._watched: dict[str, Observation] = {}

    def watch(self, model: str, df: DataFrame) -> DataFrame:
        """``df`` with its row counts observed; itself if no row check reads it."""
        checks = self._checks.get(model)
        if not checks:
            return df
        boolean = {f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)}
        metrics = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(checks):
            if c.kind == "accepted_values" and c.column in boolean:
                metrics += [F.expr(f"max(CASE WHEN `{c.column}` = {v} AND "
                                   f"coalesce({predicate_sql(c)}, FALSE) THEN 1 ELSE 0 END)")
                            .alias(f"c{i}_{v}") for v in ("true", "false")]
            else:
                metrics.append(F.expr(failure_count_sql(c)).alias(f"c{i}"))
        self._watched[model] = Observation(f"{model}-{uuid.uuid4().hex}")
        return df.observe(self._watched[model], *metrics)

    def rows(self, model: str) -> int | None:
        """Rows of a watched model, once its job has run."""
        return self._watched[model].get["rows"] if model in self._watched else None

    def failures(self, check: Check) -> int | None:
        """Failures of a row check, once its model's job has run; None if not counted."""
        if check.model not in self._watched or check not in self._checks[check.model]:
            return None
        found = self._watched[check.model].get
        i = self._checks[check.model].index(check)
        if f"c{i}" in found:
            distinct = check.kind == "accepted_values"
            return None if distinct and found[f"c{i}"] else found[f"c{i}"]
        return sum(found[f"c{i}_{v}"] or 0 for v in ("true", "false"))


def _counted_rows(frame: DataFrame, counted: Sequence[tuple[Check, int]]) -> DataFrame:
    """Summary rows of observed counts: as many as declared checks at most."""
    return frame.sparkSession.createDataFrame(
        [(c.layer, c.model, c.name, c.kind, c.column, c.severity, n) for c, n in counted],
        SUMMARY_SCHEMA)


def run_checks(frames: dict[str, DataFrame], checks: Sequence[Check],
               kinds: Sequence[str] | None = None, counts: RowCounts | None = None) -> DataFrame:
    """Summary rows ``(layer, model, check_name, kind, column_name, severity, failures)``.

    Row checks that ``counts`` has seen while their model was written read no table.
    """
    selected = [c for c in checks if kinds is None or c.kind in kinds]
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    counted: list[tuple[Check, int]] = []
    for c in selected:
        if c.kind in ROW_KINDS:
            n = None if counts is None else counts.failures(c)
            if n is None:
                by_model.setdefault(c.model, []).append(c)
            else:
                counted.append((c, n))
        elif c.kind == "unique":
            parts.append(unique_count(frames[c.model], c))
        elif c.kind == "relationships":
            parts.append(relationship_count(frames[c.model], frames[c.to_model], c))
    for model, model_checks in by_model.items():
        parts.append(row_check_counts(frames[model], model_checks))
    if counted:
        parts.append(_counted_rows(next(iter(frames.values())), counted))
    if not parts:
        first = next(iter(frames.values()))
        return first.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` of many frames as a balanced tree.

    Each ``unionByName`` re-analyses its inputs on the driver; folding left
    over n parts analyses O(n^2) plan nodes, a balanced tree O(n log n).
    """
    parts = list(parts)
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def with_status(summary: DataFrame) -> DataFrame:
    """Add ``status``: pass, warn or error."""
    status = (F.when(F.col("failures") == 0, "pass")
              .when(F.col("severity") == "warn", "warn").otherwise("error"))
    return summary.withColumn("status", status)


def gate(summary: DataFrame, layer: str | None = None) -> None:
    """Q16: raise if any error-severity check of ``layer`` has failures.

    Every failing check is named; there are at most as many as declared checks.
    """
    s = with_status(summary)
    if layer is not None:
        s = s.where(F.col("layer") == layer)
    errors = s.where(F.col("status") == "error").select("model", "check_name", "failures").collect()
    if errors:
        detail = ", ".join(f"{r.model}.{r.check_name}={r.failures}" for r in errors)
        raise QualityGateError(f"error-severity checks failed: {detail}")


# ------------------------------------------------------------------ freshness
def with_declared(found: DataFrame, sources: list[str] | None) -> DataFrame:
    """``found`` (by ``source``) with one row at least for every declared source."""
    if sources is None:
        return found
    declared = found.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    return declared.join(found, "source", "left")


def freshness(loads: DataFrame, as_of: Column | None = None, error_after_hours: float = 30.0,
              sources: list[str] | None = None) -> DataFrame:
    """Q8: newest load per source against ``as_of`` (default: newest load overall).

    ``loads`` has columns ``(source, loaded_at)``.  The default ``as_of`` is a
    scalar subquery over the per-source maxima.  With ``sources``, a declared source
    that never loaded has a row too, and its status is error.
    """
    latest = with_declared(loads.groupBy("source").agg(F.max("loaded_at").alias("max_loaded_at")),
                           sources)
    if as_of is None:
        as_of = latest.select(F.max("max_loaded_at")).scalar()
    latest = latest.withColumn("as_of", as_of.cast("timestamp"))
    from ..functions.ratios import rate
    diff_us = F.unix_micros(F.col("as_of")) - F.unix_micros(F.col("max_loaded_at"))
    limit_us = F.lit(int(error_after_hours * 3_600_000_000))
    return latest.select(
        "source", "max_loaded_at", "as_of",
        rate(diff_us, F.lit(3_600_000_000), 2).alias("hours_since_load"),
        F.lit(float(error_after_hours)).alias("error_after_hours"),
        F.when(F.col("max_loaded_at").isNull() | (diff_us > limit_us), "error")
        .otherwise("pass").alias("status"),
    )


# ------------------------------------------------------------- volume anomaly
def score_daily_series(daily: DataFrame, training_days: int = 28,
                       seasonality: str | None = "day_of_week",
                       series: list[str] | None = None) -> DataFrame:
    """Per-series daily values scored against the same weekday in the prior window.

    ``daily``: ``(series, day, value)``.  Days with no row are filled with 0
    from a per-series date spine (``sequence`` over the series' own day range,
    so its size is the number of days, not rows).  With declared ``series`` every spine
    ends on the newest day of all of them, and one without rows spans all days: a
    source that stops, or never loads, has zeros up to that day.  Each day is scored against
    the training days in the ``training_days`` before it (same weekday when
    seasonal).  Windows are partitioned by series (and weekday): a partition
    holds one series' days, bounded by the calendar.
    """
    bounds = daily.groupBy("series").agg(F.min("day").alias("d0"), F.max("day").alias("d1"))
    if series is not None:
        overall = daily.agg(F.min("day").alias("first"), F.max("day").alias("last"))
        bounds = (with_declared(bounds.withColumnRenamed("series", "source"), series)
                  .select(F.col("source").alias("series"),
                          F.coalesce("d0", overall.select("first").scalar()).alias("d0"),
                          overall.select("last").scalar().alias("d1")))
    spine = (bounds.select("series", F.explode(F.sequence("d0", "d1")).alias("day"),
                           F.col("d1").alias("last_day")))
    filled = (spine.join(daily, ["series", "day"], "left")
              .select("series", "day", "last_day",
                      F.coalesce("value", F.lit(0)).cast("long").alias("value"),
                      F.datediff("day", F.lit("1970-01-01")).alias("day_no")))
    part = ["series"]
    if seasonality == "day_of_week":
        filled = filled.withColumn("dow", F.dayofweek("day"))
        part.append("dow")
    w = Window.partitionBy(*part).orderBy("day_no").rangeBetween(-training_days, -1)
    return filled.select(
        "series", "day", "value", "last_day",
        F.avg("value").over(w).alias("training_mean"),
        F.stddev_samp("value").over(w).alias("training_stddev"),
        F.count("value").over(w).alias("training_points"),
    )


def _scored_columns(direction: str, sensitivity: float, zero_fail: Column):
    """z-score with sample stddev; < 2 training points -> not evaluated;
    stddev 0 -> flagged iff the value differs from the mean (in ``direction``)."""
    v, mean, sd, n = F.col("value"), F.col("training_mean"), F.col("training_stddev"), F.col("training_points")
    z = F.when((n >= 2) & (sd > 0), (v - mean) / sd)
    if direction == "drop":
        off_flat, off_z = v < mean, z < F.lit(-sensitivity)
    elif direction == "spike":
        off_flat, off_z = v > mean, z > F.lit(sensitivity)
    else:
        off_flat, off_z = v != mean, F.abs(z) > F.lit(sensitivity)
    flagged = (F.when(zero_fail, F.lit(True)).when(n < 2, F.lit(None).cast("boolean"))
               .when(sd == 0, off_flat).otherwise(off_z))
    return [F.round(mean, 6).alias("training_mean"), F.round(sd, 6).alias("training_stddev"),
            n.cast("long").alias("training_points"), F.round(z, 6).alias("z_score"), flagged]


def volume_anomalies(loads: DataFrame, training_days: int = 28, sensitivity: float = 3.0,
                     fail_on_zero: dict[str, bool] | None = None,
                     seasonality: str | None = "day_of_week",
                     sources: list[str] | None = None) -> DataFrame:
    """Q10/Q11: daily load counts per source, anomalous in both directions.

    With declared ``sources`` the detection day is the newest load day of all of them.

    ``loads``: ``(source, loaded_at)``; counted per source and day with a
    map-side-combined aggregate before anything else happens.
    """
    daily = (loads.where(F.col("loaded_at").isNotNull())
             .groupBy(F.col("source").alias("series"), F.to_date("loaded_at").alias("day"))
             .agg(F.count(F.lit(1)).alias("value")))
    return daily_volume_anomalies(daily, training_days, sensitivity, fail_on_zero, seasonality,
                                  sources)


def daily_volume_anomalies(daily: DataFrame, training_days: int = 28, sensitivity: float = 3.0,
                           fail_on_zero: dict[str, bool] | None = None,
                           seasonality: str | None = "day_of_week",
                           sources: list[str] | None = None) -> DataFrame:
    """:func:`volume_anomalies` of daily counts ``(series, day, value)`` that are known already."""
    scored = score_daily_series(daily, training_days, seasonality, sources)
    zero_fail = F.lit(False)
    for source, rule in (fail_on_zero or {}).items():
        if rule:
            zero_fail = zero_fail | ((F.col("series") == source) & (F.col("value") == 0))
    cols = _scored_columns("both", sensitivity, zero_fail)
    return scored.select(
        F.col("series").alias("source"), "day", F.col("value").alias("row_count"),
        *cols[:4], cols[4].alias("is_anomaly"),
        (F.col("day") == F.col("last_day")).alias("is_detection_day"),
    )


def denominator_cliffs(daily: DataFrame, training_days: int = 28, sensitivity: float = 3.0,
                       seasonality: str | None = "day_of_week") -> DataFrame:
    """Q18: sudden drops of a ratio's denominator per series (``series, day, value``)."""
    scored = score_daily_series(daily, training_days, seasonality)
    cols = _scored_columns("drop", sensitivity, F.lit(False))
    return scored.select("series", "day", F.col("value").alias("denominator"), *cols[:4],
                         cols[4].alias("is_cliff"))


def reconcile_daily(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Q18: two daily counts ``(day, n)`` side by side (full outer join on day)."""
    joined = (left.withColumnRenamed("n", left_name)
              .join(right.withColumnRenamed("n", right_name), "day", "full_outer"))
    lcol = F.coalesce(F.col(left_name), F.lit(0)).cast("long")
    rcol = F.coalesce(F.col(right_name), F.lit(0)).cast("long")
    return joined.select("day", lcol.alias(left_name), rcol.alias(right_name),
                         (lcol - rcol).alias("difference"),
                         F.when(lcol == rcol, "match").otherwise("mismatch").alias("status"))


# --------------------------------------------------------------- schema drift
def value_kind(type_name: Column) -> Column:
    """Family of a variant's type name: number, string, boolean, null, object, array."""
    t = F.upper(type_name)
    return (F.when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
            .when(t == "STRING", "string").when(t == "BOOLEAN", "boolean")
            .when(t == "VOID", "null").otherwise("number"))


def payload_profile(events: DataFrame, day_col: Column, payload_col: str = "event_properties") -> DataFrame:
    """``(day, field, kind, n_rows)`` for every top-level payload key."""
    kv = events.select(day_col.alias("day"),
                       F.explode(F.from_json(F.col(payload_col), "map<string,variant>"))
                       .alias("field", "value"))
    return (kv.select("day", "field", value_kind(F.expr("schema_of_variant(value)")).alias("kind"))
            .groupBy("day", "field", "kind").agg(F.count(F.lit(1)).alias("n_rows")))


#: Statuses of :func:`schema_drift` that mean a change.
DRIFT_CHANGES = ("field_added", "kind_added", "field_removed", "kind_removed")


def schema_drift(profile: DataFrame) -> DataFrame:
    """Q9: each day's field/kind profile against the last day before it that has rows.

    The profile may have a ``source`` column; sources are compared by themselves.  A source's
    first day has nothing to compare with and gives no row.  Rows without a day are reported as
    ``undated``.  Other statuses: ``unchanged``, ``field_added``, ``kind_added``,
    ``field_removed``, ``kind_removed``.
    """
    if "source" not in profile.columns:
        return schema_drift(profile.withColumn("source", F.lit(""))).drop("source")
    dated = profile.where(F.col("day").isNotNull())
    by_day = Window.partitionBy("source").orderBy("day")      # as long as the calendar
    steps = dated.select("source", "day").distinct().select(
        "source", "day", F.lag("day").over(by_day).alias("last_day"))
    steps = steps.where(F.col("last_day").isNotNull())
    key = ["source", "day", "field", "kind"]
    prev = (dated.withColumnRenamed("day", "last_day").join(steps, ["source", "last_day"])
            .select(*key, F.col("n_rows").alias("prev_rows")))
    pair = (dated.select(*key, "n_rows").join(steps, ["source", "day"], "left_semi")
            .join(prev, key, "full_outer"))
    field_today = Window.partitionBy("source", "day", "field")
    has_today = F.max(F.col("n_rows").isNotNull().cast("int")).over(field_today) == 1
    has_prev = F.max(F.col("prev_rows").isNotNull().cast("int")).over(field_today) == 1
    status = (F.when(F.col("n_rows").isNotNull() & F.col("prev_rows").isNotNull(), "unchanged")
              .when(F.col("n_rows").isNotNull() & ~has_prev, "field_added")
              .when(F.col("n_rows").isNotNull(), "kind_added")
              .when(~has_today, "field_removed")
              .otherwise("kind_removed"))
    undated = profile.where(F.col("day").isNull()).select(
        *key, "n_rows", F.lit(None).cast("long").alias("prev_rows"),
        F.lit("undated").alias("status"))
    return pair.select(*key, "n_rows", "prev_rows", status.alias("status")).unionByName(undated).select(
        *key, F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce("prev_rows", F.lit(0)).cast("long").alias("prev_rows"), "status")


def event_profile(events: DataFrame, day_col: Column, columns: Sequence[str],
                  payload_col: str = "event_properties") -> DataFrame:
    """Payload keys with value kinds and column presence, ``(day, field, kind, n_rows)``,
    from one pass over the feed: each event becomes an array of cells, exploded
    and counted with a map-side-combined aggregate."""
    return (events.select(day_col.alias("day"),
                          F.explode(event_cells(columns, payload_col)).alias("c"))
            .groupBy("day", F.col("c.field").alias("field"), F.col("c.kind").alias("kind"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def event_cells(columns: Sequence[str], payload_col: str = "event_properties") -> Column:
    """``array<struct<field, kind>>`` of an event: its payload keys and its filled columns."""
    kv = F.from_json(F.col(payload_col), "map<string,variant>")
    payload_cells = F.transform(F.map_entries(kv), lambda e: F.struct(
        e["key"].alias("field"), value_kind(F.schema_of_variant(e["value"])).alias("kind")))
    column_cells = F.filter(F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("field"), F.lit("column").alias("kind")))
        for c in columns]), lambda x: x.isNotNull())
    return F.concat(F.coalesce(payload_cells, F.array().cast(
        "array<struct<field:string,kind:string>>")), column_cells)


def column_profile(df: DataFrame, day_col: Column, columns: Sequence[str]) -> DataFrame:
    """``(day, field, kind, n_rows)`` for non-null values of table columns.

    The columns are counted side by side per day and turned into rows afterwards.
    """
    daily = df.groupBy(day_col.alias("_day")).agg(
        *[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_n{i}").alias("n_rows"))
                      for i, c in enumerate(columns)])
    return (daily.select(F.col("_day").alias("day"), F.explode(cells).alias("c"))
            .where(F.col("c.n_rows") > 0)
            .select("day", F.col("c.field").alias("field"), F.lit("column").alias("kind"),
                    F.col("c.n_rows").alias("n_rows")))


# ------------------------------------------------------------ Q18 extensions
def null_rate_by_day(df: DataFrame, day_col: Column, columns: Sequence[str]) -> DataFrame:
    """Q18: per day and column, rows, nulls and the null rate (4 decimals).

    Rows without a day are a group of their own.
    """
    daily = df.groupBy(day_col.alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               (F.col("_n") - F.col(f"_n{i}")).alias("n_nulls"))
                      for i, c in enumerate(columns)])
    agg = daily.select(F.col("_day").alias("day"), F.col("_n").alias("n_rows"),
                       F.explode(cells).alias("c")).select(
        "day", F.col("c.column_name").alias("column_name"), "n_rows",
        F.col("c.n_nulls").alias("n_nulls"))
    from ..functions.ratios import rate
    return agg.withColumn("null_rate", rate(F.col("n_nulls"), F.col("n_rows")))
