"""Registered data-quality queries (Q1-Q18) and their DuckDB twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contract, quality
from ..operators.quality import Check
from ..sources import sinks
from . import checks as C
from . import load_ledger, oracle, refresh, source_checks
from .models import MODEL_NAMES, Models
from .registry import query


SOURCES = list(C.SOURCES)
#: Roles in the queries over silent sources.
STOPPED_SOURCE, EMPTY_SOURCE = "wf_case", "wf_events"


# ---------------------------------------------------------------- Spark side
def loads(m: Models) -> DataFrame:
    return source_checks.loads(m.raw.frames())


def check_models(m: Models, checks) -> DataFrame:
    """Summary of ``checks``: the models that they read, and what those need, are built once
    each from the stored layer below (written under the shared checkpoint folder), and the
    writing jobs count the row checks.  Stored are the columns that later models or checks read."""
    from .refresh import build_stored, columns_read, table_store
    read = {c.model for c in checks} | {c.to_model for c in checks if c.to_model}
    counts = quality.RowCounts(checks)
    frames = build_stored(m.raw, table_store(m.spark), names=read, counts=counts,
                          count_sources=bool(read & set(MODEL_NAMES)),
                          columns=columns_read(read, checks))
    return quality.run_checks(frames, checks, counts=counts)


def check_summary(spark: SparkSession, sf_dir: str, checks) -> DataFrame:
    return quality.with_status(check_models(Models.shared(spark, sf_dir), checks))


def silenced(found: DataFrame) -> DataFrame:
    """The loads as if one source had stopped and another had never loaded."""
    last = found.select(F.max("loaded_at")).scalar()
    return found.where((F.col("source") != EMPTY_SOURCE)
                       & ((F.col("source") != STOPPED_SOURCE)
                          | (F.col("loaded_at") < last - F.expr("INTERVAL 14 DAYS"))))


def check_status(summary: DataFrame) -> DataFrame:
    """``(model, check_name, severity, failed)`` of a check summary."""
    return summary.select("model", "check_name", "severity",
                          (F.col("failures") > 0).alias("failed"))


def degraded_status(m: Models) -> DataFrame:
    """Q17: per mart, whether a check on it or on anything it reads failed, why, how badly, and
    the oldest of its sources' last loads."""
    # one pass over the sources for freshness and volume, a row a source and day
    daily = refresh.table_store(m.spark)("loads", source_checks.daily_loads(loads(m)))
    fresh = source_checks.freshness_frame(daily.select("source", "loaded_at"))
    volume = source_checks.daily_volume_frame(daily.where("day is not null").select(
        F.col("source").alias("series"), "day", F.col("n_rows").alias("value")))
    checks = check_models(m, C.ALL_CHECKS)
    return degraded_marts(fresh, source_checks.load_status(daily, fresh, volume).unionByName(
        check_status(checks)))


def degraded_marts(fresh: DataFrame, status: DataFrame) -> DataFrame:
    """Every declared mart, whatever its sources have loaded.

    ``status``: ``(model, check_name, severity, failed)``.  A mart for which nothing was checked
    is degraded.
    """
    lineage = fresh.sparkSession.createDataFrame(C.lineage(), "mart string, model string")
    joined = lineage.join(status, "model", "left").join(
        fresh.select(F.col("source").alias("model"), "max_loaded_at"), "model", "left")
    reason = F.concat_ws(", ", F.array_sort(F.collect_set(
        F.when(F.col("failed"), F.concat_ws(":", "model", "check_name")))))
    worst = F.max(F.when(F.col("failed"), F.when(F.col("severity") == "error", 2).otherwise(1))
                  .when(~F.col("failed"), 0))
    agg = joined.groupBy("mart").agg(worst.alias("_worst"), reason.alias("_r"),
                                     F.min("max_loaded_at").alias("last_loaded_at"))
    degraded = F.coalesce(F.col("_worst"), F.lit(2)) > 0
    return agg.select("mart", degraded.alias("is_degraded"),
                      F.when(F.col("_worst") == 2, "error").when(F.col("_worst") == 1, "warn")
                      .when(F.col("_worst") == 0, "pass").otherwise("error").alias("severity"),
                      F.when(degraded, F.col("_r")).alias("degraded_reason"), "last_loaded_at")


# --------------------------------------------------------------- oracle side
def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def sql_predicate(c: Check) -> str:
    col = c.column
    if c.kind == "not_null":
        return f"{col} IS NULL"
    if c.kind == "accepted_values":
        return f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(_lit(v) for v in c.values)})"
    if c.kind == "non_negative":
        return f"{col} < 0"
    if c.kind == "value_between":
        parts = []
        if c.min_value is not None:
            parts.append(f"{col} < {_lit(c.min_value)}")
        if c.max_value is not None:
            parts.append(f"{col} > {_lit(c.max_value)}")
        return f"{col} IS NOT NULL AND ({' OR '.join(parts) or 'false'})"
    if c.kind == "expression_is_true":
        return f"NOT coalesce(({c.expression}), false)"
    raise ValueError(c.kind)


def _head(c: Check) -> str:
    col = "NULL" if c.column is None else _lit(c.column)
    return (f"select {_lit(c.layer)} as layer, {_lit(c.model)} as model, {_lit(c.name)} as check_name, "
            f"{_lit(c.kind)} as kind, CAST({col} AS VARCHAR) as column_name, "
            f"{_lit(c.severity)} as severity")


def sql_check(c: Check) -> str:
    if c.kind in quality.ROW_KINDS:
        pred = f"coalesce({sql_predicate(c)}, false)"
        if c.kind == "accepted_values":
            n = f"count(distinct CAST({c.column} AS VARCHAR)) FILTER (WHERE {pred})"
        else:
            n = f"count(*) FILTER (WHERE {pred})"
        return f"{_head(c)}, CAST({n} AS BIGINT) as failures from {c.model}"
    if c.kind == "unique":
        return (f"{_head(c)}, CAST(count(*) AS BIGINT) as failures from (select {c.column} from "
                f"{c.model} where {c.column} is not null group by {c.column} having count(*) > 1)")
    if c.kind == "relationships":
        return (f"{_head(c)}, CAST(count(*) AS BIGINT) as failures from {c.model} ch "
                f"where ch.{c.column} is not null and not exists (select 1 from {c.to_model} p "
                f"where p.{c.to_column} = ch.{c.column})")
    raise ValueError(c.kind)


_STATUS = ("CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
           "ELSE 'error' END as status")


def sql_summary(checks) -> str:
    union = "\nUNION ALL\n".join(sql_check(c) for c in checks)
    return oracle.with_models(f"select *, {_STATUS} from ({union}) s", DQ_CTES)


_SOURCES = "(VALUES " + ", ".join(f"('{s}')" for s in SOURCES) + ") AS s(source)"
_LOADED = {src: oracle.timestamp("ingestion_timestamp") if src == "wf_events"
           else "ingestion_timestamp" for src in SOURCES}
_LOADS = "\nunion all\n".join(f"select '{src}' as source, {at} as loaded_at from {src}"
                              for src, at in _LOADED.items())

_FRESH = f"""
select source, max_loaded_at, as_of,
 {oracle.rate('epoch_us(as_of) - epoch_us(max_loaded_at)', '3600000000', 2)} as hours_since_load,
 CAST({C.FRESHNESS_ERROR_HOURS!r} AS DOUBLE) as error_after_hours,
 CASE WHEN max_loaded_at IS NULL OR epoch_us(as_of) - epoch_us(max_loaded_at) > {int(C.FRESHNESS_ERROR_HOURS * 3_600_000_000)}
      THEN 'error' ELSE 'pass' END as status
from (select s.source, max(loaded_at) as max_loaded_at from {_SOURCES}
      left join dq_loads d on d.source = s.source group by s.source) l,
     (select max(loaded_at) as as_of from dq_loads) r"""

_ZERO = " OR ".join(f"(source = {_lit(s)} AND row_count = 0)" for s, v in C.FAIL_ON_ZERO.items() if v) or "false"
_VOLUME = f"""
with daily as (select source, CAST(loaded_at AS DATE) as day, count(*) as row_count
               from dq_loads where loaded_at is not null group by 1, 2),
 bounds as (select s.source, coalesce(min(day), (select min(day) from daily)) as d0,
                   (select max(day) from daily) as d1
            from {_SOURCES} left join daily on daily.source = s.source group by 1),
 spine as (select source, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) as day, d1 as last_day from bounds),
 filled as (select s.source, s.day, s.last_day, CAST(coalesce(d.row_count, 0) AS BIGINT) as row_count,
                   dayofweek(s.day) as dow, date_diff('day', DATE '1970-01-01', s.day) as day_no
            from spine s left join daily d on s.source = d.source and s.day = d.day),
 scored as (select source, day, row_count, last_day,
   avg(row_count) over w as training_mean, stddev_samp(row_count) over w as training_stddev,
   count(row_count) over w as training_points
   from filled window w as (partition by source, dow order by day_no
                            range between {C.ANOMALY_TRAINING_DAYS} preceding and 1 preceding))
select source, day, row_count, round(training_mean, 6) as training_mean,
 round(training_stddev, 6) as training_stddev, CAST(training_points AS BIGINT) as training_points,
 round(CASE WHEN training_points >= 2 AND training_stddev > 0 THEN (row_count - training_mean) / training_stddev END, 6) as z_score,
 CASE WHEN {_ZERO} THEN true WHEN training_points < 2 THEN NULL
      WHEN training_stddev = 0 THEN row_count <> training_mean
      ELSE abs((row_count - training_mean) / training_stddev) > {C.ANOMALY_SENSITIVITY!r} END as is_anomaly,
 day = last_day as is_detection_day
from scored"""

_KIND = ("CASE WHEN t LIKE 'OBJECT%' THEN 'object' WHEN t LIKE 'ARRAY%' THEN 'array' "
         "WHEN t = 'VARCHAR' THEN 'string' WHEN t = 'BOOLEAN' THEN 'boolean' "
         "WHEN t = 'NULL' THEN 'null' ELSE 'number' END")
_EV_DAY = f"CAST({oracle.timestamp('ingestion_timestamp')} AS DATE)"
_PROFILE = f"""
select day, field, kind, count(*) as n_rows from (
  select day, field, {_KIND} as kind from (
    select day, field, json_type(event_properties, '$."' || field || '"') as t from (
      select {_EV_DAY} as day, event_properties, unnest(json_keys(event_properties)) as field
      from wf_events)) x) y
group by 1, 2, 3
union all
select day, field, 'column' as kind, count(*) as n_rows from (
  select {_EV_DAY} as day, unnest(['event_time', 'ingestion_timestamp', 'event_type', 'event_properties']) as field,
         unnest([event_time IS NOT NULL, ingestion_timestamp IS NOT NULL, event_type IS NOT NULL, event_properties IS NOT NULL]) as present
  from wf_events) z
where present group by 1, 2, 3"""

_DRIFT = """
with days as (select source, day, lag(day) over (partition by source order by day) as last_day
              from (select distinct source, day from PROFILE where day is not null) d),
 keys as (select source, day, field, kind from days join PROFILE using (source, day)
          where last_day is not null
          union
          select d.source, d.day, p.field, p.kind from days d join PROFILE p
            on p.source = d.source and p.day = d.last_day),
 pair as (select k.*, now.n_rows as n, was.n_rows as p,
   exists (select 1 from PROFILE x where x.source = k.source and x.day = k.day and x.field = k.field) as has_today,
   exists (select 1 from PROFILE x where x.source = k.source and x.day = d.last_day and x.field = k.field) as has_prev
  from keys k join days d on d.source = k.source and d.day = k.day
  left join PROFILE now on now.source = k.source and now.day = k.day and now.field = k.field and now.kind = k.kind
  left join PROFILE was on was.source = k.source and was.day = d.last_day and was.field = k.field and was.kind = k.kind)
select source, day, field, kind, CAST(coalesce(n, 0) AS BIGINT) as n_rows,
 CAST(coalesce(p, 0) AS BIGINT) as prev_rows,
 CASE WHEN p IS NULL THEN CASE WHEN has_prev THEN 'kind_added' ELSE 'field_added' END
      WHEN n IS NULL THEN CASE WHEN has_today THEN 'kind_removed' ELSE 'field_removed' END
      ELSE 'unchanged' END as status
from pair
union all
select source, day, field, kind, CAST(n_rows AS BIGINT), CAST(0 AS BIGINT), 'undated'
from PROFILE where day is null"""

# Columns of the sources that the derived tables never fill: they have no profile rows.
_NEVER_SET = {"description", "case_stage_scope", "blocked_reason", "force_unblocked",
              "activation_ts", "completion_ts", "role", "auto_activate"}


def _columns(source: str) -> list[str]:
    ddl = sinks.RAW_SCHEMAS[sinks.SOURCE_OF_FRAME[source]]
    return [c for c in (part.split()[0] for part in ddl.split(", ")) if c not in _NEVER_SET]


_TABLE_PROFILE = "\nunion all\n".join(
    f"select '{src}' as source, day, field, 'column' as kind, count(*) as n_rows from ("
    f"select CAST(ingestion_timestamp AS DATE) as day, unnest({[c for c in _columns(src)]}) as field, "
    f"unnest([{', '.join(f'{c} IS NOT NULL' for c in _columns(src))}]) as filled from {src}) x "
    f"where filled group by 1, 2, 3, 4" for src in SOURCES if src != "wf_events")

DQ_CTES = {
    "dq_loads": _LOADS,
    "dq_freshness": _FRESH,
    "dq_volume": _VOLUME,
    "dq_profile": f"select 'wf_events' as source, * from ({_PROFILE}) p",
    "dq_drift": _DRIFT.replace("PROFILE", "dq_profile"),
    "dq_table_profile": _TABLE_PROFILE,
    "dq_table_drift": _DRIFT.replace("PROFILE", "dq_table_profile"),
}


def _lineage_values() -> str:
    rows = ", ".join(f"({_lit(mart)}, {_lit(model)})" for mart, model in C.lineage())
    return f"(VALUES {rows}) AS lineage(mart, model)"


def _degraded_sql(status: str, fresh: str) -> str:
    """Marts by the worst failed check of their lineage; ``status`` and ``fresh`` are CTE names."""
    return f"""
select mart, bool_or(failed) as is_degraded,
 CASE WHEN bool_or(failed AND severity = 'error') THEN 'error' WHEN bool_or(failed) THEN 'warn'
      ELSE 'pass' END as severity,
 CASE WHEN bool_or(failed) THEN string_agg(DISTINCT model || ':' || check_name, ', '
   ORDER BY model || ':' || check_name) FILTER (failed) END as degraded_reason,
 min(max_loaded_at) as last_loaded_at
from {_lineage_values()} join {status} using (model)
left join (select source as model, max_loaded_at from {fresh}) f using (model)
group by mart"""


def _load_status_sql(fresh: str, volume: str) -> str:
    return f"""
select source as model, 'freshness' as check_name, 'error' as severity, status = 'error' as failed from {fresh}
union all
select source, 'volume_anomaly', 'warn', coalesce(is_anomaly, false) from {volume} where is_detection_day"""


_ALL_STATUS = _load_status_sql("dq_freshness", "dq_volume") + "\nunion all\n" + (
    "select model, check_name, severity, failures > 0 from ("
    + "\nUNION ALL\n".join(sql_check(c) for c in C.ALL_CHECKS) + ") s")


# ------------------------------------------------------------- registrations
def _register_kind(key: str, kind: str):
    sql = sql_summary(C.checks_of(kind=kind))

    @query(key, sql)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check_summary(spark, sf_dir, C.checks_of(kind=kind))
    return build


for _key, _kind in (("dq_not_null", "not_null"), ("dq_unique", "unique"),
                    ("dq_accepted_values", "accepted_values"), ("dq_non_negative", "non_negative"),
                    ("dq_value_between", "value_between"),
                    ("dq_expression_is_true", "expression_is_true"),
                    ("dq_relationships", "relationships")):
    _register_kind(_key, _kind)


def _rule_checks(model_rules: dict[str, tuple[str, ...]], layer: str) -> list[Check]:
    return [c for c in C.ALL_CHECKS if c.kind == "expression_is_true" and c.layer == layer
            and c.model in model_rules and c.expression in model_rules[c.model]]


_FUNNEL = (_rule_checks({"file_upload_attempts": C.FUNNEL_ATTEMPT_RULES}, C.INTERMEDIATE)
           + _rule_checks({"file_upload_daily": C.FUNNEL_MART_RULES}, C.MART))
_PCT = _rule_checks({"case_duration_daily": C.PERCENTILE_RULES}, C.MART)
_POP = _rule_checks(C.POPULATION_RULES, C.MART)
_GATE = [c for c in C.STAGING_CHECKS if c.model == "stg_events"
         and c.column in ("has_numeric_parse_error", "has_timestamp_parse_error")]


def _register_set(key: str, checks: list[Check]):
    @query(key, sql_summary(checks))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check_summary(spark, sf_dir, checks)
    return build


_register_set("dq_funnel_monotonic", _FUNNEL)
_register_set("dq_percentile_order", _PCT)
_register_set("dq_population_bounds", _POP)
_register_set("dq_parse_error_gate", _GATE)
_register_set("dq_summary", list(C.ALL_CHECKS))


@query("dq_freshness", oracle.with_models(
    "select source, max_loaded_at, as_of, hours_since_load, error_after_hours, status from dq_freshness",
    DQ_CTES))
def q_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_checks.freshness_frame(loads(Models.shared(spark, sf_dir)))


@query("dq_volume_anomalies", oracle.with_models("select * from dq_volume", DQ_CTES))
def q_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_checks.volume_frame(loads(Models.shared(spark, sf_dir)))


_SILENT_LOADS = f"""
select source, loaded_at from dq_loads
where source <> '{EMPTY_SOURCE}' and (source <> '{STOPPED_SOURCE}'
 or loaded_at < (select max(loaded_at) from dq_loads) - INTERVAL 14 DAYS)"""
_SILENT_CTES = {**DQ_CTES, "silent_loads": _SILENT_LOADS,
                "silent_fresh": _FRESH.replace("dq_loads", "silent_loads"),
                "silent_volume": _VOLUME.replace("dq_loads", "silent_loads"),
                "silent_status": _load_status_sql("silent_fresh", "silent_volume")}


@query("dq_silent_sources", oracle.with_models(
    "select source, status, max_loaded_at, row_count, coalesce(is_anomaly, false) as is_anomaly "
    "from silent_fresh join (select * from silent_volume where is_detection_day) v using (source)",
    _SILENT_CTES))
def q_silent_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8, Q10, Q11 with one source that stopped and one that never loaded."""
    found = silenced(loads(Models.shared(spark, sf_dir)))
    volume = source_checks.volume_frame(found).where("is_detection_day").select(
        "source", "row_count", F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"))
    return (source_checks.freshness_frame(found).select("source", "status", "max_loaded_at")
            .join(volume, "source"))


@query("metric_degraded_silent", oracle.with_models(
    _degraded_sql("silent_status", "silent_fresh"), _SILENT_CTES))
def q_degraded_silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q17 from load checks, with one source that stopped and one that never loaded."""
    found = silenced(loads(Models.shared(spark, sf_dir)))
    fresh = source_checks.freshness_frame(found)
    return degraded_marts(fresh, source_checks.load_status(found, fresh))


@query("dq_schema_drift", oracle.with_models("select * from dq_drift", DQ_CTES))
def q_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 for the event feed: payload keys, value kinds and column presence by load day."""
    m = Models.shared(spark, sf_dir)
    return quality.schema_drift(source_checks.event_profile({"wf_events": m.raw.events})
                                .withColumn("source", F.lit("wf_events")))


@query("dq_schema_drift_tables", oracle.with_models("select * from dq_table_drift", DQ_CTES))
def q_drift_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 for the table sources: filled columns by load day."""
    frames = Models.shared(spark, sf_dir).raw.frames()
    return quality.schema_drift(source_checks.table_profile(frames))


def _two_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load ledger after two runs: the first saw what was loaded up to a week before the
    newest load, the second everything, of which it counted the days inside the lookback."""
    store = refresh.table_store(spark)
    frames = Models.shared(spark, sf_dir).raw.frames()
    loaded = source_checks.loads(frames)
    cut = loaded.agg((F.max("loaded_at") - F.expr("INTERVAL 7 DAYS")).alias("cut")).first()["cut"]
    early = {s: frames[s].where(source_checks.loaded_at(s) < F.lit(cut)) if s in C.SOURCES
             else frames[s] for s in frames}
    first = store("ledger-1", load_ledger.advance(early, None))
    return store("ledger-2", load_ledger.advance(frames, first))


@query("dq_volume_ledger", oracle.with_models("select * from dq_volume", DQ_CTES))
def q_volume_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10, Q11 from the ledger of two runs: equal to a recount of all days."""
    return source_checks.daily_volume_frame(load_ledger.volumes(_two_ledgers(spark, sf_dir)))


@query("dq_drift_ledger", oracle.with_models(
    "select * from dq_drift union all select * from dq_table_drift", DQ_CTES))
def q_drift_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 of all sources from the ledger of two runs: equal to profiling all days again."""
    return quality.schema_drift(load_ledger.profile(_two_ledgers(spark, sf_dir)))


@query("metric_degraded_status", oracle.with_models(
    _degraded_sql("all_status", "dq_freshness"), {**DQ_CTES, "all_status": _ALL_STATUS}))
def q_degraded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return degraded_status(Models.shared(spark, sf_dir))


@query("rollup_with_quality", oracle.with_models(f"""
select CAST(date_trunc('week', metric_date) AS DATE) as period_start, catalog_product_id,
 {oracle.rate('sum(submitted_assignments)', 'sum(activated_assignments)')} as value,
 CAST(sum(submitted_assignments) AS BIGINT) as numerator,
 CAST(sum(activated_assignments) AS BIGINT) as denominator,
 'submitted_assignments' as numerator_name, 'activated_assignments' as denominator_name,
 'assignment_submission_rate' as metric_name, '1.0' as metric_version, 'week' as time_grain,
 'metric_date' as time_dimension, 'questionnaire_daily' as source_model,
 (select last_loaded_at from degraded where mart = 'questionnaire_daily') as fresh_as_of,
 (select is_degraded from degraded where mart = 'questionnaire_daily') as is_degraded,
 (select degraded_reason from degraded where mart = 'questionnaire_daily') as quality_warning
from questionnaire_daily group by 1, 2""", {**DQ_CTES, "load_status": _load_status_sql(
    "dq_freshness", "dq_volume"), "degraded": _degraded_sql("load_status", "dq_freshness")}))
def q_rollup_with_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the weekly submission rate with the state of the data behind it (load checks)."""
    m = Models.shared(spark, sf_dir)
    found = loads(m)
    fresh = source_checks.freshness_frame(found)
    state = degraded_marts(fresh, source_checks.load_status(found, fresh))
    rates = contract.rollup_ratio(m.questionnaire_daily, "questionnaire_daily",
                                  "assignment_submission_rate", "week")
    return contract.with_quality(rates, "questionnaire_daily", state)


_NULL_RATE_COLS = ("case_id", "task_id", "task_assignment_id", "catalog_product_id",
                   "actor_role", "task_plugin_type", "file_count", "success_count",
                   "duration_ms")


@query("dq_null_rate", oracle.with_models(
    "select day, column_name, n_rows, n_nulls, " + oracle.rate("n_nulls", "n_rows") + " as null_rate from ("
    "select event_date as day, c.column_name, count(*) as n_rows, count(*) filter (where c.is_null) as n_nulls "
    "from (select event_date, unnest([" + ", ".join(f"'{c}'" for c in _NULL_RATE_COLS) + "]) as column_name, "
    "unnest([" + ", ".join(f"{c} IS NULL" for c in _NULL_RATE_COLS) + "]) as is_null from stg_events) c "
    "group by 1, 2) x"))
def q_null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Models.shared(spark, sf_dir).stg_events
    return quality.null_rate_by_day(ev, F.col("event_date"), _NULL_RATE_COLS)


# ----------------------------------------------------------------- Q18 extras
# The denominator of each mart's headline ratio.
DENOMINATORS = {
    "questionnaire_daily": "activated_assignments",
    "custom_tasks_daily": "total_tasks",
    "file_upload_daily": "opened_upload_plugin_count",
    "case_duration_daily": "filed_cases",
}


def denominator_series(m: Models) -> DataFrame:
    parts = [m.get(mart).select(
        F.concat(F.lit(mart + ":"), F.coalesce(F.col("catalog_product_id").cast("string"), F.lit("")))
        .alias("series"), F.col("metric_date").alias("day"), F.col(col).alias("value"))
        for mart, col in DENOMINATORS.items()]
    return reduce(DataFrame.unionByName, parts)


_DENOM_DAILY = "\nunion all\n".join(
    f"select '{mart}:' || coalesce(CAST(catalog_product_id AS VARCHAR), '') as series, "
    f"metric_date as day, {col} as value from {mart}" for mart, col in DENOMINATORS.items())

_CLIFF = f"""
with daily as ({_DENOM_DAILY}),
 bounds as (select series, min(day) as d0, max(day) as d1 from daily group by 1),
 spine as (select series, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) as day from bounds),
 filled as (select s.series, s.day, CAST(coalesce(d.value, 0) AS BIGINT) as value,
                   dayofweek(s.day) as dow, date_diff('day', DATE '1970-01-01', s.day) as day_no
            from spine s left join daily d on s.series = d.series and s.day = d.day),
 scored as (select series, day, value,
   avg(value) over w as training_mean, stddev_samp(value) over w as training_stddev,
   count(value) over w as training_points
   from filled window w as (partition by series, dow order by day_no
                            range between {C.ANOMALY_TRAINING_DAYS} preceding and 1 preceding))
select series, day, value as denominator, round(training_mean, 6) as training_mean,
 round(training_stddev, 6) as training_stddev, CAST(training_points AS BIGINT) as training_points,
 round(CASE WHEN training_points >= 2 AND training_stddev > 0 THEN (value - training_mean) / training_stddev END, 6) as z_score,
 CASE WHEN training_points < 2 THEN NULL WHEN training_stddev = 0 THEN value < training_mean
      ELSE (value - training_mean) / training_stddev < -{C.ANOMALY_SENSITIVITY!r} END as is_cliff
from scored"""


@query("dq_denominator_cliff", oracle.with_models(f"select * from ({_CLIFF}) c"))
def q_denominator_cliff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q18: drops of each mart's ratio denominator per product, same-weekday baseline."""
    return quality.denominator_cliffs(denominator_series(Models.shared(spark, sf_dir)),
                                      C.ANOMALY_TRAINING_DAYS, C.ANOMALY_SENSITIVITY)


@query("dq_cross_source_reconcile", oracle.with_models("""
select coalesce(p.day, e.day) as day, CAST(coalesce(p.n, 0) AS BIGINT) as postgres_activated,
 CAST(coalesce(e.n, 0) AS BIGINT) as event_sessions_started,
 CAST(coalesce(p.n, 0) - coalesce(e.n, 0) AS BIGINT) as difference,
 CASE WHEN coalesce(p.n, 0) = coalesce(e.n, 0) THEN 'match' ELSE 'mismatch' END as status
from (select activation_date as day, count(*) as n from questionnaire_assignments
      where is_activated = 1 and activation_date is not null group by 1) p
full outer join (select event_date as day, count(distinct task_assignment_id) as n from stg_events
      where task_plugin_type = 'questionnaire' and event_name = 'cw_questionnaire_session_started'
        and event_date is not null and task_assignment_id is not null group by 1) e
on p.day = e.day"""))
def q_cross_source_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q18: activated questionnaire assignments (database) vs started sessions (events) by day."""
    m = Models.shared(spark, sf_dir)
    qa = m.questionnaire_assignments
    pg = (qa.where((F.col("is_activated") == 1) & F.col("activation_date").isNotNull())
          .groupBy(F.col("activation_date").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    ev = m.stg_events
    started = (ev.where((F.col("task_plugin_type") == "questionnaire")
                        & (F.col("event_name") == "cw_questionnaire_session_started")
                        & F.col("event_date").isNotNull() & F.col("task_assignment_id").isNotNull())
               .groupBy(F.col("event_date").alias("day"))
               .agg(F.count_distinct("task_assignment_id").alias("n")))
    return quality.reconcile_daily(pg, started, "postgres_activated", "event_sessions_started")


@query("dq_submitted_reconcile", oracle.with_models("""
select day, CAST(sum(db) AS BIGINT) as postgres_submitted, CAST(sum(ev) AS BIGINT) as event_sessions_submitted,
 CAST(sum(db) - sum(ev) AS BIGINT) as difference,
 CASE WHEN sum(db) = sum(ev) THEN 'match' ELSE 'mismatch' END as status
from (select CAST(submitted_ts AS DATE) as day, 1 as db, 0 as ev from questionnaire_assignments
      where submitted_ts is not null
      union all
      select distinct on (event_date, task_assignment_id) event_date, 0, 1 from stg_events
      where task_plugin_type = 'questionnaire' and event_name = 'cw_questionnaire_session_submitted'
        and event_date is not null and task_assignment_id is not null) x
group by day"""))
def q_submitted_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q18: submitted questionnaire assignments (database) vs submitted sessions (events) by day."""
    m = Models.shared(spark, sf_dir)
    db = (m.questionnaire_assignments.where(F.col("submitted_ts").isNotNull())
          .groupBy(F.to_date("submitted_ts").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    ev = (m.stg_events.where((F.col("task_plugin_type") == "questionnaire")
                             & (F.col("event_name") == "cw_questionnaire_session_submitted")
                             & F.col("event_date").isNotNull()
                             & F.col("task_assignment_id").isNotNull())
          .select(F.col("event_date").alias("day"), "task_assignment_id").distinct()
          .groupBy("day").agg(F.count(F.lit(1)).alias("n")))
    return quality.reconcile_daily(db, ev, "postgres_submitted", "event_sessions_submitted")


# ---------------------------------------------------------------------- sinks
_STORED = [c for c in C.ALL_CHECKS if c.model == "stg_events"
           and c.kind in ("not_null", "accepted_values", "non_negative")]


@query("sink_stored_failures", oracle.with_models("\nunion all\n".join(
    f"select {_lit(c.name)} as check_name, count(*) as n_rows from stg_events "
    f"where coalesce({sql_predicate(c)}, false) having count(*) > 0" for c in _STORED)))
def q_stored_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the failing event rows of each check, stored in one pass and read back."""
    from ..streaming.events import scratch_root
    path = f"{scratch_root(spark, 'failures')}/rows"
    events = Models.shared(spark, sf_dir).stg_events
    sinks.store_failures(sinks.row_failure_rows(
        events, {c.name: quality.failing_predicate(c) for c in _STORED}), path, "one", "events")
    return (spark.read.schema("check string, row string, stored_at timestamp").parquet(path)
            .groupBy(F.col("check").alias("check_name")).agg(F.count(F.lit(1)).alias("n_rows")))


@query("sink_full_refresh", oracle.model("case_duration_daily"))
def q_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a mart written as two versions; readers see the newest one whole."""
    from ..streaming.events import scratch_root
    table = f"{scratch_root(spark, 'refresh')}/case_duration_daily"
    mart = Models.shared(spark, sf_dir).case_duration_daily
    sinks.write_version(mart.where("filed_cases > 1"), table)
    sinks.write_version(mart, table)
    return sinks.read_current(spark, table)
