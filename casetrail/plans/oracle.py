"""DuckDB SQL for the correctness oracle.

Each registered query has an ANSI SQL twin here, run by DuckDB over the same
parquet tables (views ``orders``, ``lineitem``, ``events`` ...).  The SQL
re-derives the raw workflow tables and every model as CTEs, then selects.
It is used only for checking, and works by other means than the engine where it can: rates
use exact integer half-up rounding; percentiles are spelled out (ranks + interpolation
in double precision, as Postgres defines ``percentile_cont``); the intermediate models rank
marked moments.  The token lists of the casts are shared with the engine; pytest checks them.
"""

from __future__ import annotations

from ..functions.casts import (EPOCH_MILLIS_PATTERN, EPOCH_SECONDS_PATTERN, FALSE_TOKENS,
                               FLOAT_PATTERN, INT_PATTERN, ISO_TS_PATTERN, NULL_TOKENS,
                               TRUE_TOKENS)
from ..functions.payload import BOOLEAN_KEYS, NUMBER_KEYS, TEXT_KEYS

_NULLS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
_TRUES = ", ".join(f"'{t}'" for t in TRUE_TOKENS)
_FALSES = ", ".join(f"'{t}'" for t in FALSE_TOKENS)
# RE2 full-match forms of the cast patterns (no anchors needed).
_INT_RE, _FLOAT_RE, _ISO_RE = (p.strip("^").replace(r"\z", "") for p in
                               (INT_PATTERN, FLOAT_PATTERN, ISO_TS_PATTERN))
_SEC_RE = EPOCH_SECONDS_PATTERN.strip("^").replace(r"\z", "")
_MS_RE = EPOCH_MILLIS_PATTERN.strip("^").replace(r"\z", "")


def int64(x: str) -> str:
    cl = f"replace(trim(CAST({x} AS VARCHAR)), ',', '')"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN lower({cl}) IN ({_NULLS}) THEN NULL "
            f"WHEN regexp_full_match({cl}, '{_INT_RE}') "
            f"THEN TRY_CAST(TRY_CAST({cl} AS DECIMAL(38,10)) AS BIGINT) ELSE NULL END)")


def float64(x: str) -> str:
    cl = f"replace(trim(CAST({x} AS VARCHAR)), ',', '')"
    v = f"TRY_CAST({cl} AS DOUBLE)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN lower({cl}) IN ({_NULLS}) THEN NULL "
            f"WHEN regexp_full_match({cl}, '{_FLOAT_RE}') "
            f"THEN (CASE WHEN isinf({v}) OR isnan({v}) THEN NULL ELSE {v} END) ELSE NULL END)")


def boolean(x: str) -> str:
    n = f"lower(trim(CAST({x} AS VARCHAR)))"
    return f"(CASE WHEN {n} IN ({_TRUES}) THEN true WHEN {n} IN ({_FALSES}) THEN false ELSE NULL END)"


def timestamp(x: str) -> str:
    cl = f"trim(CAST({x} AS VARCHAR))"
    iso = (f"(CASE WHEN regexp_matches({cl}, '(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$') "
           f"THEN timezone('UTC', TRY_CAST({cl} AS TIMESTAMPTZ)) "
           f"ELSE TRY_CAST({cl} AS TIMESTAMP) END)")
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN lower({cl}) IN ({_NULLS}) THEN NULL "
            f"WHEN regexp_full_match({cl}, '{_ISO_RE}') THEN {iso} "
            f"WHEN regexp_full_match({cl}, '{_SEC_RE}') THEN make_timestamp(CAST({cl} AS BIGINT) * 1000000) "
            f"WHEN regexp_full_match({cl}, '{_MS_RE}') THEN make_timestamp(CAST({cl} AS BIGINT) * 1000) "
            f"ELSE NULL END)")


def rate(n: str, d: str, scale: int = 4) -> str:
    """Exact half-up ``round(n / d, scale)`` for n, d >= 0; NULL when d = 0."""
    f = 10 ** scale
    return (f"(CASE WHEN ({d}) = 0 THEN NULL ELSE "
            f"CAST(((2 * ({n}) * {f} + ({d})) // (2 * ({d}))) AS DOUBLE) / {f}.0 END)")


def percentile_cont(source: str, groups: list[str], col: str, p: float, out: str) -> str:
    """``percentile_cont(p) within group (order by col)`` per group, spelled out.

    Rank the non-null values, take the values at ranks floor/ceil of
    ``(n - 1) * p`` and interpolate ``lo + (hi - lo) * frac`` in double
    precision, the definition used by Postgres.
    """
    g = ", ".join(groups)
    return f"""(select {g}, CAST(min(x) FILTER (WHERE rn = floor(pos)) AS DOUBLE)
  + (CAST(min(x) FILTER (WHERE rn = ceil(pos)) AS DOUBLE) - CAST(min(x) FILTER (WHERE rn = floor(pos)) AS DOUBLE))
  * (any_value(pos) - floor(any_value(pos))) AS {out}
 from (select {g}, {col} AS x, row_number() over (partition by {g} order by {col}) - 1 AS rn,
              (count(*) over (partition by {g}) - 1) * CAST({p!r} AS DOUBLE) AS pos
       from {source} where {col} is not null) r
 where rn = floor(pos) or rn = ceil(pos)
 group by {g})"""


def with_percentiles(main: str, source: str, groups: list[str],
                     outputs: dict[str, tuple[str, float]], columns: list[str]) -> str:
    """``main`` (one row per group) left-joined to spelled-out percentiles, null-safe on keys."""
    joins, i = [], 0
    for out, (col, p) in outputs.items():
        i += 1
        cond = " AND ".join(f"m.{g} IS NOT DISTINCT FROM p{i}.{g}" for g in groups)
        joins.append(f"LEFT JOIN {percentile_cont(source, groups, col, p, out)} p{i} ON {cond}")
    sel = ", ".join(f"m.{c}" if c not in outputs else f"{c}" for c in columns)
    return f"select {sel} from ({main}) m\n" + "\n".join(joins)


def cnt(pred: str) -> str:
    return f"count(*) FILTER (WHERE {pred})"


def md5key(*parts: str) -> str:
    inner = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"md5(concat_ws('|', {inner}))"


# ---------------------------------------------------------------- raw tables
RAW = {
    "wf_case": """
select o_orderkey as id, o_custkey as beneficiary_id,
 case when o_orderkey % 97 = 0 then null else o_orderpriority end as catalog_product_id,
 o_orderkey % 5 as flow_template_id, o_orderkey % 15 as flow_template_version_id,
 case o_orderstatus when 'O' then 'preparation' when 'P' then 'review' else 'filing' end as stage,
 o_orderstatus as status, o_orderkey * 10 as stage_instance_id,
 case when o_orderkey % 13 = 0 then null else cast(o_orderdate as date) + cast(o_orderkey % 30 as int) end as kickoff_date,
 case when o_orderkey % 5 = 0 then null else cast(o_orderdate as date) + cast(o_orderkey % 20 as int) end as classification_date,
 cast(f.ship as date) as filing_date_actual,
 cast(f.ship as date) + 7 as receipt_date, cast(f.ship as date) + 90 as decision_date,
 case when o_orderkey % 11 = 0 then null else o_orderdate end as initialized_at,
 case when o_orderkey % 4 = 0 then o_orderkey end as case_matter_case_id,
 o_orderdate as created_at, o_orderdate as updated_at,
 case when o_orderkey % 50 = 0 then o_orderdate end as deleted_at, o_orderdate as ingestion_timestamp
from orders left join (select l_orderkey, max(l_shipdate) as ship from lineitem group by l_orderkey) f on l_orderkey = o_orderkey""",
    "wf_task": """
select l_orderkey * 10 + l_linenumber as id, l_orderkey as case_id,
 case when l_linenumber = 1 then 'Client Questionnaire' when l_linenumber = 2 then 'Upload documents' else 'Review' end as name,
 case when min(l_suppkey) % 3 = 0 then null else min(l_suppkey) end as task_template_id,
 case min(l_partkey) % 10 when 0 then 'Manual' when 1 then 'custom' when 2 then 'user_added' when 3 then 'library' when 4 then 'shared_library' when 5 then 'ai_suggested' else 'template' end as creation_source,
 'stage_' || cast(l_linenumber as varchar) as sub_stage, 'open' as status,
 min(l_shipdate) as created_at, min(l_shipdate) as updated_at,
 case when (l_orderkey * 10 + l_linenumber) % 43 = 0 then min(l_shipdate) end as deleted_at, min(l_shipdate) as ingestion_timestamp
from lineitem group by l_orderkey, l_linenumber""",
    "wf_assignment": """
select id, id as task_id, case when id % 2 = 0 then 'beneficiary' else 'attorney' end as role_binding,
 case when id % 9 = 0 then 'fill_Questionnaire' when name = 'Upload documents' then 'upload' else 'review' end as action,
 'active' as status, id % 3 as iteration_count, id % 1000 as active_time_ms,
 case when id % 6 = 0 then null else created_at end as activated_ts,
 case when id % 4 < 2 then created_at end as submitted_ts, case when id % 4 = 0 then created_at end as completed_ts,
 created_at, updated_at, case when id % 61 = 0 then created_at end as deleted_at, ingestion_timestamp
from wf_task""",
    "wf_task_predecessor": """
select l_orderkey * 10 + l_linenumber as task_id, l_orderkey * 10 + l_linenumber - 1 as predecessor_task_id,
 min(l_shipdate) as ingestion_timestamp
from lineitem where l_linenumber > 1 group by l_orderkey, l_linenumber""",
    "cm_case": """
select o_orderkey as id, o_custkey as beneficiary_id, o_orderpriority as product_id, o_orderstatus as status,
 o_orderdate as created_at, o_orderdate as ingestion_timestamp from orders""",
    "cm_evidence_document": """
select p_partkey as id, evidence_id, p_type as status, p_brand as uploaded_by_case_role,
 CAST(p_size AS BIGINT) as iteration_count, seen as created_at, seen as ingestion_timestamp
from part join (select l_partkey, min(l_orderkey) as evidence_id, min(l_shipdate) as seen from lineitem group by 1) u
 on l_partkey = p_partkey""",
    "cm_evidence_property": """
select s_suppkey as id, evidence_id, 'nation_' || CAST(s_nationkey AS VARCHAR) as property_type,
 seen as created_at, seen as ingestion_timestamp
from supplier join (select l_suppkey, min(l_orderkey) as evidence_id, min(l_shipdate) as seen from lineitem group by 1) u
 on l_suppkey = s_suppkey""",
    "cm_recommender": """
select c_custkey as id, case_id, c_mktsegment as status, seen as created_at, seen as ingestion_timestamp
from customer join (select o_custkey, min(o_orderkey) as case_id, min(o_orderdate) as seen from orders group by 1) u
 on o_custkey = c_custkey""",
    "wf_events": """
select
 case when event_id % 41 = 0 then 'not-a-date' when event_id % 7 = 0 then cast(1704067200 + event_id as varchar)
      when event_id % 11 = 0 then cast(date_trunc('second', ts) as varchar) || '+00' else cast(date_trunc('second', ts) as varchar) end as event_time,
 case when event_id % 53 = 0 then 'null' else cast(date_trunc('second', ts) as varchar) end as ingestion_timestamp,
 case event_type when 'view' then 'cw_task_plugin_opened' when 'click' then 'cw_doc_upload_started' when 'purchase' then 'cw_doc_upload_completed'
      when 'signup' then case when event_id % 5 = 0 then 'cw_questionnaire_session_submitted' else 'cw_questionnaire_session_started' end
      else 'app_error' end as event_type,
 '{"event_id":' || cast(event_id as varchar) || ',"case_id":"' || cast(user_id * 10 as varchar)
 || '","task_assignment_id":"' || cast(user_id * 100 + event_id % 10 * 10 + 2 as varchar)
 || '","actor_role":"' || case when event_id % 8 = 0 then 'attorney' else 'Beneficiary' end
 || '","task_plugin_type":"' || case when event_type = 'signup' then 'questionnaire' when event_id % 3 = 0 then ' File_Upload ' else 'file_upload' end
 || '","catalog_product_id":"' || cast(user_id % 4 as varchar)
 || '","user_can_act":' || case event_id % 4 when 0 then 'true' when 1 then '"yes"' when 2 then '"0"' else '""' end
 || ',"file_count":' || case event_id % 6 when 0 then '"3.0"' when 1 then '3' when 2 then '"1,200"' when 3 then '"unknown"' when 4 then 'null' else '" 2 "' end
 || ',"success_count":' || case event_id % 5 when 0 then '"3"' when 1 then '0' when 2 then '"n/a"' else '2' end
 || ',"error_count":' || cast(event_id % 2 as varchar)
 || ',"duration_ms":' || case event_id % 4 when 0 then '"1,520"' when 1 then '1520.5' else '"1520.0"' end || '}' as event_properties
from events""",
}


def _blank(x: str) -> str:
    return f"nullif(trim(CAST({x} AS VARCHAR)), '')"


def _raw_events_sql() -> str:
    cols = [f"{_blank('event_time')} AS raw_event_time",
            f"{_blank('ingestion_timestamp')} AS raw_ingestion_timestamp",
            "event_type", "event_properties"]
    cols += [f"{_blank(f'event_properties ->> {k!r}')} AS raw_{k}" for k in TEXT_KEYS]
    cols += [f"(event_properties ->> {k!r}) AS raw_{k}" for k in BOOLEAN_KEYS + NUMBER_KEYS]
    return (f"select {', '.join(cols)} from wf_events "
            f"where starts_with(event_type, 'cw_')")


def _stg_events_sql() -> str:
    num_flag = " OR ".join(f"(raw_{k} IS NOT NULL AND {int64('raw_' + k)} IS NULL)"
                           for k in NUMBER_KEYS)
    ts_flag = " OR ".join(f"(raw_{k} IS NOT NULL AND {timestamp('raw_' + k)} IS NULL)"
                          for k in ("event_time", "ingestion_timestamp"))
    cols = [
        md5key("raw_event_time", "raw_ingestion_timestamp", "event_type", "raw_case_id",
               "raw_task_id", "raw_task_assignment_id", "event_properties") + " AS event_natural_key",
        f"{timestamp('raw_event_time')} AS event_time",
        f"CAST({timestamp('raw_event_time')} AS DATE) AS event_date",
        f"{timestamp('raw_ingestion_timestamp')} AS ingestion_timestamp",
        "event_type AS event_name", "event_properties",
        "raw_case_id AS case_id", "raw_task_id AS task_id",
        "raw_task_assignment_id AS task_assignment_id",
        "raw_task_assignee_role AS task_assignee_role",
        "raw_task_active_assignment_action AS task_active_assignment_action",
        "lower(raw_task_plugin_type) AS task_plugin_type",
        "raw_task_sub_stage AS task_sub_stage", "raw_task_workflow_status AS task_workflow_status",
        "raw_catalog_product_id AS catalog_product_id",
        "raw_catalog_product_name AS catalog_product_name",
        "raw_catalog_product_service_name AS catalog_product_service_name",
        "raw_flow_template_id AS flow_template_id", "lower(raw_actor_role) AS actor_role",
        f"{boolean('raw_user_can_act')} AS user_can_act",
        f"{boolean('raw_user_can_claim')} AS user_can_claim",
    ]
    cols += [f"{int64('raw_' + k)} AS {k}" for k in NUMBER_KEYS]
    cols += [f"{float64('raw_duration_ms')} / 1000.0 AS duration_seconds",
             "raw_user_can_act", "raw_user_can_claim", "raw_event_time", "raw_ingestion_timestamp"]
    cols += [f"raw_{k}" for k in NUMBER_KEYS]
    cols += [f"coalesce({num_flag}, false) AS has_numeric_parse_error",
             f"coalesce({ts_flag}, false) AS has_timestamp_parse_error"]
    return f"select {', '.join(cols)} from raw_events"


STAGING = {
    "stg_cases": """
select id as case_id, beneficiary_id, catalog_product_id, flow_template_id, flow_template_version_id,
 stage as case_stage, status as case_status, stage_instance_id, kickoff_date, classification_date,
 filing_date_actual, receipt_date, decision_date, initialized_at, case_matter_case_id,
 created_at as case_created_at, updated_at as case_updated_at, deleted_at as case_deleted_at,
 ingestion_timestamp
from wf_case where deleted_at is null""",
    "stg_tasks": """
select id as task_id, case_id, name as task_name, CAST(NULL AS VARCHAR) as task_description,
 task_template_id, creation_source as task_creation_source, CAST(NULL AS VARCHAR) as case_stage_scope,
 sub_stage as task_sub_stage, status as task_status, CAST(NULL AS VARCHAR) as blocked_reason,
 CAST(NULL AS BOOLEAN) as force_unblocked, CAST(NULL AS TIMESTAMP) as task_activated_ts,
 CAST(NULL AS TIMESTAMP) as task_completed_ts, created_at as task_created_at,
 updated_at as task_updated_at, deleted_at as task_deleted_at, ingestion_timestamp
from wf_task where deleted_at is null""",
    "stg_assignments": """
select id as task_assignment_id, task_id, role_binding as assignment_role_binding,
 CAST(NULL AS VARCHAR) as assignee_role, action as assignment_action, status as assignment_status,
 iteration_count, active_time_ms, CAST(NULL AS BOOLEAN) as auto_activate, activated_ts, submitted_ts,
 completed_ts, created_at as assignment_created_at, updated_at as assignment_updated_at,
 deleted_at as assignment_deleted_at, ingestion_timestamp
from wf_assignment where deleted_at is null""",
    "raw_events": _raw_events_sql(),
    "stg_events": _stg_events_sql(),
}

# The intermediate models, by other means than the engine: long tables of marked moments, ranked
# to find the first or last one, and membership tests instead of conditional aggregates.
def _words(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_DAY_MARKS = (("created", "CAST(case_created_at AS DATE)"), ("initialized", "CAST(initialized_at AS DATE)"),
              ("kickoff", "kickoff_date"), ("classification", "classification_date"))
_UPLOAD_MARKS = (("opened", "first_plugin_opened_at"), ("started", "first_upload_started_at"),
                 ("some_ok", "first_successful_upload_at"), ("all_ok", "first_full_success_upload_at"))


def _long_days() -> str:
    return "\nunion all ".join(
        f"select case_id, '{mark}' as mark, date_diff('day', {day}, filing_date_actual) as days "
        f"from stg_cases where {day} <= filing_date_actual" for mark, day in _DAY_MARKS)


def _first(mark: str, column: str) -> str:
    return (f"(select any_value(f.moment) from upload_firsts f where f.mark = '{mark}' "
            f"and f.task_assignment_id = ids.task_assignment_id) as {column}")


def _tally(event: str, column: str, how: str, name: str) -> str:
    """A list function over the values of one event kind of an assignment; 0 without any."""
    return (f"CAST(coalesce({how}(list_filter(list_transform(list_filter(evs, lambda e: "
            f"e.event_name = '{event}'), lambda e: e.{column}), lambda v: v is not null)), 0) "
            f"AS BIGINT) as {name}")


def _flag(test: str, name: str) -> str:
    return f"CAST(coalesce({test}, false) AS INTEGER) as {name}"


INTERMEDIATE = {
    "filing_gaps": _long_days(),
    "case_durations": f"""
with gaps as (pivot filing_gaps on mark in ({", ".join(f"'{m}'" for m, _ in _DAY_MARKS)}) using max(days) group by case_id)
select k.case_id, beneficiary_id, catalog_product_id, flow_template_id, flow_template_version_id,
 case_stage, case_status, case_matter_case_id, case_created_at, case_created_at::date as case_created_date,
 initialized_at, initialized_at::date as initialized_date, kickoff_date, classification_date,
 filing_date_actual as filing_date, receipt_date, decision_date,
 {", ".join(f"CAST(gaps.{m} AS INTEGER) as {m}_to_filing_days" for m, _ in _DAY_MARKS)},
 {_flag("gaps.kickoff is not null", "is_valid_primary_duration")},
 {_flag("case_matter_case_id is not null", "has_legacy_case_link")}
from stg_cases k left join gaps using (case_id)
where exists (select 1 from stg_cases f where f.case_id = k.case_id and f.filing_date_actual > DATE '0001-01-01')""",
    "task_origins": """
select task_id, lower(ifnull(task_creation_source, '')) as origin from stg_tasks""",
    "custom_tasks": f"""
select task_id, cases.*, task_name, task_template_id, origin as task_creation_source, task_sub_stage,
 task_status, task_created_at, task_created_at::date as task_created_date,
 {_flag(f"list_contains({_words(('manual', 'custom', 'user_added'))}, origin)", "is_manually_added_task")},
 {_flag("task_template_id is null", "is_non_template_task")},
 {_flag(f"list_contains({_words(('manual', 'custom', 'user_added'))}, origin) or (task_template_id is null and not list_has_any([origin], {_words(('library', 'shared_library', 'ai_suggested', 'ai_generated'))}))", "is_custom_task_broad")}
from stg_tasks semi_tasks
 join task_origins using (task_id)
 join (select case_id, beneficiary_id, catalog_product_id, flow_template_id, flow_template_version_id from stg_cases) cases
   on cases.case_id = semi_tasks.case_id""",
    "upload_kinds": """
select * from (values ('cw_task_plugin_opened', 'opened'), ('cw_doc_upload_started', 'started'),
 ('cw_doc_upload_completed', 'done')) k(event_name, kind)""",
    "upload_moments": """
select e.task_assignment_id, k.kind as base_kind, e.event_time as moment,
 [k.kind,
  if(k.kind = 'done' and e.success_count >= 1, 'some_ok', null),
  if(k.kind = 'done' and e.file_count >= 1 and e.file_count is not distinct from e.success_count, 'all_ok', null)] as marks,
 e.event_name, e.file_count, e.success_count, e.error_count, e.ingestion_timestamp, e.case_id, e.task_id,
 e.catalog_product_id
from stg_events e semi join upload_kinds using (event_name) join upload_kinds k on k.event_name = e.event_name
where e.task_plugin_type = 'file_upload' and e.actor_role = 'beneficiary' and e.task_assignment_id <> ''""",
    "upload_firsts": """
select task_assignment_id, mark, moment
from (select task_assignment_id, unnest(marks) as mark, moment from upload_moments) m
where mark is not null and moment is not null
qualify row_number() over (partition by task_assignment_id, mark order by moment) = 1""",
    "upload_bags": """
select task_assignment_id,
 list({'event_name': event_name, 'file_count': file_count, 'success_count': success_count,
       'error_count': error_count}) as evs,
 list_sort(list(case_id)) as case_ids, list_sort(list(task_id)) as task_ids,
 list_sort(list(catalog_product_id)) as product_ids, list_reverse_sort(list(ingestion_timestamp), 'NULLS LAST') as loads
from upload_moments group by task_assignment_id""",
    "file_upload_attempts": f"""
with steps as (
 select ids.task_assignment_id, list_filter(case_ids, lambda v: v is not null)[1] as case_id,
  list_filter(task_ids, lambda v: v is not null)[1] as task_id,
  list_filter(product_ids, lambda v: v is not null)[1] as catalog_product_id,
  {", ".join(_first(m, c) for m, c in _UPLOAD_MARKS)},
  loads[1] as max_ingestion_timestamp,
  {", ".join(f"CAST(len(list_filter(evs, lambda e: e.event_name = '{e}')) AS BIGINT) as {n}" for e, n in (("cw_task_plugin_opened", "plugin_open_event_count"), ("cw_doc_upload_started", "upload_started_event_count"), ("cw_doc_upload_completed", "upload_completed_event_count")))},
  {_tally("cw_doc_upload_started", "file_count", "list_sum", "total_files_selected_across_attempts")},
  {_tally("cw_doc_upload_started", "file_count", "list_max", "max_files_selected_in_single_attempt")},
  {_tally("cw_doc_upload_completed", "success_count", "list_sum", "total_successful_files_uploaded")},
  {_tally("cw_doc_upload_completed", "error_count", "list_sum", "total_failed_files_uploaded")}
 from upload_bags ids)
select steps.*, first_plugin_opened_at::date as plugin_opened_date,
 {", ".join(_flag(f"steps.task_assignment_id in (select task_assignment_id from upload_firsts where mark = '{m}')", n) for m, n in (("opened", "opened_plugin"), ("started", "started_upload"), ("some_ok", "has_successful_upload"), ("all_ok", "uploaded_all_selected_files")))}
from steps
where task_assignment_id in (select task_assignment_id from upload_firsts where mark = 'opened')""",
    "questionnaire_event_signal": """
with pings as (
 select task_assignment_id, event_time, ingestion_timestamp,
  row_number() over (partition by task_assignment_id order by event_time nulls last) as nth_event,
  row_number() over (partition by task_assignment_id order by ingestion_timestamp desc nulls last) as nth_load,
  count(*) over (partition by task_assignment_id) as n
 from stg_events where task_plugin_type = 'questionnaire' and task_assignment_id <> '')
select early.task_assignment_id, early.event_time as first_questionnaire_event_at,
 late.ingestion_timestamp as max_questionnaire_event_ingestion_timestamp, early.n as questionnaire_event_count
from pings early join pings late using (task_assignment_id)
where early.nth_event = 1 and late.nth_load = 1""",
    "questionnaire_reasons": """
select task_assignment_id, 'name' as reason from stg_assignments join stg_tasks using (task_id)
where contains(lower(task_name), 'questionnaire')
union all select task_assignment_id, 'action' from stg_assignments
where contains(lower(assignment_action), 'questionnaire')
union all select task_assignment_id, 'event' from stg_assignments
where task_assignment_id::varchar in (select task_assignment_id from questionnaire_event_signal)""",
    "questionnaire_assignments": f"""
with reasons as (select task_assignment_id, list(distinct reason) as why from questionnaire_reasons group by 1)
select a.task_assignment_id, a.task_id, t.case_id, c.beneficiary_id, c.catalog_product_id,
 c.flow_template_id, c.flow_template_version_id, t.task_name, t.task_sub_stage,
 t.task_creation_source, a.assignment_action, a.assignment_status, a.assignment_role_binding,
 a.assignee_role, a.iteration_count, a.activated_ts, a.submitted_ts, a.completed_ts,
 a.assignment_created_at, a.assignment_updated_at,
 s.first_questionnaire_event_at, s.max_questionnaire_event_ingestion_timestamp, s.questionnaire_event_count,
 {", ".join(_flag(f"list_contains(why, '{w}')", n) for w, n in (("name", "matched_task_name_signal"), ("action", "matched_action_signal"), ("event", "matched_amplitude_signal")))},
 a.activated_ts::date as activation_date,
 (a.activated_ts::date - CAST(isodow(a.activated_ts) - 1 AS INTEGER)) as activation_week,
 {", ".join(_flag(f"a.{c} is not null", n) for c, n in (("activated_ts", "is_activated"), ("submitted_ts", "is_submitted"), ("completed_ts", "is_reviewer_completed")))},
 list_max([a.assignment_updated_at, s.max_questionnaire_event_ingestion_timestamp, TIMESTAMP '1900-01-01']) as source_updated_at
from reasons join stg_assignments a using (task_assignment_id)
 join stg_tasks t on t.task_id = a.task_id join stg_cases c on c.case_id = t.case_id
 left join questionnaire_event_signal s on s.task_assignment_id = a.task_assignment_id::varchar""",
}


def _avg2(x: str) -> str:
    return rate(f"sum({x})", f"count({x})", 2)


def _task_share(group: str) -> str:
    n = cnt("is_manually_added_task = 1")
    nt = cnt("is_non_template_task = 1")
    b = cnt("is_custom_task_broad = 1")
    return (f"count(*) as total_tasks, {n} as manually_added_tasks, {nt} as non_template_tasks, "
            f"{b} as broad_custom_tasks, CAST(0.2 AS DOUBLE) as manual_task_rate_target, "
            f"{rate(n, 'count(*)')} as manually_added_task_rate, "
            f"{rate(nt, 'count(*)')} as non_template_task_rate, "
            f"{rate(b, 'count(*)')} as broad_custom_task_rate, "
            f"coalesce(count(*) > 0 AND 5 * {n} > count(*), false) as is_above_pm_target")


def _funnel() -> str:
    s, a, f = cnt("started_upload = 1"), cnt("has_successful_upload = 1"), cnt("uploaded_all_selected_files = 1")
    return (f"count(*) as opened_upload_plugin_count, {s} as started_upload_count, "
            f"{a} as completed_upload_with_any_success_count, "
            f"{f} as completed_upload_with_full_success_count, "
            f"{rate(s, 'count(*)')} as open_to_start_rate, "
            f"{rate(a, 'count(*)')} as overall_any_success_rate, "
            f"{rate(a, s)} as start_to_any_success_rate, "
            f"{rate(f, s)} as start_to_full_success_rate, "
            f"{rate(f, 'count(*)')} as overall_full_success_rate, "
            "CAST(sum(total_files_selected_across_attempts) AS BIGINT) as total_files_selected_across_attempts, "
            "CAST(sum(total_successful_files_uploaded) AS BIGINT) as total_successful_files_uploaded, "
            "CAST(sum(total_failed_files_uploaded) AS BIGINT) as total_failed_files_uploaded")


def _questionnaire_daily() -> str:
    s, r = cnt("is_submitted = 1"), cnt("is_reviewer_completed = 1")
    b = "count(distinct beneficiary_id)"
    bs = "count(distinct beneficiary_id) filter (where is_submitted = 1)"
    br = "count(distinct beneficiary_id) filter (where is_reviewer_completed = 1)"
    return (f"count(*) as activated_assignments, {s} as submitted_assignments, "
            f"{r} as reviewer_completed_assignments, {b} as activated_beneficiaries, "
            f"{bs} as beneficiaries_with_any_submitted_assignment, "
            f"{br} as beneficiaries_with_any_reviewer_completed_assignment, "
            f"{rate(s, 'count(*)')} as assignment_submission_rate, "
            f"{rate(r, 'count(*)')} as assignment_reviewer_completion_rate, "
            f"{rate(bs, b)} as beneficiary_any_submission_rate, "
            f"{rate(br, b)} as beneficiary_any_reviewer_completion_rate, "
            "max(source_updated_at) as max_source_updated_at")


MARTS = {
    "case_duration_daily": with_percentiles(f"""
select filing_date as metric_date, catalog_product_id, count(*) as filed_cases,
 {cnt('is_valid_primary_duration = 1')} as kickoff_population_cases,
 {_avg2('kickoff_to_filing_days')} as avg_kickoff_to_filing_days,
 {cnt('initialized_to_filing_days is not null')} as initialized_population_cases,
 {cnt('created_to_filing_days is not null')} as created_population_cases,
 {cnt('has_legacy_case_link = 1')} as cases_with_legacy_link
from case_durations group by filing_date, catalog_product_id""",
        "(select filing_date as metric_date, * from case_durations)", ["metric_date", "catalog_product_id"],
        {"median_kickoff_to_filing_days": ("kickoff_to_filing_days", 0.5),
         "p75_kickoff_to_filing_days": ("kickoff_to_filing_days", 0.75),
         "p90_kickoff_to_filing_days": ("kickoff_to_filing_days", 0.9),
         "median_initialized_to_filing_days": ("initialized_to_filing_days", 0.5),
         "median_created_to_filing_days": ("created_to_filing_days", 0.5)},
        ["metric_date", "catalog_product_id", "filed_cases", "kickoff_population_cases",
         "avg_kickoff_to_filing_days", "median_kickoff_to_filing_days", "p75_kickoff_to_filing_days",
         "p90_kickoff_to_filing_days", "initialized_population_cases",
         "median_initialized_to_filing_days", "created_population_cases",
         "median_created_to_filing_days", "cases_with_legacy_link"]),
    "custom_tasks_daily": f"""
select task_created_date as metric_date, catalog_product_id, {_task_share('x')}
from custom_tasks group by task_created_date, catalog_product_id""",
    "file_upload_daily": f"""
select {md5key('plugin_opened_date', 'catalog_product_id')} as metric_day_product_key,
 plugin_opened_date as metric_date, catalog_product_id, {_funnel()},
 max(max_ingestion_timestamp) as max_ingestion_timestamp
from file_upload_attempts group by plugin_opened_date, catalog_product_id""",
    "questionnaire_daily": f"""
select {md5key('activation_date', 'catalog_product_id')} as metric_day_product_key,
 activation_date as metric_date, catalog_product_id, {_questionnaire_daily()}
from questionnaire_assignments where is_activated = 1 and activation_date is not null
group by activation_date, catalog_product_id""",
}

METRICS = {
    "metric_questionnaire_weekly": f"""
select activation_week as metric_week, catalog_product_id,
 count(*) as activated_questionnaire_assignments,
 {cnt('is_submitted = 1')} as submitted_questionnaire_assignments,
 {cnt('is_reviewer_completed = 1')} as reviewer_completed_questionnaire_assignments,
 {rate(cnt('is_submitted = 1'), 'count(*)')} as questionnaire_submission_rate,
 {rate(cnt('is_reviewer_completed = 1'), 'count(*)')} as questionnaire_reviewer_completion_rate
from questionnaire_assignments where is_activated = 1 and activation_week is not null
group by activation_week, catalog_product_id order by 1, 2""",
    "metric_custom_task_share": f"""
select catalog_product_id as visa_type_key, {_task_share('x')}
from custom_tasks group by catalog_product_id
order by manually_added_task_rate desc nulls first, visa_type_key""",
    "metric_case_duration": with_percentiles(f"""
select catalog_product_id, count(*) as case_count,
 {_avg2('kickoff_to_filing_days')} as avg_kickoff_to_filing_days,
 {cnt('initialized_to_filing_days is not null')} as initialized_population_cases,
 {cnt('created_to_filing_days is not null')} as created_population_cases,
 {cnt('classification_to_filing_days is not null')} as classification_population_cases,
 {cnt('has_legacy_case_link = 1')} as cases_with_legacy_link
from case_durations where is_valid_primary_duration = 1
group by catalog_product_id""",
        "(select * from case_durations where is_valid_primary_duration = 1)", ["catalog_product_id"],
        {"median_kickoff_to_filing_days": ("kickoff_to_filing_days", 0.5),
         "p75_kickoff_to_filing_days": ("kickoff_to_filing_days", 0.75),
         "p90_kickoff_to_filing_days": ("kickoff_to_filing_days", 0.9),
         "median_initialized_to_filing_days": ("initialized_to_filing_days", 0.5),
         "median_created_to_filing_days": ("created_to_filing_days", 0.5),
         "median_classification_to_filing_days": ("classification_to_filing_days", 0.5)},
        ["catalog_product_id", "case_count", "avg_kickoff_to_filing_days",
         "median_kickoff_to_filing_days", "p75_kickoff_to_filing_days", "p90_kickoff_to_filing_days",
         "initialized_population_cases", "median_initialized_to_filing_days",
         "created_population_cases", "median_created_to_filing_days",
         "classification_population_cases", "median_classification_to_filing_days",
         "cases_with_legacy_link"]),
    "metric_upload_funnel": f"""
select plugin_opened_date as metric_date, catalog_product_id, {_funnel()}
from file_upload_attempts group by plugin_opened_date, catalog_product_id order by 1, 2""",
}

# Every CTE in dependency order; later modules append to this.
CTES: dict[str, str] = {}
for _part in (RAW, STAGING, INTERMEDIATE, MARTS, METRICS):
    CTES.update(_part)


def with_models(select: str, ctes: dict[str, str] | None = None) -> str:
    """``WITH <every model> <select>``; DuckDB only evaluates referenced CTEs."""
    all_ctes = dict(CTES)
    if ctes:
        all_ctes.update(ctes)
    body = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in all_ctes.items())
    return f"WITH {body}\n{select.strip()}"


def model(name: str) -> str:
    return with_models(f"select * from {name}")
