"""Metric contract: safe re-aggregation of daily marts across time (M1-M7).

Counts are summed, ratios recomputed from summed components, averages and
percentiles recomputed from base rows.  A request for a metric, dimension or
time grain that the contract does not declare raises :class:`ContractError`
naming what is available.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import rate, rounded_mean
from .percentiles import cell_count, from_counts, merge_value_lists, percentiles


class ContractError(ValueError):
    """The request is outside the declared metric contract."""


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str                      # additive_count | ratio | average | percentile
    numerator: str | None = None
    denominator: str | None = None
    base_measure: str | None = None
    percentile: float | None = None


@dataclass(frozen=True)
class MartContract:
    mart: str
    family: str
    version: str
    time_dimension: str
    grains: tuple[str, ...]
    dimensions: tuple[str, ...]
    metrics: dict[str, Metric] = field(default_factory=dict)
    freshness_field: str | None = None
    base_model: str | None = None
    base_time_dimension: str | None = None

    def metric(self, name: str) -> Metric:
        if name not in self.metrics:
            raise ContractError(
                f"{name!r} is not a declared metric of {self.mart}; "
                f"available: {', '.join(sorted(self.metrics))}")
        return self.metrics[name]

    def check_request(self, grain: str, dimensions: Sequence[str]) -> None:
        if grain not in self.grains:
            raise ContractError(f"time grain {grain!r} is not allowed for {self.mart}; "
                                f"allowed: {', '.join(self.grains)}")
        extra = [d for d in dimensions if d not in self.dimensions]
        if extra:
            raise ContractError(
                f"{self.mart} is not defined by {', '.join(extra)}; it is available by "
                f"{', '.join(self.dimensions)} and {self.time_dimension}")


def _counts(*names):
    return {n: Metric(n, "additive_count") for n in names}


def _ratio(name, num, den):
    return {name: Metric(name, "ratio", numerator=num, denominator=den)}


GRAINS = ("day", "week", "month")
DIMS = ("catalog_product_id",)

# The declared contract of each mart.
CONTRACTS: dict[str, MartContract] = {
    "questionnaire_daily": MartContract(
        "questionnaire_daily", "questionnaire_completion", "1.0", "metric_date", GRAINS, DIMS,
        {**_counts("activated_assignments", "submitted_assignments",
                   "reviewer_completed_assignments"),
         **_ratio("assignment_submission_rate", "submitted_assignments", "activated_assignments"),
         **_ratio("assignment_reviewer_completion_rate", "reviewer_completed_assignments",
                  "activated_assignments")},
        freshness_field="max_source_updated_at"),
    "custom_tasks_daily": MartContract(
        "custom_tasks_daily", "custom_tasks", "1.0", "metric_date", GRAINS, DIMS,
        {**_counts("total_tasks", "manually_added_tasks"),
         **_ratio("manually_added_task_rate", "manually_added_tasks", "total_tasks")}),
    "case_duration_daily": MartContract(
        "case_duration_daily", "case_duration", "1.0", "metric_date", GRAINS, DIMS,
        {**_counts("filed_cases", "kickoff_population_cases"),
         "avg_kickoff_to_filing_days": Metric("avg_kickoff_to_filing_days", "average",
                                              base_measure="kickoff_to_filing_days"),
         "median_kickoff_to_filing_days": Metric("median_kickoff_to_filing_days", "percentile",
                                                 base_measure="kickoff_to_filing_days", percentile=0.5),
         "p75_kickoff_to_filing_days": Metric("p75_kickoff_to_filing_days", "percentile",
                                              base_measure="kickoff_to_filing_days", percentile=0.75),
         "p90_kickoff_to_filing_days": Metric("p90_kickoff_to_filing_days", "percentile",
                                              base_measure="kickoff_to_filing_days", percentile=0.9)},
        base_model="case_durations", base_time_dimension="filing_date"),
    "file_upload_daily": MartContract(
        "file_upload_daily", "file_upload_funnel", "1.0", "metric_date", GRAINS, DIMS,
        {**_counts("opened_upload_plugin_count", "started_upload_count",
                   "completed_upload_with_any_success_count",
                   "completed_upload_with_full_success_count"),
         **_ratio("open_to_start_rate", "started_upload_count", "opened_upload_plugin_count"),
         **_ratio("start_to_any_success_rate", "completed_upload_with_any_success_count",
                  "started_upload_count"),
         **_ratio("start_to_full_success_rate", "completed_upload_with_full_success_count",
                  "started_upload_count"),
         **_ratio("overall_any_success_rate", "completed_upload_with_any_success_count",
                  "opened_upload_plugin_count"),
         **_ratio("overall_full_success_rate", "completed_upload_with_full_success_count",
                  "opened_upload_plugin_count")},
        freshness_field="max_ingestion_timestamp"),
}

FUNNEL_RATES = ("open_to_start_rate", "start_to_any_success_rate", "start_to_full_success_rate",
                "overall_any_success_rate", "overall_full_success_rate")


def contract(mart: str) -> MartContract:
    if mart not in CONTRACTS:
        raise ContractError(f"{mart!r} has no metric contract; available: {', '.join(sorted(CONTRACTS))}")
    return CONTRACTS[mart]


def period_start(date_col: str | Column, grain: str) -> Column:
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    if grain == "day":
        return c.cast("date")
    return F.date_trunc(grain, c).cast("date")


def _context(c: MartContract, metric: str, grain: str, source_model: str) -> list[Column]:
    """M6: the context an answer needs to be auditable."""
    return [F.lit(metric).alias("metric_name"), F.lit(c.version).alias("metric_version"),
            F.lit(grain).alias("time_grain"), F.lit(c.time_dimension).alias("time_dimension"),
            F.lit(source_model).alias("source_model")]


def rollup_additive(mart_df: DataFrame, mart: str, metric: str, grain: str,
                    dimensions: Sequence[str] = DIMS) -> DataFrame:
    """M1: sum an additive count to the requested grain."""
    c = contract(mart)
    c.check_request(grain, dimensions)
    m = c.metric(metric)
    if m.kind != "additive_count":
        raise ContractError(f"{metric} is a {m.kind}; it cannot be summed across time")
    return (mart_df.groupBy(period_start(c.time_dimension, grain).alias("period_start"), *dimensions)
            .agg(F.sum(metric).cast("long").alias("value"))
            .select("period_start", *dimensions, "value", *_context(c, metric, grain, mart)))


def rollup_ratio(mart_df: DataFrame, mart: str, metric: str, grain: str,
                 dimensions: Sequence[str] = DIMS) -> DataFrame:
    """M2: ``sum(numerator) / sum(denominator)`` -- never the average of daily rates."""
    c = contract(mart)
    c.check_request(grain, dimensions)
    m = c.metric(metric)
    if m.kind != "ratio":
        raise ContractError(f"{metric} is a {m.kind}, not a ratio")
    num, den = F.sum(m.numerator), F.sum(m.denominator)
    return (mart_df.groupBy(period_start(c.time_dimension, grain).alias("period_start"), *dimensions)
            .agg(num.cast("long").alias("numerator"), den.cast("long").alias("denominator"),
                 rate(num, den).alias("value"))
            .select("period_start", *dimensions, "value", "numerator", "denominator",
                    F.lit(m.numerator).alias("numerator_name"),
                    F.lit(m.denominator).alias("denominator_name"),
                    *_context(c, metric, grain, mart)))


def rollup_funnel(mart_df: DataFrame, grain: str, dimensions: Sequence[str] = DIMS,
                  mart: str = "file_upload_daily") -> DataFrame:
    """M5: sum every funnel step, then divide (all five rates)."""
    c = contract(mart)
    c.check_request(grain, dimensions)
    steps = ("opened_upload_plugin_count", "started_upload_count",
             "completed_upload_with_any_success_count", "completed_upload_with_full_success_count")
    agg = mart_df.groupBy(period_start(c.time_dimension, grain).alias("period_start"),
                          *dimensions).agg(*[F.sum(s).cast("long").alias(s) for s in steps])
    rates = [rate(F.col(c.metrics[r].numerator), F.col(c.metrics[r].denominator)).alias(r)
             for r in FUNNEL_RATES]
    return agg.select("period_start", *dimensions, *steps, *rates,
                      *_context(c, "file_upload_funnel", grain, mart))


def rollup_average(base_df: DataFrame, mart: str, metric: str, grain: str,
                   dimensions: Sequence[str] = DIMS) -> DataFrame:
    """M3: average recomputed from base rows (exact sum / count, 2 decimals)."""
    c = contract(mart)
    c.check_request(grain, dimensions)
    m = c.metric(metric)
    if m.kind != "average":
        raise ContractError(f"{metric} is a {m.kind}, not an average")
    x = F.col(m.base_measure)
    return (base_df.groupBy(period_start(c.base_time_dimension, grain).alias("period_start"),
                            *dimensions)
            .agg(rounded_mean(F.sum(x), F.count(x)).alias("value"),
                 F.count(x).alias("base_rows"))
            .select("period_start", *dimensions, "value", "base_rows",
                    *_context(c, metric, grain, c.base_model)))


def rollup_percentile(base_df: DataFrame, mart: str, metric: str, grain: str,
                      dimensions: Sequence[str] = DIMS) -> DataFrame:
    """M4: percentile recomputed from base rows, never from daily percentiles."""
    c = contract(mart)
    c.check_request(grain, dimensions)
    m = c.metric(metric)
    if m.kind != "percentile":
        raise ContractError(f"{metric} is a {m.kind}, not a percentile")
    base = base_df.select(period_start(c.base_time_dimension, grain).alias("period_start"),
                          *dimensions, F.col(m.base_measure).alias("_x"))
    groups = ["period_start", *dimensions]
    # One pass: a constant measure keeps groups without values; counts come from the cells.
    out = percentiles(base, groups, {"_rows": F.lit(1), "x": "_x"}, {"value": ("x", m.percentile)},
                      extra={"base_rows": cell_count("x")})
    return out.select(*groups, "value", "base_rows", *_context(c, metric, grain, c.base_model))


#: Measure of :func:`casetrail.operators.marts.case_duration_values` for each base measure.
STORED_MEASURES = {"kickoff_to_filing_days": "kickoff"}


def rollup_percentile_stored(values: DataFrame, mart: str, metric: str, grain: str,
                             dimensions: Sequence[str] = DIMS) -> DataFrame:
    """M4 from the value counts stored per day: :func:`rollup_percentile` without base rows.

    ``values`` has ``(time dimension, *dimensions, measure, cells)``; days merge exactly, and a
    group whose measure is all NULL stays, with a NULL percentile and no base rows.
    """
    c = contract(mart)
    c.check_request(grain, dimensions)
    m = c.metric(metric)
    if m.kind != "percentile":
        raise ContractError(f"{metric} is a {m.kind}, not a percentile")
    measure = STORED_MEASURES[m.base_measure]
    groups = ["period_start", *dimensions]
    days = (values.where(F.col("measure").isin("_rows", measure))
            .withColumn("period_start", period_start(c.time_dimension, grain)))
    out = from_counts(merge_value_lists(days, groups), groups, {"value": (measure, m.percentile)},
                      extra={"base_rows": cell_count(measure)})
    return out.select(*groups, "value", "base_rows", *_context(c, metric, grain, c.base_model))


def with_quality(rollup: DataFrame, mart: str, status: DataFrame) -> DataFrame:
    """M6: add how fresh the mart's data is and whether one of its checks failed.

    ``status`` has one row per mart: ``mart, is_degraded, degraded_reason, last_loaded_at``.  It
    is read as one scalar subquery; a mart without a row gets NULLs.
    """
    state = status.where(F.col("mart") == contract(mart).mart).agg(F.first(F.struct(
        "last_loaded_at", "is_degraded", "degraded_reason"))).scalar()
    return rollup.select("*", state.getField("last_loaded_at").alias("fresh_as_of"),
                         state.getField("is_degraded").alias("is_degraded"),
                         state.getField("degraded_reason").alias("quality_warning"))


def metric_freshness(marts: dict[str, DataFrame]) -> DataFrame:
    """M7: newest value of the declared freshness field of each mart that has one."""
    parts = []
    for name, df in marts.items():
        c = contract(name)
        if c.freshness_field:
            parts.append(df.agg(F.max(c.freshness_field).alias("fresh_as_of")).select(
                F.lit(name).alias("mart"), F.lit(c.freshness_field).alias("freshness_field"),
                "fresh_as_of"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
