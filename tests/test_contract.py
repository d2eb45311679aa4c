"""Metric contract: safe roll-ups and refusals."""

import datetime as dt

import pytest

from casetrail.operators import contract
from casetrail.operators.contract import ContractError


def _mart(spark):
    d = dt.date
    return spark.createDataFrame([
        (d(2024, 1, 1), "p", 10, 1), (d(2024, 1, 2), "p", 1, 1), (d(2024, 1, 3), "p", 9, 0),
    ], "metric_date date, catalog_product_id string, activated_assignments long, submitted_assignments long")


def test_ratio_of_sums_not_average_of_rates(spark):
    out = contract.rollup_ratio(_mart(spark), "questionnaire_daily", "assignment_submission_rate",
                                "month").first()
    assert (out.numerator, out.denominator) == (2, 20) and out.value == 0.1
    avg_of_rates = (1 / 10 + 1 / 1 + 0 / 9) / 3
    assert abs(out.value - avg_of_rates) > 0.1
    assert out.period_start == dt.date(2024, 1, 1) and out.metric_version == "1.0"


def test_refusals(spark):
    m = _mart(spark)
    with pytest.raises(ContractError, match="not defined by attorney"):
        contract.rollup_additive(m, "questionnaire_daily", "activated_assignments", "day",
                                 ["attorney"])
    with pytest.raises(ContractError, match="quarter"):
        contract.rollup_additive(m, "questionnaire_daily", "activated_assignments", "quarter")
    with pytest.raises(ContractError, match="cannot be summed"):
        contract.rollup_additive(m, "questionnaire_daily", "assignment_submission_rate", "week")
    with pytest.raises(ContractError, match="not a declared metric"):
        contract.rollup_ratio(m, "questionnaire_daily", "beneficiary_any_submission_rate", "week")


def test_percentile_from_base_rows_differs_from_average_of_daily(spark):
    d = dt.date
    base = spark.createDataFrame([
        (d(2024, 1, 1), "p", 1), (d(2024, 1, 1), "p", 2), (d(2024, 1, 1), "p", 3),
        (d(2024, 1, 2), "p", 100),
    ], "filing_date date, catalog_product_id string, kickoff_to_filing_days int")
    out = contract.rollup_percentile(base, "case_duration_daily", "median_kickoff_to_filing_days",
                                     "month").first()
    assert out.value == 2.5 and out.base_rows == 4
    assert out.value != (2 + 100) / 2
