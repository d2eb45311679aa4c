"""O1, O2: the analyst queries come in their declared row order (NULLs as Postgres sorts them)."""

import datetime as dt

import pytest

from casetrail.plans.models import Models

LATE = dt.date.max


def _last(value, top):
    return (value is None, top if value is None else value)


@pytest.mark.parametrize("name, key", [
    ("metric_questionnaire_weekly",
     lambda r: (_last(r.metric_week, LATE), _last(r.catalog_product_id, ""))),
    ("metric_upload_funnel",
     lambda r: (_last(r.metric_date, LATE), _last(r.catalog_product_id, ""))),
    ("metric_case_duration", lambda r: _last(r.catalog_product_id, "")),
    # highest rate first, an undefined rate before all
    ("metric_custom_task_share",
     lambda r: (r.manually_added_task_rate is not None, -(r.manually_added_task_rate or 0),
                _last(r.visa_type_key, ""))),
])
def test_rows_are_in_order(spark, sf_small, name, key):
    rows = Models(spark, sf_small).get(name).collect()
    assert len(rows) > 1
    assert [key(r) for r in rows] == sorted(key(r) for r in rows)
