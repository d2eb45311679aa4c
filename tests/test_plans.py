"""Plan properties the design relies on at scale (checked on the smallest data)."""

import re

import pytest

from casetrail.plans import registry

registry.load_all()
# The keys each model groups by: its exchange on them must carry partial results.
OWN_KEYS = {"file_upload_attempts": "task_assignment_id",
            "questionnaire_event_signal": "task_assignment_id",
            "questionnaire_daily": "catalog_product_id",
            "custom_tasks_daily": "catalog_product_id",
            "case_duration_daily": "catalog_product_id"}


def _plan(spark, sf, key):
    return registry.QUERIES[key](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(OWN_KEYS))
def test_hot_keys_are_combined_before_the_shuffle(spark, sf_small, key):
    found = re.findall(r"Aggregate\(keys?=\[([^\]]*)\], functions=\[partial_", _plan(spark, sf_small, key))
    assert any(OWN_KEYS[key] in keys for keys in found), found


def test_questionnaire_filter_comes_before_the_case_join(spark, sf_small):
    plan = registry.QUERIES["questionnaire_assignments"](spark, sf_small)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    case_join = next(i for i, line in enumerate(text.splitlines()) if re.search(r"Join Inner", line))
    signals = next(i for i, line in enumerate(text.splitlines()) if "questionnaire" in line and "Filter" in line)
    assert case_join < signals                          # the filter is below the topmost join


@pytest.mark.parametrize("key", sorted(k for k in registry.QUERIES if not k.startswith("stream_")))
def test_no_python_udfs_or_cartesian_products(spark, sf_small, key):
    plan = _plan(spark, sf_small, key)
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{key}: {node}"
