"""Event payload extraction.

The payload is parsed once per row with ``json_tuple``: a generator that
returns every requested key as text in a single pass.  Because it is a
generator, Catalyst cannot inline it into pushed-down filters (as it does
with a projected ``from_json`` struct, re-parsing once per referenced key),
so each payload is parsed exactly once.  Repeated ``get_json_object`` calls
would re-parse the JSON per key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payload keys read into typed columns.
TEXT_KEYS = (
    "case_id", "task_id", "task_assignment_id", "task_assignee_role",
    "task_active_assignment_action", "task_plugin_type", "task_sub_stage",
    "task_workflow_status", "catalog_product_id", "catalog_product_name",
    "catalog_product_service_name", "flow_template_id", "actor_role",
)
BOOLEAN_KEYS = ("user_can_act", "user_can_claim")
NUMBER_KEYS = (
    "file_count", "success_count", "error_count", "session_number",
    "instance_count", "duration_ms",
)
ALL_KEYS = TEXT_KEYS + BOOLEAN_KEYS + NUMBER_KEYS


def payload_keys(c: str | Column, keys=ALL_KEYS, prefix: str = "_j_") -> Column:
    """Generator column: one text column ``{prefix}{key}`` per key, one parse per row.

    JSON null and a missing key give NULL; a number keeps its text.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.json_tuple(col, *keys).alias(*[f"{prefix}{k}" for k in keys])
