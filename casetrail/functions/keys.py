"""Deterministic text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts: Column) -> Column:
    """``md5(concat_ws('|', coalesce(p::text, ''), ...))``."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
