"""Null-safe casts for dirty text fields (C4-C11).

Each function maps a text ``Column`` to a typed ``Column``; nothing leaves the
JVM, so the casts sit inside whole-stage codegen.  Values that look valid but
cannot be represented (``2026-13-45``, a 20-digit integer, ``1e999``) become
NULL rather than failing the job, via ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that means "no value" (compared after trim + lower-case).
NULL_TOKENS = ("", "null", "none", "nan", "n/a", "na", "unknown", "undefined")
# Accepted boolean spellings.
TRUE_TOKENS = ("true", "t", "1", "yes", "y")
FALSE_TOKENS = ("false", "f", "0", "no", "n")

# Fixed patterns (anchored on the whole text).  They follow the documented
# clean examples: a literal dot before fractional digits ("3.0", "1520.0"),
# and a UTC offset of hours with optional minutes ("+00", "+05:30", "+0530").
INT_PATTERN = r"^[+-]?[0-9]+(\.0+)?\z"
FLOAT_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
ISO_TS_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?\z"
)
EPOCH_SECONDS_PATTERN = r"^[0-9]{10}\z"
EPOCH_MILLIS_PATTERN = r"^[0-9]{13}\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """``nullif(btrim(x), '')``: trims spaces only, like Postgres ``btrim``."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def is_null_token(cleaned: Column) -> Column:
    return F.lower(cleaned).isin(*NULL_TOKENS)


def _numeric_text(c: Column) -> Column:
    # ``regexp_replace(btrim(x), ',', '', 'g')`` -- a literal comma strip.
    return F.translate(F.trim(c.cast("string")), ",", "")


def safe_int64(c: str | Column) -> Column:
    """Integer-looking text (``"3"``, ``"3.0"``, ``"1,200"``) to ``bigint``."""
    raw = _col(c)
    cleaned = _numeric_text(raw)
    # Through decimal: a direct cast of "3.0" to bigint fails.  try_cast turns
    # an out-of-range value into NULL instead of an error.
    parsed = cleaned.try_cast("decimal(38,10)").try_cast("bigint")
    return (
        F.when(raw.isNull(), F.lit(None).cast("bigint"))
        .when(is_null_token(cleaned), F.lit(None).cast("bigint"))
        .when(cleaned.rlike(INT_PATTERN), parsed)
    )


def safe_float64(c: str | Column) -> Column:
    """Number-looking text to ``double``; infinities (overflow) become NULL."""
    raw = _col(c)
    cleaned = _numeric_text(raw)
    parsed = cleaned.try_cast("double")
    finite = F.when(~F.isnan(parsed) & (F.abs(parsed) != F.lit(float("inf"))), parsed)
    return (
        F.when(raw.isNull(), F.lit(None).cast("double"))
        .when(is_null_token(cleaned), F.lit(None).cast("double"))
        .when(cleaned.rlike(FLOAT_PATTERN), finite)
    )


def safe_boolean(c: str | Column) -> Column:
    """``true/t/1/yes/y`` and ``false/f/0/no/n`` (any case) to boolean."""
    norm = F.lower(F.trim(_col(c).cast("string")))
    return (
        F.when(norm.isin(*TRUE_TOKENS), F.lit(True))
        .when(norm.isin(*FALSE_TOKENS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def safe_timestamp(c: str | Column) -> Column:
    """ISO-8601 text, 10-digit epoch seconds or 13-digit epoch millis to timestamp.

    Text without an offset is read in the session zone (pinned to UTC).
    """
    raw = _col(c)
    cleaned = F.trim(raw.cast("string"))
    return (
        F.when(raw.isNull(), F.lit(None).cast("timestamp"))
        .when(is_null_token(cleaned), F.lit(None).cast("timestamp"))
        .when(cleaned.rlike(ISO_TS_PATTERN), cleaned.try_cast("timestamp"))
        .when(cleaned.rlike(EPOCH_SECONDS_PATTERN),
              F.timestamp_seconds(cleaned.try_cast("bigint")))
        .when(cleaned.rlike(EPOCH_MILLIS_PATTERN),
              F.timestamp_millis(cleaned.try_cast("bigint")))
    )


def parse_failed(raw: Column, typed: Column) -> Column:
    """True when a value was present but did not survive its cast."""
    return raw.isNotNull() & typed.isNull()


def any_parse_failed(pairs: list[tuple[Column, Column]]) -> Column:
    """OR of :func:`parse_failed` over ``(raw, typed)`` pairs; never NULL."""
    flag = F.lit(False)
    for raw, typed in pairs:
        flag = flag | parse_failed(raw, typed)
    return flag
