"""Column functions that turn raw text into typed values.

Each function comes in two forms: ``name_sql(expr) -> str`` returns Spark
SQL text (for ``selectExpr`` / ``spark.sql``), and ``name(expr) -> Column``
wraps it with ``F.expr``. ``expr`` is a column name or any SQL expression.
Both are built-in expressions only, so they stay inside whole-stage code
generation, and a whole projection of them costs one call to the JVM.

Rules (the raw tables keep business values as text):

* the zero-length string means "missing" (only ``''``; ``'  '`` stays a
  value and fails a numeric cast);
* a typed value is a *strict* cast: text that is not a valid value aborts
  the query, it never silently becomes NULL. The casts raise by themselves
  (``try_cast`` plus ``raise_error``) and read text without an offset as UTC,
  so results depend neither on ANSI mode nor on the session's time zone;
* Spark accepts a few date/time shapes other systems reject (``'2024'``,
  ``'2024-03'``, ``'T12:30:00'``) and silently rounds extra fraction
  digits; the guards below turn those into errors as well;
* dates and timestamps may be declared in other formats: ``formats`` lists
  Spark datetime patterns (or ``ISO``), tried in order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The typed form of an unbounded NUMERIC and the flag letters.
DECIMAL_PRECISION = 37  # 37 (not 38) so that a + b is exactly decimal(38, 10)
DECIMAL_SCALE = 10
FLAG_TRUE = "Y"
FLAG_FALSE = "N"

# A date or timestamp text must start with year-month-day.
_WS = " \t\r\n"
_DATE = f"^[{_WS}]*[+-]?[0-9]{{4,}}-[0-9]{{1,2}}-[0-9]{{1,2}}"
DATE_SHAPE = _DATE
# Only these can need more fraction digits than DECIMAL_SCALE.
_LONG_FRACTION = "[.][0-9]{%d}|[eE]" % (DECIMAL_SCALE + 1)
# The default format: ISO 8601 as Spark's casts read it, from year to day at least.
ISO = "ISO"

DECIMAL_SQL = f"DECIMAL({DECIMAL_PRECISION},{DECIMAL_SCALE})"


def decimal_type() -> DecimalType:
    return DecimalType(DECIMAL_PRECISION, DECIMAL_SCALE)


# ------------------------------------------------------------------ SQL text
def blank_to_null_sql(c: str) -> str:
    """``''`` becomes NULL; everything else (including spaces) is kept."""
    return f"nullif({c}, '')"


def _or_raise(t: str, typed: str, what: str) -> str:
    """``typed``, which is NULL for text it cannot read; such text raises."""
    return f"coalesce({typed}, CASE WHEN {t} IS NOT NULL THEN raise_error(concat('not a {what}: ', {t})) END)"


def strict_long_sql(c: str) -> str:
    """Blank -> NULL, otherwise text -> bigint; invalid text raises."""
    t = blank_to_null_sql(c)
    return _or_raise(t, f"try_cast({t} AS BIGINT)", "whole number")


def _needed_scale_sql(t: str) -> str:
    """Fraction digits that the number (not its spelling) needs: those of the
    mantissa without trailing zeros, less the exponent."""
    whole = f"regexp_extract({t}, '^[{_WS}+-]*([0-9]*)', 1)"
    fraction = f"trim(TRAILING '0' FROM regexp_extract({t}, '^[^.eE]*[.]([0-9]*)', 1))"
    exponent = f"coalesce(try_cast(nullif(regexp_extract({t}, '[eE]([+-]?[0-9]+)', 1), '') AS INT), 0)"
    significant = f"trim(TRAILING '0' FROM {whole})"
    return (
        f"CASE WHEN {fraction} <> '' THEN length({fraction}) - {exponent} "
        f"WHEN {significant} <> '' THEN length({significant}) - length({whole}) - {exponent} ELSE 0 END"
    )


def strict_decimal_sql(c: str, allow_rounding: bool = False) -> str:
    """Blank -> NULL, otherwise text -> decimal(37, 10).

    Invalid text raises. A number that needs more fraction digits than the
    scale raises too, unless ``allow_rounding``.
    """
    t = blank_to_null_sql(c)
    typed = _or_raise(t, f"try_cast({t} AS {DECIMAL_SQL})", "number")
    if allow_rounding:
        return typed
    return (
        f"CASE WHEN {t} RLIKE '{_LONG_FRACTION}' AND {_needed_scale_sql(t)} > {DECIMAL_SCALE} "
        f"THEN raise_error(concat('decimal text would be rounded: ', {t})) ELSE {typed} END"
    )


def _iso_instant_sql(t: str) -> str:
    """An instant, or NULL; without an offset the text is read as UTC."""
    trimmed = f"trim(BOTH '{_WS}' FROM {t})"
    return (
        f"try_cast(CASE WHEN {t} RLIKE '{_DATE}[{_WS}]*$' THEN concat({trimmed}, ' 00:00:00Z') "
        f"WHEN {t} RLIKE '{_DATE}[ T][0-9:.]+[{_WS}]*$' THEN concat({trimmed}, 'Z') "
        f"WHEN {t} RLIKE '{_DATE}' THEN {t} END AS TIMESTAMP)"
    )


def _pattern_instant_sql(t: str, pattern: str) -> str:
    """By a datetime pattern; a pattern without a zone is read as UTC."""
    bare = re.sub(r"'[^']*'", "", pattern)
    quoted = pattern.replace("'", "''") if "'" in pattern else pattern
    if re.search(r"[VzOXxZ]", bare):
        return f"try_to_timestamp({t}, '{quoted}')"
    return f"try_to_timestamp(concat({t}, ' +00:00'), '{quoted} XXX')"


def strict_timestamp_sql(c: str, formats: Sequence[str] = (ISO,)) -> str:
    """Blank -> NULL, otherwise text -> timestamp (an instant; text without
    offset is read as UTC). Text that no format fits raises."""
    t = blank_to_null_sql(c)
    tries = [_iso_instant_sql(t) if f == ISO else _pattern_instant_sql(t, f) for f in formats]
    return _or_raise(t, ", ".join(tries), "timestamp")


def strict_date_sql(c: str, formats: Sequence[str] = (ISO,)) -> str:
    """Blank -> NULL, otherwise text -> date; text that no format fits
    raises, partial dates as well."""
    t = blank_to_null_sql(c)
    tries = [
        f"CASE WHEN {t} RLIKE '{_DATE}' THEN try_cast({t} AS DATE) END" if f == ISO else instant_to_date_sql(_pattern_instant_sql(t, f))
        for f in formats
    ]
    return _or_raise(t, ", ".join(tries), "date")


def instant_to_date_sql(c: str) -> str:
    """Calendar date of an instant (TIMESTAMP) in UTC, whatever the session zone."""
    micros = f"unix_micros({c})"
    return f"date_from_unix_date(CAST(({micros} - pmod({micros}, 86400000000)) div 86400000000 AS INT))"


def ts_to_date_sql(c: str) -> str:
    """Calendar date of a timestamp without zone (TIMESTAMP_NTZ); of an
    instant in the session time zone (see :func:`instant_to_date_sql`)."""
    return f"to_date({c})"


def days_between_sql(start: str, end: str) -> str:
    """Whole days from ``start`` date to ``end`` date (end exclusive,
    negative when end is before start, NULL when either is NULL)."""
    return f"datediff({end}, {start})"


def yes_no_flag_sql(c: str) -> str:
    """``Y``/``y`` -> true, ``N``/``n`` -> false, anything else -> NULL.
    No trimming: ``' Y'`` is not a flag value."""
    return f"CASE upper({blank_to_null_sql(c)}) WHEN '{FLAG_TRUE}' THEN true WHEN '{FLAG_FALSE}' THEN false END"


def zero_if_null_sql(c: str) -> str:
    return f"coalesce({c}, 0)"


def sum_missing_as_zero_sql(*cols: str) -> str:
    """``coalesce(a, 0) + coalesce(b, 0) + ...`` — never NULL."""
    return " + ".join(f"({zero_if_null_sql(c)})" for c in cols)


# ------------------------------------------------------------------ Columns
def blank_to_null(c: str) -> Column:
    return F.expr(blank_to_null_sql(c))


def strict_long(c: str) -> Column:
    return F.expr(strict_long_sql(c))


def strict_decimal(c: str, allow_rounding: bool = False) -> Column:
    return F.expr(strict_decimal_sql(c, allow_rounding))


def strict_timestamp(c: str, formats: Sequence[str] = (ISO,)) -> Column:
    return F.expr(strict_timestamp_sql(c, formats))


def strict_date(c: str, formats: Sequence[str] = (ISO,)) -> Column:
    return F.expr(strict_date_sql(c, formats))


def instant_to_date(c: str) -> Column:
    return F.expr(instant_to_date_sql(c))


def ts_to_date(c: str) -> Column:
    return F.expr(ts_to_date_sql(c))


def days_between(start: str, end: str) -> Column:
    return F.expr(days_between_sql(start, end))


def yes_no_flag(c: str) -> Column:
    return F.expr(yes_no_flag_sql(c))


def zero_if_null(c: str) -> Column:
    return F.expr(zero_if_null_sql(c))


def sum_missing_as_zero(*cols: str) -> Column:
    return F.expr(sum_missing_as_zero_sql(*cols))
