"""Column functions (JVM-side expressions only); ``*_sql`` give SQL text."""

from tablesmith.functions.clean import (  # noqa: F401
    blank_to_null,
    blank_to_null_sql,
    days_between,
    days_between_sql,
    decimal_type,
    instant_to_date,
    instant_to_date_sql,
    strict_date,
    strict_date_sql,
    strict_decimal,
    strict_decimal_sql,
    strict_long,
    strict_long_sql,
    strict_timestamp,
    strict_timestamp_sql,
    sum_missing_as_zero,
    sum_missing_as_zero_sql,
    ts_to_date,
    ts_to_date_sql,
    yes_no_flag,
    yes_no_flag_sql,
    zero_if_null,
    zero_if_null_sql,
)
