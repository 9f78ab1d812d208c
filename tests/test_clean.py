"""Column functions: blank handling, strict casts and their guards, flags, sums."""

import datetime as dt
import decimal

import pytest
from tablesmith.functions import clean as C


def one(spark, value, col):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(col.alias("out")).first()["out"]


def test_blank_to_null_only_empty_string(spark):
    df = spark.createDataFrame([("",), ("  ",), ("x",), (None,)], "v string")
    got = [r.out for r in df.select(C.blank_to_null("v").alias("out")).collect()]
    assert got == [None, "  ", "x", None]


@pytest.mark.parametrize("text,expected", [("", None), (" 12 ", 12), ("42", 42)])
def test_strict_long_valid(spark, text, expected):
    assert one(spark, text, C.strict_long("v")) == expected


@pytest.mark.parametrize("text", ["12.5", "  ", "0x1F", "1_000", "99999999999999999999"])
def test_strict_long_rejects(spark, text):
    with pytest.raises(Exception):
        one(spark, text, C.strict_long("v"))


def test_strict_decimal(spark):
    assert one(spark, "1.25", C.strict_decimal("v")) == decimal.Decimal("1.2500000000")
    assert one(spark, "", C.strict_decimal("v")) is None
    # trailing zeros past the scale lose nothing
    assert one(spark, "1.250000000000", C.strict_decimal("v")) == decimal.Decimal("1.25")


@pytest.mark.parametrize("text", ["abc", "NaN", "1.000000000001"])
def test_strict_decimal_rejects(spark, text):
    with pytest.raises(Exception):
        one(spark, text, C.strict_decimal("v"))


def test_strict_decimal_allow_rounding(spark):
    assert one(spark, "1.000000000001", C.strict_decimal("v", allow_rounding=True)) == decimal.Decimal("1")


def test_decimal_sum_type_is_38_10(spark):
    df = spark.createDataFrame([("1.5", "")], "a string, b string")
    out = df.select(C.sum_missing_as_zero(C.strict_decimal_sql("a"), C.strict_decimal_sql("b")).alias("s"))
    assert out.schema["s"].dataType.simpleString() == "decimal(38,10)"


def test_timestamp_with_offset_and_date_in_utc(spark):
    ts = one(spark, "2024-03-10T23:00:00-05:00", C.strict_timestamp("v"))
    assert ts == dt.datetime(2024, 3, 11, 4, 0)
    d = one(spark, "2024-03-10T23:00:00-05:00", C.ts_to_date(C.strict_timestamp_sql("v")))
    assert d == dt.date(2024, 3, 11)


@pytest.mark.parametrize("text", ["2024", "2024-03", "T12:30:00", "now", "infinity", "03/10/2024"])
def test_partial_or_odd_timestamps_rejected(spark, text):
    with pytest.raises(Exception):
        one(spark, text, C.strict_timestamp("v"))


@pytest.mark.parametrize("text", ["2024", "2024-03", "2024-13-01"])
def test_partial_dates_rejected(spark, text):
    with pytest.raises(Exception):
        one(spark, text, C.strict_date("v"))


def test_date_from_timestamp_text(spark):
    assert one(spark, "2024-03-10 08:00:00", C.strict_date("v")) == dt.date(2024, 3, 10)


def test_days_between(spark):
    df = spark.createDataFrame(
        [("2024-03-01", "2024-03-10"), ("2024-03-10", "2024-03-01"), ("2024-03-01", "")], "b string, e string"
    )
    begin = C.ts_to_date_sql(C.strict_timestamp_sql("b"))
    end = C.ts_to_date_sql(C.strict_timestamp_sql("e"))
    got = [r.d for r in df.select(C.days_between(begin, end).alias("d")).collect()]
    assert got == [9, -9, None]


def test_yes_no_flag(spark):
    values = ["Y", "y", "N", "n", "", None, " Y", "X"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.f for r in df.select(C.yes_no_flag("v").alias("f")).collect()]
    assert got == [True, True, False, False, None, None, None, None]


def test_all_in_amount_never_null(spark):
    df = spark.createDataFrame([("", ""), ("1.25", ""), ("1.25", "0.10")], "a string, b string")
    s = C.sum_missing_as_zero(C.strict_decimal_sql("a"), C.strict_decimal_sql("b"))
    got = [r.s for r in df.select(s.alias("s")).collect()]
    assert got == [decimal.Decimal(0), decimal.Decimal("1.25"), decimal.Decimal("1.35")]


def test_functions_stay_jvm_side(spark):
    df = spark.createDataFrame([("1",)], "v string").select(C.strict_decimal("v"), C.yes_no_flag("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


# ------------------------------------------------- by value, not by spelling
def _one(spark, text, column):
    return spark.createDataFrame([(text,)], "c string").select(column).first()[0]


@pytest.mark.parametrize("text", ["1e-11", "1.5e-10", "0.00000000001", "123456e-12", "1.00000000001"])
def test_decimal_that_needs_more_digits_raises(spark, text):
    with pytest.raises(Exception, match="would be rounded"):
        _one(spark, text, C.strict_decimal("c"))


@pytest.mark.parametrize(
    "text,value",
    [("1.00000000001e5", "100000.0000010000"), ("1e-10", "0.0000000001"), ("1.50000000000000", "1.5"), ("100e-12", "0.0000000001"), ("-2.5E3", "-2500"), (".5", "0.5"), ("0e-20", "0")],
)
def test_decimal_that_fits_is_exact(spark, text, value):
    from decimal import Decimal

    assert _one(spark, text, C.strict_decimal("c")) == Decimal(value)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_invalid_text_raises_in_any_session(spark, ansi):
    saved = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for column, text in ((C.strict_long("c"), "12.5"), (C.strict_decimal("c"), "x"), (C.strict_timestamp("c"), "2024-13-01"), (C.strict_date("c"), "2024-02-30")):
            with pytest.raises(Exception, match="not a"):
                _one(spark, text, column)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", saved)


def test_declared_formats_are_tried_in_order(spark):
    formats = ["MM/dd/yyyy HH:mm", "yyyyMMdd HH:mm XXX", C.ISO]

    def micros(text):
        return spark.createDataFrame([(text,)], "c string").selectExpr(f"unix_micros({C.strict_timestamp_sql('c', formats)})").first()[0]

    base = micros("2024-01-31 09:00:00")
    assert micros("01/31/2024 09:00") == base and micros("20240131 11:00 +02:00") == base
    with pytest.raises(Exception, match="not a timestamp"):
        micros("31.01.2024")
    day = _one(spark, "20240131", C.strict_date("c", ["yyyyMMdd"]))
    assert str(day) == "2024-01-31" and _one(spark, "", C.strict_date("c", ["yyyyMMdd"])) is None
    with pytest.raises(Exception, match="not a date"):
        _one(spark, "2024-01-31", C.strict_date("c", ["yyyyMMdd"]))
