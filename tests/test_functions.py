import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import calendar, numbers, status


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} string" for k in inputs) or "x string"
    row = spark.createDataFrame([tuple(inputs.values()) or (None,)], schema).select(column.alias("v")).first()
    return row["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("$ 8,25", D("825.00")),
        ("$1,234.56", D("1234.56")),
        (" 12 ", D("12.00")),
        ("-$3.5", D("-3.50")),
        ("0.125", D("0.13")),
        ("1_000", D("1000.00")),
        ("", None),
        ("$", None),
        ("1.2.3", None),
        ("abc", None),
        ("9999999999999.99", None),
        (None, None),
    ],
)
def test_summary_amount(spark, text, expected):
    assert value(spark, numbers.summary_amount(F.col("a")), a=text) == expected


def test_summary_amount_with_decimal_comma(spark):
    assert value(spark, numbers.summary_amount(F.col("a"), True), a="$ 8,25") == D("8.25")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("3,00", D("3.000000")),
        ("209.00", D("209.000000")),
        ("1,234.56", None),
        ("1e2", D("100.000000")),
        ("5,", D("5.000000")),
        (",5", D("0.500000")),
        ("n/a", None),
    ],
)
def test_item_number(spark, text, expected):
    assert value(spark, numbers.item_number(F.col("a")), a=text) == expected


def test_number_form_is_told_from_range(spark):
    long = "9" * 30
    assert value(spark, numbers.is_number(F.col("a")), a=long) is True
    assert value(spark, numbers.to_decimal(F.col("a")), a=long) is None
    assert value(spark, numbers.is_number(F.col("a")), a="x") is False
    assert value(spark, numbers.is_number(F.col("a")), a=None) is False


def test_vat_default_only_for_absent_key(spark):
    rate = numbers.vat_rate(F.col("a"), F.lit(False))
    assert value(spark, rate, a=None) == D("10.0000")
    assert value(spark, numbers.vat_rate(F.col("a"), F.lit(True)), a=None) is None
    assert value(spark, numbers.vat_rate(F.col("a"), F.lit(True)), a=" 8 %") == D("8.0000")


def test_gross_uses_unrounded_net(spark):
    qty, price = F.lit("0.335").cast("decimal(18,6)"), F.lit("1.01").cast("decimal(18,6)")
    net = numbers.net_worth(qty, price)  # 0.33835
    gross = numbers.gross_worth(net, F.lit("50").cast("decimal(9,4)"))  # 0.507525; from 0.34 it would be 0.51
    assert value(spark, numbers.store_money(net, 12)) == D("0.34")
    assert value(spark, gross.cast("decimal(12,4)")) == D("0.5075")


def test_net_beyond_range_is_null(spark):
    big = F.lit("99999999999").cast("decimal(18,6)")
    assert value(spark, numbers.net_worth(big, big)) is None


@pytest.mark.parametrize("text, even, up", [("0.125", "0.12", "0.13"), ("-0.125", "-0.12", "-0.13"), ("0.135", "0.14", "0.14")])
def test_rounding(spark, text, even, up):
    number = F.col("a").cast("decimal(10,3)")
    assert value(spark, numbers.round_half_even(number), a=text) == D(even)
    assert value(spark, numbers.store_money(number, 5), a=text) == D(up)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1/5/2021", datetime.date(2021, 1, 5)),
        ("01/05/2021", datetime.date(2021, 1, 5)),
        ("13/01/2021", None),
        ("2/30/2021", None),
        ("2021-01-05", None),
        ("1/5/21", None),
        ("1/5/2021 ", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, expected):
    assert value(spark, calendar.parse_us_date(F.col("a")), a=text) == expected


def test_calendar_row(spark):
    row = spark.range(1).select(*calendar.calendar_columns(F.lit("2021-01-03").cast("date"))).first()
    assert tuple(row) == (20210103, datetime.date(2021, 1, 3), 2021, 1, 1, "Jan", 3, 1, "Sun", 53)


def test_payment_due_and_reference(spark):
    due = calendar.payment_due(F.lit("2021-12-31").cast("date"), 1)
    assert value(spark, due) == datetime.date(2022, 1, 1)
    assert value(spark, status.payment_reference(F.lit("15686725"), F.lit(889))) == "TXN-15686725-889"


@pytest.mark.parametrize("paid, expected", [(None, "UNPAID"), ("1", "PARTIALLY_PAID"), ("2", "PAID"), ("3", "PAID")])
def test_status(spark, paid, expected):
    assert value(spark, status.payment_status(F.col("a").cast("int"), F.lit(2)), a=paid) == expected


def test_stamp_does_not_move_with_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        moment = datetime.datetime(2024, 1, 1, 12)
        assert value(spark, calendar.stamp(moment)) == moment
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
