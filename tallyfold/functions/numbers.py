"""Number text of invoices, and the money arithmetic built on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a decimal number, and the rate of an item that names none.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
DEFAULT_VAT = "10%"

# Wider than the declared columns, so that the products of quantity, price and rate are exact to the last digit: the
# three scales add up to what a decimal of 38 digits holds beside ten digits before the point. Text with digits beyond
# these scales is `too_fine`: an item is refused rather than worked out with less than it says.
QUANTITY = "decimal(16,8)"
PRICE = "decimal(18,8)"
RATE = "decimal(9,6)"


def _digits(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def to_decimal(text: Column, type_name: str = PRICE) -> Column:
    """Decimal value of number text; NULL when it is no number or does not fit."""
    return F.trim(_digits(text)).try_cast(type_name)


def is_number(text: Column, value: Column | None = None) -> Column:
    """True for decimal text, false for any other and for NULL.

    `value` is the text's `to_decimal`, if it is at hand: only text without a
    value needs the slower look at its form, to tell a number out of range.
    """
    form = F.coalesce(_digits(text).rlike(NUMBER_PATTERN), F.lit(False))
    return form if value is None else F.when(value.isNotNull(), F.lit(True)).otherwise(form)


def too_fine(text: Column, value: Column, type_name: str = PRICE) -> Column:
    """True where number text has digits that its `to_decimal` value, of this type, lacks."""
    scale = int(type_name.rstrip(")").split(",")[1])
    digits = F.trim(_digits(text))
    # Text that is no longer than the scale, as nearly all is, cannot have too many digits behind the point. An exponent
    # may move digits to either side, so such text is compared by value.
    behind = (F.length(text) > scale) & digits.rlike(rf"^[^eE]*\.[0-9]{{{scale}}}[0-9]*[1-9][0-9]*$")
    moved = (text.contains("e") | text.contains("E")) & (digits.try_cast("double") != value.cast("double"))
    return F.coalesce(behind, F.lit(False)) | F.coalesce(moved, F.lit(False))


def summary_text(text: Column, decimal_comma: bool = False) -> Column:
    """Text of a summary amount without `$`; commas are thousands marks.

    `decimal_comma=True` reads the comma as the decimal point instead.
    """
    bare = F.replace(text, F.lit("$"), F.lit(""))
    return F.trim(F.replace(bare, F.lit(","), F.lit("." if decimal_comma else "")))


def summary_amount(text: Column, decimal_comma: bool = False) -> Column:
    return to_decimal(summary_text(text, decimal_comma), "decimal(14,2)")


def item_text(text: Column) -> Column:
    """Text of an item number; here the comma is the decimal point."""
    return F.replace(text, F.lit(","), F.lit("."))


def item_number(text: Column, type_name: str = PRICE) -> Column:
    return to_decimal(item_text(text), type_name)


def vat_text(text: Column, present: Column | None = None) -> Column:
    """Text of a VAT rate without `%`; the default applies only to an absent key."""
    if present is not None:
        text = F.when(present, text).otherwise(F.lit(DEFAULT_VAT))
    return F.trim(F.replace(text, F.lit("%"), F.lit("")))


def vat_rate(text: Column, present: Column | None = None, type_name: str = RATE) -> Column:
    return to_decimal(vat_text(text, present), type_name)


def net_worth(qty: Column, price: Column) -> Column:
    """Exact product; NULL when it is beyond any declared money column."""
    return F.try_multiply(qty, price).try_cast("decimal(26,16)")


def gross_worth(net: Column, vat: Column) -> Column:
    """Net plus VAT, from the unrounded net."""
    return net + net * (vat * F.lit("0.01").cast("decimal(2,2)")).try_cast("decimal(11,8)")


def round_half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value, digits)


def store_money(value: Column, precision: int) -> Column:
    """Round half up to the declared column; NULL when it does not fit."""
    return value.try_cast(f"decimal({precision},2)")
