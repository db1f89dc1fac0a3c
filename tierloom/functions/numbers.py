"""Column functions for numbers: tolerant parsing, repairs and derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in text. Spark's own cast would also take '12d' or 'NaN', and
# it finds out that text is no number by an exception, which costs far more than the pattern does.
NUMBER_PATTERN = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
INTEGER_PATTERN = r"^ *[+-]?[0-9]+ *$"


def safe_int(c: Column) -> Column:
    """Whole number from text, NULL where the text is none or does not fit 32 bits."""
    return F.when(c.rlike(INTEGER_PATTERN), c.try_cast("int"))


def safe_long(c: Column) -> Column:
    """Whole number from text, such as an id, NULL where the text is none or does not fit 64 bits."""
    return F.when(c.rlike(INTEGER_PATTERN), c.try_cast("bigint"))


def safe_double(c: Column) -> Column:
    """Number from text, NULL where the text is not a plain decimal number."""
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def absolute_amount(c: Column) -> Column:
    """Amount text as a non-negative number; missing and unreadable amounts are 0."""
    return F.coalesce(F.abs(safe_double(c)), F.lit(0.0))


def floor_at(c: Column, least: int) -> Column:
    """``c``, but never under ``least``; NULL stays NULL (``greatest`` would turn it into ``least``)."""
    return F.when(c < least, F.lit(least)).otherwise(c)


def round_long(c: Column) -> Column:
    """Number text rounded to the nearest whole number of 64 bits, halves away from zero; whole numbers are taken as they are."""
    return F.coalesce(safe_long(c), F.round(safe_double(c), 0).try_cast("bigint"))


def misfit(c: Column, value: Column, pattern: str = INTEGER_PATTERN) -> Column:
    """The text of a number that ``pattern`` can read but ``value``, made of ``c``, could not hold."""
    return F.when(value.isNull() & c.rlike(pattern), c)


def parse_money(c: Column) -> Column:
    """Money text as a number: one leading ``$`` is dropped; blanks and placeholders give NULL.

    The ``$`` must be the first character of the untrimmed text. Placeholders such as ``N/A`` need no
    list of their own, as nothing but a number passes :func:`safe_double`.
    """
    text = F.trim(c)
    return safe_double(F.when(c.startswith("$"), text.substr(F.lit(2), F.length(text))).otherwise(text))


def null_if_sentinel(c: Column, sentinel: int) -> Column:
    """Whole number from text, NULL for the placeholder value ``sentinel``."""
    return F.nullif(safe_long(c), F.lit(sentinel))


def repair_amount(amount: Column, quantity: Column, price: Column) -> Column:
    """Line amount; where missing, not positive or off from quantity x price, that product instead.

    Products are taken in 64 bits. A missing price counts as 1 in the replacement and cannot
    contradict an amount that is there.
    """
    count = quantity.cast("bigint")
    wrong = amount.isNull() | (amount <= 0) | (amount != count * F.abs(price))
    return F.when(wrong, count * F.abs(F.coalesce(price, F.lit(1)))).otherwise(
        amount.cast("bigint")
    )


def whole_quotient(a: Column, b: Column) -> Column:
    """``a / b`` of whole numbers cut towards zero, NULL where ``b`` is 0 or either is NULL."""
    return F.call_function("div", a.cast("bigint"), F.nullif(b.cast("bigint"), F.lit(0)))


def repair_price(amount: Column, quantity: Column, price: Column) -> Column:
    """Unit price; where missing or not positive, the **unrepaired** amount over the quantity."""
    return F.when(price > 0, price.cast("bigint")).otherwise(whole_quotient(amount, quantity))


def derived_total(quantity: Column, unit_cost: Column) -> Column:
    """Quantity x unit cost in double, NULL if either is NULL."""
    return quantity.cast("double") * unit_cost


def stock_gap(stock: Column, reorder_level: Column) -> Column:
    """How far the stock is over (positive) or under (negative) the reorder level."""
    return stock - reorder_level


def stock_value(stock: Column, unit_cost: Column) -> Column:
    """Stock x unit cost in 64 bits; an unknown cost counts as 0."""
    return stock.cast("bigint") * F.coalesce(unit_cost, F.lit(0))
