"""Money: whole cents inside, half-up rounding at the edges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(amount: Column) -> Column:
    """Two places, ties upwards on the binary value: 1.005 gives 1.0, 2.675 gives 2.68."""
    return F.floor(amount * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def cents(amount: Column) -> Column:
    """Amount as whole cents."""
    return F.floor(amount * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def from_cents(value: Column) -> Column:
    return value / F.lit(100.0)


def line_amount(price: Column, quantity: Column) -> Column:
    return price * quantity


def integer_div(left: Column, right: Column) -> Column:
    return F.call_function("div", left, right)


def share_cents(payment: Column, amount: Column, total: Column) -> Column:
    """payment * amount / total in cents, half up. Null for a positive amount of a zero total.

    The product is a number of 38 digits: it holds any two amounts below 10^18 cents.
    """
    wide = lambda value: value.cast("decimal(19,0)")
    doubled = (wide(payment) * wide(amount)).cast("decimal(37,0)") * F.lit(2).cast("decimal(1,0)") + wide(total)
    share = integer_div(doubled, F.lit(2).cast("decimal(1,0)") * wide(F.nullif(total, F.lit(0))))
    return F.coalesce(share, F.when((total == 0) & (amount == 0), F.lit(0)).cast("bigint"))
