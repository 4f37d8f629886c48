"""Money columns: integer cents in, ``decimal(14,2)`` out, one rounding at the end."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"   # contract type of a row amount
TOTAL = "decimal(20,2)"   # table-wide totals, which outgrow the row type at scale


def to_cents(amount: Column) -> Column:
    """Double amount with two decimals -> bigint cents (``round`` absorbs binary noise)."""
    return F.round(amount * F.lit(100)).cast("bigint")


def cents_to_money(cents: Column) -> Column:
    """Exact: bigint cents -> decimal(14,2)."""
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def to_units(value: Column, scale: int) -> Column:
    """Decimal of at most ``scale`` decimals -> bigint count of its smallest unit, exactly."""
    return (value * F.lit(10 ** scale)).cast("bigint")


def from_units(units: Column, scale: int) -> Column:
    """:func:`to_units` undone, for sums of any size."""
    return units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))


def money(value: Column) -> Column:
    """Round any decimal once, half-up, to the contract type."""
    return value.cast(MONEY)


def pct(value: Column, percent: str) -> Column:
    """``value * percent`` with an exact decimal literal (e.g. ``'0.25'``)."""
    return value * F.lit(Decimal(percent))


def idiv(a: Column, b: Column | int) -> Column:
    """Integer division truncating toward zero (SQL ``div``); exact on bigints."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))
