"""Courier pay rules.

Fixed values (the settlement rules): a courier whose average rating r in the
settlement month is
    r < 4        gets 5 % of each order, at least 100;
    4 <= r < 4.5 gets 7 % of each order, at least 150;
    4.5 <= r < 4.9 gets 8 % of each order, at least 175;
    4.9 <= r     gets 10 % of each order, at least 200.
The processing fee is 25 % of the order total and 5 % of the tips is kept as a
payment commission.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import idiv


@dataclass(frozen=True)
class Tier:
    below_tenths: int | None   # rating bound, in tenths (40 = 4.0); None: no upper bound
    percent: int
    minimum: int

    @property
    def rate(self) -> Decimal:
        return Decimal(self.percent) / 100


# Rating bound (tenths), percent of the order, minimum pay.
TIERS = (
    Tier(40, 5, 100),
    Tier(45, 7, 150),
    Tier(49, 8, 175),
    Tier(None, 10, 200),
)
FEE = Decimal("0.25")
TIPS_KEPT = Decimal("0.95")


def tier_pay(order_sum: Column, tier: Tier) -> Column:
    """``max(order_sum * percent, minimum)`` at scale 4 (no rounding until summed)."""
    return F.greatest(order_sum * F.lit(tier.rate), F.lit(tier.minimum).cast("decimal(14,2)"))


def tier_index(sum_rate: Column, n: Column) -> Column:
    """0-based tier of the average ``sum_rate / n``, compared exactly in integers."""
    out = F.lit(len(TIERS) - 1)
    for i in reversed(range(len(TIERS) - 1)):
        out = F.when(sum_rate * 10 < n * TIERS[i].below_tenths, F.lit(i)).otherwise(out)
    return out


def pick(index: Column, values: list[Column]) -> Column:
    out = values[-1]
    for i in reversed(range(len(values) - 1)):
        out = F.when(index == i, values[i]).otherwise(out)
    return out


def tier_percent(index: Column) -> Column:
    return pick(index, [F.lit(t.percent) for t in TIERS]).cast("int")


def rate_avg(sum_rate: Column, n: Column) -> Column:
    """Average rating rounded half-up to hundredths, exactly, as decimal(4,2)."""
    hundredths = idiv(sum_rate * 200 + n, n * 2)
    return (hundredths.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(4,2)")


def coded_delivery_pay(rate: Column, order_sum: Column) -> Column:
    """Per-delivery pay as the original job computes it.

    The tier comes from the delivery's own rating; each tier is tested with
    strict ``>`` and ``<`` against its minimum, so a payment equal to the minimum
    falls through to the next tier; whatever is left (including a NULL rating)
    pays the last minimum.
    """
    last = TIERS[-1]
    out = F.lit(last.minimum).cast("decimal(17,4)")
    v_last = order_sum * F.lit(last.rate)
    chain = [(rate >= F.lit(Decimal(TIERS[-2].below_tenths) / 10)) & (v_last > last.minimum), v_last]
    clauses = []
    for t in TIERS[:-1]:
        v = order_sum * F.lit(t.rate)
        bound = rate < F.lit(Decimal(t.below_tenths) / 10)
        clauses.append((bound & (v > t.minimum), v))
        clauses.append((bound & (v < t.minimum), F.lit(t.minimum)))
    clauses.append(tuple(chain))
    expr = None
    for cond, val in clauses:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(out).cast("decimal(17,4)")
