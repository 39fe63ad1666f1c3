"""Column functions of the measurement model.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so the
expressions stay inside whole-stage codegen; there are no Python UDFs.

Balance-sheet sign convention: CSM <= 0, LC <= 0, cashflow cumulative > 0 is
profit.  The transition between profitable and onerous is *memoryless*: given
the cumulative before (``b``) and after (``a``) a movement,

    csm movement = max(b, 0) - max(a, 0)
    lc movement  = min(a, 0) - min(b, 0)

which reproduces the four-way transition table (P->P, P->O, O->O, O->P, with a
zero cumulative classed BREAK_EVEN and treated like PROFITABLE as a previous
state).  Balances follow as ``csm = -max(cum, 0)`` and ``lc = min(cum, 0)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from gocledger import schema as S


def _zero() -> Column:
    return F.lit(0)


def money(c: Column) -> Column:
    """Cast to the published money type DECIMAL(18,2) (half-up rounding)."""
    return c.cast(S.MONEY)


def precise(c: Column) -> Column:
    return c.cast(S.PRECISE)


def aoc_order(step: Column) -> Column:
    """Analysis-of-change step -> order within a period (1..5)."""
    expr = None
    for name, order in S.AOC_ORDER.items():
        expr = (F.when(step == name, F.lit(order)) if expr is None
                else expr.when(step == name, F.lit(order)))
    return expr


def state_of(cum: Column) -> Column:
    """Sign of a cashflow cumulative -> profitability state."""
    return (F.when(cum > 0, F.lit(S.PROFITABLE))
            .when(cum < 0, F.lit(S.ONEROUS))
            .when(cum == 0, F.lit(S.BREAK_EVEN)))


def csm_balance(cum: Column) -> Column:
    """CSM balance of a cumulative: ``-max(cum, 0)``."""
    return F.when(cum > 0, -cum).otherwise(_zero())


def lc_balance(cum: Column) -> Column:
    """LC balance of a cumulative: ``min(cum, 0)``."""
    return F.when(cum < 0, cum).otherwise(_zero())


def csm_movement(before: Column, after: Column) -> Column:
    """CSM movement of the transition ``before -> after``."""
    return csm_balance(after) - csm_balance(before)


def lc_movement(before: Column, after: Column) -> Column:
    """LC movement of the transition ``before -> after``."""
    return lc_balance(after) - lc_balance(before)


def pro_rata(total: Column, part: Column, base: Column) -> Column:
    """``total * part / base`` at 6 decimals, 0 when ``base`` is 0.

    Multiplying first keeps the quotient exact before the 6-dp rounding, so the
    result does not depend on the size of the balances.  The zero guard uses
    NULLIF so no evaluation order can divide by zero under ANSI mode.
    """
    share = (total * part) / F.nullif(base, F.lit(0))
    return F.when(base != 0, precise(share)).otherwise(precise(_zero()))


def release_ratio(quarter: Column, ratios: Mapping[int, Decimal]) -> Column:
    """quarter -> coverage-unit ratio (NULL outside the release quarters)."""
    expr = None
    for q, r in sorted(ratios.items()):
        lit = F.lit(Decimal(r))  # exact decimal literal, e.g. 0.55 -> DECIMAL(2,2)
        expr = F.when(quarter == q, lit) if expr is None else expr.when(quarter == q, lit)
    return expr


def quarter_end(d: Column) -> Column:
    """Last day of the calendar quarter containing ``d``."""
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def period_index(d: Column) -> Column:
    """Absolute quarter number ``year*4 + quarter``: adjacent quarters differ by 1
    across year ends too (the quarter number alone would wrap)."""
    return F.year(d) * 4 + F.quarter(d)
