"""Column -> Column building blocks (all JVM-side, codegen friendly)."""

from gocledger.functions.columns import (  # noqa: F401
    aoc_order,
    csm_balance,
    csm_movement,
    lc_balance,
    lc_movement,
    money,
    period_index,
    precise,
    pro_rata,
    quarter_end,
    release_ratio,
    state_of,
)
