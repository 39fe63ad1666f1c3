"""Run parameters of the measurement."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal


def _default_ratios() -> dict[int, Decimal]:
    # Coverage-unit release ratio per release quarter
    # (first half-year 0.55, second half-year 0.45; release in quarters 2 and 4).
    return {2: Decimal("0.55"), 4: Decimal("0.45")}


@dataclass(frozen=True)
class LedgerParams:
    """Knobs of the ledger.

    release_ratios
        quarter -> coverage-unit ratio.  The key set is the set of release
        quarters, so adding a quarter can never produce a NULL release.
    tolerance
        absolute tolerance used by the validators (fixed value 0.01).
    broadcast_max_bytes
        upper bound on the size (measured rows x row width) of a GoC-level table
        that may be broadcast to treaty rows; above it the join is salted and
        shuffled instead.
    salt_buckets
        number of salt buckets for the shuffled fallback join.
    carry_release
        CSM releases reach the next OPENING (net balances); by default every OPENING
        is the gross cumulative, whatever has been released.
    to_the_cent
        hand out a GoC step's CSM and LC in whole cents by largest remainders, so that the
        treaties' movements add up to the GoC's exactly.
    treaty_buckets
        write the treaty-scale tables (treaty master, cashflows, treaty movements) in
        this many buckets of the treaty id, so that the movement join and the ledger's
        windows need no exchange; None: plain tables.
    """

    release_ratios: dict[int, Decimal] = field(default_factory=_default_ratios)
    tolerance: Decimal = Decimal("0.01")
    broadcast_max_bytes: int = 32 << 20
    salt_buckets: int = 64
    carry_release: bool = False
    to_the_cent: bool = False
    treaty_buckets: int | None = None
