"""The hand-worked golden scenario (four assumed GoCs, one retro GoC).

Used by the tests: the expected ledger values for it are worked out by hand in
FIXTURES.md.  The rows are built with an explicit schema (no pandas inference).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from gocledger import schema as S

# ---------------------------------------------------------------------------
# Golden scenario data
# ---------------------------------------------------------------------------
GOCS = [
    ("GOC_A", "ASSUMED", "PROFITABLE", "stays profitable all year"),
    ("GOC_B", "ASSUMED", "PROFITABLE", "one large loss in the second quarter"),
    ("GOC_C", "ASSUMED", "ONEROUS", "onerous from the start, falling"),
    ("GOC_D", "ASSUMED", "ONEROUS", "onerous from the start, recovering in the third quarter"),
    ("GOC_R1", "RETRO", "PROFITABLE", "outward cover of the assumed treaties"),
]

TREATIES = [
    ("TRT_A1", "ASSUMED", "GOC_A"),
    ("TRT_A2", "ASSUMED", "GOC_A"),
    ("TRT_B1", "ASSUMED", "GOC_B"),
    ("TRT_B2", "ASSUMED", "GOC_B"),
    ("TRT_C1", "ASSUMED", "GOC_C"),
    ("TRT_D1", "ASSUMED", "GOC_D"),
    ("TRT_D2", "ASSUMED", "GOC_D"),
    ("TRT_R1", "RETRO", "GOC_R1"),
    ("TRT_R2", "RETRO", "GOC_R1"),
]
INCEPTION = dt.date(2026, 1, 1)

RETRO_LINKS = [
    ("TRT_A1", "TRT_R1", "0.30"),
    ("TRT_A2", "TRT_R1", "0.30"),
    ("TRT_B1", "TRT_R1", "0.30"),
    ("TRT_B2", "TRT_R1", "0.25"),
    ("TRT_C1", "TRT_R2", "0.45"),
    ("TRT_D1", "TRT_R2", "0.45"),
    ("TRT_D2", "TRT_R2", "0.45"),
]

# (treaty, reporting date, step, amount)
CASHFLOWS = [
    ("TRT_A1", "2026-03-31", "INIT_RECOG", "60000.00"),
    ("TRT_A1", "2026-03-31", "VARIANCE", "-8000.00"),
    ("TRT_A1", "2026-06-30", "VARIANCE", "-5000.00"),
    ("TRT_A1", "2026-09-30", "VARIANCE", "-7000.00"),
    ("TRT_A1", "2026-12-31", "VARIANCE", "-6000.00"),
    ("TRT_A2", "2026-03-31", "INIT_RECOG", "40000.00"),
    ("TRT_A2", "2026-03-31", "VARIANCE", "-4000.00"),
    ("TRT_A2", "2026-06-30", "VARIANCE", "-3000.00"),
    ("TRT_A2", "2026-09-30", "VARIANCE", "-5000.00"),
    ("TRT_A2", "2026-12-31", "VARIANCE", "-3000.00"),
    ("TRT_B1", "2026-03-31", "INIT_RECOG", "35000.00"),
    ("TRT_B1", "2026-03-31", "VARIANCE", "-3000.00"),
    ("TRT_B1", "2026-06-30", "VARIANCE", "-55000.00"),
    ("TRT_B1", "2026-09-30", "VARIANCE", "-4000.00"),
    ("TRT_B1", "2026-12-31", "VARIANCE", "-3000.00"),
    ("TRT_B2", "2026-03-31", "INIT_RECOG", "25000.00"),
    ("TRT_B2", "2026-03-31", "VARIANCE", "-2000.00"),
    ("TRT_B2", "2026-06-30", "VARIANCE", "-40000.00"),
    ("TRT_B2", "2026-09-30", "VARIANCE", "-3000.00"),
    ("TRT_B2", "2026-12-31", "VARIANCE", "-2000.00"),
    ("TRT_C1", "2026-03-31", "INIT_RECOG", "-20000.00"),
    ("TRT_C1", "2026-03-31", "VARIANCE", "-8000.00"),
    ("TRT_C1", "2026-06-30", "VARIANCE", "-12000.00"),
    ("TRT_C1", "2026-09-30", "VARIANCE", "-5000.00"),
    ("TRT_C1", "2026-12-31", "VARIANCE", "-10000.00"),
    ("TRT_D1", "2026-03-31", "INIT_RECOG", "-8000.00"),
    ("TRT_D1", "2026-03-31", "VARIANCE", "-2000.00"),
    ("TRT_D1", "2026-06-30", "VARIANCE", "-1000.00"),
    ("TRT_D1", "2026-09-30", "VARIANCE", "18000.00"),
    ("TRT_D1", "2026-12-31", "VARIANCE", "2000.00"),
    ("TRT_D2", "2026-03-31", "INIT_RECOG", "-7000.00"),
    ("TRT_D2", "2026-03-31", "VARIANCE", "-1000.00"),
    ("TRT_D2", "2026-06-30", "VARIANCE", "-2000.00"),
    ("TRT_D2", "2026-09-30", "VARIANCE", "15000.00"),
    ("TRT_D2", "2026-12-31", "VARIANCE", "3000.00"),
]

# Final-period state expected per GoC by the scenario design.
EXPECTED_FINAL_STATE = [
    ("GOC_A", "PROFITABLE"),
    ("GOC_B", "ONEROUS"),
    ("GOC_C", "ONEROUS"),
    ("GOC_D", "PROFITABLE"),
]


def cashflow_rows() -> list[tuple]:
    return [(t, dt.date.fromisoformat(d), step, Decimal(amount)) for t, d, step, amount in CASHFLOWS]


def golden_raw(spark: SparkSession) -> dict[str, DataFrame]:
    """The five raw inputs of the golden scenario."""
    return {
        "goc_master": spark.createDataFrame(GOCS, S.GOC_MASTER),
        "treaty_master": spark.createDataFrame(
            [(t, ty, g, INCEPTION) for t, ty, g in TREATIES], S.TREATY_MASTER),
        "retro_link": spark.createDataFrame(
            [(a, r, Decimal(rate), INCEPTION) for a, r, rate in RETRO_LINKS], S.RETRO_LINK),
        "cashflow_input": spark.createDataFrame(cashflow_rows(), S.CASHFLOW_INPUT),
        "assumption_version": spark.createDataFrame(
            [("V1", "Golden scenario", dt.date(2026, 4, 20))], S.ASSUMPTION_VERSION),
    }


def golden_expectations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXPECTED_FINAL_STATE, "goc_id string, expected_final_state string")
