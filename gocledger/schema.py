"""Fixed vocabulary and table schemas of the ledger.

The values in this module are part of the semantics (they must equal the
values the measured data uses), so they are stated plainly here, in one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Analysis-of-change steps and their order within a period
# ---------------------------------------------------------------------------
OPENING = "OPENING"
INIT_RECOG = "INIT_RECOG"
VARIANCE = "VARIANCE"
CSM_RELEASE = "CSM_RELEASE"
CLOSING = "CLOSING"

AOC_ORDER = {OPENING: 1, INIT_RECOG: 2, VARIANCE: 3, CSM_RELEASE: 4, CLOSING: 5}

# Steps delivered in raw cashflows; the other three are computed.
INPUT_STEPS = (INIT_RECOG, VARIANCE)

# ---------------------------------------------------------------------------
# Profitability states and contract types
# ---------------------------------------------------------------------------
PROFITABLE = "PROFITABLE"
ONEROUS = "ONEROUS"
BREAK_EVEN = "BREAK_EVEN"
STATES = (PROFITABLE, ONEROUS, BREAK_EVEN)

ASSUMED = "ASSUMED"
RETRO = "RETRO"
CONTRACT_TYPES = (ASSUMED, RETRO)

# ---------------------------------------------------------------------------
# Money types
# ---------------------------------------------------------------------------
MONEY = T.DecimalType(18, 2)        # every published amount
RATE = T.DecimalType(5, 2)          # retro cession rate
PRECISE = T.DecimalType(38, 6)      # internal pro-rata amounts before the last cast

# ---------------------------------------------------------------------------
# Raw input tables (after staging casts)
# ---------------------------------------------------------------------------
GOC_MASTER = T.StructType([
    T.StructField("goc_id", T.StringType()),
    T.StructField("goc_type", T.StringType()),
    T.StructField("expected_initial_state", T.StringType()),
    T.StructField("scenario_description", T.StringType()),
])

TREATY_MASTER = T.StructType([
    T.StructField("treaty_id", T.StringType()),
    T.StructField("treaty_type", T.StringType()),
    T.StructField("goc_id", T.StringType()),
    T.StructField("inception_date", T.DateType()),
])

RETRO_LINK = T.StructType([
    T.StructField("assumed_treaty_id", T.StringType()),
    T.StructField("retro_treaty_id", T.StringType()),
    T.StructField("retro_cession_rate", RATE),
    T.StructField("effective_date", T.DateType()),
])

CASHFLOW_INPUT = T.StructType([
    T.StructField("treaty_id", T.StringType()),
    T.StructField("reporting_date", T.DateType()),
    T.StructField("aoc_step", T.StringType()),
    T.StructField("amount", MONEY),
])

ASSUMPTION_VERSION = T.StructType([
    T.StructField("version_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("as_of_date", T.DateType()),
])

RAW_TABLES = ("goc_master", "treaty_master", "retro_link", "cashflow_input", "assumption_version")

RAW_SCHEMAS = {
    "goc_master": GOC_MASTER,
    "treaty_master": TREATY_MASTER,
    "retro_link": RETRO_LINK,
    "cashflow_input": CASHFLOW_INPUT,
    "assumption_version": ASSUMPTION_VERSION,
}
