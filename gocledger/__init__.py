"""gocledger — IFRS 17 reinsurance ledger measurement on Spark DataFrames.

From signed quarterly cashflows per contract (treaty) and a few entity tables the
library builds, with DataFrame operations only:

* a balance-sheet ledger per group of contracts (GoC) and per treaty
  (OPENING, INIT_RECOG, VARIANCE, CSM_RELEASE, CLOSING),
* the profitability transitions between unearned profit (CSM) and loss
  component (LC),
* CSM release by coverage-unit ratio, loss recovery through retro treaties,
* quarterly / annual / P&L marts, invariant validators and generic data tests.

Entry points: :class:`gocledger.plans.pipeline.Ledger` (the whole model DAG),
``gocledger.sources.binding`` (driver tables -> raw inputs) and
``gocledger.sources.fixture`` (hand-worked golden scenario).
"""

__version__ = "0.1.0"
