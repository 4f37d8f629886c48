"""Fixed run parameters. No query reads the wall clock; every date is one of these."""

from __future__ import annotations

import datetime as _dt

# Fixed values of the settlement rules and runs (see README "Parameters").
RUN_DATE = _dt.date(2024, 11, 10)            # ledger run: settles 2024-10
RUN_TS = _dt.datetime(2024, 11, 10, 8, 30, 0)
DEFAULT_WATERMARK = _dt.datetime(2022, 1, 1)
EVENTS_WATERMARK = _dt.datetime(2024, 1, 21)
SETTLEMENT_WATERMARK = _dt.datetime(2026, 1, 1)
SETTLEMENT_DATE = _dt.date(2029, 12, 10)
OPEN_END = _dt.datetime(2099, 12, 31)        # active_to of a current version
BATCH_CUT_1 = _dt.datetime(2024, 1, 11)      # events T1 | T2
BATCH_CUT_2 = _dt.datetime(2024, 1, 21)      # events T2 | T3
YEAR_SHIFT = 28                              # driver dates 1995..2001 -> 2023..2029
