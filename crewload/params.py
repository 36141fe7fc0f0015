"""Run parameters, code vocabularies and the per-variant settings.

Everything here is a scalar. Dates are folded into literals by Catalyst,
so a query never reads the clock: the caller passes ``run_date``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# --- fixed values: must equal the source system's codes -------------------
FA = "FA"
PILOT = "P"
FA_RESERVE_CODES = ("RSV", "RLV")
PILOT_RESERVE_CODES = ("ARC", "SCR")
ASSIGNMENT_CODE = "ASN"
RELEASE_CODES = ("SNO", "GDO", "OFF", "DRP")  # reserve day given back
ASSIGNMENT_RELEASE_CODES = ("SNO", "GDO", "OFF")  # assignment given back (no DRP)
OVERLAP_CODES = ("FLP", "FLU", "2SK", "FLV", "FLS", "SOP", "REM", "FAR", "MIL")
RUNNING_CODE = "RLV"  # the only reserve code of the running release rule
PILOT_SEATS = ("CA", "FO")
PLACEHOLDER_CREW_IDS = ("1", "10")
FA_EQUIPMENT = "NA"  # literal two-letter text, not NULL
OVERRIDE_EQUIPMENT = "717"  # flown from the HNL base whatever the schedule says
OVERRIDE_BASE = "HNL"
EXCLUDED_EQUIPMENT = "33Y"
FLAGGED_EQUIPMENT = "789"
REPORT_BASE = "HNL"
FOLDED_FA_CODE = ("RSV", "RLV")  # RSV is counted as RLV
FOLDED_PILOT_CODE = ("ARC", "SCR")  # ARC is counted as SCR
BACKFILL_TYPO_CODE = "ACR"  # what the pilot backfill compares with (never matches)
# The pilot backfill compares PAIRING_DATE with the number 2024-04-31 = 1989,
# i.e. day 1989 after the epoch; the evident intent is the end of April 2024.
FLAG_DATE_LITERAL = dt.date(1970, 1, 1) + dt.timedelta(days=2024 - 4 - 31)
FLAG_DATE_INTENT = dt.date(2024, 5, 1)
FIRST_BID_PERIOD = "2023-01"
LAST_BID_PERIOD = "2024-10"
NO_LAST_BID_PERIOD = "9999-12"  # after every period
INCREMENTAL_CUTOFF_DAY = 25
BACKFILL_CUTOFF_DAY = 24
# ---------------------------------------------------------------------------

SILVER_COLUMNS = (
    "CREW_INDICATOR",
    "CREW_ID",
    "TRANSACTION_CODE",
    "PAIRING_DATE",
    "PAIRING_POSITION",
    "BID_PERIOD",
    "BASE",
    "EQUIPMENT",
)


@dataclass(frozen=True)
class Window:
    """Closed day window ``run_date + lo_days .. run_date + hi_days``."""

    lo_days: int
    hi_days: int


@dataclass(frozen=True)
class RunParams:
    run_date: dt.date = dt.date(2024, 3, 15)
    fa_window: Window = Window(-60, 30)
    pilot_window: Window = Window(-10, 30)
    explore_window: Window = Window(-50, 10)
    cutoff_lead_days: int = 7  # incremental cutoff month is taken from run+7
    incremental_cutoff_day: int = INCREMENTAL_CUTOFF_DAY
    backfill_cutoff_day: int = BACKFILL_CUTOFF_DAY
    first_bid_period: str = FIRST_BID_PERIOD
    last_bid_period: str = NO_LAST_BID_PERIOD
    incremental_cap_days: int = 30  # incremental rows kept up to run+30
    # literal (default) versus evident-intent switches, see README
    asn_rows_only: bool = False  # FA incremental keeps whole ASN groups
    fold_arc_in_backfill: bool = False  # backfill compares with "ACR"
    flag_date_intent: bool = False  # 789 rule inert unless switched on
    running_release: bool = False  # W6 instead of W3 (an earlier variant of the live report)
    literal_fill: bool = False  # N7/N8: fill down over the whole table, not inside each trip
    pilot_cutoff_day: int | None = None  # P5: commented pilot reserve cutoff (day 21) when set

    def day(self, offset: int) -> dt.date:
        return self.run_date + dt.timedelta(days=offset)

    def bounds(self, w: Window) -> tuple[dt.date, dt.date]:
        return self.day(w.lo_days), self.day(w.hi_days)

    @property
    def incremental_cap(self) -> dt.date:
        return self.day(self.incremental_cap_days)

    @property
    def pilot_bid_range(self) -> tuple[str, str]:
        """Schedule versions read by the pilot incremental run."""
        lo, hi = self.bounds(self.pilot_window)
        return self.run_date.strftime("%Y-%m"), hi.strftime("%Y-%m")

    @property
    def flag_date(self) -> dt.date:
        return FLAG_DATE_INTENT if self.flag_date_intent else FLAG_DATE_LITERAL

    def with_(self, **kw) -> "RunParams":
        return replace(self, **kw)


#: The registered queries keep the source's own end; a job has none unless told.
DEFAULT = RunParams(last_bid_period=LAST_BID_PERIOD)
