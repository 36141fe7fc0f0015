"""Sources: the crew tables and their scans."""

from .fixtures import sched, txn  # noqa: F401
from .history import bid_periods, read_table, scan_bid_periods, scan_window, schedule_scan  # noqa: F401
