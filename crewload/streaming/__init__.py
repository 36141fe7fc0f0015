"""Table lifecycle: backfill, rolling refresh, refresh on file arrival."""
from .rolling import refresh_on_arrival, run_backfill, run_incremental  # noqa: F401
