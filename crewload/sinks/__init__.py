"""Table sinks."""
from .tables import append_guarded, append_plain, guarded_rows, read_silver, write_overwrite  # noqa: F401
