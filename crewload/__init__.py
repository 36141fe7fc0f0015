"""crewload: standby-crew utilization on Spark.

Builds one silver row per crew member, code and day from a transaction log
and a versioned schedule, reconciles reserve days with assigned trips, and
reports the daily share of reserve crew that was used.
"""

from .params import DEFAULT, RunParams  # noqa: F401
