"""tidemark: change records to trustworthy tables, on Spark.

Reads snapshot and change-log files, normalises operations and ordering,
and maintains latest-state (SCD1), full-history (SCD2) and append-only
tables with hard or soft deletes, independent of arrival order, batching
or replay.
"""

from .spec import TableSpec  # noqa: F401
from .functions.cdc import standardize  # noqa: F401
from .operators.merge import scd1, scd2, scd_targets, latest_per_key  # noqa: F401
