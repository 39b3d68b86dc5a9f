"""driftwatch: column profiles, period-over-period deviations and schedules on Spark."""

from .operators.deviations import deviations
from .operators.profile import Slice, profile_many, profile_period, profile_periods, profile_table, to_statistics
from .plans.run import Store, run_checks

__all__ = [
    "Slice",
    "Store",
    "deviations",
    "profile_many",
    "profile_period",
    "profile_periods",
    "profile_table",
    "run_checks",
    "to_statistics",
]
