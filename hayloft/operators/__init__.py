"""Reusable relational operators; every one takes column names as parameters."""

from hayloft.operators.asof import point_in_time_join  # noqa: F401
from hayloft.operators.dedup import dedup  # noqa: F401
from hayloft.operators.intervals import fill_days, split_intervals  # noqa: F401
from hayloft.operators.pairing import pair_events  # noqa: F401
from hayloft.operators.scd import scd2  # noqa: F401
from hayloft.operators.shred import shred  # noqa: F401
