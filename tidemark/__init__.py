"""Point-in-time analytics over tick and end-of-day time series, as Spark plans.

Everything takes and returns a ``DataFrame``; the clock is always a parameter and
the session time zone is UTC.
"""
from tidemark.session import build_session, pin_utc, scratch_dir

__all__ = ["build_session", "pin_utc", "scratch_dir"]
