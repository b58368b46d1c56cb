"""Event-anchored cohort and feature engine on PySpark DataFrames."""

from anchorframe.core import TimeWindow
from anchorframe.session import build_session, configure

__all__ = ["TimeWindow", "build_session", "configure"]
