"""Crate tracking on a Spark lake: queue, landing zones, gold table, dashboard."""

from cratelake.session import build_session

__all__ = ["build_session"]
