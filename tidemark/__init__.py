"""Audit-event and change-history analytics on Spark."""

from tidemark.session import build_session, configure

__all__ = ["build_session", "configure"]
