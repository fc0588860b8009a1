"""Tank and batch telemetry analytics on Spark."""

from tankwise.session import build_session, stage

__all__ = ["build_session", "stage"]
