"""Plant telemetry analytics on Spark: landing, star schema, checks, panels and streams."""

from millwatt.session import configure, get_session

__all__ = ["configure", "get_session"]
