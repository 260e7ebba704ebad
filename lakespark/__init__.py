"""Lake-pixel bloom analytics as Spark DataFrame jobs."""

from lakespark.session import configure

__all__ = ["configure"]
