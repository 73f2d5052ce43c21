"""Work-order event ingestion and analytics as Spark DataFrame jobs."""

from workledger.session import configure

__all__ = ["configure"]
