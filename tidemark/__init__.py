"""Market-data ingest and time-series analytics expressed as Spark DataFrame work."""

__version__ = "0.1.0"
