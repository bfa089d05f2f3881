"""Invoice ingestion and incremental star-schema loading on Spark."""

__version__ = "0.1.0"
