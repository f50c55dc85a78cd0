"""Customer-retention analytics expressed as Spark DataFrame, ML and streaming operators."""

__version__ = "0.1.0"
