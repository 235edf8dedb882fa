"""Change-stream analytics on Spark: captured log bytes in, transaction-correct tables out."""

__version__ = "0.1.0"
