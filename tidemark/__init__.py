"""Change-log analytics on Spark: decode, order, gate and serve database changes."""

__version__ = "0.1.0"
