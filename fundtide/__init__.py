"""Fund-trend and portfolio analytics as lazy Spark DataFrame functions."""

__version__ = "0.1.0"
