"""Spark-native retail analytics: shop behaviour, review sentiment and
weather vs. purchases, as composable DataFrame operators."""

from .settings import DEFAULT, Settings  # noqa: F401

__version__ = "0.1.0"
