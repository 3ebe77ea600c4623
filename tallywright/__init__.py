"""Commerce analytics as composable Spark DataFrame operators."""

from tallywright.config import Config

__all__ = ["Config"]
