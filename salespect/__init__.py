"""Retail transaction analytics expressed as lazy Spark DataFrame operators."""

from salespect.config import Settings

__all__ = ["Settings"]
