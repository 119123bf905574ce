"""Spark-first analytics for market-data lakes: scans, bars, books, reconciliation and data-quality operators."""

__version__ = "0.1.0"
