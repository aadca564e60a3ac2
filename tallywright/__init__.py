"""Receivables and revenue controls as PySpark DataFrame jobs."""

from tallywright.model import TABLES, Tables

__all__ = ["TABLES", "Tables"]
