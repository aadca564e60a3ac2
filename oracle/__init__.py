"""Independent DuckDB check queries, one per named result."""

from oracle import queries, raw, reports  # noqa: F401  (each module adds its queries)
from oracle.queries import ORACLES

__all__ = ["ORACLES"]
