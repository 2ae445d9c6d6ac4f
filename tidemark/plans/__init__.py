"""Plans: market layer, fundamentals, factors, audit, overrides, calibration."""

from tidemark.plans import catalog, controls  # noqa: F401  both register queries
from tidemark.plans.catalog import ORACLE, QUERIES


def oracle_queries() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["QUERIES", "oracle_queries"]
