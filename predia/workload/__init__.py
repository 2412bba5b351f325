"""The registered queries: marketplace tables derived from the driver's tables, Spark queries, and their SQL oracles."""

from predia.workload import operator_queries, storage_queries, product_queries  # noqa: F401  (they register their queries)
from predia.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
