"""The library's operators as queries over the TPC-H-like test tables, each with
equivalent SQL to compare against."""

from workloads import cleaning, control, endtoend, files, standings, writes  # noqa: F401
from workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
