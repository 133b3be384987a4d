"""The registered queries, each with the SQL text of its answer."""

from windrow.plans import changes, files, functions, groups, models, streams, summaries, tables, versions  # noqa: F401
from windrow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
