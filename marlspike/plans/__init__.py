"""Named queries over the driver tables, each with its DuckDB oracle where SQL can express it."""

from marlspike.plans import blocks, graph, ml, relational, retrieval, series, sources, streaming, text  # noqa: F401
from marlspike.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
