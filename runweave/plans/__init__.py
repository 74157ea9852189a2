"""Registered queries over the test tables."""

from runweave.plans import (  # noqa: F401
    artifact_queries,
    compute_queries,
    function_queries,
    graph_queries,
    log_queries,
    metadata_queries,
    stream_queries,
    telemetry_queries,
)
from runweave.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
