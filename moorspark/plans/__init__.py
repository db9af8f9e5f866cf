"""Composite jobs and the query registry."""

import importlib

_MODULES = ["clean_queries", "lookup_queries", "stats_queries", "series_queries", "deployment_queries",
            "clock_queries", "grid_queries", "qc_queries", "calibration_queries", "profile_queries",
            "merge_queries", "metadata_queries", "source_queries", "stream_queries", "job_queries"]


def load_all():
    """Import every query module; returns ``(queries, oracles)``."""
    from moorspark.plans import registry

    for m in _MODULES:
        importlib.import_module(f"moorspark.plans.{m}")
    return registry.QUERIES, registry.ORACLES
