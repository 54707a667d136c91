"""Wiring of operators to input tables, one module per area."""

from importlib import import_module

MODULES = (
    "kpi_queries", "meter_queries", "spatial_queries", "polygon_queries", "route_queries", "live_queries",
    "forecast_queries", "synth_queries", "source_queries", "stream_queries",
)


def load_all() -> None:
    for name in MODULES:
        import_module(f"fareline.plans.{name}")
