"""All registered queries of the library, by loading the modules that register them."""

from __future__ import annotations

from importlib import import_module

from geoframe.catalog import ORACLE, QUERIES

MODULES = ("scalars", "shapes", "filters", "joins", "sets", "sums", "axes", "stores", "streams", "requests", "pipelines")

for _name in MODULES:
    import_module(f"geoframe.plans.{_name}")

__all__ = ["ORACLE", "QUERIES"]
