"""All registered geospatial queries and their SQL statements, gathered from the plan modules."""

from __future__ import annotations

from importlib import import_module

#: Modules of ``urbanframe.plans`` that hold ``QUERIES`` and ``ORACLE_SQL``.
MODULES = ("building_plans", "road_plans", "raster_plans", "mesh_plans", "overlay_plans", "misc_plans")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"urbanframe.plans.{name}"), attribute)
        if clash := out.keys() & part.keys():
            raise ValueError(f"registered twice: {sorted(clash)}")
        out |= part
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE_SQL")
