"""Every operator bound to the test tables, with the SQL that gives the same rows.

The bindings only choose tables, columns and names; the work is done by the
operators. All of them read the whole tables.
"""

from __future__ import annotations

from importlib import import_module

from tarn.plans.bindings.registry import ORACLES, QUERIES

for _module in ("sources", "sinks", "validation", "joins", "chain", "aggregates", "series", "quality", "text", "sql", "streams"):
    import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
