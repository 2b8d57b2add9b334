"""Every operator as a named query over the given tables, with its plain SQL twin."""

from __future__ import annotations

from importlib import import_module

from siltbed.registry.core import ENTRIES

for _part in ("ingest", "expand", "reshape", "merge", "profile", "tables", "history", "quality", "layers", "streams"):
    import_module(f"siltbed.registry.{_part}")

__all__ = ["ENTRIES"]
