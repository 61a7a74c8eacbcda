"""Loads every query module once."""

from __future__ import annotations

import importlib
import importlib.util

MODULES = ("shapes", "files", "names", "matching", "duplicates", "payloads", "checks", "planning", "ledger", "logs",
           "metrics", "labelling", "invariants", "audit", "store", "release", "verdicts", "flows", "streams")


def load() -> None:
    for name in MODULES:
        if importlib.util.find_spec(f"cairnsift.queries.{name}") is None:
            continue
        importlib.import_module(f"cairnsift.queries.{name}")
