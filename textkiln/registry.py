"""Named queries over a folder of Parquet tables, and DuckDB SQL for the same rows."""

from __future__ import annotations

import importlib

#: Modules with QUERIES (name -> function of session and folder) and ORACLE_SQL.
MODULES = ("urls", "texts", "states", "relations", "contents", "checks", "curations", "custody", "retirements", "proofs", "projections", "changes")

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"textkiln.plans.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
