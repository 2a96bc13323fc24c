"""Registered queries over the given tables, each with a SQL twin where SQL can say it."""
import importlib

from shardloom.suite.registry import ORACLE, QUERIES

for _part in ("scans", "mappings", "docs", "placement", "indexing", "written", "lifecycles", "streams",
              "builds"):
    importlib.import_module(f"shardloom.suite.{_part}")

__all__ = ["ORACLE", "QUERIES"]
