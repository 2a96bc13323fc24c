"""Spark-native builder for versioned, sharded document indexes.

A warehouse table goes in; sparse flat documents, a field mapping, exact-term
postings, sharded Parquet and a version ledger come out.  Everything is DataFrame
work: no Python UDFs, no RDDs, no custom planner rules.
"""
from shardloom.session import prepare, shared_dir
from shardloom.spec import BuildSpec, Rules

__all__ = ["BuildSpec", "Rules", "prepare", "shared_dir"]
