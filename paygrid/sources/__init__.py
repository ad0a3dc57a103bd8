"""Readers of the job's four sources, and the writers of its tables."""

from .frames import FrameSources
from .sinks import append_log, merge_by_key, read_log, upsert_partitioned
from .tables import SOURCE_SCHEMAS, TableSources
from .testdata import TestDataSources

__all__ = ["FrameSources", "append_log", "merge_by_key", "read_log", "upsert_partitioned",
           "SOURCE_SCHEMAS", "TableSources", "TestDataSources"]
