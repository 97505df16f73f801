"""Scans, partition discovery, lineage declarations, result store, sinks."""

from tideline.sources.datasets import read_dataset, read_partition, read_reference
from tideline.sources.partitions import list_partitions, new_partitions, partitions_of
from tideline.sources.sinks import write_partitioned
from tideline.sources.store import (
    CHECKPOINT_SCHEMA,
    RESULT_KEY,
    RESULT_SCHEMA,
    ResultStore,
    checkpoints_from_results,
    latest_by_key,
)

__all__ = [
    "read_dataset",
    "read_partition",
    "read_reference",
    "list_partitions",
    "new_partitions",
    "partitions_of",
    "write_partitioned",
    "CHECKPOINT_SCHEMA",
    "RESULT_KEY",
    "RESULT_SCHEMA",
    "ResultStore",
    "checkpoints_from_results",
    "latest_by_key",
]
