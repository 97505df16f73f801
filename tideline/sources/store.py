"""Result and checkpoint tables.

Both are ``SegmentTable``s: immutable Parquet segments under a manifest, compacted by
size, results partitioned by dataset.  An "upsert" appends a new version; readers keep
the latest one per key, ``max_by(row, _seq)``, batch and streaming writes alike.  A
retried write with the same key (e.g. the same ``run_id``) therefore overwrites its
own earlier rows, and a crash between the result and checkpoint writes leaves
a state the next run repairs.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources.segments import SegmentTable

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), True),
        T.StructField("dataset", T.StringType(), True),
        T.StructField("partition", T.StringType(), True),
        T.StructField("check_name", T.StringType(), True),
        T.StructField("check_type", T.StringType(), True),
        T.StructField("passed", T.BooleanType(), True),
        T.StructField("metric_value", T.DoubleType(), True),
        T.StructField("threshold", T.StringType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
    ]
)
RESULT_KEY = ("run_id", "dataset", "partition", "check_name")

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType(), True),
        T.StructField("last_checked_partition", T.StringType(), True),
        T.StructField("last_check_time", T.TimestampNTZType(), True),
    ]
)
CHECKPOINT_KEY = ("dataset",)
SEQ = "_seq"


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per ``key``: the greatest by the columns ``order`` (W2, last write wins).

    An aggregate, so versions are dropped before the shuffle and nothing is sorted by key.
    """
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return df.groupBy(*key).agg(best).select(*[F.col(c) if c in key else F.col(f"__best.{c}").alias(c) for c in df.columns])


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """``INSERT OR REPLACE`` as a DataFrame: incoming rows replace equal keys.

    Rows inside ``incoming`` with the same key keep the last one by its
    ``_seq`` column when present, else any one of them.
    """
    cols = existing.columns
    a = existing.select(*cols, F.lit(0).alias("__src"))
    b = incoming.select(*cols, F.lit(1).alias("__src"))
    return latest_by_key(a.unionByName(b), key, ["__src", SEQ] if SEQ in cols else ["__src"]).drop("__src")


def checkpoints_from_results(results: DataFrame, when=None) -> DataFrame:
    """Checkpoint rows implied by a batch of results.

    The reference moves the mark partition by partition in listing order, so
    after a run it stands at the run's greatest partition of each dataset.
    """
    ts = F.col("__ts") if when is None else F.lit(when)
    base = results.where(F.col("partition").isNotNull()).groupBy("dataset").agg(
        F.max("partition").alias("last_checked_partition"), F.max("timestamp").alias("__ts")
    )
    return base.select(
        "dataset",
        "last_checked_partition",
        (ts if when is not None else F.col("__ts")).cast("timestamp_ntz").alias("last_check_time"),
    )


class ResultStore:
    """Results + checkpoints under one shared root directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._results = SegmentTable(spark, self.results_path, RESULT_SCHEMA, RESULT_KEY, SEQ, partition_by="dataset")
        self._checkpoints = SegmentTable(spark, self.checkpoints_path, CHECKPOINT_SCHEMA, CHECKPOINT_KEY, SEQ)

    @property
    def results_path(self) -> str:
        return f"{self.root}/quality_results"

    @property
    def checkpoints_path(self) -> str:
        return f"{self.root}/partition_checkpoints"

    def raw_results(self, datasets: Sequence[str] | None = None) -> DataFrame:
        """All versions of all rows, or of some datasets (only their files are opened)."""
        return self._results.read(values=datasets)

    def results(self, datasets: Sequence[str] | None = None) -> DataFrame:
        """Latest version of each ``(run_id, dataset, partition, check_name)``."""
        df = latest_by_key(self.raw_results(datasets), RESULT_KEY, [SEQ])
        return df.select(*RESULT_SCHEMA.fieldNames())

    def checkpoints(self) -> DataFrame:
        """Latest checkpoint per dataset (S9 for all datasets at once)."""
        df = latest_by_key(self._checkpoints.read(), CHECKPOINT_KEY, [SEQ])
        return df.select(*CHECKPOINT_SCHEMA.fieldNames())

    def written(self, seq: int) -> DataFrame:
        """The rows of one ``save_results`` call (unique keys, no dedupe needed), from the segments that hold it."""
        return self._results.read(seq=seq).select(*RESULT_SCHEMA.fieldNames())

    def last_checkpoint(self, dataset: str) -> DataFrame:
        return self.checkpoints().where(F.col("dataset") == F.lit(dataset))

    def checkpoint_value(self, dataset: str) -> str | None:
        """The dataset's last checked partition (S9): a top-1 read, no shuffle."""
        rows = (
            self._checkpoints.read(values=[dataset])
            .orderBy(F.col(SEQ).desc())
            .select("last_checked_partition")
            .limit(1)
            .collect()
        )
        return rows[0][0] if rows else None

    def save_results(self, results: DataFrame, seq: int | None = None) -> int:
        """Append one version of ``results`` (S7); returns its sequence number."""
        seq = time.time_ns() if seq is None else seq
        self._results.append(results, seq)
        return seq

    def update_checkpoints(self, checkpoints: DataFrame, seq: int | None = None) -> int:
        """Append checkpoint versions (S10); no max guard, like the reference."""
        seq = time.time_ns() if seq is None else seq
        self._checkpoints.append(checkpoints, seq)
        return seq
