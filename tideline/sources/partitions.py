"""Partition discovery.

Only partition *names* travel to the driver (one per directory, as Spark's
own file index does); the new-partition decision is a comparison with the
checkpoint table's value, or an anti-join.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"


def list_partitions(
    spark: SparkSession, path: str, partition_col: str = "dt", pattern: str | None = DATE_PATTERN
) -> list[str]:
    """Sorted partition values of a Hive-style dataset directory.

    Lists one directory level through the Hadoop FileSystem of the path, so
    empty partitions (no rows, or no files) are included, as the value comes
    from the directory name.  ``pattern`` rejects look-alikes such as
    ``dt=2024-11-15.backup``; ``None`` accepts every ``dt=`` directory.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    prefix = f"{partition_col}="
    rx = re.compile(pattern) if pattern else None
    out = []
    for st in fs.listStatus(hpath):
        if not st.isDirectory():
            continue
        name = st.getPath().getName()
        if not name.startswith(prefix):
            continue
        value = name.split("=", 1)[1]
        if rx is not None and not rx.fullmatch(value):
            continue
        out.append(value)
    return sorted(out)


def partitions_frame(spark: SparkSession, values: Sequence[str], partition_col: str = "dt") -> DataFrame:
    schema = T.StructType([T.StructField(partition_col, T.StringType(), False)])
    return spark.createDataFrame([(v,) for v in values], schema)


def partitions_of(df: DataFrame, partition_col: str = "dt", extra: Sequence[str] = ()) -> DataFrame:
    """Distinct partition values present in a DataFrame, plus ``extra`` names.

    For a view this is the only listing there is; ``extra`` adds partitions
    known to exist without rows (a zero-row directory).
    """
    parts = df.select(F.col(partition_col).cast("string").alias(partition_col)).distinct()
    if extra:
        spark = df.sparkSession
        parts = parts.unionByName(partitions_frame(spark, extra, partition_col)).distinct()
    return parts


def new_partitions(
    parts: DataFrame,
    checkpoints: DataFrame,
    dataset: str,
    *,
    partition_col: str = "dt",
    mode: str = "watermark",
    checked: DataFrame | None = None,
) -> DataFrame:
    """Partitions of ``dataset`` that still need checking, sorted (S3).

    ``watermark`` (default): values strictly greater than the dataset's last
    checked partition, all of them when there is no checkpoint.  A partition
    that arrives below the mark is never picked up in this mode.
    ``anti``: every value with no result row yet for ``dataset`` (``checked``
    holds ``dataset, partition`` rows), which does pick up late partitions.
    """
    p = F.col(partition_col)
    if mode == "watermark":
        last = checkpoints.where(F.col("dataset") == F.lit(dataset)).agg(F.max("last_checked_partition")).scalar()
        out = parts.where(last.isNull() | (p > last)).select(p)
    elif mode == "anti":
        if checked is None:
            raise ValueError("mode='anti' needs the checked (dataset, partition) rows")
        done = (
            checked.where(F.col("dataset") == F.lit(dataset))
            .select(F.col("partition").alias(partition_col))
            .distinct()
        )
        out = parts.join(done, partition_col, "left_anti")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return out.orderBy(p)
