"""Parquet footers of many partitions as one distributed table.

One Spark job lists the files of each partition and parses their footers on the
executors: the schema's fingerprint, the row count, and the null counts of the
columns from the statistics of the row groups.  No data page is read.  Row and null
counts are then sums over that table, and partitions of equal fingerprints share one schema.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import materialize
from tideline.sources.partitions import partitions_frame

#: file systems that Python workers can open by themselves
OPENED = ("file", "hdfs")
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_ROW = "partition string, file string, fingerprint string, rows long, nulls map<string,long>, error string"
_TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.int64()), pa.string()]
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host of its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file:///") else full


def footers(spark: SparkSession, path: str, values: Sequence[str], partition_col: str = "dt") -> DataFrame | None:
    """``partition, file, fingerprint, rows, nulls, error``: a row for each data file, or one without a file for
    a partition that has none; None where the workers cannot open the file system."""
    root = qualified(spark, path).rstrip("/")
    if root.split(":", 1)[0] not in OPENED or not values:
        return None
    tasks = min(len(values), 4 * spark.sparkContext.defaultParallelism)
    names = partitions_frame(spark, list(values), "partition").repartition(tasks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                rows = list(_partition(system, f"{base}/{partition_col}={value}"))
                table = [[value, *r] for r in rows or [(None, None, None, None, None)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table), _TYPES)], _NAMES)

    return materialize(names.mapInArrow(read, _ROW), "footers")


def _partition(system, folder: str) -> Iterator[tuple]:
    from pyarrow import fs
    from pyarrow import parquet as pq

    try:
        found = [f for f in system.get_file_info(fs.FileSelector(folder, recursive=True))
                 if f.type == fs.FileType.File and not any(x[:1] in "._" for x in f.path[len(folder) + 1 :].split("/"))]
    except OSError as e:
        yield None, None, None, None, str(e)
        return
    for f in found:
        try:
            with system.open_input_file(f.path) as handle:
                meta = pq.ParquetFile(handle).metadata
            own = (meta.metadata or {}).get(SPARK_SCHEMA, b"")
            print_of = hashlib.sha256(str(meta.schema).encode().split(b"\n", 1)[1] + own).hexdigest()
            yield f.path, print_of, meta.num_rows, list(_nulls(meta).items()), None
        except (OSError, pa.ArrowException) as e:
            yield f.path, None, None, None, str(e) or type(e).__name__


def _nulls(meta) -> dict[str, int]:
    """Null counts of the top-level columns whose statistics are complete."""
    out = {}
    for i in range(meta.num_columns):
        column = meta.schema.column(i)
        if column.path != column.name or column.max_repetition_level:
            continue
        total = 0
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(i).statistics
            if column.max_definition_level == 0:
                continue  # a required column
            if s is None or not s.has_null_count:
                break
            total += s.null_count
        else:
            out[column.name] = total
    return out


def counts(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``partition, rows, nulls_<k>`` for the k-th of ``columns``: null where a file lacks the statistics.

    Only for partitions without errors and with files.
    """
    nulls = [F.when(F.count(F.col("nulls")[c]) == F.count(F.lit(1)), F.sum(F.col("nulls")[c])).alias(f"nulls_{k}")
             for k, c in enumerate(columns)]
    return found.groupBy("partition").agg(F.sum("rows").alias("rows"), *nulls)
