"""Dataset scans.

A dataset is a directory of Parquet files laid out Hive-style as
``<root>/dt=<value>/...``.  The partition value is always a STRING: Spark would
otherwise infer DATE from date-looking directory names.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources.footers import footers
from tideline.sources.partitions import DATE_PATTERN, list_partitions


def _with_string_partition(spark: SparkSession, path: str, partition_col: str) -> T.StructType:
    """Footer schema of the data files plus ``partition_col`` as STRING."""
    probe = spark.read.parquet(path).schema
    fields = [f for f in probe.fields if f.name != partition_col]
    return T.StructType(fields + [T.StructField(partition_col, T.StringType(), True)])


def read_dataset(
    spark: SparkSession,
    path: str,
    partition_col: str = "dt",
    *,
    pattern: str | None = DATE_PATTERN,
    tolerant: bool = False,
    contract: T.StructType | None = None,
    partitions: Sequence[str] | None = None,
) -> DataFrame:
    """Scan a whole partitioned dataset.

    Filters on ``partition_col`` become partition filters of the file scan, so
    a later ``where(dt > x)`` or ``isin`` reads only those directories.
    Directories whose value does not match ``pattern`` (e.g. a left-over
    ``dt=2024-11-15.backup`` copy) are pruned the same way; ``None`` keeps all.

    ``tolerant=True`` reads datasets whose partitions disagree on a column type
    (e.g. an integer column rewritten as double in one partition): partitions
    are grouped by schema (``schema_groups``), each group is one scan widened to
    ``contract`` (default: the widest type of each column over all partitions) and the
    groups are unioned.  A column that a partition lacks reads as NULL.  No
    value is narrowed, and an unreadable partition raises instead of being
    dropped; to check such a dataset partition by partition, with error rows,
    use ``tideline.plans.partitioned``.
    """
    if not tolerant:
        schema = _with_string_partition(spark, path, partition_col)
        df = spark.read.schema(schema).option("basePath", path).parquet(path)
        if pattern:
            df = df.where(F.col(partition_col).rlike(f"^(?:{pattern})$"))
        if partitions is not None:
            df = df.where(F.col(partition_col).isin(list(partitions)))
        return df

    parts = list_partitions(spark, path, partition_col, pattern=pattern)
    if partitions is not None:
        wanted = set(partitions)
        parts = [p for p in parts if p in wanted]
    found = schema_groups(spark, path, parts, partition_col)
    if found.unreadable:
        raise ValueError(f"unreadable partitions under {path}: {found.unreadable}")
    if not found.groups:
        raise ValueError(f"no partitions with files under {path}")
    if contract is None:
        contract = widest([schema for schema, _ in found.groups])
    pieces = []
    for schema, values in found.groups:
        df = read_group(spark, path, schema, values, partition_col)
        cols = [
            (F.col(f.name).cast(f.dataType) if f.name in schema.fieldNames() else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in contract.fields
            if f.name != partition_col
        ]
        pieces.append(df.select(*cols, F.col(partition_col)))
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class SchemaGroups:
    """Partitions by their own schema: ``groups`` of (schema without the partition column,
    names), ``empty`` ones without data files, and ``unreadable`` ones."""

    groups: list[tuple[T.StructType, list[str]]]
    empty: list[str]
    unreadable: list[str]
    footers: DataFrame | None = None


def schema_groups(
    spark: SparkSession, path: str, values: Sequence[str], partition_col: str = "dt", parallel: int = 16
) -> SchemaGroups:
    """Group partitions by the schema of their own files.

    One Spark job reads all footers on the executors (``tideline.sources.footers``); Spark is
    then asked for the schema of one partition of each group, ``parallel`` at a time.  On
    file systems that Python workers cannot open, it is asked for each partition.  Pass only the new
    partitions of an incremental run.  Files of one partition that cannot be merged make it unreadable.
    """

    def own(value: str):
        try:
            s = spark.read.option("mergeSchema", "true").parquet(f"{path.rstrip('/')}/{partition_col}={value}").schema
            return T.StructType([f for f in s.fields if f.name != partition_col])
        except AnalysisException as e:
            # no data files at all is an empty partition; anything else could not be read
            return "empty" if "UNABLE_TO_INFER_SCHEMA" in str(e) else "unreadable"
        except Exception:  # noqa: BLE001 - corrupt footer, permissions, network
            return "unreadable"

    values, like = list(values), {}
    found = footers(spark, path, values, partition_col)
    if found is not None:
        rows = found.groupBy("partition").agg(
            F.count("file").alias("files"), F.count("error").alias("errors"), F.sort_array(F.collect_set("fingerprint")).alias("prints"))
        for row in rows.collect():  # a row for each partition
            like[row["partition"]] = "unreadable" if row["errors"] else "empty" if not row["files"] else tuple(row["prints"])
    asked = {like.get(v, v): v for v in reversed(values) if not isinstance(like.get(v), str)}  # the first of each kind
    with ThreadPoolExecutor(max(1, min(parallel, len(asked)))) as pool:
        schemas = dict(zip(asked, pool.map(own, asked.values())))
    schemas = [like[v] if isinstance(like.get(v), str) else schemas[like.get(v, v)] for v in values]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for value, s in zip(values, schemas):
        if not isinstance(s, str):
            groups.setdefault(s.json(), (s, []))[1].append(value)
    return SchemaGroups(list(groups.values()), [v for v, s in zip(values, schemas) if s == "empty"],
                        [v for v, s in zip(values, schemas) if s == "unreadable"], found)


def read_group(spark: SparkSession, path: str, schema: T.StructType, values: Sequence[str], partition_col: str = "dt") -> DataFrame:
    """One scan of partitions that share ``schema``; only their directories are listed."""
    full = T.StructType(schema.fields + [T.StructField(partition_col, T.StringType(), True)])
    leaves = [f"{path.rstrip('/')}/{partition_col}={v}" for v in values]
    return spark.read.schema(full).option("basePath", path).parquet(*leaves)


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    x, y = a.simpleString(), b.simpleString()
    if x == y:
        return a
    if x in _WHOLE and y in _WHOLE:
        return a if _WHOLE.index(x) > _WHOLE.index(y) else b
    if {x, y} <= {*_WHOLE, "float", "double"}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    return T.StringType()


def widest(schemas: Sequence[T.StructType]) -> T.StructType:
    """Each column once, in order of appearance, with a type that holds all of its values."""
    out: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            out[f.name] = _wider(out[f.name], f.dataType) if f.name in out else f.dataType
    return T.StructType([T.StructField(k, v, True) for k, v in out.items()])


def read_partition(
    spark: SparkSession, path: str, value: str, partition_col: str = "dt"
) -> DataFrame:
    """Scan one partition (S2) under its own schema; only its directory is listed."""
    leaf = f"{path.rstrip('/')}/{partition_col}={value}"
    s = spark.read.option("basePath", path).parquet(leaf).schema
    return read_group(spark, path, T.StructType([f for f in s.fields if f.name != partition_col]), [value], partition_col)


def read_partitions(
    spark: SparkSession, path: str, values: Sequence[str], partition_col: str = "dt"
) -> DataFrame:
    """Scan a list of partitions with one statically pruned file scan."""
    return read_dataset(spark, path, partition_col).where(F.col(partition_col).isin(list(values)))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """Load an unpartitioned reference (dimension) dataset."""
    return spark.read.parquet(path)
