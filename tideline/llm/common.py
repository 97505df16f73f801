"""Small helpers that several operators share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.session import materialize, scratch_dir  # noqa: F401


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names."""
    importable(docs.sparkSession)
    return docs.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, most: int = 100_000, entries: Column | None = None) -> DataFrame:
    """Broadcast ``df`` if a count shows it to be small, else join as it is.

    ``df`` is a written table with rows of a few numbers, or of ``entries`` such entries; ``most``
    of them are some 30 MB in a hash table.
    """
    n = df.limit(most + 1).agg(F.count("*") if entries is None else F.coalesce(F.sum(entries + 1), F.lit(0))).first()[0]
    return F.broadcast(df) if n <= most else df


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` and their rank from 0 in this order, in as many parts as they need; ties may span parts."""
    tie = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1024))
    keys = [*order, "tie"]
    ranged = materialize(
        rows.withColumn("tie", tie).repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ranked")
    parts = ranged.groupBy("part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", "first", F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("earlier"))
    return ranged.join(F.broadcast(parts), "part").select(  # a row for each part
        *rows.columns, (F.col("earlier") + F.col("at") - F.col("first")).alias("rank"))


def merged_spans(spans: DataFrame, *key: str) -> DataFrame:
    """``spans`` (``start, stop``) of each ``key`` as one sorted array; those that overlap or touch become one.

    One pass along the sorted spans, so the time does not depend on how many stay apart.
    """
    along = Window.partitionBy(*key).orderBy("start")
    reach = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") > reach, F.lit(True)).cast("long")
    runs = spans.select(*key, "start", "stop", apart.alias("apart")).withColumn("run", F.sum("apart").over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy(*key, "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
