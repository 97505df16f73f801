"""Exact-fraction row selection per partition value.

Marks the ``round_half_even(rate * n)`` rows of each partition value with the
smallest ``md5(key)`` (ties by key, then by input position), the deterministic
counterpart of a pandas ``sample(frac=rate)``.

A ``row_number()`` window partitioned by the partition value would put a whole
partition value (possibly a third of the data) into one task.  Instead the
rows are range-partitioned on ``(value, md5, key, rowid)``, so any value spans
as many tasks as its size needs; each task's rows are counted per value (at
most #tasks + #values counter rows), a window over that small table gives each
task's starting rank, and a row's rank is that start plus its position in the
task.  The ranged rows (with their task and position) are written once to the
shared checkpoint folder, so both uses of them see the same positions even
after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import ensure_checkpoint_dir, materialize


def exact_fraction(
    df: DataFrame,
    rate: float,
    *,
    key: str,
    partition_col: str = "dt",
    flag: str = "__sel",
    where: Column | None = None,
) -> DataFrame:
    """``df`` plus boolean ``flag``: True on selected rows of the target set,
    False on the other target rows, NULL outside ``where``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cond = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
    marked = df.withColumn("__w", cond)
    rest = marked.where(~F.col("__w")).drop("__w").withColumn(flag, F.lit(None).cast("boolean"))

    target = (
        marked.where(F.col("__w"))
        .drop("__w")
        .withColumn("__h", F.md5(F.col(key).cast("string")))
        .withColumn("__rid", F.monotonically_increasing_id())
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [partition_col, "__h", key, "__rid"]
    ranged = materialize(
        target.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id()),
        "ranked-rows",
    )
    stats = ranged.groupBy("__pid", partition_col).agg(
        F.count(F.lit(1)).alias("__c"), F.min("__pos").alias("__first")
    )
    by_value = Window.partitionBy(partition_col)
    stats = stats.select(
        "__pid",
        partition_col,
        "__first",
        F.coalesce(
            F.sum("__c").over(by_value.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
        F.sum("__c").over(by_value).alias("__total"),
    )
    ranked = ranged.join(stats, ["__pid", partition_col])
    rank = F.col("__before") + (F.col("__pos") - F.col("__first")) + F.lit(1)
    quota = F.bround(F.lit(float(rate)) * F.col("__total"), 0)
    chosen = ranked.withColumn(flag, rank <= quota).select(*df.columns, flag)
    return chosen.unionByName(rest.select(*df.columns, flag))
