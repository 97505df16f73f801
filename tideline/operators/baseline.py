"""Trailing metric baseline.

For every ``(dataset, check_name, partition)`` the baseline is the mean and
the maximum of ``metric_value`` over the last ``window`` result rows of the same
dataset and check whose partition is strictly earlier, ordered by
``(partition, timestamp, run_id, metric_value)`` (the last ones break ties at the
window's edge).  Failed rows and error rows (-1.0) are included.

The baseline of a partition is therefore the trailing frame at its first row in
that order.  The history is written once, and its rows are counted by that write.  Up
to ``BLOCK_ROWS`` rows, one window keyed by ``(dataset, check_name)`` does; a
longer history is cut by range into sorted blocks, so that one check's results use
as many tasks as they need, and each block is handed the ``window`` rows before it
(its *halo*).  What one task sees besides its block is at most ``window`` rows of each block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tideline.operators.checks import ERROR_METRIC
from tideline.session import materialize

DEFAULT_WINDOW = 30
BLOCK_ROWS = 1_000_000
KEY = ("dataset", "check_name")
ORDER = ("partition", "timestamp", "run_id", "metric_value")


def baseline(
    history: DataFrame, window: int = DEFAULT_WINDOW, exclude_errors: bool = False, block_rows: int = BLOCK_ROWS,
    counted: int | None = None,
) -> DataFrame:
    """``(dataset, check_name, partition, baseline_mean, baseline_max, baseline_rows)``.

    Partitions with no earlier rows get ``baseline_rows = 0`` and NULL stats.
    ``exclude_errors`` leaves error rows (metric -1.0) out of the window (by
    default they count, as in the reference); a partition with nothing but
    error rows then has no baseline row.  ``counted`` is a number of rows that the caller has
    counted and that ``history`` does not exceed; a small one saves the write.
    """
    if exclude_errors:
        history = history.where(F.col("metric_value") != F.lit(ERROR_METRIC))
    if counted is not None and counted <= block_rows:
        return _at_first_rows(history.select(*KEY, *ORDER), list(KEY), window)
    seen = Observation()
    h = materialize(history.select(*KEY, *ORDER).observe(seen, F.count(F.lit(1)).alias("rows")), "baseline-history")
    rows = seen.get["rows"]
    if rows <= block_rows:
        return _at_first_rows(h, list(KEY), window)
    return _at_first_rows(*_with_halo(h, -(-rows // block_rows), window), window)


def _at_first_rows(rows: DataFrame, key: list[str], window: int) -> DataFrame:
    """The trailing frame at the first row of each partition; rows marked ``__halo`` only fill frames."""
    halo = F.col("__halo") if "__halo" in rows.columns else F.lit(False)
    order = Window.partitionBy(*key).orderBy(*ORDER, *([halo.desc()] if "__halo" in rows.columns else []))
    frame = order.rowsBetween(-window, -1)
    firsts = rows.select(
        *KEY,
        "partition",
        (F.row_number().over(order) == 1).alias("__start"),
        (~F.lag("partition").over(order).eqNullSafe(F.col("partition"))).alias("__turn"),
        halo.alias("__halo"),
        F.avg("metric_value").over(frame).alias("baseline_mean"),
        F.max("metric_value").over(frame).alias("baseline_max"),
        F.count("metric_value").over(frame).alias("baseline_rows"),
    ).where(~F.col("__halo") & (F.col("__start") | F.col("__turn")))
    return firsts.select(*KEY, "partition", "baseline_mean", "baseline_max", "baseline_rows")


def _with_halo(h: DataFrame, blocks: int, window: int) -> tuple[DataFrame, list[str]]:
    """The rows in sorted blocks, each with the ``window`` rows of its first check that stand before it."""
    parts = max(blocks, int(h.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = materialize(
        h.repartitionByRange(parts, *KEY, *ORDER)
        .sortWithinPartitions(*KEY, *ORDER)
        .withColumn("__block", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id()),
        "baseline-blocks",
    )
    ends = F.broadcast(ranged.groupBy("__block").agg(F.min("__at").alias("__first"), F.max("__at").alias("__last")))  # a row a block
    edge = materialize(
        ranged.join(ends, "__block")
        .where((F.col("__at") == F.col("__first")) | (F.col("__at") > F.col("__last") - F.lit(window)))
        .withColumn("__is_first", F.col("__at") == F.col("__first"))
        .withColumn("__is_tail", F.col("__at") > F.col("__last") - F.lit(window)),
        "baseline-edges",
    )
    # if a check goes on into a block, all rows after its last ``window`` ones before are its own:
    # the tails of the earlier blocks hold them
    by_key = Window.partitionBy(*KEY).orderBy("__at")
    tails = edge.where("__is_tail").withColumn("__nth", F.row_number().over(by_key))
    earlier = Window.partitionBy(*KEY).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        edge.groupBy(*KEY, "__block")
        .agg(F.count_if("__is_tail").alias("__tails"), F.max("__is_first").alias("__opens"))
        .withColumn("__upto", F.coalesce(F.sum("__tails").over(earlier), F.lit(0)))
        .where((F.col("__opens")) & (F.col("__upto") > 0))
        .select(F.col("dataset").alias("__dataset"), F.col("check_name").alias("__check"), F.col("__block").alias("__for"),
                F.explode(F.sequence(F.greatest(F.col("__upto") - F.lit(window - 1), F.lit(1)), F.col("__upto"))).alias("__take"))
    )
    same = F.col("__dataset").eqNullSafe(F.col("dataset")) & F.col("__check").eqNullSafe(F.col("check_name"))
    halo = heads.join(tails, same & (F.col("__take") == F.col("__nth"))).select(
        *KEY, *ORDER, F.col("__for").alias("__block"), F.lit(True).alias("__halo"))
    own = ranged.select(*KEY, *ORDER, "__block", F.lit(False).alias("__halo"))
    return own.unionByName(halo), ["__block", *KEY]


def anomalies(
    history: DataFrame, current: DataFrame | None = None, window: int = DEFAULT_WINDOW, exclude_errors: bool = False
) -> DataFrame:
    """Current rows whose metric exceeds twice the baseline mean or its max.

    ``current`` defaults to every history row.  Rows need at least one earlier
    row.  A drop is never anomalous here, as in the reference rule.
    """
    cur = history if current is None else current
    b = baseline(history, window, exclude_errors)
    j = cur.join(b, ["dataset", "check_name", "partition"], "inner")
    anomalous = (F.col("metric_value") > F.col("baseline_mean") * 2) | (F.col("metric_value") > F.col("baseline_max"))
    return j.where((F.col("baseline_rows") > 0) & anomalous)
