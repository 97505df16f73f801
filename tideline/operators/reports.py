"""Reports over the results table.

Each report section is a DataFrame; nothing is printed.  The results table is
small next to the checked data (one row per check and partition), and every
report below is one aggregate or one sorted projection of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalar import safe_ratio

# Fixed values of the metrics report.
ROWS_PER_PARTITION = {"orders_raw": 15000, "revenue_daily": 1000}
MANUAL_MTTR_MIN = 120
AUTOMATED_MTTR_MIN = 15
SAVED_PER_INCIDENT_MIN = MANUAL_MTTR_MIN - AUTOMATED_MTTR_MIN


def _passed_failed(key: list[str], results: DataFrame, count_name: str) -> DataFrame:
    return results.groupBy(*key).agg(
        F.count(F.lit(1)).alias(count_name),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def summary_by_dataset(results: DataFrame) -> DataFrame:
    """``dataset, total_checks, passed, failed`` ordered by dataset (A4)."""
    return _passed_failed(["dataset"], results, "total_checks").orderBy("dataset")


def failed_checks(results: DataFrame) -> DataFrame:
    """Failed rows, newest first (T2); ties broken by key for a stable order."""
    return (
        results.where(~F.col("passed"))
        .select("dataset", "partition", "check_name", "metric_value", "threshold", "timestamp")
        .orderBy(F.col("timestamp").desc(), "dataset", "partition", "check_name")
    )


def failed_projection(results: DataFrame) -> DataFrame:
    """The run report's failed-check listing."""
    return failed_checks(results).select("dataset", "partition", "check_name", "metric_value")


def recent_results(results: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recent result rows (T1): a top-k, not a full sort."""
    return (
        results.select("dataset", "partition", "check_name", "passed", "metric_value", "timestamp", "run_id")
        .orderBy(F.col("timestamp").desc(), F.col("partition").desc(), "dataset", "check_name", "run_id")
        .limit(n)
    )


def checkpoint_listing(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints ordered by dataset."""
    return checkpoints.select("dataset", "last_checked_partition", "last_check_time").orderBy("dataset")


def run_impact(results: DataFrame) -> DataFrame:
    """Failed checks and hours saved ``(failed * 105) // 60``."""
    failed = F.count_if(~F.col("passed"))
    return results.agg(
        failed.alias("failed_checks"),
        F.floor(failed * F.lit(SAVED_PER_INCIDENT_MIN) / F.lit(60)).cast("bigint").alias("hours_saved"),
    )


def scale_metrics(results: DataFrame) -> DataFrame:
    """Checks, distinct datasets, distinct partition names across datasets."""
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_distinct("dataset").alias("datasets_checked"),
        F.count_distinct("partition").alias("partitions_checked"),
    )


def row_estimates(results: DataFrame) -> DataFrame:
    """Distinct partitions per dataset and estimated rows.

    ``estimated_rows`` uses the fixed rows-per-partition constants; the
    ``measured_rows`` column sums the volume metric of the latest result of
    each partition instead, which needs no constant.
    """
    const = F.create_map(*[x for k, v in ROWS_PER_PARTITION.items() for x in (F.lit(k), F.lit(v))])
    volume = F.col("check_name") == "volume_check"
    per = results.groupBy("dataset", "partition").agg(
        F.max_by("metric_value", F.when(volume, F.struct("timestamp", "run_id"))).alias("__rows"))
    out = per.groupBy("dataset").agg(
        F.count("partition").alias("partitions"), F.sum(F.col("__rows").cast("bigint")).alias("measured_rows"))
    rpp = F.element_at(const, F.col("dataset"))
    return out.select(
        "dataset",
        "partitions",
        F.coalesce(rpp, F.lit(0)).cast("bigint").alias("rows_per_partition"),
        (F.col("partitions") * F.coalesce(rpp, F.lit(0))).cast("bigint").alias("estimated_rows"),
        F.coalesce("measured_rows", F.lit(0)).cast("bigint").alias("measured_rows"),
    )


def total_rows(results: DataFrame) -> DataFrame:
    """Estimated and measured rows over all datasets."""
    return row_estimates(results).agg(
        F.coalesce(F.sum("estimated_rows"), F.lit(0)).alias("estimated_rows"),
        F.coalesce(F.sum("measured_rows"), F.lit(0)).alias("measured_rows"))


def detection_metrics(results: DataFrame) -> DataFrame:
    """Failures, failure rate in %, distinct failed ``dataset/partition``."""
    failed = ~F.col("passed")
    return results.agg(
        F.count_if(failed).alias("issues_detected"),
        F.count_distinct(F.when(failed, F.concat("dataset", F.lit("/"), "partition"))).alias("affected_partitions"),
        (safe_ratio(F.count_if(failed), F.count(F.lit(1))) * F.lit(100.0)).alias("failure_rate_pct"),
    )


def impact_metrics(results: DataFrame) -> DataFrame:
    """Time saved over the affected partitions (A10)."""
    d = detection_metrics(results)
    saved = F.col("affected_partitions") * F.lit(SAVED_PER_INCIDENT_MIN)
    return d.select(
        F.lit(MANUAL_MTTR_MIN).alias("manual_mttr_min"),
        F.lit(AUTOMATED_MTTR_MIN).alias("automated_mttr_min"),
        F.lit(SAVED_PER_INCIDENT_MIN).alias("saved_per_incident_min"),
        saved.cast("bigint").alias("total_saved_min"),
        (saved / F.lit(60.0)).alias("total_saved_hours"),
        F.lit((MANUAL_MTTR_MIN - AUTOMATED_MTTR_MIN) / MANUAL_MTTR_MIN * 100).alias("mttr_reduction_pct"),
    )


def type_breakdown(results: DataFrame) -> DataFrame:
    """Checks / passed / failed per check type, most frequent first (A5)."""
    return _passed_failed(["check_type"], results, "count").orderBy(F.col("count").desc(), "check_type")


def profile(
    df: DataFrame,
    partition_col: str = "dt",
    key: str = "product_id",
    amount: str = "amount",
    partitions: list[str] | None = None,
) -> DataFrame:
    """One-pass data profile of a dataset.

    Partition count and range (from the directory listing when ``partitions``
    is given, so empty partitions count), column list, NULLs per column, key
    and amount range, total rows: one aggregate, one scan.
    """
    cols = df.columns
    if partitions is not None:
        parts = sorted(partitions)
        head = [
            F.lit(len(parts)).cast("bigint").alias("n_partitions"),
            F.lit(parts[0] if parts else None).cast("string").alias("first_partition"),
            F.lit(parts[-1] if parts else None).cast("string").alias("last_partition"),
        ]
    else:
        head = [
            F.count_distinct(partition_col).alias("n_partitions"),
            F.min(partition_col).alias("first_partition"),
            F.max(partition_col).alias("last_partition"),
        ]
    aggs = head + [
        F.lit(len(cols)).alias("n_columns"),
        F.lit(", ".join(cols)).alias("columns"),
    ]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols]
    aggs += [
        F.min(key).alias(f"min_{key}"),
        F.max(key).alias(f"max_{key}"),
        F.min(amount).alias(f"min_{amount}"),
        F.max(amount).alias(f"max_{amount}"),
        F.count(F.lit(1)).alias("total_rows"),
    ]
    return df.agg(*aggs)


# --- report bundles: one DataFrame per section ------------------------------
def run_report(results: DataFrame) -> dict[str, DataFrame]:
    """Q1: the run report (summary by dataset, failed checks, impact)."""
    return {
        "summary": summary_by_dataset(results),
        "failed": failed_projection(results),
        "impact": run_impact(results),
    }


def results_report(results: DataFrame, checkpoints: DataFrame, recent: int = 10) -> dict[str, DataFrame]:
    """Q2: the results report (summary, checkpoints, most recent, failed)."""
    return {
        "summary": summary_by_dataset(results),
        "checkpoints": checkpoint_listing(checkpoints),
        "recent": recent_results(results, recent),
        "failed": failed_checks(results),
    }


def metrics_report(results: DataFrame) -> dict[str, DataFrame]:
    """Q3: system metrics (scale, rows, detection, impact, check-type mix)."""
    return {
        "scale": scale_metrics(results),
        "rows": row_estimates(results),
        "detection": detection_metrics(results),
        "impact": impact_metrics(results),
        "types": type_breakdown(results),
    }
