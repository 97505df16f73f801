"""Checks on a partitioned directory, each partition under its own schema; isolation of failures.

``check_partitions`` groups the partitions by schema and evaluates one fused
aggregate for each group, so a partition whose column type drifted, or which
lacks a column, is checked with what it has: a check on a column that it lacks
becomes an error row there and nowhere else.  A partition that cannot be read gets
error rows for all checks; it is never treated as empty.

Null-rate and volume checks take row and null counts from the footers that the grouping has read
(``tideline.sources.footers``), and read no data; only partitions with a file that lacks the
statistics, and the other checks, scan the columns they need.

``isolated`` evaluates a plan that failed at run time piece by piece, until
only the (check, partition) pairs at fault are left; these become error rows.
For b bad pairs of n partitions and k checks it takes some ``k + 2 * b * log2(n)`` jobs, in ``2 + log2(n)`` rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.checks import Check, NullRateCheck, VolumeCheck
from tideline.plans.failures import DataError, tried
from tideline.plans.fused import N, agg_name, check_results, error_results
from tideline.session import materialize
from tideline.sources.datasets import read_group, schema_groups, widest
from tideline.sources.footers import counts
from tideline.sources.store import RESULT_SCHEMA


def check_partitions(
    spark: SparkSession, path: str, checks: Sequence[Check], *, dataset: str, partitions: Sequence[str], run_id: str,
    run_ts=None, partition_col: str = "dt",
) -> DataFrame:
    """Results of every check on every named partition of the directory ``path``."""
    found = schema_groups(spark, path, list(partitions), partition_col)
    quick = [c for c in checks if type(c) in (NullRateCheck, VolumeCheck)]  # row and null counts say it all
    options = {"dataset": dataset, "run_id": run_id, "run_ts": run_ts, "partition_col": partition_col}
    pieces = []
    for schema, values in found.groups:
        known = _from_footers(found.footers, schema, quick, values) if quick else None
        scanned = [(checks, values)]
        if known is not None:
            stats, told = known
            df = read_group(spark, path, schema, told, partition_col)  # for its schema
            pieces.append(check_results(df, quick, partitions=told, aggregated=stats.withColumnRenamed("partition", partition_col), **options))
            left = [v for v in values if v not in set(told)]
            scanned = [([c for c in checks if c not in quick], told), (checks, left)]
        pieces += [check_results(read_group(spark, path, schema, some, partition_col), which, partitions=some, **options)
                   for which, some in scanned if which and some]
    if found.empty:  # no files: the columns are those of the other partitions, or else those that the checks name
        schema = widest([s for s, _ in found.groups])
        fields = schema.fields or [T.StructField(c, T.StringType()) for c in sorted({c for x in checks for c in x.columns()})]
        none = spark.createDataFrame([], T.StructType([*fields, T.StructField(partition_col, T.StringType())]))
        pieces.append(check_results(none, checks, partitions=found.empty, **options))
    if found.unreadable:
        pieces.append(error_results(spark, checks, dataset=dataset, partitions=found.unreadable, run_id=run_id, run_ts=run_ts))
    if not pieces:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out


def _from_footers(footers: DataFrame | None, schema: T.StructType, checks: Sequence[Check], values: Sequence[str]):
    """The aggregates of ``checks`` from the statistics in the footers, and the partitions that have them all."""
    if footers is None:
        return None
    columns = sorted({c.column for c in checks if isinstance(c, NullRateCheck) and c.column in schema.fieldNames()})
    stats = counts(footers.where(F.col("partition").isin(list(values))), columns)
    told = {r[0] for r in stats.dropna().select("partition").collect()}  # partition names
    if not told:
        return None
    nulls = [F.col(f"nulls_{columns.index(c.column)}").alias(agg_name(i, "nulls")) for i, c in enumerate(checks)
             if isinstance(c, NullRateCheck) and c.column in columns]
    return stats.select("partition", F.col("rows").alias(N), *nulls), [v for v in values if v in told]


def isolated(
    make: Callable[[Sequence[Check], Sequence[str]], DataFrame], checks: Sequence[Check], values: Sequence[str],
    error: Callable[[Sequence[Check], Sequence[str]], DataFrame], parallel: int = 8,
) -> list[DataFrame]:
    """Written results of ``make(checks, values)`` in pieces, with error rows for the pairs that fail.

    Group testing: what fails is cut by check, then by halves of its partitions; the
    pieces of a round are tested at a time, in a scheduler pool of their own.  A failure
    of the cluster is tried again and then raised (``plans.failures``); it makes no error rows.
    """

    def test(piece) -> DataFrame | None:
        which, some = piece

        def write():
            df = make(which, some)
            df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", "isolation")
            return materialize(df, "isolated")

        try:
            return tried(write)
        except DataError:
            return None

    out: list[DataFrame] = []
    todo = [(list(checks), list(values))] if checks and values else []
    with ThreadPoolExecutor(parallel) as pool:
        while todo:
            cut = []
            for (which, some), got in zip(todo, pool.map(test, todo)):
                if got is not None:
                    out.append(got)
                elif len(which) > 1:
                    cut += [([c], some) for c in which]
                elif len(some) > 1:
                    half = len(some) // 2
                    cut += [(which, some[:half]), (which, some[half:])]
                else:
                    out.append(error(which, some))
            todo = cut
    return out
