"""The fused checks as a Structured Streaming job.

Instead of listing partition directories against a high-water mark, the file
source's own log remembers which files were processed, so a partition that
arrives late (below the mark) is still checked.  Each micro-batch is checked
with the same fused aggregation as a batch run, then appended to the result
store and the checkpoint table.  ``trigger(availableNow=True)`` processes what
is there and stops, which gives a scheduled incremental job; any other
trigger keeps it running.

A partition may arrive in several batches.  What the built-in checks are computed from
(row, null and orphan counts) adds up, so each batch leaves its counts in a *check state*
table, keyed by stream, partition and batch, and the partition is judged by their sum over all batches so
far; only the new files are read.  Checks of other kinds cannot be added up: for these, the
partitions that a batch touches are read whole.

The run id of a partition holds the id of the first batch that delivered it, so each later
verdict replaces the one before, and a partition ends with one row for each check, the rows of a batch run.  A
micro-batch replayed after a failure writes the same keys again, in the state and in the
results; the latest-version reads keep one copy.  The state belongs to the query id that Spark keeps in
the checkpoint location: a stream begun anew counts anew.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.checks import Check, NullRateCheck, ReferentialCheck, VolumeCheck
from tideline.plans.fused import check_results
from tideline.session import materialize
from tideline.sources.partitions import DATE_PATTERN
from tideline.sources.segments import SegmentTable
from tideline.sources.store import SEQ, ResultStore, checkpoints_from_results, latest_by_key


STATE_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.LongType()),
])
STATE_KEY = ("dataset", "stream", "partition", "batch", "name")


def state_table(store: ResultStore) -> SegmentTable:
    """Counts of each batch, next to the results."""
    return SegmentTable(store.spark, f"{store.root}/check_state", STATE_SCHEMA, STATE_KEY, SEQ, partition_by="dataset")


def add_counts(state: SegmentTable, counts: DataFrame, *, dataset: str, stream: str, batch_id: int, partition_col: str) -> DataFrame:
    """Keep the counts of one batch; returns those of its partitions over all batches, and the ``first`` batch of each."""
    names = [c for c in counts.columns if c != partition_col]
    seq = time.time_ns()
    rows = counts.select(
        F.lit(dataset).alias("dataset"), F.lit(stream).alias("stream"), F.col(partition_col).cast("string").alias("partition"),
        F.lit(batch_id).cast("long").alias("batch"),
        F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("long").alias("value")) for n in names])))
    state.append(rows, seq)
    touched = state.read(seq=seq, values=[dataset]).select(F.col("partition").alias("__touched")).distinct()
    known = latest_by_key(state.read(values=[dataset]).where(F.col("stream") == F.lit(stream)), STATE_KEY, [SEQ])
    mine = known.join(touched, F.col("partition").eqNullSafe(F.col("__touched")), "left_semi")
    return mine.groupBy(F.col("partition").alias(partition_col)).agg(
        F.min("batch").alias("first"), *[F.sum(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])


def stream_checks(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checks: Sequence[Check],
    *,
    dataset: str,
    store: ResultStore,
    checkpoint_location: str,
    partition_col: str = "dt",
    pattern: str | None = DATE_PATTERN,
    run_prefix: str | None = None,
    run_ts=None,
    trigger_available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start (and, with ``availableNow``, finish) a streaming check job.

    ``schema`` must include ``partition_col`` as a string column.  Returns the
    ``StreamingQuery``; with ``availableNow`` it has already terminated.
    """
    prefix = run_prefix or dataset
    reader = spark.readStream.schema(schema).option("basePath", path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(path)
    if pattern:
        src = src.where(F.col(partition_col).rlike(f"^(?:{pattern})$"))

    state = state_table(store)
    added = [c for c in checks if type(c) in (NullRateCheck, VolumeCheck, ReferentialCheck)]
    others = [c for c in checks if c not in added]

    def check_batch(batch: DataFrame, batch_id: int) -> None:
        options = {"dataset": dataset, "run_id": prefix, "run_ts": run_ts, "partition_col": partition_col}
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or prefix
        counts = check_results(batch, added, raw=True, **options)
        totals = materialize(add_counts(state, counts, dataset=dataset, stream=stream, batch_id=batch_id, partition_col=partition_col),
                             "stream-totals")
        results = check_results(batch, added, aggregated=totals.drop("first"), **options) if added else None
        if others:
            touched = [r[0] for r in totals.select(partition_col).collect()]  # partition names
            whole = spark.read.schema(schema).option("basePath", path).parquet(path).where(F.col(partition_col).isin(touched))
            more = check_results(whole, others, **options)
            results = more if results is None else results.unionByName(more)
        first = totals.select(F.col(partition_col).alias("__p"), F.concat(F.lit(f"{prefix}-"), F.col("first")).alias("__run"))
        results = results.join(first, F.col("partition").eqNullSafe(F.col("__p"))).withColumn("run_id", F.col("__run"))
        # versions are ordered by time of writing, as those of batch runs are
        written = store.written(store.save_results(results))
        store.update_checkpoints(checkpoints_from_results(written))

    writer = src.writeStream.foreachBatch(check_batch).option("checkpointLocation", checkpoint_location)
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    q = writer.start()
    if trigger_available_now:
        q.awaitTermination()
    return q
