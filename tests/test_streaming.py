"""Streaming incremental checks: new and late partitions, one result set per batch."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.checks import ExpressionCheck, NullRateCheck, ReferentialCheck, VolumeCheck
from tideline.plans.fused import check_results
from tideline.sources.store import ResultStore
from tideline.streaming import stream_checks
from tideline.streaming.incremental import add_counts, state_table

SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("dt", T.StringType()),
])


def _write(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").partitionBy("dt").parquet(root)


def test_stream_checks_picks_up_new_and_late_partitions(spark, tmp_root):
    data, store = f"{tmp_root}/orders", ResultStore(spark, f"{tmp_root}/store")
    checks = [NullRateCheck("product_id", 0.0), VolumeCheck(1, 5)]
    kw = dict(dataset="orders", store=store, checkpoint_location=f"{tmp_root}/ckpt")
    _write(spark, data, [(1, 1, 1.0, "2024-01-02"), (2, None, 1.0, "2024-01-02"), (3, 3, 1.0, "2024-01-03")])
    stream_checks(spark, data, SCHEMA, checks, **kw)
    first = {(r.partition, r.check_name): r for r in store.results().collect()}
    assert first[("2024-01-02", "null_rate_product_id")].metric_value == 0.5
    assert first[("2024-01-03", "volume_check")].passed
    # a late partition below the last checked one is still picked up
    _write(spark, data, [(4, 4, 1.0, "2024-01-01")])
    stream_checks(spark, data, SCHEMA, checks, **kw)
    parts = {r.partition for r in store.results().collect()}
    assert parts == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert store.results().count() == 6
    assert {r.dataset for r in store.checkpoints().collect()} == {"orders"}


def test_a_partition_in_three_batches_ends_with_the_rows_of_a_batch_run(spark, tmp_root):
    """Counts add up over batches; a check that cannot be added up reads the partition whole."""
    data, store = f"{tmp_root}/orders", ResultStore(spark, f"{tmp_root}/store")
    keys = spark.createDataFrame([(1,), (2,)], "product_id long")
    top = ExpressionCheck(name="max_id", check_type="max", aggs={"m": F.max("order_id")}, metric=lambda agg, n: agg("m"),
                          passes=lambda m: m < F.lit(100.0), needs=("order_id",))
    checks = [NullRateCheck("product_id", 0.3), VolumeCheck(5, 6), ReferentialCheck("product_id", keys), top]
    kw = dict(dataset="orders", store=store, checkpoint_location=f"{tmp_root}/ckpt", run_prefix="s", run_ts="2024-02-01 00:00:00")
    batches = [
        [(1, 1, 1.0, "2024-01-01"), (2, None, 1.0, "2024-01-01")],
        [(3, 2, 1.0, "2024-01-01"), (4, 2, 1.0, "2024-01-01"), (7, 9, 1.0, "2024-01-02")],
        [(500, 1, 1.0, "2024-01-01")],
    ]
    seen = []
    for rows in batches:
        _write(spark, data, rows)
        stream_checks(spark, data, SCHEMA, checks, **kw)
        seen.append({r.metric_value for r in store.results().where("partition = '2024-01-01' and check_name = 'volume_check'").collect()})
    assert seen == [{2.0}, {4.0}, {5.0}]
    got = sorted((tuple(r) for r in store.results().drop("run_id").collect()), key=repr)
    whole = check_results(spark.read.schema(SCHEMA).parquet(data), checks, dataset="orders", run_id="b", run_ts="2024-02-01 00:00:00")
    assert got == sorted((tuple(r) for r in whole.drop("run_id").collect()), key=repr)
    assert {(r.partition, r.run_id) for r in store.results().collect()} == {("2024-01-01", "s-0"), ("2024-01-02", "s-1")}


def test_a_replayed_batch_counts_once(spark, tmp_root):
    store = ResultStore(spark, f"{tmp_root}/store")
    state = state_table(store)
    counts = spark.createDataFrame([("p", 3, 1), (None, 2, 0)], "dt string, __n long, __c0_nulls long")
    for batch_id in (0, 1, 1):
        got = add_counts(state, counts, dataset="d", stream="q", batch_id=batch_id, partition_col="dt")
    assert sorted(map(tuple, got.collect()), key=repr) == [("p", 0, 6, 2), (None, 0, 4, 0)]
    anew = add_counts(state, counts, dataset="d", stream="another", batch_id=0, partition_col="dt")
    assert sorted(map(tuple, anew.collect()), key=repr) == [("p", 0, 3, 1), (None, 0, 2, 0)]
