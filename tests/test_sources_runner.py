"""Partition discovery, tolerant reads, result store and incremental runs."""

import pytest
from pyspark.sql import functions as F

from tideline.operators.checks import ExpressionCheck, NullRateCheck, ReferentialCheck, VolumeCheck
from tideline.plans.runner import DatasetSpec, QualityRunner
from tideline.sources.datasets import read_dataset
from tideline.sources.partitions import list_partitions
from tideline.sources.store import RESULT_SCHEMA, ResultStore


def _write(spark, root, rows, schema="order_id long, product_id long, amount double, dt string"):
    spark.createDataFrame(rows, schema).write.mode("append").partitionBy("dt").parquet(root)


def _mkdir(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def test_listing_keeps_empty_dirs_and_skips_backups(spark, tmp_root):
    _write(spark, tmp_root, [(1, 1, 1.0, "2024-01-01"), (2, 1, 1.0, "2024-01-02")])
    _mkdir(spark, f"{tmp_root}/dt=2024-01-03")
    spark.createDataFrame([(9, 9, 9.0)], "order_id long, product_id long, amount double").write.parquet(
        f"{tmp_root}/dt=2024-01-02.backup")
    assert list_partitions(spark, tmp_root) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    df = read_dataset(spark, tmp_root)
    assert dict(df.schema.fields and [(f.name, f.dataType.simpleString()) for f in df.schema.fields])["dt"] == "string"
    assert sorted(r.order_id for r in df.collect()) == [1, 2]  # the backup copy is not read


def test_tolerant_read_unions_drifted_partitions(spark, tmp_root):
    _write(spark, tmp_root, [(1, 5, 1.0, "2024-01-01")])
    # the same column stored as double in one partition (what a null injection through pandas does)
    spark.createDataFrame([(2, None, 2.0)], "order_id long, product_id double, amount double").write.parquet(
        f"{tmp_root}/dt=2024-01-02")
    df = read_dataset(spark, tmp_root, tolerant=True)
    got = sorted((r.order_id, r.product_id, r.dt) for r in df.collect())
    assert got == [(1, 5, "2024-01-01"), (2, None, "2024-01-02")]
    assert df.schema["product_id"].dataType.simpleString() == "double"  # the wider of the two


def test_incremental_runs_watermark_and_late_partitions(spark, tmp_root):
    data = f"{tmp_root}/orders"
    store = ResultStore(spark, f"{tmp_root}/store")
    checks = [NullRateCheck("product_id", 0.0), VolumeCheck(1, 2)]
    _write(spark, data, [(1, 1, 1.0, "2024-01-01"), (2, None, 1.0, "2024-01-02")])

    def spec():
        return DatasetSpec("orders", read_dataset(spark, data), checks, partitions=list_partitions(spark, data))

    runner = QualityRunner(spark, store)
    out = runner.run([spec()], run_id="r1", run_ts="2024-02-01 00:00:00")
    s = out.summary.collect()[0]
    assert (s.total_checks, s.passed, s.failed) == (4, 3, 1)
    assert store.checkpoints().collect()[0].last_checked_partition == "2024-01-02"

    # nothing new -> the dataset is skipped
    assert runner.run([spec()], run_id="r2").skipped == ["orders"]

    # a new partition above the mark and a late one below it
    _write(spark, data, [(3, 3, 1.0, "2024-01-03"), (4, 4, 1.0, "2024-01-00")])
    out3 = runner.run([spec()], run_id="r3", run_ts="2024-02-03 00:00:00")
    assert {r.partition for r in out3.results.collect()} == {"2024-01-03"}
    late = QualityRunner(spark, store, mode="anti").run([spec()], run_id="r4")
    assert {r.partition for r in late.results.collect()} == {"2024-01-00"}

    # re-running with the same run_id replaces its own rows (idempotent retry)
    runner2 = QualityRunner(spark, store, mode="anti")
    before = store.results().count()
    store.save_results(out3.results.withColumn("metric_value", F.lit(7.0)))
    assert store.results().count() == before
    assert {r.metric_value for r in store.results().where("run_id = 'r3'").collect()} == {7.0}
    assert runner2 is not None


def test_diagnosis_is_lazy_and_optional(spark):
    df = spark.createDataFrame([(1, None, 1.0, "d")], "order_id long, product_id long, amount double, dt string")
    spec = DatasetSpec("orders", df, [NullRateCheck("product_id", 0.0)])
    off = QualityRunner(spark, enable_diagnostics=False).run([spec], run_id="x")
    assert off.analysis is None


def test_tolerant_read_limited_to_requested_partitions(spark, tmp_root):
    _write(spark, tmp_root, [(1, 5, 1.0, "2024-01-01"), (3, 6, 1.0, "2024-01-03")])
    spark.createDataFrame([(2, None, 2.0)], "order_id long, product_id double, amount double").write.parquet(
        f"{tmp_root}/dt=2024-01-02")
    df = read_dataset(spark, tmp_root, tolerant=True, partitions=["2024-01-02", "2024-01-03"])
    assert sorted(r.order_id for r in df.collect()) == [2, 3]
    plain = read_dataset(spark, tmp_root, partitions=["2024-01-01"])
    assert [r.order_id for r in plain.collect()] == [1]


def test_unreadable_partition_yields_error_rows_not_a_failed_run(spark, tmp_root):
    data = f"{tmp_root}/orders"
    _write(spark, data, [(1, 1, 1.0, "2024-01-01"), (2, 2, 1.0, "2024-01-02")])
    _mkdir(spark, f"{data}/dt=2024-01-03")
    with open(f"{data}/dt=2024-01-03/part-corrupt.parquet".replace("file:", ""), "wb") as fh:
        fh.write(b"this is not parquet")
    store = ResultStore(spark, f"{tmp_root}/store")
    spec = DatasetSpec("orders", read_dataset(spark, data), [NullRateCheck("product_id", 0.0), VolumeCheck(1, 5)],
                       partitions=list_partitions(spark, data))
    out = QualityRunner(spark, store).run([spec], run_id="r")
    rows = {(r.partition, r.check_name): r for r in out.results.collect()}
    assert rows[("2024-01-01", "volume_check")].passed
    assert rows[("2024-01-03", "volume_check")].metric_value == -1.0
    assert rows[("2024-01-03", "null_rate_product_id")].threshold == "0.0"
    assert not rows[("2024-01-03", "volume_check")].passed


def test_generate_revenue_job_and_report_bundles(spark, tmp_root):
    from tideline.operators.reports import metrics_report, results_report, run_report
    from tideline.operators.rollup import generate_revenue

    src, out = f"{tmp_root}/orders", f"{tmp_root}/revenue"
    _write(spark, src, [(1, 1, 2.5, "2024-01-01"), (2, 1, 1.25, "2024-01-01"), (3, None, 4.0, "2024-01-02")])
    assert generate_revenue(spark, src, out) == 2
    rev = {(r.dt, r.product_id): (r.total_revenue, r.order_count) for r in read_dataset(spark, out).collect()}
    assert rev == {("2024-01-01", 1): (3.75, 2), ("2024-01-02", None): (4.0, 1)}
    store = ResultStore(spark, f"{tmp_root}/store")
    out_run = QualityRunner(spark, store).run(
        [DatasetSpec("orders", read_dataset(spark, src), [NullRateCheck("product_id", 0.0)])], run_id="r")
    rep = run_report(out_run.results)
    assert rep["impact"].collect()[0].failed_checks == 1
    rr = results_report(store.results(), store.checkpoints())
    assert rr["checkpoints"].collect()[0].last_checked_partition == "2024-01-02"
    assert metrics_report(store.results())["scale"].collect()[0].total_checks == 2


def test_new_partitions_frame_api(spark):
    from tideline.sources.partitions import new_partitions, partitions_frame, partitions_of
    from tideline.sources.store import CHECKPOINT_SCHEMA

    parts = partitions_frame(spark, ["2024-01-01", "2024-01-02", "2024-01-03"])
    empty = spark.createDataFrame([], CHECKPOINT_SCHEMA)
    assert [r.dt for r in new_partitions(parts, empty, "orders").collect()] == ["2024-01-01", "2024-01-02",
                                                                               "2024-01-03"]
    cps = spark.createDataFrame([("orders", "2024-01-02", None), ("other", "2024-01-03", None)],
                                "dataset string, last_checked_partition string, last_check_time timestamp_ntz")
    assert [r.dt for r in new_partitions(parts, cps, "orders").collect()] == ["2024-01-03"]
    checked = spark.createDataFrame([("orders", "2024-01-01"), ("orders", "2024-01-03")],
                                    "dataset string, partition string")
    late = new_partitions(parts, cps, "orders", mode="anti", checked=checked)
    assert [r.dt for r in late.collect()] == ["2024-01-02"]
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-05",)], "dt string")
    assert sorted(r.dt for r in partitions_of(df, extra=["2024-01-06"]).collect()) == ["2024-01-05", "2024-01-06"]


def _corrupt(spark, path):
    spark.createDataFrame([("this is not parquet",)], "value string").write.text(path)


def test_tolerant_read_never_narrows_or_drops(spark, tmp_root):
    spark.createDataFrame([(1, 5)], "order_id int, product_id long").write.parquet(f"{tmp_root}/dt=2024-01-01")
    spark.createDataFrame([(2, 1.75, 0.5)], "order_id long, product_id double, amount double").write.parquet(f"{tmp_root}/dt=2024-01-02")
    _mkdir(spark, f"{tmp_root}/dt=2024-01-03")  # no files: an empty partition, no rows
    df = read_dataset(spark, tmp_root, tolerant=True)
    got = sorted((r.order_id, r.product_id, r.amount, r.dt) for r in df.collect())
    assert got == [(1, 5.0, None, "2024-01-01"), (2, 1.75, 0.5, "2024-01-02")]
    _corrupt(spark, f"{tmp_root}/dt=2024-01-04")
    with pytest.raises(ValueError, match="2024-01-04"):
        read_dataset(spark, tmp_root, tolerant=True)
    assert read_dataset(spark, tmp_root, tolerant=True, partitions=["2024-01-01", "2024-01-02"]).count() == 2


def test_each_partition_under_its_own_schema(spark, tmp_root):
    """Type drift, an absent column, no files and a corrupt file, through the runner."""
    data = f"{tmp_root}/orders"
    spark.createDataFrame([(1, 5, 1.0)], "order_id long, product_id long, amount double").write.parquet(f"{data}/dt=2024-01-01")
    spark.createDataFrame([(2, None, 2.0), (3, 5.0, 2.0)], "order_id long, product_id double, amount double").write.parquet(
        f"{data}/dt=2024-01-02")
    spark.createDataFrame([(4, 5)], "order_id long, product_id long").write.parquet(f"{data}/dt=2024-01-03")
    _mkdir(spark, f"{data}/dt=2024-01-04")
    _corrupt(spark, f"{data}/dt=2024-01-05")
    ref = spark.createDataFrame([(5,)], "product_id long")
    checks = [NullRateCheck("product_id", 0.3), NullRateCheck("amount", 0.0), VolumeCheck(1, 5), ReferentialCheck("product_id", ref)]
    store = ResultStore(spark, f"{tmp_root}/store")
    out = QualityRunner(spark, store).run([DatasetSpec("orders", None, checks, path=data)], run_id="r")
    got = {(r.partition[-2:], r.check_name): (r.metric_value, r.passed) for r in out.results.collect()}
    assert len(got) == 20
    assert got["02", "null_rate_product_id"] == (0.5, False) and got["02", "ref_integrity_product_id"] == (0.5, False)
    assert got["03", "null_rate_amount"] == (-1.0, False) and got["03", "null_rate_product_id"] == (0.0, True)
    assert got["04", "volume_check"] == (0.0, False) and got["04", "null_rate_amount"] == (0.0, True)
    assert {got["05", c.name] for c in checks} == {(-1.0, False)}  # never a pass for what was not read
    assert {got["01", c.name][1] for c in checks} == {True}


def test_failures_stay_with_their_check_dataset_and_partition(spark, tmp_root):
    good = spark.createDataFrame([(1, 1, "a"), (2, None, "b")], "id long, product_id long, dt string")
    text = F.when(F.col("dt") == "b", F.lit("x")).otherwise(F.lit("7"))
    failing = ExpressionCheck(name="sum", check_type="custom", aggs={"s": F.sum(text.cast("bigint"))},
                              metric=lambda agg, n: agg("s"), passes=lambda m: m > 0, needs=("dt",))
    _corrupt(spark, f"{tmp_root}/ref")
    unreadable = spark.read.schema("product_id long").parquet(f"{tmp_root}/ref")
    checks = [failing, NullRateCheck("product_id", 0.5), ReferentialCheck("product_id", unreadable)]
    store = ResultStore(spark, f"{tmp_root}/store")
    out = QualityRunner(spark, store).run(
        [DatasetSpec("one", good, checks), DatasetSpec("two", good, [VolumeCheck(1, 1)])], run_id="r")
    got = {(r.dataset, r.partition, r.check_name): r.metric_value for r in out.results.collect()}
    assert got == {("one", "a", "sum"): 7.0, ("one", "b", "sum"): -1.0, ("one", "a", "null_rate_product_id"): 0.0,
                   ("one", "b", "null_rate_product_id"): 1.0, ("one", "a", "ref_integrity_product_id"): -1.0,
                   ("one", "b", "ref_integrity_product_id"): -1.0, ("two", "a", "volume_check"): 1.0, ("two", "b", "volume_check"): 1.0}


def test_check_names_must_differ(spark):
    df = spark.createDataFrame([(1, "a")], "id long, dt string")
    with pytest.raises(ValueError, match="null_rate_id"):
        QualityRunner(spark).run([DatasetSpec("d", df, [NullRateCheck("id", 0.0), NullRateCheck("id", 0.1)])])


def test_broadcast_sides_are_bounded_together(spark, tmp_root):
    from tideline.plans.broadcast import at_most, fitting, measure

    assert fitting([(10, 100), (5, 50), (7, 900)], 20, 1000) == {1, 2}
    assert fitting([(10, 100), (5, 950)], 20, 1000) == {1}
    assert fitting([(1, 0)], 0, 10) == set()
    path = f"{tmp_root}/ref"
    spark.range(5).coalesce(1).write.parquet(path)
    assert at_most(spark.read.parquet(path), 10)
    spark.range(500).coalesce(1).write.mode("overwrite").parquet(path)  # rewritten in place
    assert not at_most(spark.read.parquet(path), 10)
    assert measure(spark.read.parquet(path), 10)[0] == 11


def test_three_large_references_cost_one_further_scan(spark, tmp_root):
    from tideline.plans.fused import check_results

    spark.createDataFrame([(1, 2.0, "x", "a"), (5, -0.0, None, "a"), (5, 9.0, "y", None)],
                          "k1 int, k2 double, k3 string, dt string").write.parquet(f"{tmp_root}/fact")
    fact = spark.read.parquet(f"{tmp_root}/fact")
    refs = [spark.createDataFrame([(v,) for v in values], f"k {kind}") for kind, values in (
        ("long", [1, 2]), ("int", [2, 0]), ("string", ["x", "y", "y"]))]
    checks = [ReferentialCheck(f"k{i + 1}", r, "k") for i, r in enumerate(refs)]
    out = [check_results(fact, checks, dataset="d", run_id="r", run_ts="2024-01-01 00:00:00", broadcast_rows=n) for n in (0, None)]
    rows = [sorted((str(r.partition), r.check_name, r.metric_value) for r in o.collect()) for o in out]
    assert rows[0] == rows[1]
    assert dict(((p, c), m) for p, c, m in rows[0])["a", "ref_integrity_k2"] == 0.0  # -0.0 is 0, 2.0 is 2
    assert dict(((p, c), m) for p, c, m in rows[0])["None", "ref_integrity_k2"] == 1.0
    plan = out[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2


def test_batch_and_stream_versions_share_one_order(spark, tmp_root):
    store = ResultStore(spark, f"{tmp_root}/store")
    row = spark.createDataFrame([("r", "d", "p", "c", "t", True, 1.0, "N/A", None)], RESULT_SCHEMA)
    store.save_results(row)
    store.save_results(row.withColumn("metric_value", F.lit(2.0)))
    assert [r.metric_value for r in store.results().collect()] == [2.0]


def test_scratch_folders_can_be_dropped(spark):
    from tideline.session import drop_scratch, materialize, scratch_dir, scratch_folders

    others = tuple(scratch_folders(spark))  # tables of other tests in this session
    kept = scratch_dir(spark, "kept")
    spark.range(3).write.parquet(kept)
    table = materialize(spark.range(5), "gone")
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    assert drop_scratch(spark, keep=(*others, kept)) == 1
    assert spark.read.parquet(kept).count() == 3
    assert set(scratch_folders(spark)) == {*others, kept}
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
