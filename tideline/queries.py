"""Registered queries: one per operator of the inventory, over the fixtures.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the SQL of the same key in ``tideline.oracle_queries``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.checks import ExpressionCheck, NullRateCheck, ReferentialCheck, VolumeCheck, orphan_rows
from tideline.operators.rollup import MONEY, revenue_rollup, write_revenue
from tideline.plans import fixtures as fx
from tideline.plans.fused import check_results
from tideline.session import scratch_dir
from tideline.sources.datasets import read_dataset, read_partition, read_reference
from tideline.sources.partitions import list_partitions, new_partitions, partitions_frame
from tideline.sources.store import CHECKPOINT_KEY, RESULT_KEY, checkpoints_from_results, upsert

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


# --------------------------------------------------------------------------
# an on-disk, Hive-partitioned copy of ``raw`` (S1-S3 read real directories)
_MATERIALIZED: dict[tuple, str] = {}


def raw_on_disk(spark: SparkSession, sf_dir: str) -> str:
    """Write ``raw`` as ``dt=`` directories once per session, plus an empty
    ``dt=2024-01-31`` directory and a ``dt=2024-01-10.backup`` look-alike."""
    key = (id(spark.sparkContext), spark.sparkContext.applicationId, sf_dir)
    if key in _MATERIALIZED:
        return _MATERIALIZED[key]
    root = scratch_dir(spark, "orders_raw")
    df = fx.raw(spark, sf_dir)
    df.write.mode("overwrite").partitionBy("dt").parquet(root)
    df.where(F.col("dt") == "2024-01-10").drop("dt").write.mode("overwrite").parquet(f"{root}/dt=2024-01-10.backup")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/dt={fx.EMPTY_PARTITION}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    _MATERIALIZED[key] = root
    return root


# --------------------------------------------------------------------------
# S1, S2, S5
@query("scan_all")
def scan_all(spark, sf_dir):
    return read_dataset(spark, raw_on_disk(spark, sf_dir)).select("order_id", "product_id", "amount", "dt")


@query("scan_partition")
def scan_partition(spark, sf_dir):
    return read_partition(spark, raw_on_disk(spark, sf_dir), "2024-01-10").select(
        "order_id", "product_id", "amount", "dt"
    )


@query("scan_reference")
def scan_reference(spark, sf_dir):
    ref = read_reference(spark, f"{sf_dir.rstrip('/')}/customer.parquet")
    return ref.agg(F.count(F.lit(1)).alias("n_products"))


# S3, S9, P6, T4, F5
def _previous_checkpoints(spark, sf_dir):
    """Checkpoints left by a run that stopped after 2024-01-20."""
    done = fx.res(spark, sf_dir).where(F.col("partition") <= "2024-01-20")
    return checkpoints_from_results(done)


@query("new_partitions")
def q_new_partitions(spark, sf_dir):
    root = raw_on_disk(spark, sf_dir)
    parts = partitions_frame(spark, list_partitions(spark, root))
    out = new_partitions(parts, _previous_checkpoints(spark, sf_dir), fx.ORDERS)
    return out.select(F.col("dt").alias("partition"))


@query("new_partitions_late")
def q_new_partitions_late(spark, sf_dir):
    root = raw_on_disk(spark, sf_dir)
    parts = partitions_frame(spark, list_partitions(spark, root))
    checked = fx.res(spark, sf_dir).where(F.col("partition") != "2024-01-05")
    out = new_partitions(parts, _previous_checkpoints(spark, sf_dir), fx.ORDERS, mode="anti", checked=checked)
    return out.select(F.col("dt").alias("partition"))


# C1-C5, J1
def _one(spark, sf_dir, checks, **kw):
    return check_results(fx.bad(spark, sf_dir), checks, dataset=fx.ORDERS, run_id=fx.RUN_ID, run_ts=fx.RUN_TS,
                         extra_partitions=[fx.EMPTY_PARTITION], **kw)


@query("check_null_rate")
def check_null_rate(spark, sf_dir):
    return _one(spark, sf_dir, [NullRateCheck("product_id", 0.05)])


@query("check_volume")
def check_volume(spark, sf_dir):
    return _one(spark, sf_dir, [VolumeCheck(*fx.BAD_VOLUME)])


@query("check_ref_integrity")
def check_ref_integrity(spark, sf_dir):
    return _one(spark, sf_dir, [ReferentialCheck("product_id", fx.ref(spark, sf_dir), "product_id")])


@query("check_ref_integrity_shuffled")
def check_ref_integrity_shuffled(spark, sf_dir):
    """Same check with broadcasting disabled: the pre-aggregated shuffle path."""
    return _one(spark, sf_dir, [ReferentialCheck("product_id", fx.ref(spark, sf_dir), "product_id")], broadcast_rows=0)


@query("orphan_rows")
def q_orphan_rows(spark, sf_dir):
    chk = ReferentialCheck("product_id", fx.ref(spark, sf_dir), "product_id")
    return orphan_rows(fx.bad(spark, sf_dir), chk)


@query("check_error_rows")
def check_error_rows(spark, sf_dir):
    ref = fx.ref(spark, sf_dir)
    checks = [
        NullRateCheck("discount", 0.05),
        VolumeCheck(*fx.BAD_VOLUME),
        ReferentialCheck("customer_id", ref, "product_id"),
        ReferentialCheck("product_id", ref, "sku"),
    ]
    return _one(spark, sf_dir, checks)


def custom_check() -> ExpressionCheck:
    """A user-defined check: share of amounts above 400, at most 25%."""
    return ExpressionCheck(
        name="high_amount_rate",
        check_type="distribution",
        aggs={"high": F.count_if(F.col("amount") > 400)},
        metric=lambda agg, n: F.coalesce(F.try_divide(agg("high").cast("double"), n.cast("double")), F.lit(0.0)),
        passes=lambda m: m <= F.lit(0.25),
        threshold=0.25,
        needs=("amount",),
        counts=("high",),
    )


@query("check_custom")
def check_custom(spark, sf_dir):
    from tideline.operators.rca import explain_failure

    out = _one(spark, sf_dir, [custom_check()])
    return out.withColumn("explanation", explain_failure())


@query("check_empty_partition")
def check_empty_partition(spark, sf_dir):
    checks = fx.order_checks(fx.ref(spark, sf_dir))
    return check_results(fx.bad(spark, sf_dir), checks, dataset=fx.ORDERS, run_id=fx.RUN_ID, run_ts=fx.RUN_TS,
                         partitions=["2024-01-30", fx.EMPTY_PARTITION])


@query("check_all_fused")
def check_all_fused(spark, sf_dir):
    return fx.bad_results(spark, sf_dir)


# A3, S4
@query("revenue_rollup")
def q_revenue_rollup(spark, sf_dir):
    return fx.rev(spark, sf_dir)


@query("revenue_sink_roundtrip")
def revenue_sink_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "revenue_daily")
    write_revenue(fx.rev(spark, sf_dir), path)
    return read_dataset(spark, path).select("dt", "product_id", "total_revenue", "order_count")


# S7, S8, S10, W2
@query("results_upsert")
def results_upsert(spark, sf_dir):
    """Run 1 over the faulty data, then the same run_id re-checks days >= 01-15
    of the clean data: the later rows replace the earlier ones key by key."""
    first = fx.res(spark, sf_dir)
    again = fx.bad_results(spark, sf_dir, fx.RUN_ID, fx.RUN2_TS, source=fx.raw(spark, sf_dir)).where(
        F.col("partition") >= "2024-01-15"
    )
    return upsert(first, again, RESULT_KEY)


@query("checkpoint_upsert")
def checkpoint_upsert(spark, sf_dir):
    first = checkpoints_from_results(fx.res(spark, sf_dir).where(F.col("partition") <= "2024-01-20"))
    second = checkpoints_from_results(
        fx.res_two_runs(spark, sf_dir).where((F.col("run_id") == fx.RUN2_ID))
    )
    return upsert(first, second, CHECKPOINT_KEY)


# --------------------------------------------------------------------------
# runs
def _specs(spark, sf_dir, bad_df=None, rev_df=None, rev_volume=fx.REV_VOLUME, extra=(fx.EMPTY_PARTITION,)):
    from tideline.plans.runner import DatasetSpec

    b = fx.bad(spark, sf_dir) if bad_df is None else bad_df
    r = revenue_rollup(b, money_type=MONEY) if rev_df is None else rev_df
    return [
        DatasetSpec(fx.ORDERS, b, fx.order_checks(fx.ref(spark, sf_dir)), extra_partitions=list(extra)),
        DatasetSpec(fx.REVENUE, r, fx.revenue_checks(rev_volume)),
    ]


@query("run_all_datasets")
def run_all_datasets(spark, sf_dir):
    from tideline.plans.runner import QualityRunner

    results, _ = QualityRunner(spark).plan(_specs(spark, sf_dir), fx.RUN_ID, fx.RUN_TS)
    return results


@query("run_summary")
def q_run_summary(spark, sf_dir):
    from tideline.plans.runner import QualityRunner

    return QualityRunner(spark).run(_specs(spark, sf_dir), fx.RUN_ID, fx.RUN_TS).summary


@query("run_without_diagnostics")
def run_without_diagnostics(spark, sf_dir):
    from tideline.plans.runner import QualityRunner

    out = QualityRunner(spark, lineage=None, enable_diagnostics=False).run(_specs(spark, sf_dir), fx.RUN_ID, fx.RUN_TS)
    assert out.analysis is None
    return out.results


@query("run_incremental")
def run_incremental(spark, sf_dir):
    """Two runs against one store: the first sees data up to 2024-01-20, the
    second the full data and checks only the partitions after the mark."""
    from tideline.plans.runner import QualityRunner
    from tideline.sources.store import ResultStore

    store = ResultStore(spark, scratch_dir(spark, "store"))
    runner = QualityRunner(spark, store, fx.reference_lineage(spark))
    early = fx.bad(spark, sf_dir).where(F.col("dt") <= "2024-01-20")
    runner.run(_specs(spark, sf_dir, bad_df=early, extra=()), "run-a", fx.RUN_TS)
    runner.run(_specs(spark, sf_dir), "run-b", fx.RUN2_TS)
    return store.results()


# --------------------------------------------------------------------------
# lineage
@query("lineage_edges")
def lineage_edges(spark, sf_dir):
    g = fx.lineage(spark, sf_dir)
    return g.edges.join(g.datasets.select("dataset", "decl_ord"), "dataset", "left").select(
        "dataset", "upstream", "ord", "decl_ord"
    )


@query("lineage_upstream")
def lineage_upstream(spark, sf_dir):
    from tideline.operators.lineage import direct_upstream

    return direct_upstream(fx.lineage(spark, sf_dir))


@query("lineage_downstream")
def lineage_downstream(spark, sf_dir):
    from tideline.operators.lineage import direct_downstream

    return direct_downstream(fx.lineage(spark, sf_dir))


@query("lineage_all_upstream")
def lineage_all_upstream(spark, sf_dir):
    from tideline.operators.lineage import all_upstream

    return all_upstream(fx.lineage(spark, sf_dir))


@query("lineage_all_downstream")
def lineage_all_downstream(spark, sf_dir):
    from tideline.operators.lineage import all_downstream

    return all_downstream(fx.lineage(spark, sf_dir))


@query("lineage_critical")
def lineage_critical(spark, sf_dir):
    from tideline.operators.lineage import critical_columns

    return critical_columns(fx.lineage(spark, sf_dir))


@query("lineage_listing")
def lineage_listing(spark, sf_dir):
    from tideline.operators.lineage import listing

    return listing(fx.lineage(spark, sf_dir))


@query("lineage_listing_pages")
def lineage_listing_pages(spark, sf_dir):
    from tideline.operators.lineage import listing_pages

    return listing_pages(fx.lineage(spark, sf_dir))


# --------------------------------------------------------------------------
# baselines
def _rounded(b):
    return b.withColumn("baseline_mean", F.round("baseline_mean", 9))


@query("baseline_window")
def baseline_window(spark, sf_dir):
    from tideline.operators.baseline import baseline

    return _rounded(baseline(fx.res(spark, sf_dir)))


@query("baseline_multi_run")
def baseline_multi_run(spark, sf_dir):
    from tideline.operators.baseline import baseline

    return _rounded(baseline(fx.res_two_runs(spark, sf_dir)))


# --------------------------------------------------------------------------
# Root-cause analysis
def _analysis(spark, sf_dir, results=None):
    from tideline.operators.rca import analyze

    res = fx.res(spark, sf_dir) if results is None else results
    return analyze(res, fx.lineage(spark, sf_dir), declared=_declared(spark, sf_dir))


def _declared(spark, sf_dir):
    return {fx.ORDERS: [c.name for c in fx.order_checks(fx.ref(spark, sf_dir))], fx.REVENUE: [c.name for c in fx.revenue_checks()]}


CAUSE_COLS = ["run_id", "dataset", "partition", "cause_dataset", "reason", "confidence", "kind", "upstream_ord",
              "item", "cause_ord", "cause_rank", "band"]


@query("rca_source")
def rca_source(spark, sf_dir):
    return _analysis(spark, sf_dir).causes.where(F.col("kind") == "source").select(*CAUSE_COLS)


@query("rca_upstream")
def rca_upstream(spark, sf_dir):
    return _analysis(spark, sf_dir).causes.where(F.col("kind") == "upstream").select(*CAUSE_COLS)


@query("rca_fallback")
def rca_fallback(spark, sf_dir):
    """Stricter revenue volume: failures on days with a clean upstream give
    baseline-anomaly causes, or self-origin causes when there are none."""
    a = _analysis(spark, sf_dir, fx.res_strict(spark, sf_dir))
    return a.causes.where(F.col("dataset") == fx.REVENUE).select(*CAUSE_COLS)


@query("rca_all")
def rca_all(spark, sf_dir):
    return _analysis(spark, sf_dir, fx.res_two_runs(spark, sf_dir)).causes.select(*CAUSE_COLS)


@query("rca_impact")
def rca_impact(spark, sf_dir):
    return _analysis(spark, sf_dir).impact


@query("rca_recommendations")
def rca_recommendations(spark, sf_dir):
    return _analysis(spark, sf_dir, fx.res_strict(spark, sf_dir)).recommendations


@query("rca_ranked")
def rca_ranked(spark, sf_dir):
    c = _analysis(spark, sf_dir, fx.res_strict(spark, sf_dir)).causes
    return c.select("run_id", "dataset", "partition", "cause_rank", "cause_dataset", "confidence", "band", "reason")


@query("rca_mttr")
def rca_mttr(spark, sf_dir):
    return _analysis(spark, sf_dir, fx.res_strict(spark, sf_dir)).mttr


# --------------------------------------------------------------------------
# Fault injection
@query("inject_null_spike")
def q_inject_null_spike(spark, sf_dir):
    from tideline.operators.inject import inject_null_spike

    return inject_null_spike(fx.raw(spark, sf_dir), "2024-01-10", "product_id", 0.35, key="order_id", how="hash")


@query("inject_volume_drop")
def q_inject_volume_drop(spark, sf_dir):
    from tideline.operators.inject import inject_volume_drop

    return inject_volume_drop(fx.raw(spark, sf_dir), "2024-01-15", 0.25, key="order_id", how="hash")


@query("inject_ref_break")
def q_inject_ref_break(spark, sf_dir):
    from tideline.operators.inject import inject_referential_break

    return inject_referential_break(fx.raw(spark, sf_dir), "2024-01-20", "product_id", 0.18, key="order_id",
                                    missing=fx.MISSING_KEY, how="hash")


@query("inject_scenarios")
def q_inject_scenarios(spark, sf_dir):
    return fx.bad(spark, sf_dir)


@query("inject_exact_fraction")
def q_inject_exact(spark, sf_dir):
    """Exact-count selection: round_half_even(0.35 * n) rows of 2024-01-10 by md5(order_id)."""
    from tideline.operators.inject import inject_null_spike

    return inject_null_spike(fx.raw(spark, sf_dir), "2024-01-10", "product_id", 0.35, key="order_id", how="exact")


# --------------------------------------------------------------------------
# reports
@query("report_summary")
def report_summary(spark, sf_dir):
    from tideline.operators.reports import summary_by_dataset

    return summary_by_dataset(fx.res(spark, sf_dir))


@query("report_failed")
def report_failed(spark, sf_dir):
    from tideline.operators.reports import failed_checks

    return failed_checks(fx.res_two_runs(spark, sf_dir))


@query("report_failed_projection")
def report_failed_projection(spark, sf_dir):
    from tideline.operators.reports import failed_projection

    return failed_projection(fx.res(spark, sf_dir))


@query("report_recent")
def report_recent(spark, sf_dir):
    from tideline.operators.reports import recent_results

    return recent_results(fx.res_two_runs(spark, sf_dir))


@query("report_checkpoints")
def report_checkpoints(spark, sf_dir):
    from tideline.operators.reports import checkpoint_listing

    return checkpoint_listing(checkpoint_upsert(spark, sf_dir))


@query("run_impact")
def q_run_impact(spark, sf_dir):
    from tideline.operators.reports import run_impact

    return run_impact(fx.res(spark, sf_dir))


@query("metrics_scale")
def metrics_scale(spark, sf_dir):
    from tideline.operators.reports import scale_metrics

    return scale_metrics(fx.res_two_runs(spark, sf_dir))


@query("metrics_rows")
def metrics_rows(spark, sf_dir):
    from tideline.operators.reports import row_estimates

    return row_estimates(fx.res_two_runs(spark, sf_dir))


@query("metrics_detection")
def metrics_detection(spark, sf_dir):
    from tideline.operators.reports import detection_metrics

    return detection_metrics(fx.res_two_runs(spark, sf_dir))


@query("metrics_impact")
def metrics_impact(spark, sf_dir):
    from tideline.operators.reports import impact_metrics

    return impact_metrics(fx.res_two_runs(spark, sf_dir))


@query("metrics_types")
def metrics_types(spark, sf_dir):
    from tideline.operators.reports import type_breakdown

    return type_breakdown(fx.res_two_runs(spark, sf_dir))


@query("profile")
def q_profile(spark, sf_dir):
    from tideline.operators.reports import profile

    root = raw_on_disk(spark, sf_dir)
    return profile(read_dataset(spark, root), partitions=list_partitions(spark, root))


@query("check_lineitem_monthly")
def check_lineitem_monthly(spark, sf_dir):
    """All five checks over ``lineitem`` as month partitions, FK to ``part``."""
    checks = [
        NullRateCheck("order_id", 0.0),
        NullRateCheck("product_id", 0.05),
        NullRateCheck("amount", 0.05),
        VolumeCheck(*fx.BIG_VOLUME),
        ReferentialCheck("product_id", fx.ref_big(spark, sf_dir), "product_id"),
    ]
    return check_results(fx.raw_big(spark, sf_dir), checks, dataset="lineitem_monthly", run_id=fx.RUN_ID,
                         run_ts=fx.RUN_TS)


@query("rca_latest_run")
def rca_latest_run(spark, sf_dir):
    """Two runs; upstream failures count only from the upstream's newest run,
    where the re-check of clean data passed."""
    from tideline.operators.rca import analyze

    a = analyze(fx.res_two_runs(spark, sf_dir), fx.lineage(spark, sf_dir), upstream_runs="latest",
                declared=_declared(spark, sf_dir))
    return a.causes.select(*CAUSE_COLS)


@query("stream_checks")
def q_stream_checks(spark, sf_dir):
    """The fused checks as a Structured Streaming job over an on-disk copy of
    ``bad``: one availableNow micro-batch sees every partition with files."""
    from pyspark.sql import types as T

    from tideline.sources.store import ResultStore
    from tideline.streaming import stream_checks

    root = scratch_dir(spark, "stream-orders")
    fx.bad(spark, sf_dir).write.partitionBy("dt").parquet(root)
    schema = T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("dt", T.StringType()),
    ])
    store = ResultStore(spark, scratch_dir(spark, "stream-store"))
    stream_checks(spark, root, schema, fx.order_checks(fx.ref(spark, sf_dir)), dataset=fx.ORDERS, store=store,
                  checkpoint_location=scratch_dir(spark, "stream-ckpt"), run_prefix="stream", run_ts=fx.RUN_TS)
    return store.results()


# --------------------------------------------------------------------------
# partitions under their own schema, isolation, NULL partitions
def drifted_on_disk(spark: SparkSession, sf_dir: str) -> str:
    """All days of ``raw``; of these, one with the key as double and 35 % of it NULL, one without
    ``amount``, and one of files that are not Parquet."""
    root = scratch_dir(spark, "drifted")
    days = fx.raw(spark, sf_dir)
    key = F.when(F.col("order_id") % 20 >= 7, F.col("product_id")).cast("double")
    odd = ["2024-01-02", "2024-01-03", "2024-01-04"]
    days.where(~F.col("dt").isin(odd)).write.partitionBy("dt").parquet(root)
    days.where("dt = '2024-01-02'").drop("dt").withColumn("product_id", key).write.parquet(f"{root}/dt=2024-01-02")
    days.where("dt = '2024-01-03'").drop("dt", "amount").write.parquet(f"{root}/dt=2024-01-03")
    days.where("dt = '2024-01-04'").select(F.col("order_id").cast("string").alias("value")).write.text(f"{root}/dt=2024-01-04")
    return root


@query("check_drifted_partition")
def check_drifted_partition(spark, sf_dir):
    from tideline.plans.runner import DatasetSpec, QualityRunner
    from tideline.sources.store import ResultStore

    spec = DatasetSpec(fx.ORDERS, None, fx.order_checks(fx.ref(spark, sf_dir)), path=drifted_on_disk(spark, sf_dir))
    store = ResultStore(spark, scratch_dir(spark, "store"))
    return QualityRunner(spark, store).run([spec], fx.RUN_ID, fx.RUN_TS).results


@query("check_error_runtime")
def check_error_runtime(spark, sf_dir):
    """A check that fails while it runs, on one partition: an error row there, results everywhere else."""
    from tideline.plans.runner import DatasetSpec, QualityRunner
    from tideline.sources.store import ResultStore

    digits = F.when(F.col("dt") == "2024-01-02", F.lit("no number")).otherwise(F.col("order_id").cast("string"))
    parsed = ExpressionCheck(
        name="parsed_ids", check_type="format", aggs={"sum": F.sum(digits.cast("bigint"))},
        metric=lambda agg, n: agg("sum").cast("double"), passes=lambda m: m > F.lit(0.0), needs=("dt", "order_id"))
    spec = DatasetSpec(fx.ORDERS, fx.raw(spark, sf_dir), [parsed, NullRateCheck("product_id", 0.05), VolumeCheck(*fx.BAD_VOLUME)])
    store = ResultStore(spark, scratch_dir(spark, "store"))
    return QualityRunner(spark, store).run([spec], fx.RUN_ID, fx.RUN_TS).results


def _some_null_days(spark, sf_dir):
    day = F.when(F.col("order_id") % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("dt"))
    return fx.bad(spark, sf_dir).withColumn("dt", day)


@query("check_null_partition")
def check_null_partition(spark, sf_dir):
    """Rows without a partition value, on the broadcast and on the shuffled path: the same results twice."""
    checks = [ReferentialCheck("product_id", fx.ref(spark, sf_dir), "product_id"), VolumeCheck(*fx.BAD_VOLUME)]
    out = [check_results(_some_null_days(spark, sf_dir), checks, dataset=name, run_id=fx.RUN_ID, run_ts=fx.RUN_TS,
                         broadcast_rows=rows) for name, rows in (("broadcast", None), ("shuffled", 0))]
    return out[0].unionByName(out[1])


@query("new_rows_null_partition")
def new_rows_null_partition(spark, sf_dir):
    """Rows that ``anti`` mode still has to check, by a short and by a long list of checked names."""
    from tideline.plans.runner import DatasetSpec, QualityRunner

    history = fx.res(spark, sf_dir).where(F.col("partition") != "2024-01-05")
    spec = DatasetSpec(fx.ORDERS, _some_null_days(spark, sf_dir), [])
    out = []
    for name, most in (("inlined", 2000), ("joined", 3)):
        df, _, _ = QualityRunner(spark, mode="anti", max_literal=most).scope(spec, None, history)
        out.append(df.groupBy(F.col("dt").alias("partition")).agg(F.count(F.lit(1)).alias("n")).withColumn("way", F.lit(name)))
    return out[0].unionByName(out[1])


@query("check_three_references")
def check_three_references(spark, sf_dir):
    """Three foreign keys, all of them shuffled: one further scan of the fact, in which keys without a match are planted."""
    planted = F.col("l_linenumber") == 7
    t = fx.table(spark, sf_dir, "lineitem").select(
        F.when(planted, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        F.when(planted & (F.col("l_quantity") > 25), -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("l_partkey"),
        "l_suppkey", F.date_format("l_shipdate", "yyyy").alias("dt"))
    checks = [
        ReferentialCheck("l_orderkey", fx.table(spark, sf_dir, "orders"), "o_orderkey"),
        ReferentialCheck("l_partkey", fx.table(spark, sf_dir, "part").selectExpr("cast(p_partkey as double) as k"), "k"),
        ReferentialCheck("l_suppkey", fx.table(spark, sf_dir, "supplier"), "s_suppkey"),
    ]
    return check_results(t, checks, dataset="lineitem", run_id=fx.RUN_ID, run_ts=fx.RUN_TS, broadcast_rows=0)


@query("revenue_fine_amounts")
def revenue_fine_amounts(spark, sf_dir):
    """The roll-up with amounts of many decimals, summed as they are."""
    fine = fx.raw(spark, sf_dir).withColumn("amount", F.col("amount") / 7000)
    return revenue_rollup(fine).withColumn("total_revenue", F.round("total_revenue", 6))


# exact-count injections of every kind, and on a text key
@query("inject_volume_exact")
def inject_volume_exact(spark, sf_dir):
    from tideline.operators.inject import inject_volume_drop

    return inject_volume_drop(fx.raw(spark, sf_dir), "2024-01-15", 0.25, key="order_id")


@query("inject_break_exact")
def inject_break_exact(spark, sf_dir):
    from tideline.operators.inject import inject_referential_break

    return inject_referential_break(fx.raw(spark, sf_dir), "2024-01-20", "product_id", 0.18, key="order_id", missing=fx.MISSING_KEY)


@query("inject_text_key")
def inject_text_key(spark, sf_dir):
    """Two faults in a row, rows chosen by a text key as uuid-like order ids are."""
    from tideline.operators.inject import Fault, inject_scenarios

    keyed = fx.raw(spark, sf_dir).withColumn("order_id", F.md5(F.concat(F.lit("order-"), F.col("order_id").cast("string"))))
    return inject_scenarios(keyed, [Fault("null_spike", "2024-01-10", 0.35, column="product_id"),
                                    Fault("volume_drop", "2024-01-15", 0.25)], key="order_id")


@query("metrics_total_rows")
def metrics_total_rows(spark, sf_dir):
    from tideline.operators.reports import total_rows

    return total_rows(fx.res_two_runs(spark, sf_dir))


@query("checkpoint_mixed_writes")
def checkpoint_mixed_writes(spark, sf_dir):
    """A batch run over the first half of the month, then a stream over the second, into one store."""
    from pyspark.sql import types as T

    from tideline.plans.runner import DatasetSpec, QualityRunner
    from tideline.sources.store import ResultStore
    from tideline.streaming import stream_checks

    raw = fx.raw(spark, sf_dir)
    store = ResultStore(spark, scratch_dir(spark, "mixed-store"))
    checks = [NullRateCheck("product_id", 0.05), VolumeCheck(*fx.BAD_VOLUME)]
    QualityRunner(spark, store).run([DatasetSpec(fx.ORDERS, raw.where("dt <= '2024-01-15'"), checks)], "batch", fx.RUN_TS)
    root = scratch_dir(spark, "mixed-orders")
    raw.where("dt > '2024-01-15'").write.partitionBy("dt").parquet(root)
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("product_id", T.LongType()),
                           T.StructField("amount", T.DoubleType()), T.StructField("dt", T.StringType())])
    stream_checks(spark, root, schema, checks, dataset=fx.ORDERS, store=store, run_prefix="stream", run_ts=fx.RUN2_TS,
                  checkpoint_location=scratch_dir(spark, "mixed-ckpt"))
    return store.checkpoints()


@query("lineage_upstream_of_some")
def lineage_upstream_of_some(spark, sf_dir):
    """All upstream datasets of a hundred parts only."""
    from tideline.operators.lineage import all_upstream

    seeds = fx.table(spark, sf_dir, "part").where("p_partkey >= 100 and p_partkey < 200").select(
        F.concat(F.lit("ds_"), F.col("p_partkey").cast("string")).alias("dataset"))
    return all_upstream(fx.lineage(spark, sf_dir), seeds)


@query("rca_impact_deep")
def rca_impact_deep(spark, sf_dir):
    """Impact of failures at ``ds_9``: several hops down the graph made from ``part``."""
    res = fx.res(spark, sf_dir).where(F.col("dataset") == fx.ORDERS).withColumn("dataset", F.lit("ds_9"))
    return _analysis(spark, sf_dir, res).impact


@query("baseline_anomalies")
def baseline_anomalies(spark, sf_dir):
    from tideline.operators.baseline import anomalies

    a = anomalies(fx.res_two_runs(spark, sf_dir))
    return _rounded(a.select("run_id", "dataset", "partition", "check_name", "metric_value", "baseline_mean",
                             "baseline_max", "baseline_rows"))
