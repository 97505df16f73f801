"""Check semantics (C1-C5) on small hand-made frames."""

import math

import pytest
from pyspark.sql import functions as F

from tideline.operators.checks import (
    ExpressionCheck,
    NullRateCheck,
    ReferentialCheck,
    VolumeCheck,
    orphan_rows,
)
from tideline.plans.fused import check_results


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id long, product_id long, amount double, dt string")


def _by_name(df):
    return {(r["partition"], r["check_name"]): r for r in df.collect()}


def test_null_rate_threshold_inclusive_and_nan_is_not_null(spark):
    rows = [(1, None, 1.0, "d1"), (2, 5, float("nan"), "d1"), (3, 5, 2.0, "d1"), (4, 5, 3.0, "d1")]
    out = _by_name(check_results(_orders(spark, rows), [NullRateCheck("product_id", 0.25),
                                                          NullRateCheck("amount", 0.0)], dataset="o", run_id="r"))
    pid = out[("d1", "null_rate_product_id")]
    assert pid["metric_value"] == 0.25 and pid["passed"] is True  # rate == threshold passes
    amt = out[("d1", "null_rate_amount")]
    assert amt["metric_value"] == 0.0 and amt["passed"] is True  # NaN is not NULL
    assert pid["threshold"] == "0.25" and amt["threshold"] == "0.0"


def test_volume_bounds_inclusive(spark):
    rows = [(i, 1, 1.0, "a") for i in range(3)] + [(i, 1, 1.0, "b") for i in range(5)] + [(9, 1, 1.0, "c")]
    out = _by_name(check_results(_orders(spark, rows), [VolumeCheck(3, 5)], dataset="o", run_id="r"))
    assert out[("a", "volume_check")]["passed"] and out[("b", "volume_check")]["passed"]
    assert not out[("c", "volume_check")]["passed"]
    assert out[("a", "volume_check")]["metric_value"] == 3.0
    assert out[("a", "volume_check")]["threshold"] == "3-5"


def test_referential_null_fk_is_orphan_and_duplicate_ref_keys_do_not_multiply(spark):
    ref = spark.createDataFrame([(1,), (1,), (2,), (None,)], "product_id long")
    rows = [(1, 1, 1.0, "d"), (2, 2, 1.0, "d"), (3, None, 1.0, "d"), (4, 7, 1.0, "d")]
    checks = [ReferentialCheck("product_id", ref), VolumeCheck(0, 10)]
    for rows_cap in (None, 0):  # broadcast path and pre-aggregated shuffle path
        out = _by_name(check_results(_orders(spark, rows), checks, dataset="o", run_id="r", broadcast_rows=rows_cap))
        ri = out[("d", "ref_integrity_product_id")]
        assert ri["metric_value"] == 0.5 and ri["passed"] is False and ri["threshold"] == "0.0"
        assert out[("d", "volume_check")]["metric_value"] == 4.0  # no row multiplication
    orphans = orphan_rows(_orders(spark, rows), ReferentialCheck("product_id", ref)).collect()
    assert sorted(r["order_id"] for r in orphans) == [3, 4]


def test_empty_partition_gets_results(spark):
    rows = [(1, 1, 1.0, "d1")]
    ref = spark.createDataFrame([(1,)], "product_id long")
    checks = [NullRateCheck("product_id", 0.0), VolumeCheck(1, 10), ReferentialCheck("product_id", ref)]
    out = _by_name(check_results(_orders(spark, rows), checks, dataset="o", run_id="r", extra_partitions=["d2"]))
    assert out[("d2", "null_rate_product_id")]["passed"] and out[("d2", "null_rate_product_id")]["metric_value"] == 0.0
    assert not out[("d2", "volume_check")]["passed"] and out[("d2", "volume_check")]["metric_value"] == 0.0
    assert out[("d2", "ref_integrity_product_id")]["passed"]
    listed = _by_name(check_results(_orders(spark, rows), checks, dataset="o", run_id="r", partitions=["d2"]))
    assert set(p for p, _ in listed) == {"d2"}


def test_unresolvable_checks_become_error_rows(spark):
    ref = spark.createDataFrame([(1,)], "product_id long")
    checks = [NullRateCheck("nope", 0.1), VolumeCheck(0, 9), ReferentialCheck("nope", ref),
              ReferentialCheck("product_id", ref, "sku")]
    out = _by_name(check_results(_orders(spark, [(1, 1, 1.0, "d")]), checks, dataset="o", run_id="r"))
    assert out[("d", "null_rate_nope")]["metric_value"] == -1.0
    assert out[("d", "null_rate_nope")]["threshold"] == "0.1"  # null checks keep their threshold text
    assert out[("d", "ref_integrity_nope")]["threshold"] == "N/A"
    assert not out[("d", "ref_integrity_product_id")]["passed"]
    assert out[("d", "volume_check")]["passed"]


def test_custom_check_extension_point(spark):
    chk = ExpressionCheck(
        name="max_amount", check_type="range", aggs={"mx": F.max("amount")},
        metric=lambda agg, n: agg("mx"), passes=lambda m: m <= 10.0, threshold=10.0, needs=("amount",),
    )
    out = _by_name(check_results(_orders(spark, [(1, 1, 3.0, "d"), (2, 1, 12.5, "d")]), [chk], dataset="o", run_id="r"))
    r = out[("d", "max_amount")]
    assert r["metric_value"] == 12.5 and r["passed"] is False and r["check_type"] == "range"


def test_one_scan_for_all_checks(spark, tmp_root):
    """The fused plan reads the fact once whatever the number of checks."""
    df = _orders(spark, [(i, i % 3, float(i), f"d{i % 2}") for i in range(20)])
    df.write.parquet(tmp_root)
    fact = spark.read.parquet(tmp_root)
    ref = spark.createDataFrame([(0,), (1,)], "product_id long")
    checks = [NullRateCheck("order_id"), NullRateCheck("amount"), VolumeCheck(1, 100), ReferentialCheck("product_id", ref)]
    plan = check_results(fact, checks, dataset="o", run_id="r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1, plan


def test_orphan_rows_both_paths_with_a_hot_key(spark):
    ref = spark.createDataFrame([(k,) for k in range(10)] + [(3,)], "product_id long")
    rows = [(i, 3, 1.0, "d") for i in range(60)] + [(100, 42, 1.0, "d"), (101, None, 1.0, "d")]
    df = _orders(spark, rows)
    for cap in (None, 0):
        got = orphan_rows(df, ReferentialCheck("product_id", ref), broadcast_rows=cap)
        assert sorted(r.order_id for r in got.collect()) == [100, 101]
        assert got.columns == df.columns


def test_long_partition_lists_use_a_semi_join(spark, monkeypatch):
    import tideline.plans.fused as fused

    df = _orders(spark, [(i, 1, 1.0, f"d{i % 5}") for i in range(50)])
    short = check_results(df, [VolumeCheck(0, 100)], dataset="o", run_id="r", partitions=["d1", "d2", "zz"])
    monkeypatch.setattr(fused, "MAX_LITERAL_PARTITIONS", 2)
    long_ = check_results(df, [VolumeCheck(0, 100)], dataset="o", run_id="r", partitions=["d1", "d2", "zz"])
    a = sorted((r.partition, r.metric_value) for r in short.collect())
    b = sorted((r.partition, r.metric_value) for r in long_.collect())
    assert a == b == [("d1", 10.0), ("d2", 10.0), ("zz", 0.0)]


def test_integer_references_beyond_the_broadcast_bound_become_bitmaps(spark):
    """Dense and negative keys, nulls and keys of other blocks; no exchange of the fact, same results as when shuffled."""
    edges = [-(2**63), 2**63 - 1, -1, 0, 63, 64, 32767, 32768]
    ref = spark.range(-70_000, 200_000, 3).selectExpr("cast(id as int) as k").union(spark.createDataFrame([(None,), (0,)], "k int"))
    big = spark.createDataFrame([(e,) for e in edges], "k long")
    fact = spark.range(-100_000, 300_000, 7).selectExpr("id as a", "if(id % 5 = 0, null, id) as b", "'p' || (id % 3) as dt")
    fact = fact.union(spark.createDataFrame([(e + d, None, "x") for e in edges for d in (-1, 0, 1) if -(2**63) <= e + d < 2**63], fact.schema))
    checks = [ReferentialCheck("a", ref, "k"), ReferentialCheck("b", big, "k"), VolumeCheck(1, 2)]

    def rows(**kw):
        df = check_results(fact, checks, dataset="d", run_id="r", run_ts="2024-01-01 00:00:00", **kw)
        return sorted(map(tuple, df.collect())), df._jdf.queryExecution().optimizedPlan().toString()

    got, plan = rows(broadcast_rows=5)
    assert plan.count("words#") and "__key" not in plan
    assert got == rows(broadcast_rows=0)[0] == rows()[0]
    from tideline.operators.checks import orphan_rows

    ways = [orphan_rows(fact, checks[0], n) for n in (0, 5, None)]
    assert len({df.count() for df in ways}) == 1 and ways[1].exceptAll(ways[0]).isEmpty()
    assert "words#" in ways[1]._jdf.queryExecution().optimizedPlan().toString()


def test_a_bitmap_is_counted_before_it_is_built(spark):
    from tideline.plans.bitmaps import BLOCK_BYTES, key_blocks

    dense = spark.range(1_000_000)
    assert key_blocks(dense, 31 * BLOCK_BYTES).count() == 31
    assert key_blocks(dense, 30 * BLOCK_BYTES) is None
    sparse = spark.range(1000).selectExpr("id * 1000003 as id")
    assert key_blocks(sparse, 900 * BLOCK_BYTES) is None
    assert key_blocks(spark.range(0), BLOCK_BYTES).count() == 0
