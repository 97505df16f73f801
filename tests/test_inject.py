"""Fault injection and exact-fraction selection."""

from pyspark.sql import functions as F

from tideline.operators.inject import Fault, inject_scenarios, inject_volume_drop
from tideline.operators.sampling import exact_fraction


def test_exact_fraction_hot_partition_value(spark):
    # one partition value holds most rows; counts must be exact per value
    rows = [(i, "hot") for i in range(5000)] + [(10_000 + i, f"d{i % 3}") for i in range(301)]
    df = spark.createDataFrame(rows, "k long, dt string")
    marked = exact_fraction(df, 0.35, key="k", partition_col="dt", flag="sel")
    got = {r.dt: (r.n, r.s) for r in marked.groupBy("dt").agg(F.count("*").alias("n"),
                                                                F.count_if("sel").alias("s")).collect()}
    assert got["hot"] == (5000, 1750)
    assert got["d0"] == (101, round(0.35 * 101)) and got["d1"] == (100, 35)
    # the chosen rows are the ones with the smallest md5(key) in each value
    hot = marked.where("dt = 'hot'").withColumn("h", F.md5(F.col("k").cast("string")))
    cut = hot.where("sel").agg(F.max("h")).collect()[0][0]
    assert hot.where(~F.col("sel") & (F.col("h") < cut)).count() == 0


def test_exact_fraction_only_inside_target(spark):
    df = spark.createDataFrame([(i, "a" if i < 10 else "b") for i in range(20)], "k long, dt string")
    marked = exact_fraction(df, 0.5, key="k", flag="sel", where=F.col("dt") == "a")
    by = {r.dt: r.s for r in marked.groupBy("dt").agg(F.count_if("sel").alias("s")).collect()}
    assert by == {"a": 5, "b": 0}
    assert marked.where("dt = 'b'").where(F.col("sel").isNotNull()).count() == 0


def test_scenarios_compose_in_order(spark):
    df = spark.createDataFrame([(i, i % 7, 1.0, "x") for i in range(1000)],
                               "order_id long, product_id long, amount double, dt string")
    out = inject_scenarios(df, [Fault("null_spike", "x", 0.5, column="product_id"),
                                Fault("ref_break", "x", 0.2, column="product_id", missing=-9)], key="order_id")
    r = out.agg(F.count_if(F.col("product_id").isNull()).alias("nulls"),
                F.count_if(F.col("product_id") == -9).alias("broken")).collect()[0]
    assert r.broken == 200 and r.nulls == 300  # the later fault wins on rows both select
    kept = inject_volume_drop(df, "x", 0.25, key="order_id", how="exact").count()
    assert kept == 250


def test_any_key_type(spark):
    from tideline.functions.selectors import hash_unit
    from tideline.operators.inject import inject_null_spike, inject_referential_break

    rows = [(f"6f1c-{i:04d}", i, "d1" if i < 100 else "d2") for i in range(200)]
    df = spark.createDataFrame(rows, "order_id string, product_id long, dt string")
    spiked = inject_null_spike(df, "d1", "product_id", 0.35, key="order_id")
    assert spiked.where("product_id is null").groupBy("dt").count().collect()[0][1] == 35
    assert inject_volume_drop(df, "d2", 0.25, key="order_id").count() == 125
    broken = inject_referential_break(df, "d2", "product_id", 0.18, key="order_id", missing=-1)
    assert broken.where("product_id = -1").count() == 18
    near = inject_volume_drop(df, "d2", 0.25, key="order_id", how="hash").count()
    assert 100 < near < 150
    big = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (7,), (-7,), (None,)], "k long")
    assert [r[0] for r in big.select(hash_unit("k")).collect()] == [
        ((2**63 - 1) * 7919 + 13) % 1000, (-(2**63) % 1000 * 7919 + 13) % 1000, (7 * 7919 + 13) % 1000, (-7 * 7919 + 13) % 1000, None]
