"""Fixture views over the driver's test tables (FIXTURES.md, part B).

``raw`` stands for an ``orders_raw`` dataset partitioned by day, ``ref`` for
the product table, ``bad`` for ``raw`` with the three injected faults, ``rev``
for the revenue roll-up of ``bad`` and ``res`` for the check results of both.
Everything is derived lazily from the parquet tables, so work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.checks import NullRateCheck, ReferentialCheck, VolumeCheck
from tideline.operators.inject import Fault, inject_scenarios
from tideline.operators.rollup import MONEY, revenue_rollup
from tideline.plans.fused import check_results

# Fixed fixture values (shared with the SQL oracle).
RUN_ID = "run-0001"
RUN_TS = "2024-02-01 00:00:00"
RUN2_ID = "run-0002"
RUN2_TS = "2024-02-02 00:00:00"
EMPTY_PARTITION = "2024-01-31"
MISSING_KEY = 999999
FAULTS = (
    Fault("null_spike", "2024-01-10", 0.35, column="product_id"),
    Fault("volume_drop", "2024-01-15", 0.25),
    Fault("ref_break", "2024-01-20", 0.18, column="product_id", missing=MISSING_KEY),
)
ORDERS = "orders_raw"
PRODUCTS = "products"
REVENUE = "revenue_daily"
BAD_VOLUME = (200, 600)
REV_VOLUME = (100, 160)
BIG_VOLUME = (500, 5000)
STRICT_REV_VOLUME = (130, 160)


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's parquet table (read-only inputs: one scan definition per session)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _TABLES[key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as day-partitioned orders."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("product_id"),
        F.col("value").alias("amount"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )


def ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the product reference table."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("product_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
        F.col("c_acctbal").alias("price"),
    )


def bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject_scenarios(raw(spark, sf_dir), FAULTS, key="order_id", how="hash")


def rev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_rollup(bad(spark, sf_dir), money_type=MONEY)  # the test amounts have two decimals


def order_checks(reference: DataFrame, volume=BAD_VOLUME):
    return [
        NullRateCheck("order_id", threshold=0.0),
        NullRateCheck("product_id", threshold=0.05),
        NullRateCheck("amount", threshold=0.05),
        VolumeCheck(*volume),
        ReferentialCheck("product_id", reference, "product_id"),
    ]


def revenue_checks(volume=REV_VOLUME):
    return [
        NullRateCheck("total_revenue", threshold=0.0),
        NullRateCheck("product_id", threshold=0.0),
        VolumeCheck(*volume),
    ]


def bad_results(spark: SparkSession, sf_dir: str, run_id=RUN_ID, run_ts=RUN_TS, source=None) -> DataFrame:
    src = bad(spark, sf_dir) if source is None else source
    return check_results(
        src,
        order_checks(ref(spark, sf_dir)),
        dataset=ORDERS,
        run_id=run_id,
        run_ts=run_ts,
        extra_partitions=[EMPTY_PARTITION],
    )


def rev_results(spark: SparkSession, sf_dir: str, run_id=RUN_ID, run_ts=RUN_TS, volume=REV_VOLUME, source=None) -> DataFrame:
    src = rev(spark, sf_dir) if source is None else source
    return check_results(src, revenue_checks(volume), dataset=REVENUE, run_id=run_id, run_ts=run_ts)


def res(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of one run over ``bad`` and ``rev``."""
    return bad_results(spark, sf_dir).unionByName(rev_results(spark, sf_dir))


def res_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run where revenue uses a stricter volume range (130-160), so it
    also fails on days its upstream is clean (baseline and self-origin causes)."""
    return bad_results(spark, sf_dir).unionByName(rev_results(spark, sf_dir, volume=STRICT_REV_VOLUME))


def res_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the faulty data, then a re-check of the clean data one day later."""
    r2 = bad_results(spark, sf_dir, RUN2_ID, RUN2_TS, source=raw(spark, sf_dir)).unionByName(
        rev_results(spark, sf_dir, RUN2_ID, RUN2_TS, source=revenue_rollup(raw(spark, sf_dir), money_type=MONEY))
    )
    return res(spark, sf_dir).unionByName(r2)


def raw_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as month-partitioned orders (the heavier bench input)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("amount"),
        F.date_format("l_shipdate", "yyyy-MM").alias("dt"),
    )


def ref_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"))


# --- lineage fixtures -------------------------------------------------------
# The reference's three datasets, a diamond and a 3-cycle.
REFERENCE_LINEAGE = (
    {"dataset": "orders_raw", "upstream": []},
    {"dataset": "products", "upstream": []},
    {"dataset": "revenue_daily", "upstream": ["orders_raw", "products"], "critical_columns": ["product_id", "amount"]},
)
SHAPES_LINEAGE = (
    {"dataset": "d_top", "upstream": []},
    {"dataset": "d_left", "upstream": ["d_top"]},
    {"dataset": "d_right", "upstream": ["d_top"]},
    {"dataset": "d_bottom", "upstream": ["d_left", "d_right"]},
    {"dataset": "cyc_a", "upstream": ["cyc_c"]},
    {"dataset": "cyc_b", "upstream": ["cyc_a"]},
    {"dataset": "cyc_c", "upstream": ["cyc_b"]},
)
PART_ORD_OFFSET = 10


def reference_lineage(spark: SparkSession):
    from tideline.sources.lineage import LineageGraph

    return LineageGraph.from_records(spark, REFERENCE_LINEAGE)


def lineage(spark: SparkSession, sf_dir: str):
    """Reference graph + diamond + cycle + a graph from ``part``:
    ``ds_<k>`` depends on ``ds_<k div 2>`` (no edge for the root ``k = 0``)."""
    from tideline.sources.lineage import DECLARATION_SCHEMA, LineageGraph

    fixed_ = LineageGraph.from_records(
        spark, [dict(r, decl_ord=i) for i, r in enumerate(REFERENCE_LINEAGE + SHAPES_LINEAGE)]
    )
    k = F.col("p_partkey")
    decl = table(spark, sf_dir, "part").select(
        F.concat(F.lit("ds_"), k.cast("string")).alias("dataset"),
        F.when(k > 0, F.array(F.concat(F.lit("ds_"), F.expr("p_partkey div 2").cast("string"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("upstream"),
        # every third part names its upstream's key and its own brand and size as critical
        F.when(k % 3 == 0, F.array(F.lit("partkey"), F.lower(F.translate("p_brand", "# ", "__")),
                                   F.concat(F.lit("size_"), F.col("p_size").cast("string")))).alias("critical_columns"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("transformation"),
        (k + F.lit(PART_ORD_OFFSET)).cast("long").alias("decl_ord"),
    )
    part_graph = LineageGraph.from_declarations(decl.select(*DECLARATION_SCHEMA.fieldNames()))
    return fixed_.union(part_graph)
