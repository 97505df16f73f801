"""The trailing baseline against a naive loop, in one window and in blocks with halo rows."""

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators.baseline import anomalies, baseline

SCHEMA = "dataset string, check_name string, partition string, run_id string, timestamp timestamp_ntz, metric_value double"


def naive(rows, window):
    out = []
    for key in {r[:2] for r in rows}:
        mine = sorted((r for r in rows if r[:2] == key), key=lambda r: (r[2] is not None, r[2] or "", r[4], r[3], r[5] is not None, r[5] or 0))
        for part in {r[2] for r in mine}:
            first = next(i for i, r in enumerate(mine) if r[2] == part)
            last = [r[5] for r in mine[max(first - window, 0) : first] if r[5] is not None]
            mean = round(sum(last) / len(last), 9) if last else None
            out.append((*key, part, mean, max(last, default=None), len(last)))
    return sorted(out, key=repr)


def history(seed, n, keys, parts):
    from datetime import datetime, timedelta

    r = random.Random(seed)
    return [(*r.choice(keys), r.choice(parts), f"run{r.randint(0, 3)}", datetime(2024, 1, 1) + timedelta(hours=r.randint(0, 5)),
             r.choice([None, -1.0, float(r.randint(0, 50))])) for _ in range(n)]


def got(df):
    return sorted((tuple(r) for r in df.withColumn("baseline_mean", F.round("baseline_mean", 9)).collect()), key=repr)


CASES = {
    "many checks": (400, [(f"d{i}", f"c{j}") for i in range(4) for j in range(5)], [f"p{i:02}" for i in range(9)] + [None]),
    "one hot check": (1500, [("d", "c")] * 40 + [("a", "c"), ("z", "c"), (None, None)], [f"p{i:03}" for i in range(200)]),
    "one hot partition": (600, [("d", "c")], ["p1"] * 20 + ["p0", "p2", "p3"]),
    "few rows": (3, [("d", "c")], ["p1", "p2"]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("window", [3, 30])
def test_blocks_give_what_one_window_gives(spark, case, window):
    rows = history(window, *CASES[case])
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = naive(rows, window)
    for block_rows in (1_000_000, 60) if window == 3 else (1,):  # the last: blocks smaller than the window
        assert got(baseline(df, window, block_rows=block_rows)) == expected


def test_a_hot_check_uses_many_tasks(spark):
    """The window over the blocks is keyed by block: one check's rows are spread over as many tasks."""
    df = spark.range(40_000).select(
        F.lit("d").alias("dataset"), F.lit("c").alias("check_name"), F.format_string("p%06d", F.col("id") % 5000).alias("partition"),
        F.col("id").cast("string").alias("run_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % 97).cast("double").alias("metric_value"))
    blocked = baseline(df, block_rows=1000)
    assert "__block" in blocked._jdf.queryExecution().executedPlan().toString()
    from tideline.operators import baseline as module

    rows, _ = module._with_halo(df.select(*module.KEY, *module.ORDER), 40, 30)
    sizes = [r["count"] for r in rows.groupBy("__block").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 3000
    one = baseline(df)
    assert blocked.exceptAll(one).isEmpty() and one.exceptAll(blocked).isEmpty()


def test_anomalies_of_a_blocked_history(spark):
    rows = [("d", "c", f"p{i:02}", "r", None, 10.0 if i != 40 else 50.0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r["partition"] for r in anomalies(df).collect()] == ["p40"]


def test_empty_history(spark):
    assert baseline(spark.createDataFrame([], SCHEMA)).collect() == []
