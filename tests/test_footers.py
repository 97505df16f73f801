"""Footers as a table: one job for all partitions, checks without a data page."""

import pytest
from pyspark.sql import functions as F

from tideline.operators.checks import NullRateCheck, ReferentialCheck, VolumeCheck
from tideline.plans import partitioned
from tideline.plans.partitioned import check_partitions
from tideline.sources import datasets
from tideline.sources.datasets import schema_groups
from tideline.sources.footers import counts, footers


def write(spark, root, day, rows, schema, **options):
    spark.createDataFrame(rows, schema).coalesce(2).write.mode("append").options(**options).parquet(f"{root}/dt={day}")


@pytest.fixture(scope="module")
def root(spark):
    from tideline.session import scratch_dir

    root = scratch_dir(spark, "footers")
    whole = "k long, v double, s struct<a:int>"
    for day in range(1, 13):
        write(spark, root, f"2024-01-{day:02}", [(i if i % day else None, float("nan"), (1,)) for i in range(20)], whole)
    write(spark, root, "2024-01-13", [(1.5, 1.0)], "k double, v double")
    write(spark, root, "2024-01-14", [(1, 2.0, (3,))], whole)
    write(spark, root, "2024-01-14", [(1, "x")], "k long, v string")  # cannot be merged with the other file
    write(spark, root, "2024-01-15", [], whole)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/dt=2024-01-16")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    spark.range(3).selectExpr("cast(id as string) as value").coalesce(1).write.text(f"{root}/dt=2024-01-17")
    return root


DAYS = [f"2024-01-{d:02}" for d in range(1, 18)]


def described(found):
    return sorted((s.simpleString(), v) for s, v in found.groups), sorted(found.empty), sorted(found.unreadable)


def test_groups_are_those_of_the_files_read_one_by_one(spark, root, monkeypatch):
    got = schema_groups(spark, root, DAYS)
    assert got.empty == ["2024-01-16"] and sorted(got.unreadable) == ["2024-01-14", "2024-01-17"]
    assert len(got.groups) == 2
    with monkeypatch.context() as m:  # a file system that only Spark can open
        m.setattr(datasets, "footers", lambda *_: None)
        assert described(schema_groups(spark, root, DAYS)) == described(got)


def test_schemas_are_asked_once_for_each_group(spark, root, monkeypatch):
    asked = []

    class Reader:
        def __init__(self, inner):
            self.inner = inner

        def option(self, *a):
            self.inner = self.inner.option(*a)
            return self

        def parquet(self, path):
            asked.append(path)
            return self.inner.parquet(path)

    class Session:
        sparkContext = spark.sparkContext
        read = property(lambda _: Reader(spark.read))

        def __getattr__(self, name):
            return getattr(spark, name)

    monkeypatch.setattr(datasets, "footers", lambda s, *a: footers(spark, *a))
    schema_groups(Session(), root, DAYS)
    assert len(asked) == 3  # the two groups, and the partition whose files do not agree


def test_counts_are_those_of_the_rows(spark, root):
    got = {r[0]: tuple(r)[1:] for r in counts(footers(spark, root, DAYS[:12]), ["k", "v", "s", "none"]).collect()}
    assert got == {f"2024-01-{d:02}": (20, len([i for i in range(20) if i % d == 0]), 0, None, None) for d in range(1, 13)}


def test_checks_are_the_same_with_and_without_footers(spark, root, monkeypatch):
    keys = spark.createDataFrame([(i,) for i in range(0, 20, 2)], "k long")
    checks = [NullRateCheck("k", 0.1), NullRateCheck("s", 0.1), VolumeCheck(1, 19), ReferentialCheck("k", keys), NullRateCheck("none", 0.2)]

    def rows():
        out = check_partitions(spark, root, checks, dataset="d", partitions=DAYS, run_id="r", run_ts="2024-02-01 00:00:00")
        return sorted(map(tuple, out.collect()), key=repr)

    got = rows()
    assert len(got) == len(DAYS) * len(checks)
    monkeypatch.setattr(partitioned, "_from_footers", lambda *_: None)
    assert rows() == got


def test_null_rate_and_volume_read_no_data(spark, root):
    """The plan has no scan of the dataset: its files may be gone once the footers are read."""
    checks = [NullRateCheck("k", 0.1), NullRateCheck("v", 0.1), VolumeCheck(1, 30)]
    df = check_partitions(spark, root, checks, dataset="d", partitions=DAYS[:12], run_id="r", run_ts="2024-02-01 00:00:00")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    scans = [f for f in df.inputFiles() if "/dt=" in f]
    assert not scans and "footers" in " ".join(df.inputFiles()), plan
    assert df.where(F.col("check_name") == "null_rate_k").where("partition = '2024-01-02'").first()["metric_value"] == 0.5


def test_schema_of_an_empty_list(spark, root):
    assert schema_groups(spark, root, []).groups == []
