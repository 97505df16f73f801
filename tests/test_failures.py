"""Errors in the data become error rows; failures of the cluster do not."""

import pytest
from pyspark.sql import functions as F

from tideline.operators.checks import ERROR_METRIC, ExpressionCheck, NullRateCheck, VolumeCheck
from tideline.plans import runner as runner_module
from tideline.plans.failures import DataError, is_data_error, tried
from tideline.plans.partitioned import isolated
from tideline.plans.runner import DatasetSpec, QualityRunner
from tideline.sources.store import ResultStore


class Lost(RuntimeError):
    """As a lost executor shows itself: an exception without a SQLSTATE."""


def orders(spark):
    return spark.createDataFrame([(i, f"2024-01-{i % 8 + 1:02}") for i in range(32)], "k long, dt string")


def bad_on(day):
    text = F.when(F.col("dt") == day, F.lit("no number")).otherwise(F.col("k").cast("string"))
    return ExpressionCheck(name=f"parsed_{day}", check_type="format", aggs={"s": F.sum(text.cast("bigint"))},
                           metric=lambda agg, n: agg("s"), passes=lambda m: m >= F.lit(0.0), needs=("dt", "k"))


def test_kinds_of_errors(spark):
    def raised(action):
        with pytest.raises(Exception) as e:
            action()
        return e.value

    assert is_data_error(raised(lambda: spark.range(3).select("none")))
    assert is_data_error(raised(lambda: spark.sql("select cast('x' as int)").collect()))
    assert is_data_error(raised(lambda: spark.range(3).selectExpr("1 / (id - id)").collect()))
    assert is_data_error(raised(lambda: spark.range(3).selectExpr("1 / (id - id) as x").write.format("noop").mode("append").save()))
    assert not is_data_error(Lost("ExecutorLostFailure"))


def test_tries_again_and_then_raises():
    calls = []

    def fails(times):
        def action():
            calls.append(1)
            if len(calls) <= times:
                raise Lost("lost")
            return "done"

        calls.clear()
        return action

    assert tried(fails(1)) == "done"
    with pytest.raises(Lost):
        tried(fails(2))

    def data():
        raise DataError("bad")

    with pytest.raises(DataError):
        tried(data)


def test_a_transient_failure_leaves_no_error_row(spark, tmp_root, monkeypatch):
    store = ResultStore(spark, f"{tmp_root}/store")
    spec = DatasetSpec("orders", orders(spark), [NullRateCheck("k", 0.1), VolumeCheck(1, 9)])
    lost = [1]
    save = store.save_results
    monkeypatch.setattr(store, "save_results", lambda df: (_ for _ in ()).throw(Lost("lost")) if lost and lost.pop() else save(df))
    out = QualityRunner(spark, store).run([spec], "r")
    assert out.results.where(F.col("metric_value") == ERROR_METRIC).isEmpty() and out.results.count() == 16


def test_a_lasting_failure_fails_the_run_and_moves_no_checkpoint(spark, tmp_root, monkeypatch):
    store = ResultStore(spark, f"{tmp_root}/store")
    spec = DatasetSpec("orders", orders(spark), [VolumeCheck(1, 9)])

    def down(*_):
        raise Lost("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "save_results", down)
        with pytest.raises(Lost):
            QualityRunner(spark, store).run([spec], "r")
    assert store.checkpoint_value("orders") is None and store.results().isEmpty()
    assert QualityRunner(spark, store).run([spec], "r").results.count() == 8


def test_only_the_pairs_at_fault_get_error_rows(spark, tmp_root, monkeypatch):
    rounds = []
    real = runner_module.isolated

    def counted(make, *args):
        def counting(checks, values):
            rounds.append((len(checks), len(values)))
            return make(checks, values)

        return real(counting, *args)

    monkeypatch.setattr(runner_module, "isolated", counted)
    spec = DatasetSpec("orders", orders(spark), [bad_on("2024-01-03"), VolumeCheck(1, 9), bad_on("2024-01-08")])
    out = QualityRunner(spark, ResultStore(spark, f"{tmp_root}/store")).run([spec], "r")
    errors = {(r.check_name, r.partition) for r in out.results.where(F.col("metric_value") == ERROR_METRIC).collect()}
    assert errors == {("parsed_2024-01-03", "2024-01-03"), ("parsed_2024-01-08", "2024-01-08")}
    assert out.results.count() == 24
    assert len(rounds) == 1 + 3 + 2 * 2 * 3  # all, each check, and halves down to the days at fault


def test_isolation_does_not_hide_a_cluster_failure(spark):
    def make(checks, values):
        raise Lost("lost")

    with pytest.raises(Lost):
        isolated(make, [VolumeCheck(1, 2)], ["a", "b"], lambda *_: None)
