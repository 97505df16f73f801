"""Incremental runs over several datasets.

A run, for every dataset in declared order: find its new partitions against
the checkpoint table, evaluate all its checks in one fused aggregation, and
collect the long result rows.  Then, once for the whole run: append results,
move checkpoints, and (optionally) build the root-cause analysis over every
failure of the run, so an upstream declared later is still seen.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.checks import Check
from tideline.operators.rca import Analysis, analyze
from tideline.plans.failures import DataError, tried
from tideline.plans.fused import MAX_LITERAL_PARTITIONS, check_results, error_results
from tideline.plans.partitioned import check_partitions, isolated
from tideline.session import materialize
from tideline.sources.lineage import LineageGraph
from tideline.sources.partitions import list_partitions, partitions_frame
from tideline.sources.store import CHECKPOINT_SCHEMA, RESULT_SCHEMA, ResultStore, checkpoints_from_results


@dataclass
class DatasetSpec:
    """A dataset to check: its rows, checks and partition listing.

    ``path``: a partitioned directory, listed by the runner and read partition by
    partition under each one's own schema (``df`` and ``partitions`` are not used).
    Otherwise ``df`` are the rows; ``partitions`` are names known to exist (e.g. from
    ``list_partitions`` on a directory), ``None`` takes the partition values present in
    ``df`` plus ``extra_partitions``.
    """

    name: str
    df: DataFrame | None
    checks: Sequence[Check]
    partitions: Sequence[str] | None = None
    extra_partitions: Sequence[str] = ()
    partition_col: str = "dt"
    path: str | None = None


@dataclass
class RunOutcome:
    run_id: str
    results: DataFrame
    summary: DataFrame
    skipped: list[str] = field(default_factory=list)
    _diagnose: object = None
    _analysis: Analysis | None = None

    @property
    def analysis(self) -> Analysis | None:
        """Root-cause analysis of the run's failures, built on first access."""
        if self._analysis is None and self._diagnose is not None:
            self._analysis = self._diagnose()
        return self._analysis


def run_summary(results: DataFrame) -> DataFrame:
    """``total_checks, passed, failed`` in one aggregate."""
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


class QualityRunner:
    """Incremental check runner.

    ``store=None`` runs against an in-memory empty history (nothing is
    written); ``enable_diagnostics=False`` skips the lineage analysis entirely
    (C8).
    """

    def __init__(
        self,
        spark: SparkSession,
        store: ResultStore | None = None,
        lineage: LineageGraph | None = None,
        enable_diagnostics: bool = True,
        mode: str = "watermark",
        max_literal: int = MAX_LITERAL_PARTITIONS,
    ):
        self.max_literal = max_literal
        self.spark = spark
        self.store = store
        self.lineage = lineage
        self.enable_diagnostics = enable_diagnostics and lineage is not None
        self.mode = mode

    # -- state -----------------------------------------------------------
    def _history(self) -> DataFrame:
        if self.store is None:
            return self.spark.createDataFrame([], RESULT_SCHEMA)
        return self.store.results()

    def _checkpoints(self) -> DataFrame:
        if self.store is None:
            return self.spark.createDataFrame([], CHECKPOINT_SCHEMA)
        return self.store.checkpoints()

    # -- planning --------------------------------------------------------
    def _mark(self, checkpoints: DataFrame, name: str) -> str | None:
        if self.store is not None:
            return self.store.checkpoint_value(name)
        row = checkpoints.where(F.col("dataset") == F.lit(name)).select("last_checked_partition").collect()
        return row[0][0] if row else None

    def _checked(self, history: DataFrame, name: str) -> list[str]:
        rows = history.where(F.col("dataset") == F.lit(name)).select("partition").distinct().collect()
        return [r[0] for r in rows]

    def scope(self, spec: DatasetSpec, checkpoints: DataFrame, history: DataFrame):
        """(restricted rows, explicit partition list or None, extra names).

        Only partition *names* reach the driver (the checkpoint value, or in
        ``anti`` mode the checked names).  The rows are restricted by a
        predicate on the partition column, which a file scan turns into
        partition pruning; no extra pass lists a view's partitions.  Rows
        with a NULL partition value are never above a mark; in ``anti`` mode they
        are a partition of their own, new until it has results.
        """
        p = F.col(spec.partition_col)
        df = spec.df
        if self.mode == "watermark":
            mark = self._mark(checkpoints, spec.name)
            keep = (lambda v: True) if mark is None else (lambda v: v > mark)
            if df is not None and mark is not None:
                df = df.where(p > F.lit(mark))
        elif self.mode == "anti":
            done = set(self._checked(history, spec.name))
            keep = lambda v: v not in done
            names = sorted(v for v in done if v is not None)
            if df is not None and names:
                if len(names) <= self.max_literal:
                    df = df.where(p.isNull() | ~p.isin(names))  # as the anti-join: a NULL equals no name
                else:
                    df = df.join(partitions_frame(self.spark, names, spec.partition_col), spec.partition_col, "left_anti")
            if df is not None and None in done:
                df = df.where(p.isNotNull())
        else:
            raise ValueError(f"unknown mode {self.mode!r}")
        listed = None if spec.partitions is None else [v for v in spec.partitions if keep(v)]
        if spec.path is not None:
            listed = [v for v in list_partitions(self.spark, spec.path, spec.partition_col) if keep(v)]
        extra = [v for v in spec.extra_partitions if keep(v)]
        return df, listed, extra

    def piece(self, spec: DatasetSpec, run_id: str, run_ts, checkpoints: DataFrame, history: DataFrame) -> DataFrame | None:
        """Lazy results of one dataset; None if an explicit listing has nothing new."""
        df, listed, extra = self.scope(spec, checkpoints, history)
        if listed is not None and not listed:
            return None
        if spec.path is not None:
            return check_partitions(self.spark, spec.path, spec.checks, dataset=spec.name, partitions=listed, run_id=run_id,
                                    run_ts=run_ts, partition_col=spec.partition_col)
        return check_results(df, spec.checks, dataset=spec.name, run_id=run_id, run_ts=run_ts, partitions=listed,
                             extra_partitions=extra if listed is None else (), partition_col=spec.partition_col)

    def _declared(self, *args):
        try:
            return self.piece(*args)
        except ValueError as e:
            return e

    def plan(
        self, specs: Sequence[DatasetSpec], run_id: str | None = None, run_ts=None
    ) -> tuple[DataFrame, list[str]]:
        """Lazy results of one run over all datasets, and the skipped ones
        (datasets with an explicit partition list and nothing new in it)."""
        pieces, skipped = self._pieces(specs, run_id or str(uuid.uuid4()), run_ts or _dt.datetime.now())
        return self._union([p for _, p in pieces]), skipped

    def _pieces(self, specs, run_id, run_ts):
        cps, hist = self._checkpoints(), self._history()
        pieces, skipped = [], []
        for spec in specs:
            try:
                p = tried(lambda spec=spec: self._declared(spec, run_id, run_ts, cps, hist))
                if isinstance(p, ValueError):
                    raise p  # a mistake in the declaration, not in the data
            except DataError:  # planning may read (listing, references): an error of this dataset alone
                p = self._isolate(spec, run_id, run_ts, cps, hist)
            if p is None:
                skipped.append(spec.name)
            else:
                pieces.append((spec, p))
        return pieces, skipped

    def _union(self, pieces: Sequence[DataFrame]) -> DataFrame:
        if not pieces:
            return self.spark.createDataFrame([], RESULT_SCHEMA)
        out = pieces[0]
        for p in pieces[1:]:
            out = out.unionByName(p)
        return out

    # -- execution -------------------------------------------------------
    def run(self, specs: Sequence[DatasetSpec], run_id: str | None = None, run_ts=None) -> RunOutcome:
        """Evaluate, persist, move checkpoints, diagnose.

        With a store, the run's results are written once and re-read, so the
        checks are computed once however many reports follow.  A failure of the cluster is
        tried again, and then fails the run before any checkpoint moves.  If a fused pass
        fails by its data, the failing dataset alone is narrowed down
        (``plans.partitioned.isolated``): the checks and partitions at fault get
        error rows, all others their results.
        """
        run_id = run_id or str(uuid.uuid4())
        run_ts = run_ts or _dt.datetime.now()
        pieces, skipped = self._pieces(specs, run_id, run_ts)
        results = self._union([p for _, p in pieces])
        if self.store is not None:
            try:
                seq = tried(lambda: self.store.save_results(results))
            except DataError:  # isolate the failing dataset, then the failing checks and partitions
                seq = self.store.save_results(self._union([self._settled(spec, p, run_id, run_ts) for spec, p in pieces]))
            results = self.store.written(seq)
            self.store.update_checkpoints(checkpoints_from_results(results))
        diagnose = None
        if self.enable_diagnostics:
            hist = self._history() if self.store is not None else results
            fails = results.where(~F.col("passed"))

            def diagnose():
                return analyze(hist, self.lineage, failures=fails, declared={x.name: [c.name for c in x.checks] for x in specs})

        return RunOutcome(run_id, results, run_summary(results), skipped, diagnose)

    def _settled(self, spec: DatasetSpec, piece: DataFrame, run_id: str, run_ts) -> DataFrame:
        """The results of one dataset, kept as they are if they can be computed."""
        try:
            return tried(lambda: materialize(piece, "settled"))
        except DataError:
            return self._isolate(spec, run_id, run_ts, self._checkpoints(), self._history())

    def _isolate(self, spec: DatasetSpec, run_id: str, run_ts, checkpoints: DataFrame, history: DataFrame) -> DataFrame:
        """Results of a failing dataset with error rows for the checks and partitions at fault."""
        options = {"dataset": spec.name, "run_id": run_id, "run_ts": run_ts}

        def error(checks, values):
            return error_results(self.spark, checks, partitions=values, **options)

        def named():
            df, listed, extra = self.scope(spec, checkpoints, history)
            if listed is None:
                p = F.col(spec.partition_col)
                listed = sorted({r[0] for r in df.select(p.cast("string")).distinct().collect() if r[0] is not None} | set(extra))
            return df, listed

        try:
            df, listed = tried(named)
        except DataError:  # not even the partitions can be told: one error row for each check
            return error(spec.checks, [None])

        def make(checks, values):
            if spec.path is not None:
                return check_partitions(self.spark, spec.path, checks, partitions=values, partition_col=spec.partition_col, **options)
            return check_results(df, checks, partitions=values, partition_col=spec.partition_col, **options)

        return self._union(isolated(make, list(spec.checks), listed, error))
