"""Root-cause analysis as one set-based plan over all failures.

For every analysed failure group ``(run_id, dataset, partition)``:

* R2  source origin: the dataset declares no upstream -> each failed check is
      a cause in the dataset itself, confidence 0.95;
* R3  upstream failure: a direct upstream has failed rows for the same
      partition (any run); a row counts if its column is critical for the
      dataset or its type is volume/referential; confidence 0.90;
* R4  baseline anomaly: a direct upstream with no failed row at all for the
      partition, whose metrics there exceed twice their trailing mean or their
      trailing max; confidence 0.70;
* R5  self origin: the dataset has upstreams but none produced a cause ->
      its own failed checks, confidence 0.75;
* R7  downstream impact: the transitive downstream set of the dataset;
* R8  recommendations; R9 rank and confidence band; R10 MTTR estimate.

The reference runs these as Python loops with one point query per upstream
and metric; here they are joins, anti-joins and one window, planned once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tideline.functions.scalar import fixed, percent, py_float_text, strip_prefix, template
from tideline.operators.baseline import DEFAULT_WINDOW, baseline
from tideline.operators.checks import ERROR_METRIC, NULL_PREFIX, REF_PREFIX
from tideline.operators.lineage import all_downstream
from tideline.session import materialize as write_back
from tideline.sources.lineage import LineageGraph

# Fixed values of the analysis (kept identical to the reference's output).
CONF_SOURCE = 0.95
CONF_UPSTREAM = 0.90
CONF_SELF = 0.75
CONF_BASELINE = 0.70
HIGH_CONFIDENCE = 0.85
MTTR_FEW_CAUSES = 15
MTTR_MANY_CAUSES = 30
MTTR_MANUAL = 120
FEW_CAUSES = 2
# Explanation, reason and recommendation texts.
TEXT_NULL = "High null rate in '{col}': {metric} (threshold: {threshold})"
TEXT_VOLUME = "Row count anomaly: {rows} rows (expected: {threshold})"
TEXT_REFERENTIAL = "Referential integrity broken for '{col}': {metric} orphaned records"
TEXT_OTHER = "{check_name} failed: {metric} vs {threshold}"
TEXT_UPSTREAM = "{check_name} failed (value: {metric})"
TEXT_ANOMALY = "{check_name} anomaly: {metric} vs baseline {mean}"
REC_NULL = "Investigate null spike in '{col}' column - check upstream data source"
REC_VOLUME = "Verify data ingestion for {dataset} - possible incomplete load"
REC_REFERENTIAL = "Update reference data or fix FK constraint on '{col}'"
REC_CAUSE = "Check {cause_dataset} - {reason}"
# Our own text for error rows (the reference raises while formatting them).
TEXT_ERROR = "{check_name} could not be evaluated (check error)"
GROUP = ["run_id", "dataset", "partition"]


def _check_column(name: Column) -> Column:
    return strip_prefix(name, NULL_PREFIX, REF_PREFIX)


def explain_failure(
    check_type: str = "check_type",
    check_name: str = "check_name",
    metric: str = "metric_value",
    threshold: str = "threshold",
) -> Column:
    """Human-readable reason for a failed check row.

    Error rows (metric -1.0) get their own text; the reference would raise
    while formatting them.
    """
    t, n, m, th = F.col(check_type), F.col(check_name), F.col(metric), F.col(threshold)
    null_text = template(TEXT_NULL, col=strip_prefix(n, NULL_PREFIX), metric=percent(m),
                         threshold=percent(th.try_cast("double")))
    volume_text = template(TEXT_VOLUME, rows=m.cast("bigint").cast("string"), threshold=th)
    ref_text = template(TEXT_REFERENTIAL, col=strip_prefix(n, REF_PREFIX), metric=percent(m))
    other_text = template(TEXT_OTHER, check_name=n, metric=py_float_text(m), threshold=th)
    error_text = template(TEXT_ERROR, check_name=n)
    return (
        F.when(m == F.lit(ERROR_METRIC), error_text)
        .when(t == "null_check", null_text)
        .when(t == "volume", volume_text)
        .when(t == "referential", ref_text)
        .otherwise(other_text)
    )


@dataclass(frozen=True)
class Analysis:
    causes: DataFrame
    impact: DataFrame
    recommendations: DataFrame
    mttr: DataFrame


def _cause(df: DataFrame, cause_dataset: Column, reason: Column, conf: float, kind: str, up_ord: Column, item: Column) -> DataFrame:
    return df.select(
        *GROUP,
        cause_dataset.alias("cause_dataset"),
        reason.alias("reason"),
        F.lit(conf).alias("confidence"),
        F.lit(kind).alias("kind"),
        up_ord.cast("int").alias("upstream_ord"),
        item.alias("item"),
    )


def with_declared_order(df: DataFrame, declared: Mapping[str, Sequence[str]] | None, dataset: str, check: str) -> DataFrame:
    """``df`` and ``__declared``: a check's place among those declared for its dataset; the last place if it is not named."""
    last = F.lit(1 << 30)
    places = [(d, c, i) for d, names in (declared or {}).items() for i, c in enumerate(dict.fromkeys(names))]
    if not places:
        return df.withColumn("__declared", last)
    table = df.sparkSession.createDataFrame(places, "__of string, __check string, __place int")  # a row for each declared check
    on = (F.col(dataset) == F.col("__of")) & (F.col(check) == F.col("__check"))
    return df.join(table, on, "left").withColumn("__declared", F.coalesce("__place", last)).drop("__of", "__check", "__place")


def suspected_causes(
    results: DataFrame,
    graph: LineageGraph,
    failures: DataFrame | None = None,
    window: int = DEFAULT_WINDOW,
    upstream_runs: str = "all",
    exclude_errors: bool = False,
    declared: Mapping[str, Sequence[str]] | None = None,
    counted: int | None = None,
) -> DataFrame:
    """``(run_id, dataset, partition, cause_dataset, reason, confidence, kind,
    upstream_ord, item, cause_ord, cause_rank, band)`` (R1-R5, R9).

    ``declared`` names the checks of each dataset in the order they were declared, which is
    the order causes are found in; checks that it lacks follow by name.

    ``upstream_runs="all"`` (default, as the reference) counts upstream
    failures of every run of the partition; ``"latest"`` only those of the
    upstream's most recent run of it.  ``exclude_errors`` keeps error rows out
    of the baselines.  ``counted``: the rows of ``results``, if they have been counted.
    """
    fails = results.where(~F.col("passed")) if failures is None else failures
    fails = fails.select(*GROUP, "check_name", "check_type", "metric_value", "threshold")
    targets = fails.select(*GROUP).distinct()
    edges = graph.edges.select("dataset", "upstream", "ord")
    has_up = edges.select("dataset").distinct()

    # R2: no declared upstream (or an unknown dataset)
    src = fails.join(has_up, "dataset", "left_anti")
    r2 = _cause(src, F.col("dataset"), explain_failure(), CONF_SOURCE, "source", F.lit(-1), F.col("check_name"))

    # Failed rows of a direct upstream in the same partition, any run
    tu = targets.join(edges, "dataset")
    upstream_rows = results
    if upstream_runs == "latest":
        newest = Window.partitionBy("dataset", "partition")
        upstream_rows = (
            results.withColumn("__newest", F.max(F.struct("timestamp", "run_id")).over(newest))
            .where(F.struct("timestamp", "run_id") == F.col("__newest"))
            .drop("__newest")
        )
    elif upstream_runs != "all":
        raise ValueError(f"unknown upstream_runs {upstream_runs!r}")
    up_fail = upstream_rows.where(~F.col("passed")).select(
        F.col("dataset").alias("upstream"),
        "partition",
        F.col("check_name").alias("u_check"),
        F.col("check_type").alias("u_type"),
        F.col("metric_value").alias("u_metric"),
    )
    crit = graph.critical.select("dataset", F.col("column").alias("__col"), F.lit(True).alias("__critical")).distinct()
    r3_rows = (
        tu.join(up_fail, ["upstream", "partition"])
        .withColumn("__col", _check_column(F.col("u_check")))
        .join(crit, ["dataset", "__col"], "left")
        .where(F.col("__critical").isNotNull() | F.col("u_type").isin("volume", "referential"))
    )
    r3 = _cause(
        r3_rows,
        F.col("upstream"),
        template(TEXT_UPSTREAM, check_name=F.col("u_check"), metric=fixed(F.col("u_metric"), 4)),
        CONF_UPSTREAM,
        "upstream",
        F.col("ord"),
        F.col("u_check"),
    )

    # Upstreams without any failed row there -> compare with their baseline
    failed_parts = up_fail.select("upstream", "partition").distinct()
    clean = tu.join(failed_parts, ["upstream", "partition"], "left_anti")
    current = results.select(
        F.col("dataset").alias("upstream"), "partition", "check_name", "metric_value"
    )
    # baselines only for the upstreams R4 will look at, not the whole history
    relevant = clean.select(F.col("upstream").alias("dataset")).distinct()
    base = baseline(results.join(relevant, "dataset", "left_semi"), window, exclude_errors, counted=counted)
    base = base.withColumnRenamed("dataset", "upstream")
    r4_rows = (
        clean.join(current, ["upstream", "partition"])
        .join(base, ["upstream", "check_name", "partition"])
        .where(
            (F.col("baseline_rows") > 0)
            & (
                (F.col("metric_value") > F.col("baseline_mean") * 2)
                | (F.col("metric_value") > F.col("baseline_max"))
            )
        )
    )
    r4 = _cause(
        r4_rows,
        F.col("upstream"),
        template(TEXT_ANOMALY, check_name=F.col("check_name"), metric=fixed(F.col("metric_value"), 4),
                 mean=fixed(F.col("baseline_mean"), 4)),
        CONF_BASELINE,
        "baseline",
        F.col("ord"),
        F.col("check_name"),
    )

    # Has upstreams, none of them yielded a cause
    found = r3.select(*GROUP).unionByName(r4.select(*GROUP)).distinct()
    self_fails = fails.join(has_up, "dataset", "left_semi").join(found, GROUP, "left_anti")
    r5 = _cause(self_fails, F.col("dataset"), explain_failure(), CONF_SELF, "self", F.lit(-1), F.col("check_name"))

    causes = r2.unionByName(r3).unionByName(r4).unionByName(r5)
    kind_ord = F.when(F.col("kind") == "source", 0).when(F.col("kind") == "self", 2).otherwise(1)
    g = Window.partitionBy(*GROUP)
    insertion = g.orderBy(kind_ord, "upstream_ord", "__declared", "item", "reason")
    ranked = g.orderBy(F.col("confidence").desc(), kind_ord, "upstream_ord", "__declared", "item", "reason")
    return with_declared_order(causes, declared, "cause_dataset", "item").select(
        *causes.columns,
        F.row_number().over(insertion).cast("bigint").alias("cause_ord"),
        F.row_number().over(ranked).cast("bigint").alias("cause_rank"),
        F.when(F.col("confidence") > HIGH_CONFIDENCE, F.lit("high")).otherwise(F.lit("medium")).alias("band"),
    )


def downstream_impact(targets: DataFrame, graph: LineageGraph) -> DataFrame:
    """``(run_id, dataset, partition, impacted_dataset, depth)``.

    The closure is walked only from the failed datasets, not the whole graph.
    """
    t = targets.select(*GROUP).distinct()
    down = all_downstream(graph, seeds=t.select("dataset"))
    down = down.select("dataset", F.col("downstream").alias("impacted_dataset"), "depth")
    return t.join(down, "dataset").select(*GROUP, "impacted_dataset", "depth")


def recommendations(failures: DataFrame, causes: DataFrame, declared: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``(run_id, dataset, partition, rec_no, recommendation)``.

    First one line per failed check by type (none for other types), in declared order, then
    one ``Check <dataset> - <reason>`` per cause found in another dataset.
    """
    f = failures.select(*GROUP, "check_name", "check_type")
    name = F.col("check_name")
    text = (
        F.when(F.col("check_type") == "null_check", template(REC_NULL, col=strip_prefix(name, NULL_PREFIX)))
        .when(F.col("check_type") == "volume", template(REC_VOLUME, dataset=F.col("dataset")))
        .when(F.col("check_type") == "referential", template(REC_REFERENTIAL, col=strip_prefix(name, REF_PREFIX)))
    )
    f = with_declared_order(f, declared, "dataset", "check_name")
    per_check = f.select(*GROUP, F.lit(0).alias("__sec"), F.col("__declared").alias("__d"),
                         F.col("check_name").alias("__k"), F.lit(0).alias("__o"), text.alias("recommendation")).where(F.col("recommendation").isNotNull())
    per_cause = causes.where(F.col("cause_dataset") != F.col("dataset")).select(
        *GROUP, F.lit(1).alias("__sec"), F.lit(0).alias("__d"), F.lit("").alias("__k"), F.col("cause_ord").alias("__o"),
        template(REC_CAUSE, cause_dataset=F.col("cause_dataset"), reason=F.col("reason")).alias("recommendation"),
    )
    both = per_check.unionByName(per_cause)
    w = Window.partitionBy(*GROUP).orderBy("__sec", "__d", "__k", "__o", "recommendation")
    return both.select(*GROUP, F.row_number().over(w).cast("bigint").alias("rec_no"), "recommendation")


def mttr(targets: DataFrame, causes: DataFrame) -> DataFrame:
    """``(run_id, dataset, partition, n_causes, estimated_mttr, manual_mttr, time_saved)``."""
    n = causes.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_causes"))
    t = targets.select(*GROUP).distinct().join(n, GROUP, "left")
    cnt = F.coalesce(F.col("n_causes"), F.lit(0)).cast("bigint")
    est = F.when(cnt <= FEW_CAUSES, F.lit(MTTR_FEW_CAUSES)).otherwise(F.lit(MTTR_MANY_CAUSES))
    return t.select(
        *GROUP,
        cnt.alias("n_causes"),
        est.alias("estimated_mttr"),
        F.lit(MTTR_MANUAL).alias("manual_mttr"),
        (F.lit(MTTR_MANUAL) - est).alias("time_saved"),
    )


def analyze(
    results: DataFrame,
    graph: LineageGraph,
    failures: DataFrame | None = None,
    window: int = DEFAULT_WINDOW,
    materialize: bool = True,
    upstream_runs: str = "all",
    exclude_errors: bool = False,
    declared: Mapping[str, Sequence[str]] | None = None,
) -> Analysis:
    """The whole analysis for every failure group at once.

    ``results`` and the lineage tables are read by several branches (upstream
    failures, current metrics, baselines); with ``materialize`` they are written
    once to the shared checkpoint folder.  With ``failures`` given (those of a run, say)
    only the history of the failed datasets' direct upstreams is read and written,
    however old and wide the store is.
    """
    if materialize:
        graph = graph.materialized(with_datasets=False)
        if failures is not None:
            failures = write_back(failures, "rca-failures")
            looked_at = failures.select("dataset").distinct().join(graph.edges.select("dataset", "upstream"), "dataset").select(
                F.col("upstream").alias("dataset")).distinct()
            results = results.join(looked_at, "dataset", "left_semi")
        seen = Observation()
        results = write_back(results.observe(seen, F.count(F.lit(1)).alias("rows")), "rca-history")
    fails = results.where(~F.col("passed")) if failures is None else failures
    causes = suspected_causes(results, graph, fails, window, upstream_runs, exclude_errors, declared,
                              seen.get["rows"] if materialize else None)
    if materialize:  # read by causes, recommendations and MTTR
        causes = write_back(causes, "rca-causes")
    targets = fails.select(*GROUP).distinct()
    return Analysis(
        causes=causes,
        impact=downstream_impact(targets, graph),
        recommendations=recommendations(fails, causes, declared),
        mttr=mttr(targets, causes),
    )
