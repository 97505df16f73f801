"""Compile the checks of one dataset into one distributed aggregation.

Plan shape for a dataset with null, volume and referential checks::

    scan(dt IN new partitions; only checked columns)
      -> [broadcast left join to each size-checked reference key set]
      -> partial aggregate by dt  (map-side: one row per task and dt)
      -> exchange(dt) -> final aggregate
      -> join from the partition list (zero-row partitions get count 0)
      -> inline(array(struct(check result)...))  one row per check

The fact is scanned once for all checks.  References whose key sets are too
large to broadcast (all broadcast sides together are bounded in rows and bytes)
become bitmaps if their keys are integers and the bitmap fits (``plans.bitmaps``).
The others are not joined row by row: one further scan, however many they are, reduces the
fact to ``(dt, check, key, count)`` by a partial aggregation (a hot key collapses to
one row per task), and only those rows are shuffled against the union of the
reference keys.  Rows with a NULL partition value form a partition of their own
on either path.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.checks import ERROR_METRIC, Check, ReferentialCheck
from tideline.plans.bitmaps import BLOCK_BYTES, block_of, has_key, is_integral, key_blocks
from tideline.plans.broadcast import fitting, max_broadcast_bytes, max_broadcast_rows, measure
from tideline.sources.partitions import partitions_frame
from tideline.sources.store import RESULT_SCHEMA

N = "__n"
# Partition lists up to this length are inlined as an IN list; longer ones
# are broadcast and semi-joined.
MAX_LITERAL_PARTITIONS = 2000


def ts_literal(ts) -> Column:
    """A TIMESTAMP_NTZ literal (no session-zone shift) from a datetime or text."""
    if ts is None:
        return F.localtimestamp()
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(ts)).cast("timestamp_ntz")


@dataclass
class _Plan:
    ok: list[tuple[int, Check]]
    errors: list[tuple[int, Check]]


def resolve(df: DataFrame, checks: Sequence[Check]) -> _Plan:
    """Split checks into resolvable ones and error ones at plan time.

    A check whose columns or aggregate expressions do not resolve against the
    dataset (or whose reference key is missing) becomes an error row instead of
    failing the whole run; nothing is executed here, only analysed.
    """
    cols = set(df.columns)
    ok, errors = [], []
    for i, c in enumerate(checks):
        good = all(x in cols for x in c.columns())
        if good and isinstance(c, ReferentialCheck):
            good = c.reference is not None and c.reference_key in c.reference.columns
        (ok if good else errors).append((i, c))
    # analyse every aggregate at once; only on failure look for the culprit
    exprs = [(i, e) for i, c in ok for e in c.aggregates().values()]
    if exprs:
        try:
            df.agg(*[e.alias(f"__probe{j}") for j, (_, e) in enumerate(exprs)]).schema
        except Exception:
            bad = set()
            for i, c in ok:
                try:
                    df.agg(*[e.alias(f"__probe{j}") for j, e in enumerate(c.aggregates().values())]).schema
                except Exception:
                    bad.add(i)
            errors += [(i, c) for i, c in ok if i in bad]
            ok = [(i, c) for i, c in ok if i not in bad]
    return _Plan(ok, errors)


def agg_name(i: int, local: str) -> str:
    return f"__c{i}_{local}"


def locals_of(c: Check) -> list[str]:
    """Names of the aggregates that a check is computed from, besides the row count."""
    return ["orphans"] if isinstance(c, ReferentialCheck) else list(c.aggregates())


def _key_text(column: Column, kind: str) -> Column:
    """A key as text that is equal exactly when the keys are."""
    if kind in ("double", "float"):
        return (column.cast(kind) + F.lit(0.0)).cast("string")  # -0.0 equals 0.0
    return column.cast(kind).cast("string")


def _common_type(spark, a: str, b: str) -> str:
    """The type that Spark compares the two types in."""
    try:
        return spark.range(0).select(F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("k")).schema["k"].dataType.simpleString()
    except Exception:  # noqa: BLE001
        return "string"


def _shuffled_orphans(fact: DataFrame, checks: Sequence[tuple[int, ReferentialCheck]], partition_col: str) -> DataFrame:
    """Orphans of each partition (``__part``) for all large references, in one scan of the fact."""
    spark = fact.sparkSession
    cells, keys = [], None
    for i, c in checks:
        ref = c.raw_keys()
        kind = _common_type(spark, fact.schema[c.foreign_key].dataType.simpleString(), ref.schema[0].dataType.simpleString())
        cells.append(F.struct(F.lit(i).alias("__chk"), _key_text(F.col(c.foreign_key), kind).alias("__key")))
        own = ref.select(F.lit(i).alias("__chk"), _key_text(F.col(c.reference_key), kind).alias("__key"))
        keys = own if keys is None else keys.unionByName(own)
    pairs = (fact.select(F.col(partition_col).alias("__part"), F.inline(F.array(*cells)))
             .groupBy("__part", "__chk", "__key").agg(F.count(F.lit(1)).alias("__cnt")))
    joined = pairs.join(keys.distinct().withColumn("__hit", F.lit(True)), ["__chk", "__key"], "left")
    missing = F.when(F.col("__hit").isNull(), F.col("__cnt")).otherwise(F.lit(0))
    return joined.groupBy("__part").agg(
        *[F.sum(F.when(F.col("__chk") == i, missing).otherwise(F.lit(0))).alias(agg_name(i, "orphans")) for i, _ in checks])


def check_results(
    df: DataFrame,
    checks: Sequence[Check],
    *,
    dataset: str,
    run_id: str | None = None,
    run_ts=None,
    partitions: Sequence[str] | DataFrame | None = None,
    extra_partitions: Sequence[str] = (),
    partition_col: str = "dt",
    broadcast_rows: int | None = None,
    aggregated: DataFrame | None = None,
    raw: bool = False,
) -> DataFrame:
    """Results of every check on every requested partition of ``df``.

    ``partitions``: ``None`` = the partitions present in ``df`` (taken from the
    aggregate itself, no extra scan) plus ``extra_partitions`` known to exist
    without rows; a list of names = exactly those (names without rows still
    get results, as empty partitions); a one-column DataFrame = the same,
    computed lazily (a small list: it is joined, and the fact semi-joined).
    ``aggregated``: the row count (``__n``) and the checks' aggregates (``agg_name``) of
    each partition, if they are known without a scan; then ``df`` only gives the schema,
    and a check whose aggregates are not among them gets error rows.  ``raw`` returns these
    columns themselves instead of results.
    Returns rows in ``RESULT_SCHEMA``.
    """
    spark = df.sparkSession
    names = [c.name for c in checks]
    if len(set(names)) < len(names):  # results are keyed by check name
        raise ValueError(f"check names repeat: {sorted({n for n in names if names.count(n) > 1})}")
    run_id = run_id or str(uuid.uuid4())
    p = F.col(partition_col)
    plan = resolve(df, checks)
    if broadcast_rows is None:
        broadcast_rows = max_broadcast_rows(spark)

    # --- partition list and the pruned fact ------------------------------
    if partitions is None:
        fact = df
        parts = None
    elif isinstance(partitions, DataFrame):
        parts = partitions.select(F.col(partitions.columns[0]).cast("string").alias(partition_col)).distinct()
        fact = df.join(parts, partition_col, "left_semi")
    else:
        values = list(dict.fromkeys(str(v) for v in partitions))
        parts = partitions_frame(spark, values, partition_col)
        if len(values) <= MAX_LITERAL_PARTITIONS:
            fact = df.where(p.isin(values))  # static partition pruning on file scans
        else:
            # a long list: a semi-join, which dynamic partition pruning applies to
            # file scans; Spark broadcasts the list if its size allows
            fact = df.join(parts, partition_col, "left_semi")

    needed = {partition_col}
    for _, c in plan.ok:
        needed.update(c.columns())
    fact = fact.select(*[F.col(c) for c in df.columns if c in needed])

    # --- referential checks: broadcast when measured small, else pre-aggregate
    aggs: list[Column] = [F.count(F.lit(1)).alias(N)]
    base_fact = fact
    if aggregated is not None:
        have = set(aggregated.columns)
        lost = [(i, c) for i, c in plan.ok if not {agg_name(i, x) for x in locals_of(c)} <= have]
        plan = _Plan([x for x in plan.ok if x not in lost], plan.errors + lost)
    refs = [(i, c) for i, c in plan.ok if isinstance(c, ReferentialCheck)] if aggregated is None else []
    sizes: list[tuple[int, int]] = []
    for i, c in list(refs):
        try:
            sizes.append(measure(c.raw_keys(), broadcast_rows) if broadcast_rows > 0 else (1, 0))
        except Exception:  # noqa: BLE001 - an unreadable reference is an error of this check alone
            refs.remove((i, c))
            plan.ok.remove((i, c))
            plan.errors.append((i, c))
    small = fitting(sizes, broadcast_rows, max_broadcast_bytes(spark))
    shuffled = []
    room = max_broadcast_bytes(spark) - sum(sizes[k][1] for k in small)
    for i, c in [x for k, x in enumerate(refs) if k not in small]:
        whole = broadcast_rows > 0 and is_integral(fact, c.foreign_key) and is_integral(c.reference, c.reference_key)
        blocks = key_blocks(c.raw_keys(), room) if whole else None
        if blocks is None:
            shuffled.append((i, c))
            continue
        room -= blocks.count() * BLOCK_BYTES
        blocks = blocks.select(F.col("block").alias(f"__rk{i}"), F.col("words").alias(f"__rw{i}"))
        fact = fact.join(F.broadcast(blocks), block_of(fact[c.foreign_key]) == blocks[f"__rk{i}"], "left")  # counted: within ``room``
        aggs.append(F.count_if(~has_key(F.col(c.foreign_key), F.col(f"__rw{i}"))).alias(agg_name(i, "orphans")))
    for i, c in [x for k, x in enumerate(refs) if k in small]:
        keys = c.reference_keys(f"__rk{i}").withColumn(f"__rm{i}", F.lit(True))
        fact = fact.join(F.broadcast(keys), fact[c.foreign_key] == keys[f"__rk{i}"], "left")
        aggs.append(F.count_if(F.col(f"__rm{i}").isNull()).alias(agg_name(i, "orphans")))
    for i, c in plan.ok:
        if not isinstance(c, ReferentialCheck):
            for local, e in c.aggregates().items():
                aggs.append(e.alias(agg_name(i, local)))

    stats = fact.groupBy(partition_col).agg(*aggs) if aggregated is None else aggregated
    if shuffled:
        orphans = _shuffled_orphans(base_fact, shuffled, partition_col)
        stats = stats.join(orphans, stats[partition_col].eqNullSafe(orphans["__part"]), "left").drop("__part")

    # zero-row partitions are absent from the aggregate: join from the list
    counters = {N}
    for i, c in plan.ok:
        if isinstance(c, ReferentialCheck):
            counters.add(agg_name(i, "orphans"))
        else:
            counters.update(agg_name(i, local) for local in c.count_aggregates())
    if parts is None:
        full = stats
        if extra_partitions:
            extras = partitions_frame(spark, list(dict.fromkeys(extra_partitions)), partition_col)
            full = stats.join(extras, partition_col, "full")
    else:
        full = parts.join(stats, partition_col, "left")
    full = full.select(
        F.col(partition_col),
        *[F.coalesce(F.col(x), F.lit(0)).cast("bigint").alias(x) if x in counters else F.col(x) for x in stats.columns if x != partition_col],
    )

    if raw:
        return full

    # --- one struct per check, then long rows ------------------------------
    n = F.col(N)
    structs = []
    failed = {i for i, _ in plan.errors}
    for i, c in sorted(plan.ok + plan.errors, key=lambda t: t[0]):
        if i in failed:
            passed, metric, thr = F.lit(False), F.lit(ERROR_METRIC), c.error_threshold_text
        else:
            passed, metric = c.outcome(lambda local, i=i: F.col(agg_name(i, local)), n)
            passed = F.coalesce(passed, F.lit(False))
            thr = c.threshold_text
        structs.append(
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.check_type).alias("check_type"),
                passed.cast("boolean").alias("passed"),
                metric.cast("double").alias("metric_value"),
                F.lit(thr).alias("threshold"),
            )
        )
    long = full.select(F.col(partition_col).alias("partition"), F.inline(F.array(*structs)))
    return long.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset"),
        "partition",
        "check_name",
        "check_type",
        "passed",
        "metric_value",
        "threshold",
        ts_literal(run_ts).alias("timestamp"),
    )


def error_results(
    spark, checks: Sequence[Check], *, dataset: str, partitions: Sequence[str], run_id: str, run_ts=None
) -> DataFrame:
    """Error rows (passed=false, metric=-1.0) for partitions that could not be read."""
    rows = [
        (run_id, dataset, p, c.name, c.check_type, False, ERROR_METRIC, c.error_threshold_text)
        for p in partitions
        for c in checks
    ]
    schema = RESULT_SCHEMA
    base = spark.createDataFrame(rows, ",".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields[:-1]))
    return base.withColumn("timestamp", ts_literal(run_ts))
