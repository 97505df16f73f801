"""Declarative data-quality checks.

A check does not run anything by itself: it contributes aggregate columns to
one shared ``groupBy(partition).agg(...)`` (see ``tideline.plans.fused``) and
turns the aggregated values into ``passed`` / ``metric_value``.  All checks of
a dataset therefore cost one scan and one partial aggregation, however many
there are.

Result vocabulary (fixed values, kept identical to the results table):
    check_type: "null_check", "volume", "referential"
    check_name: "null_rate_<column>", "volume_check", "ref_integrity_<column>"
    threshold:  str(float) for null checks, "<min>-<max>" for volume, "0.0" for
                referential; on an error row "N/A" unless the check has a
                numeric threshold attribute (only null-rate checks do).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalar import safe_ratio, threshold_text

NULL_PREFIX = "null_rate_"
REF_PREFIX = "ref_integrity_"
ERROR_METRIC = -1.0


@dataclass(frozen=True)
class Check:
    """Base of every check (the extension point, C0).

    Subclasses declare the input columns they read and the aggregate columns
    they need; ``outcome`` maps the aggregated columns (and the row count ``n``)
    to ``(passed, metric_value)`` columns.
    """

    name: str
    check_type: str

    def columns(self) -> Sequence[str]:
        return ()

    def aggregates(self) -> Mapping[str, Column]:
        """Aggregate expressions over the partition's rows, keyed by a local name."""
        return {}

    def count_aggregates(self) -> Sequence[str]:
        """Names among ``aggregates`` that are counts: 0, not NULL, on an empty partition."""
        return ()

    def outcome(self, agg: Callable[[str], Column], n: Column) -> tuple[Column, Column]:
        raise NotImplementedError

    @property
    def threshold_text(self) -> str:
        return "N/A"

    @property
    def error_threshold_text(self) -> str:
        return "N/A"


@dataclass(frozen=True)
class NullRateCheck(Check):
    """Share of NULLs in a column; passes iff rate <= threshold.

    An empty partition has rate 0.0 and passes.  NaN is not NULL.
    """

    column: str = ""
    threshold: float = 0.05

    def __init__(self, column: str, threshold: float = 0.05):
        object.__setattr__(self, "name", f"{NULL_PREFIX}{column}")
        object.__setattr__(self, "check_type", "null_check")
        object.__setattr__(self, "column", column)
        object.__setattr__(self, "threshold", float(threshold))

    def columns(self):
        return (self.column,)

    def aggregates(self):
        return {"nulls": F.count_if(F.col(self.column).isNull())}

    def count_aggregates(self):
        return ("nulls",)

    def outcome(self, agg, n):
        rate = safe_ratio(agg("nulls"), n)
        return rate <= F.lit(self.threshold), rate

    @property
    def threshold_text(self):
        return threshold_text(self.threshold)

    @property
    def error_threshold_text(self):
        return threshold_text(self.threshold)


@dataclass(frozen=True)
class VolumeCheck(Check):
    """Row count within ``[expected_min, expected_max]``, both inclusive."""

    expected_min: int = 0
    expected_max: int = 0

    def __init__(self, expected_min: int, expected_max: int):
        object.__setattr__(self, "name", "volume_check")
        object.__setattr__(self, "check_type", "volume")
        object.__setattr__(self, "expected_min", expected_min)
        object.__setattr__(self, "expected_max", expected_max)

    def outcome(self, agg, n):
        return n.between(F.lit(self.expected_min), F.lit(self.expected_max)), n.cast("double")

    @property
    def threshold_text(self):
        return f"{self.expected_min}-{self.expected_max}"


@dataclass(frozen=True)
class ReferentialCheck(Check):
    """Share of rows whose key has no match in the reference; passes iff 0.

    A NULL key never matches, so it counts as an orphan (anti-join semantics).
    Duplicate reference keys do not matter: the key set is de-duplicated.
    """

    foreign_key: str = ""
    reference: DataFrame | None = field(default=None, compare=False, hash=False)
    reference_key: str = ""

    def __init__(self, foreign_key: str, reference: DataFrame, reference_key: str | None = None):
        object.__setattr__(self, "name", f"{REF_PREFIX}{foreign_key}")
        object.__setattr__(self, "check_type", "referential")
        object.__setattr__(self, "foreign_key", foreign_key)
        object.__setattr__(self, "reference", reference)
        object.__setattr__(self, "reference_key", reference_key or foreign_key)

    def columns(self):
        return (self.foreign_key,)

    def raw_keys(self) -> DataFrame:
        """Non-null reference keys, repeated ones included."""
        k = F.col(self.reference_key)
        return self.reference.select(k).where(k.isNotNull())

    def reference_keys(self, alias: str) -> DataFrame:
        """Distinct, non-null reference keys under ``alias``."""
        k = F.col(self.reference_key)
        return self.reference.select(k.alias(alias)).where(k.isNotNull()).distinct()

    def outcome(self, agg, n):
        rate = safe_ratio(agg("orphans"), n)
        return rate == F.lit(0.0), rate

    @property
    def threshold_text(self):
        return threshold_text(0.0)


@dataclass(frozen=True)
class ExpressionCheck(Check):
    """User-defined check from aggregate expressions (C0 extension point).

    ``aggs`` maps local names to aggregate columns; ``metric`` builds the metric
    from ``agg(name)`` and the row count; ``passes`` turns the metric into a
    boolean.  The check type is free text and gets the default explanation.
    """

    aggs: Mapping[str, Column] = field(default_factory=dict, compare=False, hash=False)
    metric: Callable[[Callable[[str], Column], Column], Column] | None = field(
        default=None, compare=False, hash=False
    )
    passes: Callable[[Column], Column] | None = field(default=None, compare=False, hash=False)
    threshold: float | None = None
    needs: tuple[str, ...] = ()
    counts: tuple[str, ...] = ()

    def columns(self):
        return self.needs

    def count_aggregates(self):
        return self.counts

    def aggregates(self):
        return dict(self.aggs)

    def outcome(self, agg, n):
        m = self.metric(agg, n).cast("double")
        return self.passes(m), m

    @property
    def threshold_text(self):
        return "N/A" if self.threshold is None else threshold_text(self.threshold)

    @property
    def error_threshold_text(self):
        return self.threshold_text


def orphan_rows(df: DataFrame, check: ReferentialCheck, broadcast_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose foreign key has no reference match.

    The reference side is reduced to its distinct non-null keys.  When an
    action has proved that set small it is broadcast, so the fact is never
    shuffled and a hot key costs nothing extra; a larger set of integers is broadcast as a
    bitmap if that fits (``plans.bitmaps``); otherwise it is a shuffled
    ``left_anti`` join, where AQE splits a fact partition made large by one
    hot key across several tasks.
    """
    from tideline.plans import bitmaps
    from tideline.plans.broadcast import at_most, max_broadcast_bytes, max_broadcast_rows

    keys = check.reference_keys("__rk")
    limit = max_broadcast_rows(df.sparkSession) if broadcast_rows is None else broadcast_rows
    if at_most(check.raw_keys(), limit):
        keys = F.broadcast(keys)
    elif limit > 0 and bitmaps.is_integral(df, check.foreign_key) and bitmaps.is_integral(check.reference, check.reference_key):
        blocks = bitmaps.key_blocks(check.raw_keys(), max_broadcast_bytes(df.sparkSession))
        if blocks is not None:
            blocks = F.broadcast(blocks.select(F.col("block").alias("__rk"), F.col("words").alias("__rw")))
            key = df[check.foreign_key]
            return df.join(blocks, bitmaps.block_of(key) == blocks["__rk"], "left").where(
                ~bitmaps.has_key(key, F.col("__rw"))).select(*[df[c] for c in df.columns])
    return df.join(keys, df[check.foreign_key] == keys["__rk"], "left_anti")
