"""Fault-injection transforms.

Pure DataFrame -> DataFrame functions: the input is never modified, nothing is
backed up or restored.  Rows are chosen by an exact per-partition fraction of
the key's text (``exact``, the default, see ``tideline.operators.sampling``), or by a
selector expression of the row key (``hash``, map-only, about the fraction);
keys can be of any type.  Never by a driver-side sample.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.selectors import hash_selector
from tideline.operators.sampling import exact_fraction

# Fixed defaults of the injection operators.
DEFAULT_NULL_RATE = 0.30
DEFAULT_KEEP_RATE = 0.30
DEFAULT_BREAK_RATE = 0.15
DEFAULT_MISSING_KEY = 99999


def _selected(df: DataFrame, key: str, rate: float, in_partition: Column, partition_col: str, how: str):
    """(df', flag) where flag marks the chosen rows of the target partition."""
    if how == "hash":
        return df, in_partition & hash_selector(key, rate)
    if how == "exact":
        marked = exact_fraction(df, rate, key=key, partition_col=partition_col, flag="__sel", where=in_partition)
        return marked, F.coalesce(F.col("__sel"), F.lit(False))
    raise ValueError(f"unknown selection {how!r}")


def inject_null_spike(
    df: DataFrame,
    partition: str,
    column: str,
    null_rate: float = DEFAULT_NULL_RATE,
    *,
    key: str,
    partition_col: str = "dt",
    how: str = "exact",
) -> DataFrame:
    """Set ``column`` to NULL in ``null_rate`` of one partition's rows."""
    inp = F.col(partition_col) == F.lit(partition)
    df2, sel = _selected(df, key, null_rate, inp, partition_col, how)
    out = df2.withColumn(column, F.when(sel, F.lit(None)).otherwise(F.col(column)).cast(df.schema[column].dataType))
    return out.select(*df.columns)


def inject_volume_drop(
    df: DataFrame,
    partition: str,
    keep_rate: float = DEFAULT_KEEP_RATE,
    *,
    key: str,
    partition_col: str = "dt",
    how: str = "exact",
) -> DataFrame:
    """Keep only ``keep_rate`` of one partition's rows."""
    inp = F.col(partition_col) == F.lit(partition)
    df2, sel = _selected(df, key, keep_rate, inp, partition_col, how)
    return df2.where(~inp | sel).select(*df.columns)


def inject_referential_break(
    df: DataFrame,
    partition: str,
    column: str,
    break_rate: float = DEFAULT_BREAK_RATE,
    *,
    key: str,
    missing=DEFAULT_MISSING_KEY,
    partition_col: str = "dt",
    how: str = "exact",
) -> DataFrame:
    """Point ``break_rate`` of one partition's foreign keys at a missing value."""
    inp = F.col(partition_col) == F.lit(partition)
    df2, sel = _selected(df, key, break_rate, inp, partition_col, how)
    t = df.schema[column].dataType
    out = df2.withColumn(column, F.when(sel, F.lit(missing).cast(t)).otherwise(F.col(column)))
    return out.select(*df.columns)


@dataclass(frozen=True)
class Fault:
    """One scenario step: ``kind`` in {"null_spike", "volume_drop", "ref_break"}."""

    kind: str
    partition: str
    rate: float
    column: str | None = None
    missing: object = DEFAULT_MISSING_KEY


def inject_scenarios(df: DataFrame, faults: Sequence[Fault], *, key: str, partition_col: str = "dt", how: str = "exact") -> DataFrame:
    """Apply several faults in order (I4); each is a lazy projection/filter."""
    for f in faults:
        if f.kind == "null_spike":
            df = inject_null_spike(df, f.partition, f.column, f.rate, key=key, partition_col=partition_col, how=how)
        elif f.kind == "volume_drop":
            df = inject_volume_drop(df, f.partition, f.rate, key=key, partition_col=partition_col, how=how)
        elif f.kind == "ref_break":
            df = inject_referential_break(
                df, f.partition, f.column, f.rate, key=key, missing=f.missing, partition_col=partition_col, how=how
            )
        else:
            raise ValueError(f"unknown fault kind {f.kind!r}")
    return df
