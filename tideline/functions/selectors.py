"""Deterministic per-row selectors used by fault injection.

A selector is a pure expression of the row key, so it needs no shuffle, is the
same on every retry of a task, and gives the same rows in SQL engines that
share the arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed selector constants (the test fixtures are defined with them):
# h = (key * 7919 + 13) % 1000, row selected when h < rate * 1000.
SELECTOR_MULTIPLIER = 7919
SELECTOR_OFFSET = 13
SELECTOR_MODULUS = 1000


def hash_unit(key: Column | str) -> Column:
    """``(key * 7919 + 13) % 1000`` as a bigint in ``[0, 1000)`` for a whole-number key,
    a hash of the key's text for any other."""
    k = F.col(key) if isinstance(key, str) else key
    whole = F.typeof(k).isin("tinyint", "smallint", "int", "bigint")
    text = k.cast("string")
    m = text.try_cast("bigint") % F.lit(SELECTOR_MODULUS)  # the remainder first: no large key overflows
    h = F.pmod(m * F.lit(SELECTOR_MULTIPLIER) + F.lit(SELECTOR_OFFSET), F.lit(SELECTOR_MODULUS))
    return F.when(whole, h).otherwise(F.pmod(F.xxhash64(text), F.lit(SELECTOR_MODULUS)))


def hash_selector(key: Column | str, rate: float) -> Column:
    """True for roughly ``rate`` of the rows: ``h < rate * 1000``."""
    return hash_unit(key) < F.lit(float(rate) * SELECTOR_MODULUS)
