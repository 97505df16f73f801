"""Size-checked broadcast decisions.

A side is broadcast only after an action has measured it: at most ``max_rows`` rows and
``max_bytes`` bytes of keys, summed over all sides that one plan broadcasts.
The measurement reads the keys as they are (no ``distinct``, so no shuffle) and
``limit(n + 1)`` ends it early, so it reads at most about that many rows however
large the side is.  A side that does not fit takes the shuffle path instead;
nothing is remembered between calls, since files can be rewritten in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def max_broadcast_rows(spark) -> int:
    v = spark.conf.get("tideline.broadcast.maxRows", None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_ROWS


def max_broadcast_bytes(spark) -> int:
    v = spark.conf.get("tideline.broadcast.maxBytes", None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_BYTES


def measure(keys: DataFrame, max_rows: int) -> tuple[int, int]:
    """Rows and bytes of a one-column DataFrame, counted up to ``max_rows + 1`` rows."""
    size = F.coalesce(F.octet_length(F.col(keys.columns[0]).cast("string")), F.lit(0)) + 16
    r = keys.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def fitting(sizes: Sequence[tuple[int, int]], max_rows: int, max_bytes: int) -> set[int]:
    """Which sides fit together, smallest first."""
    out, rows, total = set(), 0, 0
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        n, b = sizes[i]
        if rows + n <= max_rows and total + b <= max_bytes:
            out.add(i)
            rows, total = rows + n, total + b
    return out


def at_most(keys: DataFrame, max_rows: int) -> bool:
    """True iff the one-column ``keys`` fit the row bound and the session's byte bound."""
    if max_rows <= 0:
        return False
    n, b = measure(keys, max_rows)
    return n <= max_rows and b <= max_broadcast_bytes(keys.sparkSession)
