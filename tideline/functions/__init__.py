"""Column-level helpers (JVM-side expressions only)."""

from tideline.functions.scalar import (
    fixed,
    percent,
    py_float_text,
    safe_ratio,
    strip_prefix,
    threshold_text,
)
from tideline.functions.selectors import hash_selector, hash_unit

__all__ = [
    "fixed",
    "percent",
    "py_float_text",
    "safe_ratio",
    "strip_prefix",
    "threshold_text",
    "hash_selector",
    "hash_unit",
]
