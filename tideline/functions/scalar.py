"""Scalar functions used by checks, diagnosis and reports.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; nothing runs per row in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column | str, den: Column | str, empty: float = 0.0) -> Column:
    """``num / den`` as double, ``empty`` when the denominator is 0.

    ``try_divide`` keeps ANSI mode from raising on a zero divisor.
    """
    ratio = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return F.coalesce(ratio, F.lit(float(empty)))


def strip_prefix(name: Column | str, *prefixes: str) -> Column:
    """Remove every occurrence of each prefix, in order (F1, ``str.replace``)."""
    out = _col(name)
    for p in prefixes:
        out = F.replace(out, F.lit(p), F.lit(""))
    return out


def fixed(x: Column | str, digits: int) -> Column:
    """Python ``f"{x:.Nf}"``: round half-even on the exact binary value.

    ``format_number`` rounds like Python does; only its grouping commas differ.
    """
    return F.regexp_replace(F.format_number(_col(x), digits), ",", "")


def percent(x: Column | str, digits: int = 2) -> Column:
    """Python ``f"{x:.N%}"``: multiply by 100 in double, then fixed, then ``%``."""
    return F.concat(fixed(_col(x) * F.lit(100.0), digits), F.lit("%"))


def py_float_text(x: Column | str) -> Column:
    """Python ``str(float)`` for a double column.

    Spark renders doubles like Java (``1.0E-5``, ``1.5E7``); Python switches to
    exponent form only below 1e-4 or from 1e16 on, with a two-digit exponent.
    The digits are the JVM's own (shortest that read back the same); only the
    point is moved, so no digit is lost or made up.
    """
    c = _col(x)
    java = c.cast("string")  # ddd.ddd, or d.dddE[-]n
    sign = F.when(java.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.regexp_extract(java, r"^-?([0-9.]+)E", 1), r"\.0$|\.", "")
    exp = F.regexp_extract(java, r"E(-?[0-9]+)$", 1).try_cast("int")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)  # 1e-4 <= |x| < 1e-3
    whole = F.rpad(F.substring(digits, F.lit(1), exp + 1), exp + 1, F.lit("0"))
    rest = F.substr(digits, exp + 2)
    large = F.concat(sign, whole, F.lit("."), F.when(rest == "", F.lit("0")).otherwise(rest))  # 1e7 <= |x| < 1e16
    mant = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    size = F.abs(exp).cast("string")
    sci = F.concat(mant, F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size))
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(c), F.lit("nan"))
        .when(c == F.lit(float("inf")), F.lit("inf"))
        .when(c == F.lit(float("-inf")), F.lit("-inf"))
        .when(~java.contains("E"), java)
        .when(exp.between(-4, -1), small)
        .when(exp.between(0, 15), large)
        .otherwise(sci)
    )


def threshold_text(value) -> str:
    """Threshold rendered as text the way results store it.

    Thresholds are driver-side literals, so plain Python ``str`` is exact.
    """
    if isinstance(value, str):
        return value
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    return str(float(value))


def template(text: str, **fields: Column) -> Column:
    """Fill a ``{name}`` text template with columns: ``concat`` of the pieces."""
    import re as _re

    parts: list[Column] = []
    pos = 0
    for m in _re.finditer(r"\{(\w+)\}", text):
        if m.start() > pos:
            parts.append(F.lit(text[pos:m.start()]))
        parts.append(fields[m.group(1)])
        pos = m.end()
    if pos < len(text):
        parts.append(F.lit(text[pos:]))
    return F.concat(*parts)
