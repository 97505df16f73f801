"""Telling errors in the data from failures of the cluster.

A check that cannot be evaluated because of its expression or of the rows it reads is a
verdict on the data: an error row.  A lost executor, a full disk or a network that is down says nothing about the
data: the work is tried once more, and if it fails again the run fails, before any checkpoint moves.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark import errors

R = TypeVar("R")

#: classes of SQLSTATE: data exception, cardinality, syntax or analysis, errors of user code
DATA_STATES = ("22", "21", "42", "38", "39")
#: a file that cannot be read: its own fault only if it fails again
FILE_STATES = ("KD",)
_DATA_TYPES = (errors.AnalysisException, errors.ParseException, errors.ArithmeticException, errors.NumberFormatException,
               errors.DateTimeException, errors.ArrayIndexOutOfBoundsException, errors.IllegalArgumentException, errors.PythonException)


class DataError(Exception):
    """What failed did so because of its data or its declaration."""


def states(e: BaseException) -> list[str]:
    """The SQLSTATEs of an exception and of its causes, here and in the JVM."""
    out, seen = [], 0
    while e is not None and seen < 20:
        seen += 1
        if isinstance(e, errors.PySparkException):
            out.append(e.getSqlState() or "")
        java = getattr(e, "_origin", None) or (e if isinstance(e, Py4JJavaError) else None)
        cause = getattr(java, "java_exception", None)
        while cause is not None and seen < 40:
            seen += 1
            try:
                out.append(cause.getSqlState() or "")
            except Py4JError:  # not one of Spark's own
                pass
            cause = cause.getCause()
        e = e.__cause__
    return out


def is_data_error(e: BaseException, files: bool = False) -> bool:
    """Whether data or declaration are at fault; ``files`` counts files that cannot be read as data."""
    if isinstance(e, _DATA_TYPES):
        return True
    return any(s.startswith(DATA_STATES + (FILE_STATES if files else ())) for s in states(e))


def tried(action: Callable[[], R], retries: int = 1) -> R:
    """The result of ``action``; raises ``DataError`` if its data are at fault, else what it raised last."""
    for left in range(retries, -1, -1):
        try:
            return action()
        except DataError:
            raise
        except Exception as e:  # noqa: BLE001 - sorted out below
            if is_data_error(e, files=not left):
                raise DataError(str(e)) from e
            if not left:
                raise
    raise AssertionError
