"""Numeric text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's float() takes: optional sign, digits with optional point and
# exponent, or inf/infinity/nan, surrounded by blanks. Spark's cast also takes
# '1d' or '2f', which Python refuses, hence the pattern test first.
_FLOAT_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def is_python_float(s) -> Column:
    s = F.col(s) if isinstance(s, str) else s
    return s.rlike(_FLOAT_TEXT)


def parse_float(s) -> Column:
    """``float(s)`` or NULL when Python would raise."""
    s = F.col(s) if isinstance(s, str) else s
    return F.when(is_python_float(s), F.lower(F.trim(s)).try_cast("double"))  # a cast knows inf, infinity and nan
