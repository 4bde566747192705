"""Integer arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """SQL ``a div b``: BIGINT quotient truncated toward zero (Python ``int(a / b)``)."""
    return F.call_function("div", a, b)
