"""Replayable uniform numbers (F13) that DuckDB reproduces exactly.

``uniform01(seed, salt, key)`` is the first 13 hex digits of
``md5(seed:salt:key)`` over 16^13. Draws of one key under different salts are
independent, and so are draws of different keys; 52 bits fit a double exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13
SPAN = float(16 ** HEX_DIGITS)


def digits(seed: int, salt: str, key) -> Column:
    """The hex digits of a draw from a key column (or its name)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:{salt}:"), k.cast("string")).cast("binary"))
    return F.substring(digest, 1, HEX_DIGITS)


def uniform01(seed: int, salt: str, key) -> Column:
    """A number in [0, 1) from a key column (or its name)."""
    return F.conv(digits(seed, salt, key), 16, 10).cast("double") / F.lit(SPAN)


def below(drawn: Column, p: float) -> Column:
    """``uniform01 < p`` by the draw's :func:`digits`, without a number for each row: digits of
    one length stand in the order of their numbers."""
    limit = math.ceil(p * SPAN)  # exact: SPAN is a power of two
    return drawn < F.lit("" if limit <= 0 else "g" if limit >= SPAN else f"{limit:0{HEX_DIGITS}x}")


def with_uniforms(df, seed: int, specs: dict):
    """Add one uniform column per ``name: (salt, key column)``."""
    return df.withColumns({name: uniform01(seed, salt, key) for name, (salt, key) in specs.items()})


def uniform01_sql(seed: int, salt: str, key_sql: str) -> str:
    """The DuckDB form of :func:`uniform01`."""
    digest = f"md5('{seed}:{salt}:' || CAST({key_sql} AS VARCHAR))"
    return f"(CAST(CAST('0x' || substr({digest}, 1, {HEX_DIGITS}) AS BIGINT) AS DOUBLE) / {SPAN})"
