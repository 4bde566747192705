"""Time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tsquality.functions.arith import idiv


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def micros(ts) -> Column:
    """Microseconds since the epoch as BIGINT (F10 works on these)."""
    return F.unix_micros(_c(ts))


def from_micros(us) -> Column:
    return F.timestamp_micros(_c(us))


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def bucket(width: str, ts) -> Column:
    """``time_bucket(width, ts)`` (F1). Widths '1 minute', '1 hour', '15 minutes', ...

    Unit widths map to ``date_trunc``; other widths align to the epoch like
    ``time_bucket`` does, computed on microseconds.
    """
    n, unit = width.split()
    n = int(n)
    unit = unit.rstrip("s")
    if n == 1 and unit in ("minute", "hour", "day"):
        return F.date_trunc(unit, _c(ts))
    step = n * _UNITS[unit] * 1_000_000
    us = micros(ts)
    return from_micros(us - F.pmod(us, F.lit(step)))


_ISO_DATE_PREFIX = r"^\s*\d{4}-\d{2}-\d{2}"
_PLAIN_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_iso_timestamp(s, fallback_plain: bool = False) -> Column:
    """ISO text (``Z``, offsets, ``T`` or space, fractions, date only) to TIMESTAMP, else NULL.

    ``fallback_plain`` adds the ``%Y-%m-%d %H:%M:%S`` retry of the CSV replay path.
    """
    s = _c(s)
    iso = F.when(s.rlike(_ISO_DATE_PREFIX), _try_cast_ts(F.trim(s)))
    if fallback_plain:
        return F.coalesce(iso, F.try_to_timestamp(s, F.lit(_PLAIN_FORMAT)))
    return iso


def _try_cast_ts(s: Column) -> Column:
    return s.try_cast("timestamp")


def iso_format(ts) -> Column:
    """``datetime.isoformat()`` of a UTC time, with ``+00:00``."""
    ts = _c(ts)
    frac = F.when(F.pmod(micros(ts), F.lit(1_000_000)) != 0,
                  F.date_format(ts, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("+00:00"))
