"""tsquality: data quality of interval readings (smart-meter style series) on Spark.

Batch and streaming share the same DataFrame operators. Only the per-meter
timer logic of the stream is a stateful processor (``streaming.processor``).
"""

from tsquality.config import QualityConfig

__all__ = ["QualityConfig"]
