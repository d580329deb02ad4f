"""Recency predicates on relative offsets (negative = before the application)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import _c


def within(offset: Column | str, limit: int, strict: bool = False) -> Column:
    """Offset no older than ``limit``; rows without an offset do not qualify."""
    return _c(offset) > -limit if strict else _c(offset) >= -limit


def since(ts: Column | str, anchor: str, limit: int, strict: bool = False) -> Column:
    """The same window on a timestamp: a comparison with a constant, so scans skip row groups."""
    oldest = datetime.date.fromisoformat(anchor) - datetime.timedelta(days=limit - 1 if strict else limit)
    return _c(ts) >= F.lit(oldest.isoformat()).cast("timestamp_ntz")


def day_offset(ts: Column | str, anchor: str) -> Column:
    """Days from ``anchor`` to ``ts``: negative in the past."""
    return F.datediff(_c(ts), F.lit(anchor).cast("date"))
