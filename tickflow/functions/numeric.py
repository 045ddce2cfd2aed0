"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dround(x, k: int) -> Column:
    """Round half-up on the decimal value, as SQL ``round(x::numeric, k)``.

    A double is first fixed to 10 decimals (absorbs last-bit noise of sums and
    quotients), then rounded exactly, so ties such as 0.285 -> 0.29 resolve
    the same way on every engine and every partitioning.  Doubles that no such
    decimal holds (NaN, infinities, 1e28 and more) have no digits to round and
    stay as they are.
    """
    c = (F.col(x) if isinstance(x, str) else x).cast("double")
    return F.coalesce(F.round(c.try_cast("decimal(38,10)"), k).cast("double"), c)
