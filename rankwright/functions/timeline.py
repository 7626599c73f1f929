"""Timestamps as exact integers, so they can be bucketed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column, whichever flavour it has.

    A zone-less timestamp is measured by subtraction; going through the session
    zone would fold the repeated hour of a clock change. Whole seconds come from
    the interval, the fraction (the same in every zone) from the timestamp, and
    counting from year 1 keeps both parts non-negative.
    """
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.expr(
            f"cast(cast(`{name}` - timestamp_ntz'0001-01-01' as interval second) as bigint) * 1000000"
            f" - 62135596800000000 + pmod(unix_micros(cast(`{name}` as timestamp)), 1000000)"
        )
    return F.unix_micros(F.col(name))
