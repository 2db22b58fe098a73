"""Zone-free conversions between TIMESTAMP_NTZ (UTC wall clock) and instants.

Streaming watermarks need TIMESTAMP (an instant). The input tables hold UTC
wall clocks as TIMESTAMP_NTZ. A plain cast between the two goes through the
session time zone, which shifts values and is ambiguous around DST changes;
these helpers go through explicit UTC fields and epoch arithmetic instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000


def ntz_to_instant(ts: Column) -> Column:
    """UTC wall clock (NTZ) -> the same instant as TIMESTAMP."""
    return F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
                            F.extract(F.lit("SECOND"), ts), F.lit("UTC"))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP instant -> its UTC wall clock as TIMESTAMP_NTZ."""
    us = F.unix_micros(ts)
    days = F.floor(us / F.lit(_MICROS_PER_DAY)).cast("bigint")
    rem = us - days * F.lit(_MICROS_PER_DAY)
    secs = rem.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(18,0)")
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), secs.cast("decimal(18,6)")))
