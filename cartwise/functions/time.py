"""Zone-free time arithmetic on microsecond epochs.

Timestamps without a zone (TIMESTAMP_NTZ) are converted by subtracting the epoch, so the
session time zone never shifts a day boundary. Instants (TIMESTAMP) use ``unix_micros``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def to_micros(col: Column | str, dtype: T.DataType) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        # wall-clock parts of a zone-free timestamp; every piece is zone independent
        days = F.unix_date(F.to_date(c)).cast("bigint")
        seconds = F.extract(F.lit("SECOND"), c)  # decimal(8,6): seconds with the fraction
        micros = (seconds * F.lit(1_000_000)).cast("bigint")
        return days * F.lit(MICROS_PER_DAY) + (F.hour(c) * F.lit(3600) + F.minute(c) * F.lit(60)).cast("bigint") * F.lit(1_000_000) + micros
    return F.unix_micros(c)


def _lit(x: Column | int) -> Column:
    return F.lit(x) if isinstance(x, int) else x


def floor_div(a: Column, b: Column | int) -> Column:
    """Exact floor division of integers for ``b > 0`` (SQL ``div`` truncates toward zero)."""
    b = _lit(b)
    multiple = a - F.pmod(a, b)  # a multiple of b, so integral division is exact
    return F.call_function("div", multiple, b)


def ceil_div(a: Column, b: Column | int) -> Column:
    return -floor_div(-a, _lit(b))


def micros_to_days(micros: Column) -> Column:
    """Whole days in a non-negative duration (``timedelta.days``)."""
    return floor_div(micros, MICROS_PER_DAY)


def add_days(ts: Column, days: Column | float | int) -> Column:
    """``ts + days`` as an exact day-time interval; ``days`` may be fractional (micro precision)."""
    d = F.lit(days) if isinstance(days, (int, float)) else days
    seconds = (d.cast("double") * F.lit(86400.0)).cast("decimal(18,6)")
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
