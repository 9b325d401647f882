"""Column functions for commit days and log positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MICROS_PER_DAY = 86_400_000_000
UNSET_TIME_MICROS = -62_135_596_800_000_000  # 0001-01-01T00:00:00Z
LOW_32_BITS = 4_294_967_295

COMMIT_TABLE = "_transaction"


def unset_time() -> Column:
    """The instant a file stores where the commit time is unknown."""
    return F.timestamp_micros(F.lit(UNSET_TIME_MICROS))


def effective_time(commit_time: Column, timestamp: Column) -> Column:
    """Commit time, or the decode time where the commit time is unset."""
    return F.coalesce(F.nullif(commit_time, unset_time()), timestamp)


def commit_date(commit_time: Column, timestamp: Column) -> Column:
    """UTC day of a change, whatever the session time zone is."""
    micros = F.unix_micros(effective_time(commit_time, timestamp))
    # Subtracting the remainder first keeps the division exact.
    days = (micros - F.pmod(micros, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def lsn_str(lsn: Column) -> Column:
    """``HI/LO`` text of a position: upper-case hex without padding."""
    return F.format_string("%X/%X", F.shiftrightunsigned(lsn, 32), lsn.bitwiseAND(F.lit(LOW_32_BITS)))


def lsn_value(text: Column) -> Column:
    """Position of a ``HI/LO`` text (the inverse of :func:`lsn_str`)."""
    halves = F.split(text, "/")
    high = F.conv(halves.getItem(0), 16, 10).cast("bigint")
    low = F.conv(halves.getItem(1), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def utc_timestamp(wall_clock: Column) -> Column:
    """Instant of a zone-less timestamp that is known to be in UTC."""
    return F.concat(wall_clock.cast("string"), F.lit("Z")).cast("timestamp")
